"""The registered queries as SQL over the driver tables, written independently of the operators."""

from __future__ import annotations

# Check, counter and description of the quality summary.
LINES = (
    ("Rows processed", "row_count", "Silver rows evaluated by the quality checks."),
    ("Rows dropped", "rows_dropped", "Rows not conserved between Silver and reconciled Gold."),
    (
        "Missing merchant ID",
        "missing_merchant_id",
        "Transactions without a merchant identifier; name falls back to Unknown merchant.",
    ),
    (
        "Unmatched merchant lookup",
        "unmatched_merchant_lookup",
        "Transactions without a matching merchant metadata row; merchant ID is used as the name.",
    ),
    (
        "Merchant identity collisions",
        "ambiguous_merchant_ids",
        "Merchant IDs associated with more than one nonblank source name.",
    ),
    (
        "Unknown category",
        "unknown_category",
        "Null or blank categories retained as Unknown category.",
    ),
    ("Unknown city", "unknown_city", "Null or -1 transaction city identifiers."),
    ("Unknown state", "unknown_state", "Null or -1 transaction state identifiers."),
    (
        "Denied authorization",
        "denied",
        "Valid denied attempts retained for recorded-attempt analysis.",
    ),
    ("Unknown authorization", "unknown_authorization", "Authorization values outside Y and N."),
    ("Nonpositive amount", "nonpositive_amount", "Purchase amounts less than or equal to zero."),
    (
        "Unknown installments",
        "unknown_installments",
        "Null, negative, or sentinel 999 installment values.",
    ),
)

SILVER = """
raw_merchants AS (
  SELECT 'M_' || s_suppkey AS merchant_id,
         CASE WHEN s_suppkey % 33 = 5 THEN '  ' ELSE s_name END AS merchant_name
  FROM supplier WHERE s_suppkey % 20 <> 7
  UNION ALL
  SELECT 'M_' || s_suppkey, 'Alias ' || s_name FROM supplier WHERE s_suppkey % 25 = 3
  UNION ALL
  SELECT NULL, 'Orphan'
),
names AS (
  SELECT merchant_id, count(DISTINCT nullif(trim(merchant_name, ' '), '')) AS n,
         min(nullif(trim(merchant_name, ' '), '')) AS only_name
  FROM raw_merchants GROUP BY merchant_id
),
lookup AS (
  SELECT merchant_id,
         CASE WHEN merchant_id IS NULL THEN 'Unknown merchant'
              WHEN n = 1 THEN only_name ELSE merchant_id END AS merchant_name,
         n > 1 AS merchant_name_ambiguous,
         true AS merchant_lookup_matched
  FROM names
),
attempts AS (
  SELECT CASE WHEN l_orderkey % 97 <> 0 THEN 'M_' || l_suppkey END AS merchant_id,
         l_shipdate + to_hours(CAST((18 + l_orderkey % 8 + l_partkey % 8) % 24 AS INTEGER))
           AS purchase_date,
         CAST(CASE WHEN l_orderkey % 499 = 0 THEN 0
                   WHEN l_orderkey % 503 = 0 THEN -l_extendedprice
                   ELSE l_extendedprice END AS DECIMAL(28,2)) AS purchase_amount,
         CASE WHEN l_orderkey % 89 = 0 THEN -1 WHEN l_orderkey % 101 = 0 THEN NULL
              ELSE CAST(c_nationkey AS BIGINT) END AS city_id,
         CASE WHEN l_orderkey % 83 = 0 THEN -1 WHEN l_orderkey % 103 = 0 THEN NULL
              ELSE CAST(n_regionkey AS BIGINT) END AS state_id,
         CASE WHEN l_partkey % 53 = 0 OR l_partkey % 59 = 0 THEN 'Unknown category'
              ELSE l_returnflag END AS category,
         CASE WHEN l_orderkey % 211 = 0 THEN 999 WHEN l_orderkey % 223 = 0 THEN -1
              WHEN l_orderkey % 227 = 0 THEN NULL
              ELSE CAST(l_linenumber - 1 AS BIGINT) END AS installments,
         CASE WHEN l_orderkey % 307 = 0 THEN NULL
              WHEN l_linestatus = 'O' AND l_linenumber <= 2 THEN 'N' ELSE 'Y' END
           AS authorized_flag
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
),
silver AS (
  SELECT a.*, coalesce(l.merchant_name, a.merchant_id, 'Unknown merchant') AS merchant_name,
         coalesce(l.merchant_name_ambiguous, false) AS merchant_name_ambiguous,
         coalesce(l.merchant_lookup_matched, false) AS merchant_lookup_matched,
         strftime(purchase_date, '%Y-%m') AS year_month,
         CAST(purchase_date AS DATE) AS purchase_day,
         hour(purchase_date) AS purchase_hour,
         CASE WHEN installments IN (0, 1) THEN 1
              WHEN installments >= 2 AND installments <> 999 THEN installments END AS plan,
         authorized_flag IS NOT NULL AND authorized_flag = 'Y' AS ok
  FROM attempts a LEFT JOIN lookup l ON a.merchant_id = l.merchant_id
)"""

# The four measures, exact and as compared.
FOUR = """sum(purchase_amount) AS all_amount, count(*) AS all_count,
  sum(CASE WHEN ok THEN purchase_amount ELSE 0 END) AS ok_amount,
  CAST(sum(CASE WHEN ok THEN 1 ELSE 0 END) AS BIGINT) AS ok_count"""
FOUR_OUT = """CAST(all_amount AS DOUBLE) AS all_attempt_amount, all_count AS all_attempt_count,
  CAST(ok_amount AS DOUBLE) AS approved_amount, ok_count AS approved_count"""
SHARE = """round(CASE WHEN sum(ok_amount) OVER () = 0 THEN 0E0
  ELSE CAST(ok_amount AS DOUBLE) / CAST(sum(ok_amount) OVER () AS DOUBLE) END, 12)"""


def _money(column: str) -> str:
    return (
        f"CASE WHEN {column} < 0 THEN '-' ELSE '' END || '$' || "
        f"format('{{:,.2f}}', CAST(abs({column}) AS DOUBLE))"
    )


def _modelled(text: str) -> str:
    return f"coalesce({text}, 'Excluded')"


# Bodies that follow the Silver CTEs; each is "<ctes> SELECT ..." in one string.
Q1 = f"""q1 AS (
  SELECT rank, year_month, city_id, merchant_id, merchant_name, total, attempts FROM (
    SELECT *, row_number() OVER (PARTITION BY year_month, city_id
                                 ORDER BY total DESC, merchant_id NULLS LAST) AS rank
    FROM (SELECT year_month, city_id, merchant_id, merchant_name,
                 sum(purchase_amount) AS total, count(*) AS attempts
          FROM silver GROUP BY ALL)) WHERE rank <= 5
)"""
Q1_OUT = """rank, year_month, city_id, merchant_id, merchant_name,
  CAST(total AS DOUBLE) AS total_amount, attempts AS attempt_count"""
Q2 = """q2 AS (
  SELECT merchant_id, merchant_name AS merchant, state_id,
         round(CAST(sum(purchase_amount) AS DOUBLE) / count(*), 6) AS average_amount,
         row_number() OVER (ORDER BY round(CAST(sum(purchase_amount) AS DOUBLE) / count(*), 6) DESC,
           merchant_id NULLS LAST, state_id NULLS LAST, merchant_name NULLS LAST) AS rank
  FROM silver GROUP BY merchant_id, merchant_name, state_id
)"""
Q3 = """q3 AS (
  SELECT category, rank, printf('%02d00', purchase_hour) AS "hour" FROM (
    SELECT category, purchase_hour,
           row_number() OVER (PARTITION BY category ORDER BY total DESC, purchase_hour) AS rank
    FROM (SELECT category, purchase_hour, sum(purchase_amount) AS total
          FROM silver GROUP BY ALL)) WHERE rank <= 3
)"""
Q4 = """popular AS (
  SELECT merchant_id, merchant_name, count(*) AS global_attempt_count,
         row_number() OVER (ORDER BY count(*) DESC, merchant_id NULLS LAST) AS global_rank
  FROM silver GROUP BY merchant_id, merchant_name QUALIFY global_rank <= 5
),
placed AS (
  SELECT city_id, merchant_id, merchant_name, count(*) AS city_attempt_count,
         row_number() OVER (PARTITION BY city_id
                            ORDER BY count(*) DESC, merchant_id NULLS LAST) AS city_rank
  FROM silver GROUP BY city_id, merchant_id, merchant_name
),
q4 AS (
  SELECT city_id, p.merchant_id, p.merchant_name, city_attempt_count, city_rank,
         global_attempt_count, global_rank,
         round(city_attempt_count / CAST(global_attempt_count AS DOUBLE), 12) AS city_share
  FROM placed JOIN popular p
    ON placed.merchant_id = p.merchant_id AND placed.merchant_name = p.merchant_name
)"""
ASSOCIATION = """cells AS (
  SELECT city_id, category, count(*) AS n FROM silver
  WHERE city_id IS NOT NULL AND city_id <> -1 GROUP BY city_id, category
),
marginals AS (
  SELECT n, sum(n) OVER (PARTITION BY city_id) AS r, sum(n) OVER (PARTITION BY category) AS c,
         sum(n) OVER () AS total
  FROM cells
),
chi AS (
  SELECT greatest(sum(CAST(n AS DOUBLE) * n / (CAST(r AS DOUBLE) * c / total)) - max(total), 0E0)
    AS x FROM marginals
)"""
ASSOCIATION_OUT = """SELECT CAST(sum(n) AS BIGINT) AS population, count(DISTINCT city_id) AS city_count,
       count(DISTINCT category) AS category_count, round((SELECT x FROM chi), 6) AS chi_square,
       round(sqrt((SELECT x FROM chi) / (sum(n)
         * least(count(DISTINCT city_id) - 1, count(DISTINCT category) - 1))), 9) AS cramers_v
FROM cells"""
OVERVIEW = """overview AS (
  SELECT sum(purchase_amount) AS recorded, count(*) AS attempts,
         round(CAST(sum(purchase_amount) AS DOUBLE) / count(*), 6) AS average,
         count(DISTINCT city_id) AS cities, count(DISTINCT year_month) AS months,
         CAST(sum(CASE WHEN ok THEN 1 ELSE 0 END) AS BIGINT) AS accepted,
         sum(CASE WHEN ok THEN purchase_amount ELSE 0 END) AS accepted_amount
  FROM silver
)"""
OVERVIEW_OUT = """SELECT CAST(recorded AS DOUBLE) AS recorded_amount, attempts AS recorded_attempts,
  average AS average_recorded_amount, cities AS city_count, months AS month_count,
  accepted AS approved_attempts, CAST(accepted_amount AS DOUBLE) AS approved_amount,
  attempts - accepted AS denied_attempts, attempts - accepted AS not_approved_attempts,
  round(accepted / CAST(attempts AS DOUBLE), 12) AS approval_rate
FROM overview"""
CITIES = f"""cities AS (
  SELECT city_id, {FOUR_OUT},
         row_number() OVER (ORDER BY ok_amount DESC, city_id NULLS LAST) AS rank,
         {SHARE} AS approved_share
  FROM (SELECT city_id, {FOUR} FROM silver GROUP BY city_id)
)"""
CATEGORIES = f"""categories AS (
  SELECT category, {FOUR_OUT},
         row_number() OVER (ORDER BY ok_amount DESC, category NULLS LAST) AS rank,
         {SHARE} AS approved_share
  FROM (SELECT category, {FOUR} FROM silver GROUP BY category)
)"""
MONTHS = f"""months AS (
  SELECT year_month, {FOUR_OUT}, CAST(d1 AS VARCHAR) AS first_observed_date,
         CAST(d2 AS VARCHAR) AS last_observed_date, days AS observed_days,
         round(CAST(ok_amount AS DOUBLE) / days, 6) AS approved_amount_per_observed_day,
         row_number() OVER (ORDER BY round(CAST(ok_amount AS DOUBLE) / days, 6) DESC, year_month)
           AS exposure_adjusted_rank
  FROM (SELECT year_month, {FOUR}, min(purchase_day) AS d1, max(purchase_day) AS d2,
               count(DISTINCT purchase_day) AS days FROM silver GROUP BY year_month)
)"""
HOURS = f"""hours AS (
  SELECT purchase_hour AS "hour", {FOUR_OUT}, {SHARE} AS approved_share
  FROM (SELECT purchase_hour, {FOUR} FROM silver GROUP BY purchase_hour)
)"""


ACTIVE = """SELECT year_month, count(DISTINCT city_id) AS city_count,
  count(DISTINCT merchant_id) AS merchant_count FROM silver GROUP BY year_month"""
# Events as delimited text with broken lines, and why each of those is broken.
EVENT_LINES = """lines AS (
  SELECT event_id, event_type, CAST(value AS DECIMAL(18,2)) AS v,
    concat_ws(',', event_id, CASE WHEN event_id % 17 = 0 THEN 'x' ELSE '' END || user_id,
      CASE WHEN event_id % 5 = 0 THEN '"' || event_type || ', again"' ELSE event_type END,
      CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 13 = 0 THEN 'n/a'
           ELSE CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) END,
      CASE WHEN event_id % 11 = 0 AND event_id % 7 <> 0 THEN 'more' END) AS line,
    CASE WHEN event_id % 17 = 0 THEN 'user_id is not of type bigint'
         WHEN event_id % 13 = 0 AND event_id % 7 <> 0 THEN 'value is not of type decimal(18,2)'
         WHEN event_id % 11 = 0 OR event_id % 7 = 0 THEN 'wrong number of fields' END AS reason
  FROM events
)"""


def _interval(slots: str) -> str:
    """Best window over a relation ``slots(slot, w)``, by trying every start and length."""
    return f"""slots AS ({slots}),
candidates AS (
  SELECT s.range AS first_slot, l.range AS run, sum(coalesce(w, 0)) AS covered
  FROM range(24) s, range(1, 25) l, range(24) o
  LEFT JOIN slots ON slot = (s.range + o.range) % 24
  WHERE o.range < l.range GROUP BY s.range, l.range
),
best AS (
  SELECT first_slot AS start_hour, (first_slot + run) % 24 AS end_hour, run AS hours,
         CAST(covered AS DOUBLE) AS covered_amount,
         CAST((SELECT sum(w) FROM slots) AS DOUBLE) AS total_approved_amount,
         CAST(covered AS DOUBLE) / CAST((SELECT sum(w) FROM slots) AS DOUBLE) AS raw_share
  FROM candidates
  WHERE CAST(covered AS DOUBLE) / CAST((SELECT sum(w) FROM slots) AS DOUBLE) >= 0.8E0
  ORDER BY run, first_slot LIMIT 1
)"""


INTERVAL = _interval(
    """SELECT purchase_hour AS slot, sum(CASE WHEN ok THEN purchase_amount ELSE 0 END) AS w
       FROM silver GROUP BY purchase_hour"""
)
INTERVAL_OUT = """SELECT start_hour, end_hour, hours, covered_amount, total_approved_amount,
  round(raw_share, 12) AS share, 0.8E0 AS target_share FROM best"""
PLANS = f"""plans AS (
  SELECT plan AS plan_installments,
         CASE WHEN plan IS NULL THEN 'Unknown' WHEN plan = 1 THEN 'Baseline (0/1)'
              ELSE plan || ' payments' END AS installment_plan,
         all_amount, ok_amount, {FOUR_OUT},
         1E0 - pow(0.771E0, plan) AS p,
         CAST(ok_amount AS DOUBLE) * (0.25E0 - 0.5E0 * (1E0 - pow(0.771E0, plan))) AS monthly,
         CASE WHEN plan IS NOT NULL THEN CAST(ok_amount AS DOUBLE) * 0.1355E0 END AS flat
  FROM (SELECT plan, {FOUR} FROM silver GROUP BY plan)
)"""
PLANS_OUT = """SELECT plan_installments, installment_plan, all_attempt_amount, all_attempt_count,
  approved_amount, approved_count, round(p, 12) AS monthly_default_probability,
  CASE WHEN plan_installments IS NOT NULL THEN 0.229E0 END AS flat_lifetime_default_probability,
  round(monthly, 4) AS expected_profit_monthly, round(flat, 4) AS expected_profit_flat_lifetime,
  CASE WHEN approved_amount > 0 THEN round(monthly / approved_amount, 12) END
    AS expected_profit_rate_monthly,
  CASE WHEN approved_amount > 0 THEN round(flat / approved_amount, 12) END
    AS expected_profit_rate_flat_lifetime,
  CASE WHEN approved_amount > 0 AND monthly >= 0 THEN 'Positive'
       WHEN approved_amount > 0 AND monthly < 0 THEN 'Negative' END AS monthly_profitability
FROM plans"""


def _count(condition: str) -> str:
    return f"CAST(sum(CASE WHEN {condition} THEN 1 ELSE 0 END) AS BIGINT)"


UNKNOWN_STATE = "state_id IS NULL OR state_id = -1"
UNKNOWN_PLAN = "installments IS NULL OR installments < 0 OR installments = 999"
CONFLICTS = """conflicts AS (
  SELECT merchant_id, string_agg(DISTINCT nm, ' | ' ORDER BY nm) AS nonblank_names,
         count(DISTINCT nm) AS distinct_name_count
  FROM (SELECT merchant_id, nullif(trim(merchant_name, ' '), '') AS nm FROM raw_merchants)
  GROUP BY merchant_id HAVING count(DISTINCT nm) > 1
)"""
METRICS = f"""metrics AS (
  SELECT count(*) AS row_count, {_count('merchant_id IS NULL')} AS missing_merchant_id,
    {_count('NOT merchant_lookup_matched')} AS unmatched_merchant_lookup,
    {_count("category = 'Unknown category'")} AS unknown_category,
    {_count('city_id IS NULL OR city_id = -1')} AS unknown_city,
    {_count(UNKNOWN_STATE)} AS unknown_state,
    {_count("authorized_flag = 'N'")} AS denied,
    {_count("authorized_flag IS NULL OR authorized_flag NOT IN ('Y', 'N')")}
      AS unknown_authorization,
    {_count('purchase_amount <= 0')} AS nonpositive_amount,
    {_count(UNKNOWN_PLAN)} AS unknown_installments,
    CAST(sum(purchase_amount) AS DOUBLE) AS total_amount,
    (SELECT count(*) FROM conflicts) AS ambiguous_merchant_ids
  FROM silver
)"""

def _line(name: str, counter: str, text: str) -> str:
    count = counter
    if counter == "rows_dropped":
        count = "row_count - (SELECT CAST(sum(n) AS BIGINT) FROM by_city)"
    population = "NULL" if counter == "ambiguous_merchant_ids" else "row_count"
    status = (
        "'Informational'"
        if counter in ("row_count", "denied")
        else f"CASE WHEN {count} = 0 THEN 'Passed' ELSE 'Warning' END"
    )
    return f"""SELECT '{name}' AS check_name, {status} AS status, {count} AS result_count,
  CAST({population} AS BIGINT) AS population_count,
  round(CAST({count} AS DOUBLE) / nullif({population}, 0), 12) AS result_rate,
  '{text}' AS description FROM metrics"""


SUMMARY = f"""{CONFLICTS}, {METRICS},
by_city AS (SELECT city_id, count(*) AS n FROM silver GROUP BY city_id),
summary AS ({' UNION ALL '.join(_line(*line) for line in LINES)})"""

_SAMPLED = [
    ("Missing merchant ID", "merchant_id IS NULL"),
    ("Unmatched merchant lookup", "NOT merchant_lookup_matched"),
    ("Unknown category", "category = 'Unknown category'"),
    ("Unknown state", UNKNOWN_STATE),
    ("Unknown installments", UNKNOWN_PLAN),
]
SAMPLES = f"""tagged AS (
  {' UNION ALL '.join(
      f"SELECT '{name}' AS check_name, silver.* FROM silver WHERE {condition}"
      for name, condition in _SAMPLED)}
),
samples AS (
  SELECT check_name, sample_rank, merchant_id, merchant_name,
         strftime(purchase_date, '%Y-%m-%d %H:%M:%S') AS purchase_date, city_id, state_id,
         category, installments, authorized_flag,
         CAST(purchase_amount AS DOUBLE) AS purchase_amount
  FROM (SELECT *, row_number() OVER (
          PARTITION BY check_name
          ORDER BY merchant_id NULLS LAST, purchase_date NULLS LAST, city_id NULLS LAST,
            state_id NULLS LAST, merchant_name NULLS LAST, category NULLS LAST,
            installments NULLS LAST, authorized_flag NULLS LAST, purchase_amount NULLS LAST
        ) AS sample_rank FROM tagged)
  WHERE sample_rank <= 5
)"""

EVENTS = """ev AS (
  SELECT user_id, event_type, CAST(value AS DECIMAL(28,2)) AS v, CAST(ts AS DATE) AS d,
         hour(ts) AS h FROM events
)"""


def _silver_query(*parts: str) -> str:
    """Silver, then further CTEs, then the final SELECT (last part)."""
    *ctes, last = parts
    return "WITH " + ",\n".join([SILVER.strip(), *ctes]) + "\n" + last


def _source(key: str) -> str:
    return {
        "hour": "purchase_hour",
        "day": "purchase_day",
        "plan_installments": "plan",
    }.get(key, key)


def _grouping_sets() -> str:
    sets = [
        ("city_id+category", {"city_id": "city_id", "category": "category"}),
        ("city_id+year_month", {"city_id": "city_id", "year_month": "year_month"}),
        ("category+hour", {"category": "category", "hour": "purchase_hour"}),
        ("day", {"day": "CAST(purchase_day AS VARCHAR)"}),
        ("plan_installments", {"plan_installments": "plan"}),
    ]
    parts = []
    for label, keys in sets:
        sources = ", ".join(_source(k) for k in keys)
        columns = {
            "city_id": "CAST(NULL AS BIGINT)",
            "category": "CAST(NULL AS VARCHAR)",
            "year_month": "CAST(NULL AS VARCHAR)",
            "hour": "CAST(NULL AS BIGINT)",
            "day": "CAST(NULL AS VARCHAR)",
            "plan_installments": "CAST(NULL AS BIGINT)",
        } | keys
        chosen = ", ".join(f'{expr} AS "{name}"' for name, expr in columns.items())
        parts.append(
            f"SELECT '{label}' AS grouping_set, {chosen}, {FOUR_OUT} "
            f"FROM (SELECT {sources}, {FOUR} FROM silver GROUP BY {sources})"
        )
    return _silver_query(" UNION ALL ".join(parts))


def oracle_sql() -> dict[str, str]:
    q = _silver_query
    q1 = q(Q1, f"SELECT {Q1_OUT} FROM q1")
    overview = q(OVERVIEW, OVERVIEW_OUT)
    months = q(MONTHS, "SELECT * FROM months")
    popular = q(Q4, "SELECT * FROM q4")
    return {
        "q1_top_merchants": q1,
        "silver_enriched": q(
            """SELECT merchant_id, city_id, state_id, category, installments, authorized_flag,
              strftime(purchase_date, '%Y-%m-%d %H:%M:%S') AS purchase_date,
              CAST(purchase_amount AS DOUBLE) AS purchase_amount, merchant_name,
              merchant_name_ambiguous, merchant_lookup_matched FROM silver"""
        ),
        "merchant_lookup": q("SELECT * FROM lookup"),
        "merchant_conflicts": q(CONFLICTS, "SELECT * FROM conflicts"),
        "merchant_conflict_names": q(
            """several AS (SELECT merchant_id FROM names WHERE n > 1)""",
            """SELECT DISTINCT r.merchant_id, trim(merchant_name, ' ') AS nonblank_name
               FROM raw_merchants r JOIN several USING (merchant_id)
               WHERE trim(merchant_name, ' ') <> ''""",
        ),
        "contract_of_unparsed_text": """SELECT count(*) AS row_count,
            count(*) FILTER (event_id % 3 <> 1) AS invalid_date,
            count(*) FILTER (event_id % 5 IN (0, 4)) AS invalid_amount FROM events""",
        "rows_rejected": """SELECT event_type AS category, count(*) AS rejected FROM events
            WHERE event_id % 3 <> 1 OR event_id % 5 IN (0, 4) GROUP BY event_type""",
        "peek_attempts": q(
            """SELECT strftime(purchase_date, '%Y-%m-%d %H:%M:%S') AS purchase_date, merchant_id,
              CAST(purchase_amount AS DOUBLE) AS purchase_amount, city_id, category FROM silver
              ORDER BY silver.purchase_date NULLS LAST, merchant_id NULLS LAST, silver.purchase_amount NULLS LAST,
                city_id NULLS LAST, category NULLS LAST LIMIT 10"""
        ),
        "order_row_digests": """WITH digests AS (
              SELECT o_orderstatus, sha256(concat_ws('|', o_orderkey, o_custkey, o_orderstatus,
                CAST(o_totalprice AS DECIMAL(28,2)), CAST(o_orderdate AS DATE), o_orderpriority)) AS d
              FROM orders),
            words AS (
              SELECT o_orderstatus, i, count(*) AS n,
                sum(('0x' || substr(d, 8 * i + 1, 8))::BIGINT) % 4294967296 AS w
              FROM digests, range(8) AS t(i) GROUP BY o_orderstatus, i)
            SELECT o_orderstatus, max(n) AS row_count,
              string_agg(lpad(lower(to_hex(w::BIGINT)), 8, '0'), '' ORDER BY i) AS sha256
            FROM words GROUP BY o_orderstatus""",
        "contract_report": q(
            f"""SELECT count(*) AS row_count, {_count('purchase_date IS NULL')} AS invalid_date,
              {_count('purchase_amount IS NULL')} AS invalid_amount FROM attempts"""
        ),
        "q2_merchant_state": q(Q2, "SELECT rank, merchant, state_id, average_amount FROM q2"),
        "q3_category_hours": q(Q3, "SELECT * FROM q3"),
        "q4_popular_merchants": popular,
        "q4_city_category": q(
            """SELECT city_id, category, count(*) AS attempt_count
               FROM silver GROUP BY city_id, category"""
        ),
        "q4_association": q(ASSOCIATION, ASSOCIATION_OUT),
        "q5_overview": overview,
        "q5_cities": q(CITIES, "SELECT * FROM cities"),
        "q5_categories": q(CATEGORIES, "SELECT * FROM categories"),
        "q5_months": months,
        "q5_hours": q(HOURS, "SELECT * FROM hours"),
        "q5_opening_hours": q(INTERVAL, INTERVAL_OUT),
        "q5_installments": q(PLANS, PLANS_OUT),
        "quality_metrics": q(CONFLICTS, METRICS, "SELECT * FROM metrics"),
        "batch_job_metrics": q(CONFLICTS, METRICS, "SELECT * FROM metrics"),
        "quality_summary": q(SUMMARY, "SELECT * FROM summary"),
        "warning_samples": q(SAMPLES, "SELECT * FROM samples"),
        "reconciliation": q(
            """gold AS (SELECT sum(n) AS n, sum(a) AS a FROM (
                 SELECT city_id, count(*) AS n, sum(purchase_amount) AS a
                 FROM silver GROUP BY city_id))""",
            """SELECT count(*) = max(gold.n) AND sum(purchase_amount) = max(gold.a) AS passed,
              count(*) AS silver_count, CAST(max(gold.n) AS BIGINT) AS gold_count,
              CAST(sum(purchase_amount) AS DOUBLE) AS silver_amount,
              CAST(max(gold.a) AS DOUBLE) AS gold_amount FROM silver, gold""",
        ),
        "measures_grouping_sets": _grouping_sets(),
        "stored_q1_top_merchants": q1,
        "stored_q4_popular_merchants": popular,
        "stored_q5_overview": overview,
        "stored_q5_months": months,
        "authorization_summary": q(
            """SELECT authorized_flag, count(*) AS attempt_count,
              CAST(sum(purchase_amount) AS DOUBLE) AS total_amount
              FROM silver GROUP BY authorized_flag"""
        ),
        "q1_first_rows": q(
            Q1,
            f"""SELECT {Q1_OUT} FROM q1
              ORDER BY year_month, city_id NULLS FIRST, rank LIMIT 5""",
        ),
        "q1_months": q(Q1, "SELECT DISTINCT year_month FROM q1 WHERE year_month IS NOT NULL"),
        "q1_cities_of_month": q(
            Q1,
            """SELECT DISTINCT city_id FROM q1
               WHERE year_month = '1998-06' AND city_id IS NOT NULL""",
        ),
        "q1_city_month_slice": q(
            Q1,
            f"""SELECT rank, strftime(strptime(year_month, '%Y-%m'), '%b %Y') AS "month", city_id,
              merchant_name, CAST(total AS DOUBLE) AS total_amount, {_money('total')}
                AS total_label, attempts AS attempt_count
              FROM q1 WHERE year_month = '1998-06' AND city_id = 3""",
        ),
        "stored_q1_city_month_slice": q(
            Q1,
            f"""SELECT rank, strftime(strptime(year_month, '%Y-%m'), '%b %Y') AS "month", city_id,
              merchant_name, CAST(total AS DOUBLE) AS total_amount, {_money('total')}
                AS total_label, attempts AS attempt_count
              FROM q1 WHERE year_month = '1998-06' AND city_id = 3""",
        ),
        "active_by_month": q(ACTIVE),
        "stored_active_by_month": q(ACTIVE),
        "active_overall": q(
            "SELECT count(DISTINCT city_id) AS city_count, count(DISTINCT merchant_id) AS merchant_count FROM silver"
        ),
        "csv_rejected_by_reason": f"""WITH {EVENT_LINES}
            SELECT reason, count(*) AS line_count, min(line) AS first_line
            FROM lines WHERE reason IS NOT NULL GROUP BY reason""",
        "csv_accepted_by_type": f"""WITH {EVENT_LINES}
            SELECT CASE WHEN event_id % 5 = 0 THEN event_type || ', again' ELSE event_type END AS event_type,
              count(*) AS line_count, CAST(sum(v) AS DOUBLE) AS value
            FROM lines WHERE reason IS NULL GROUP BY ALL""",
        "q4_hundred_merchants": q(Q4.replace("global_rank <= 5", "global_rank <= 100"), "SELECT * FROM q4"),
        "q2_leaders": q(
            Q2,
            "SELECT rank, merchant, state_id, average_amount FROM q2 WHERE rank <= 5",
        ),
        "q2_hundred_leaders": q(
            Q2,
            "SELECT rank, merchant, state_id, average_amount FROM q2 WHERE rank <= 100",
        ),
        "q3_listing": q(Q3, "SELECT * FROM q3"),
        "q4_ordered": q(
            Q4,
            """SELECT *, row_number() OVER (PARTITION BY global_rank
              ORDER BY city_attempt_count DESC, city_id NULLS LAST) AS position FROM q4""",
        ),
        "association_text": q(
            ASSOCIATION,
            """SELECT format('{:.4f}', sqrt((SELECT x FROM chi) / (sum(n)
                * least(count(DISTINCT city_id) - 1, count(DISTINCT category) - 1))))
                AS cramers_v,
              format('{:,}', CAST(sum(n) AS BIGINT)) AS attempts,
              format('{:,}', count(DISTINCT city_id)) AS cities,
              format('{:,}', count(DISTINCT category)) AS categories FROM cells""",
        ),
        "merchant_city_stack": q(
            Q4,
            """SELECT merchant_name, CAST(city_id AS VARCHAR) AS city_label,
              min(global_rank) AS merchant_order, CAST(sum(city_attempt_count) AS BIGINT)
                AS attempts FROM q4 GROUP BY merchant_name, city_id""",
        ),
        "leading_cities": q(CITIES, "SELECT * FROM cities WHERE rank <= 5"),
        "ten_leading_cities": q(CITIES, "SELECT * FROM cities WHERE rank <= 10"),
        "ten_leading_categories": q(CATEGORIES, "SELECT * FROM categories WHERE rank <= 10"),
        "leading_categories": q(
            CATEGORIES,
            """SELECT * FROM categories WHERE category <> 'Unknown category'
               ORDER BY rank LIMIT 2""",
        ),
        "leading_months": q(MONTHS, "SELECT * FROM months WHERE exposure_adjusted_rank <= 5"),
        "months_in_order": q(
            MONTHS,
            """SELECT row_number() OVER (ORDER BY year_month) AS position, year_month,
              strftime(strptime(year_month, '%Y-%m'), '%b %Y') AS "month",
              approved_amount_per_observed_day, observed_days FROM months""",
        ),
        "hours_in_order": q(
            HOURS,
            """SELECT row_number() OVER (ORDER BY "hour") AS position, "hour",
              printf('%02d:00', "hour") AS hour_label, approved_amount,
              approved_count, approved_share FROM hours""",
        ),
        "midnight_bucket": q(HOURS, 'SELECT * FROM hours WHERE "hour" = 0'),
        "charted_plans": q(
            PLANS,
            """SELECT plan_installments, round(monthly / approved_amount, 12)
                AS expected_profit_rate_monthly,
              CASE WHEN monthly >= 0 THEN 'Positive' ELSE 'Negative' END AS monthly_profitability
              FROM plans WHERE plan_installments BETWEEN 1 AND 12 AND approved_amount > 0""",
        ),
        "positive_plan_limit": q(
            PLANS,
            """SELECT max(CASE WHEN monthly >= 0 THEN plan_installments END)
                AS largest_positive_plan,
              min(CASE WHEN monthly < 0 THEN plan_installments END) AS smallest_negative_plan
              FROM plans WHERE approved_amount > 0 AND plan_installments IS NOT NULL""",
        ),
        "installment_report": q(
            PLANS,
            f"""SELECT installment_plan, {_money('ok_amount')} AS approved_exposure,
              {_money('all_amount')} AS all_attempt_exposure,
              {_modelled("format('{:.2f}', 100 * monthly / nullif(approved_amount, 0)) || '%'")} AS monthly_rate,
              {_modelled(_money('CAST(round(monthly, 2) AS DECIMAL(38,2))'))} AS monthly_profit,
              {_modelled(_money('CAST(round(flat, 2) AS DECIMAL(38,2))'))} AS flat_profit
              FROM plans""",
        ),
        "overview_text": q(
            OVERVIEW,
            f"""SELECT format('{{:,}}', attempts) AS attempts, {_money('recorded')} AS amount,
              {_money('average')} AS average, format('{{:,}}', cities) AS cities,
              format('{{:,}}', months) AS months, format('{{:,}}', accepted) AS approved,
              format('{{:.1f}}', 100 * accepted / CAST(attempts AS DOUBLE)) || '%'
                AS approval_rate,
              {_money('accepted_amount')} AS approved_amount,
              format('{{:,}}', attempts - accepted) AS not_approved FROM overview""",
        ),
        "interval_text": q(
            INTERVAL,
            f"""SELECT printf('%02d:00', start_hour) AS opens, printf('%02d:00', end_hour)
                AS closes, hours, {_money('covered_amount')} AS covered,
              format('{{:.1f}}', 100 * raw_share) || '%' AS share FROM best""",
        ),
        "quality_check_value": q(
            SUMMARY,
            "SELECT result_count, result_rate FROM summary WHERE check_name = 'Unknown state'",
        ),
        "sampled_checks": q(SAMPLES, "SELECT DISTINCT check_name FROM samples"),
        "samples_of_check": q(
            SAMPLES, "SELECT * FROM samples WHERE check_name = 'Unknown state'"
        ),
        "conflict_listing": q(
            CONFLICTS,
            """SELECT merchant_id, nonblank_names AS source_names, distinct_name_count
               FROM conflicts""",
        ),
        "load_metadata": """SELECT 'lineitem.parquet' AS source_file_name,
            '2026-01-02 03:04:05' AS bronze_load_timestamp, count(*) AS row_count
            FROM lineitem""",
        "events_top_users_by_type": f"""WITH {EVENTS}
            SELECT event_type, user_id, rank, CAST(total AS DOUBLE) AS all_attempt_amount,
              n AS all_attempt_count
            FROM (SELECT event_type, user_id, sum(v) AS total, count(*) AS n,
                    row_number() OVER (PARTITION BY event_type ORDER BY sum(v) DESC, user_id)
                      AS rank
                  FROM ev GROUP BY event_type, user_id) WHERE rank <= 3""",
        "events_user_rank": f"""WITH {EVENTS}
            SELECT user_id, CAST(sum(v) AS DOUBLE) AS all_attempt_amount,
              row_number() OVER (ORDER BY sum(v) DESC, user_id NULLS LAST) AS rank,
              round(CAST(sum(v) AS DOUBLE) / CAST(sum(sum(v)) OVER () AS DOUBLE), 12)
                AS approved_share
            FROM ev GROUP BY user_id""",
        "events_leader_rank_by_type": f"""WITH {EVENTS},
            leaders AS (
              SELECT user_id, count(*) AS all_events,
                     row_number() OVER (ORDER BY count(*) DESC, user_id) AS overall_rank
              FROM ev GROUP BY user_id QUALIFY overall_rank <= 5),
            places AS (
              SELECT event_type, user_id, count(*) AS events,
                     row_number() OVER (PARTITION BY event_type ORDER BY count(*) DESC, user_id)
                       AS rank_in_type
              FROM ev GROUP BY event_type, user_id)
            SELECT user_id, event_type, events, all_events, overall_rank, rank_in_type
            FROM places JOIN leaders USING (user_id)""",
        "events_type_hour_association": f"""WITH {EVENTS},
            cells AS (SELECT event_type, h, count(*) AS n FROM ev GROUP BY event_type, h),
            expected AS (
              SELECT n, CAST(sum(n) OVER (PARTITION BY event_type) AS DOUBLE)
                * sum(n) OVER (PARTITION BY h) / sum(n) OVER () AS e FROM cells),
            chi AS (SELECT sum(CAST(n AS DOUBLE) * n / e) - sum(n) AS x FROM expected)
            SELECT CAST(sum(n) AS BIGINT) AS population, count(DISTINCT event_type) AS type_count,
              count(DISTINCT h) AS hour_count, round((SELECT x FROM chi), 6) AS chi_square,
              round(sqrt((SELECT x FROM chi) / (sum(n)
                * least(count(DISTINCT event_type) - 1, count(DISTINCT h) - 1))), 9) AS cramers_v
            FROM cells""",
        "events_busiest_hours": f"""WITH {EVENTS},
            {_interval("SELECT h AS slot, sum(v) AS w FROM ev GROUP BY h")}
            {INTERVAL_OUT}""",
        "events_busiest_minutes": """WITH slots AS (
              SELECT 60 * hour(ts) + minute(ts) AS slot, sum(CAST(value AS DECIMAL(28,2))) AS w
              FROM events GROUP BY ALL),
            turns AS (
              SELECT i, coalesce(w, 0) AS w FROM range(2880) t(i) LEFT JOIN slots ON slot = i % 1440),
            sums AS (
              SELECT i, coalesce(sum(w) OVER (ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                AS before, sum(w) OVER (ORDER BY i) AS until FROM turns),
            whole AS (SELECT sum(w) AS total FROM slots),
            runs AS (
              SELECT a.i AS first_slot, b.i - a.i + 1 AS run, b.until - a.before AS covered
              FROM sums a JOIN sums b ON a.i < 1440 AND b.i >= a.i AND b.i < a.i + 1440)
            SELECT CAST(first_slot AS BIGINT) AS start_minute, CAST((first_slot + run) % 1440 AS BIGINT) AS end_minute,
              CAST(run AS BIGINT) AS minutes, CAST(covered AS DOUBLE) AS covered_amount,
              CAST(total AS DOUBLE) AS total_approved_amount,
              round(CAST(covered AS DOUBLE) / CAST(total AS DOUBLE), 12) AS share, 0.8E0 AS target_share
            FROM runs, whole WHERE CAST(covered AS DOUBLE) / CAST(total AS DOUBLE) >= 0.8E0
            ORDER BY run, first_slot LIMIT 1""",
        "events_weekday_exposure": f"""WITH {EVENTS}
            SELECT isodow(d) - 1 AS weekday, CAST(sum(v) AS DOUBLE) AS all_attempt_amount,
              count(*) AS all_attempt_count,
              CAST(sum(CASE WHEN event_type = 'purchase' THEN v ELSE 0 END) AS DOUBLE)
                AS approved_amount,
              CAST(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS BIGINT)
                AS approved_count,
              CAST(min(d) AS VARCHAR) AS first_observed_date,
              CAST(max(d) AS VARCHAR) AS last_observed_date,
              count(DISTINCT d) AS observed_days,
              round(CAST(sum(CASE WHEN event_type = 'purchase' THEN v ELSE 0 END) AS DOUBLE)
                / count(DISTINCT d), 6) AS approved_amount_per_observed_day
            FROM ev GROUP BY isodow(d)""",
        "customer_segment_names": """
            SELECT CAST(c_nationkey AS VARCHAR) AS nation,
              CASE WHEN count(DISTINCT c_mktsegment) = 1 THEN min(c_mktsegment)
                   ELSE CAST(c_nationkey AS VARCHAR) END AS segment,
              count(DISTINCT c_mktsegment) > 1 AS segment_ambiguous,
              CASE WHEN count(DISTINCT c_mktsegment) > 1
                THEN string_agg(DISTINCT c_mktsegment, ' | ' ORDER BY c_mktsegment) END
                AS nonblank_names,
              CASE WHEN count(DISTINCT c_mktsegment) > 1
                THEN count(DISTINCT c_mktsegment) END AS distinct_name_count
            FROM customer GROUP BY c_nationkey""",
    }
