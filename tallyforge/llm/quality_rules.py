"""Quality rules on documents and on their hosts.

Rules are counted on each whole text.  Failures are added up by host, and a host's failure rate is
shrunk towards all hosts by a beta prior fitted to their rates, so that a host of few documents is
not judged on them alone.  The host's verdict goes back to its documents: a host on which most
documents fail the base rules is rejected as a whole; on a host where a further rule fails more
than rarely, the documents that fail it are rejected; elsewhere such a failure counts as a slip.
"""

from __future__ import annotations

from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import same, small, stage

#: Fixed by the contract.
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
LEAST_WORDS = 50
REPEATED_PERCENT = 50

#: Limits of the further rules and of the host verdicts.
SYMBOL_PERCENT = 10
DUPLICATE_LINE_PERCENT = 30
REJECT_RATE = 0.5
SLIP_RATE = 0.01

FACTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
RULES = ("base_failed", "symbols_failed", "lines_failed")
FACT_TYPE = T.StructType([T.StructField(n, T.LongType(), False) for n in FACTS])


def repeated_words(words: list[bytes]) -> int:
    """Words in a window of three that is found twice or more in the text, the first included."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    found = Counter(windows)
    covered, free = 0, 0
    for at, window in enumerate(windows):
        if found[window] > 1:
            covered += at + 3 - max(at, free)
            free = at + 3
    return covered


def facts_of(text: str | None) -> tuple[int, ...]:
    """The counts ``FACTS`` of one text; a null text has none."""
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    return (
        len(words),
        len(text) - sum(map(text.count, SPACES)),
        sum(map(text.count, SYMBOLS)),
        len(lines),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


@F.pandas_udf(FACT_TYPE)
def text_facts(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([facts_of(x) for x in texts], columns=list(FACTS))


def failures() -> dict[str, Column]:
    """Each rule as a condition on the counts; all of them are whole-number comparisons."""
    n = F.col("n_words")
    return {
        "base_failed": (n < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEATED_PERCENT * n),
        "symbols_failed": 100 * F.col("n_symbols") > SYMBOL_PERCENT * n,
        "lines_failed": 100 * F.col("n_dup_lines") > DUPLICATE_LINE_PERCENT * F.col("n_lines"),
    }


def with_failures(documents: DataFrame, text: str = "text") -> DataFrame:
    """Add the counts and the failures; columns of these names are replaced."""
    measured = documents.withColumn("_llm_facts", text_facts(F.col(text)))
    measured = measured.withColumns({n: F.col("_llm_facts")[n] for n in FACTS}).drop("_llm_facts")
    return measured.withColumns(failures())


def host_rates(scored: DataFrame, host: str) -> DataFrame:
    """Each host's rows, failures and shrunk failure rate ``<rule>_rate``, one row a host.

    The prior of a rule has the mean m and variance v of the hosts' rates: alpha + beta is
    m (1 - m) / v - 1, or 0 where that is negative or all rates are equal to 0 or 1; where all
    rates are equal otherwise it makes no difference.  Only the sums go to the driver, one row.
    """
    hosts = stage(
        scored.groupBy(F.col(host).alias("host")).agg(
            F.count(F.lit(1)).alias("n"), *(F.sum(F.col(r).cast("long")).alias(r) for r in RULES)
        ),
        "hosts",
    )
    moments = hosts.agg(
        *(F.avg(F.col(r) / F.col("n")).alias(f"{r}_m") for r in RULES),
        *(F.var_pop(F.col(r) / F.col("n")).alias(f"{r}_v") for r in RULES),
    ).first()

    def shrunk(rule: str) -> Column:
        m, v = moments[f"{rule}_m"] or 0.0, moments[f"{rule}_v"] or 0.0
        weight = max(0.0, m * (1 - m) / v - 1) if v > 0 else 0.0
        return (F.col(rule) + m * weight) / (F.col("n") + weight)

    return hosts.withColumns({f"{r}_rate": shrunk(r) for r in RULES})


def with_verdict(scored: DataFrame, host: str = "source") -> DataFrame:
    """Add ``kept``; ``scored`` comes from ``with_failures`` and should be a stored table.

    Documents without a host are judged as one host of their own.  A null or empty text has no
    words and fails; repeated rows get the same verdict; an empty table gives an empty result.
    """
    rates = stage(host_rates(scored, host).select("host", *(f"{r}_rate" for r in RULES)), "rates")
    scored = scored.drop("kept", *(f"{r}_rate" for r in RULES))
    joined = scored.join(small(rates), scored[host].eqNullSafe(rates["host"])).select(
        scored["*"], *(rates[f"{r}_rate"] for r in RULES)
    )
    against = F.col("base_failed_rate") > REJECT_RATE
    for rule in RULES[1:]:
        against = against | (F.col(rule) & (F.col(f"{rule}_rate") > SLIP_RATE))
    return joined.withColumn("kept", ~F.col("base_failed") & ~against)


def passing(documents: DataFrame) -> DataFrame:
    """The documents with a favourable verdict; columns as given, whatever their names."""
    row = F.struct(*(F.col(f"`{c}`") for c in documents.columns)).alias("_llm_doc")
    scored = with_failures(documents.select(row, "text", "source")).drop("text")
    judged = with_verdict(stage(scored, "scored"))
    return judged.filter("kept").select("_llm_doc.*")


def op10_quality_rules(spark, sf_dir: str) -> DataFrame:
    """Counts, base rules and verdict of every document."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scored = with_failures(documents.select("doc_id", "source", "text")).drop("text")
    judged = with_verdict(stage(scored, "facts"))
    return judged.select("doc_id", "source", *FACTS, *RULES, "kept")


SQL = r"""
WITH body AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM documents),
words AS (
  SELECT r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM body
),
windows AS (
  SELECT r, i, w[i:i+2] AS gram FROM words, unnest(range(1, len(w) - 1)) AS t(i) WHERE len(w) >= 3
),
repeated AS (SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, gram) > 1),
covered AS (
  SELECT r, count(DISTINCT i + d)::BIGINT AS n FROM repeated, unnest([0, 1, 2]) AS t(d) GROUP BY r
),
lines AS (
  SELECT r, unnest(string_split(text, chr(10))) AS line FROM body
),
counted_lines AS (
  SELECT r, count(*)::BIGINT AS n_lines, (count(*) - count(DISTINCT line))::BIGINT AS n_dup_lines
  FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r
),
facts AS (
  SELECT b.r, doc_id, source, len(w)::BIGINT AS n_words,
    length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
    coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines,
    coalesce(c.n, 0) AS n_repeat_words
  FROM body b JOIN words USING (r) LEFT JOIN counted_lines l USING (r) LEFT JOIN covered c USING (r)
),
scored AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    100 * n_symbols > 10 * n_words AS symbols_failed,
    100 * n_dup_lines > 30 * n_lines AS lines_failed
  FROM facts
),
hosts AS (
  SELECT source, count(*) AS n, sum(base_failed::INT) AS b, sum(symbols_failed::INT) AS s,
    sum(lines_failed::INT) AS l
  FROM scored GROUP BY source
),
moments AS (
  SELECT avg(b / n) AS bm, var_pop(b / n) AS bv, avg(s / n) AS sm, var_pop(s / n) AS sv,
    avg(l / n) AS lm, var_pop(l / n) AS lv
  FROM hosts
),
prior AS (
  SELECT bm, CASE WHEN bv > 0 THEN greatest(0, bm * (1 - bm) / bv - 1) ELSE 0 END AS bw,
    sm, CASE WHEN sv > 0 THEN greatest(0, sm * (1 - sm) / sv - 1) ELSE 0 END AS sw,
    lm, CASE WHEN lv > 0 THEN greatest(0, lm * (1 - lm) / lv - 1) ELSE 0 END AS lw
  FROM moments
),
rates AS (
  SELECT source, (b + bm * bw) / (n + bw) AS br, (s + sm * sw) / (n + sw) AS sr,
    (l + lm * lw) / (n + lw) AS lr
  FROM hosts, prior
)
SELECT doc_id, scored.source, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words,
  base_failed, symbols_failed, lines_failed,
  NOT base_failed AND NOT (br > 0.5 OR (symbols_failed AND sr > 0.01) OR (lines_failed AND lr > 0.01)) AS kept
FROM scored JOIN rates ON scored.source IS NOT DISTINCT FROM rates.source
"""
