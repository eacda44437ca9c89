"""The raw -> Bronze -> Silver -> Gold batch job.

Each stage can run on its own from the published version of the stage before.  Tables are refreshed in
full.  A stage writes a new version of its layer, checks what it wrote, and only then makes it the
current one (see ``versions``), so a failure at any point leaves the last good version readable as a
whole, and runs that overlap do each other no harm.  The caller owns the session, which must use UTC.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone
from decimal import Decimal

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyforge.operators.dimension import BROADCAST_BYTES, text_bytes
from tallyforge.operators.reconcile import reconcile_counts, require_reconciled
from tallyforge.plans import gold as questions
from tallyforge.plans import quality, silver, summaries
from tallyforge.sources import provenance, quarantine, tables, versions
from tallyforge.sources.scoped import persisted

# Business tables are independent small jobs; a few at a time keep the cluster busy.
CONCURRENT_WRITES = 4
METRICS_SCHEMA = (
    "row_count long, missing_merchant_id long, unmatched_merchant_lookup long, "
    "unknown_category long, unknown_city long, unknown_state long, denied long, "
    "unknown_authorization long, nonpositive_amount long, total_amount decimal(38,2), "
    "unknown_installments long, ambiguous_merchant_ids long"
)


def _now() -> datetime:
    return datetime.now(timezone.utc)


def _require_utc(spark: SparkSession) -> None:
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC"):
        raise ValueError(f"spark.sql.session.timeZone must be UTC, not {zone}")


def run_bronze(
    spark: SparkSession,
    raw_dir: str,
    bronze_dir: str,
    transactions_file: str = "historical_transactions.parquet",
    merchants_file: str = "merchants.csv",
    spread: int | None = None,
    most_rejected: int | None = None,
) -> None:
    """Copy both sources with load metadata and record their digests.

    ``spread`` deals the transactions over so many files, which is for a raw file that Spark cannot
    split; otherwise the session's settings for files decide.

    Lines of the merchants' file that do not fit its header are not loaded but published beside it, as
    ``rejected_merchants`` with file, line and reason; more than ``most_rejected`` end the stage.
    """
    transactions = f"{raw_dir}/{transactions_file}"
    merchants = f"{raw_dir}/{merchants_file}"
    tables.require_paths(spark, [transactions, merchants], "Bronze")
    loaded_at = _now()
    with versions.new_version(spark, bronze_dir) as folder:
        read = tables.read_parquet(spark, transactions)
        described = tables.with_load_metadata(read, "bronze", loaded_at, source_file=True)
        _write_all(
            spark,
            described.repartition(spread) if spread else described,
            f"{folder}/historical_transactions",
            read.count,  # from file footers
        )
        schema = quarantine.text_schema(spark, merchants)
        _load_checked(
            spark,
            quarantine.read_flagged_csv(spark, merchants, schema),
            f"{folder}/merchants",
            f"{folder}/rejected_merchants",
            loaded_at,
            most_rejected,
        )
        sources = {transactions_file: transactions, merchants_file: merchants}
        digests = provenance.manifest(spark, sources)
        digests.coalesce(1).write.json(f"{folder}/provenance.json")


def _write_all(spark: SparkSession, frame: DataFrame, path: str, read_rows: Callable[[], int]) -> None:
    """Write ``frame`` and compare the rows written with those read."""
    tables.write_parquet(frame, path)
    read, written = read_rows(), tables.read_parquet(spark, path).count()
    if read != written:
        raise ValueError(f"{path.rsplit('/', 1)[1]}: {read} rows read, {written} written")


def _load_checked(
    spark: SparkSession,
    flagged: DataFrame,
    accepted_path: str,
    rejected_path: str,
    loaded_at: datetime,
    most_rejected: int | None,
) -> None:
    """Parse delimited text once, and write its accepted and its rejected lines from that."""
    name = accepted_path.rsplit("/", 1)[1]
    parsed = f"{accepted_path}_parsed"
    seen = Observation(name)
    named = flagged.withColumn("_file", F.col("_metadata.file_name"))
    tables.write_parquet(named.observe(seen, F.count(F.lit(1)).alias("rows")), parsed)
    whole = tables.read_parquet(spark, parsed)
    rejected = quarantine.divided(whole).rejected
    tables.write_parquet(tables.with_load_metadata(rejected, "bronze", loaded_at), rejected_path)
    accepted = whole.filter(F.col(quarantine.REJECTED).isNull()).drop(quarantine.REJECTED)
    accepted = accepted.withColumnRenamed("_file", "source_file_name")
    tables.write_parquet(tables.with_load_metadata(accepted, "bronze", loaded_at), accepted_path)
    kept, left = (tables.read_parquet(spark, p).count() for p in (accepted_path, rejected_path))
    lines = seen.get["rows"]
    if lines != whole.count():  # a task that was repeated may have reported twice
        lines = flagged.select(*flagged.columns[:1], quarantine.REJECTED).count()
    if lines != kept + left:
        raise ValueError(f"{name}: {lines} lines read, {kept} written and {left} rejected")
    if most_rejected is not None and left > most_rejected:
        reasons = rejected.groupBy("reason").count().orderBy(F.desc("count"), "reason").limit(5).collect()
        told = ", ".join(f"{r['reason']}: {r['count']}" for r in reasons)
        raise ValueError(f"{name}: {left} lines rejected, {most_rejected} allowed ({told})")
    tables.remove(spark, parsed)


def run_silver(
    spark: SparkSession,
    bronze_dir: str,
    silver_dir: str,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> dict:
    """Write validated, enriched attempts in one pass; returns the quality metrics.

    The written lookup is measured and broadcast up to ``broadcast_bytes``; beyond that the same
    join merges.
    """
    _require_utc(spark)
    names = ("historical_transactions", "merchants")
    sources = [versions.table_path(spark, bronze_dir, name) for name in names]
    tables.require_paths(spark, sources, "Silver")
    loaded_at = _now()
    raw = tables.read_parquet(spark, sources[0])
    merchants = tables.read_parquet(spark, sources[1])
    typed = silver.typed_attempts(raw)
    with versions.new_version(spark, silver_dir) as folder:

        def put(frame: DataFrame, name: str) -> DataFrame:
            path = f"{folder}/{name}"
            tables.write_parquet(tables.with_load_metadata(frame, "silver", loaded_at), path)
            return tables.read_parquet(spark, path)

        # The lookup is joined from its written form: measured exactly, and a plain scan.
        lookup = put(silver.merchant_lookup(merchants), "merchant_lookup")
        conflicts = put(silver.merchant_conflicts(merchants), "merchant_conflicts")
        names = lookup.drop("silver_load_timestamp")
        enriched = silver.enrich(typed, names, text_bytes(names) <= broadcast_bytes)

        # Counters ride on the write, as its last step, where a task counts only once.
        observed = Observation("silver")
        counted = enriched.observe(
            observed, *silver.contract_counts()[1:], *quality.quality_counts()
        )
        written = put(counted, "transactions")
        counts = dict(observed.get)
        source_rows, written_rows = raw.count(), written.count()  # from file footers
        if counts["row_count"] != written_rows:
            again = written.agg(*silver.contract_counts()[1:], *quality.quality_counts())
            counts = again.first().asDict()
        silver.enforce_contract(counts)
        if source_rows != written_rows:
            raise ValueError(
                f"enrichment changed the row count from {source_rows} to {written_rows}"
            )
        metrics = {k: n for k, n in counts.items() if not k.startswith("invalid_")}
        merchants_counted = conflicts.agg(F.count_distinct("merchant_id"))
        metrics["ambiguous_merchant_ids"] = merchants_counted.first()[0]
        _write_metrics(spark, metrics, f"{folder}/dq.json")
    return metrics


def _write_metrics(spark: SparkSession, metrics: dict, path: str) -> None:
    def literal(value):
        return F.lit(str(value) if isinstance(value, Decimal) else value)

    row = spark.range(1).select(*(literal(n).alias(k) for k, n in metrics.items()))
    tables.write_json(row, path)


def run_gold(spark: SparkSession, silver_dir: str, gold_dir: str) -> dict:
    """Write all business and quality tables; returns the reconciliation.

    Silver is scanned three times: for the two stored summaries, from which every business table is
    rolled up, and for the warning samples.  Its side of the reconciliation is what Silver recorded about
    itself when it was written.
    """
    _require_utc(spark)
    names = ("transactions", "merchant_conflicts", "dq.json")
    needed = [versions.table_path(spark, silver_dir, name) for name in names]
    tables.require_paths(spark, needed, "Gold")
    loaded_at = _now()
    attempts = tables.read_parquet(spark, needed[0])
    metrics = tables.read_json(spark, needed[2], METRICS_SCHEMA)
    conflicts = tables.read_parquet(spark, needed[1]).drop("silver_load_timestamp")
    with versions.new_version(spark, gold_dir) as folder:

        def put(
            frame: DataFrame, name: str, single_file: bool = False, cluster: Sequence[str] = ()
        ) -> DataFrame:
            path = f"{folder}/{name}"
            described = tables.with_load_metadata(frame, "gold", loaded_at)
            if cluster:
                tables.write_clustered(described, path, cluster)
            else:
                tables.write_parquet(described, path, single_file)
            return tables.read_parquet(spark, path)

        def at_once(*writes: Callable[[], DataFrame]) -> list[DataFrame]:
            run = inheritable_thread_target(spark)(lambda write: write())
            with ThreadPoolExecutor(CONCURRENT_WRITES) as pool:
                return list(pool.map(run, writes))

        small, merchant = f"{folder}/small_summary", f"{folder}/merchant_summary"
        at_once(
            lambda: summaries.small_summary(attempts).write.partitionBy("grouping_set").parquet(small),
            lambda: summaries.merchant_summary(attempts).write.parquet(merchant),
            lambda: put(quality.warning_samples(attempts), "data_quality_warning_samples", True),
            lambda: put(conflicts, "data_quality_merchant_conflicts"),
        )
        # Most questions ask the small summary, which is therefore kept for as long as they do.
        with persisted(tables.read_parquet(spark, small)) as (kept,):
            by = summaries.stored_summaries(kept, tables.read_parquet(spark, merchant))
            written = at_once(
                *(lambda q=q: put(q.ask(by), q.name, q.bounded, q.cluster) for q in questions.QUESTIONS)
            )
            numbers = put(summaries.merchant_numbers(by), "merchant_numbers")
            maps = at_once(
                lambda: put(summaries.city_maps(by), "city_maps"),
                lambda: put(
                    summaries.merchant_maps(by, numbers.drop("gold_load_timestamp")), "merchant_maps"
                ),
            )
            put(summaries.active_counts(*maps, "year_month"), "active_by_month", True)
            put(summaries.active_counts(*maps), "active_overall", True)
        cities = dict(zip((q.name for q in questions.QUESTIONS), written))["q5_cities"]
        recorded = metrics.select("row_count", "total_amount").first()
        result = require_reconciled(
            reconcile_counts(
                recorded["row_count"],
                recorded["total_amount"],
                cities,
                "all_attempt_count",
                "all_attempt_amount",
            )
        )
        _write_metrics(spark, result, f"{folder}/reconciliation.json")
        gold_rows = spark.range(1).select(F.lit(result["gold_count"]).alias("gold_count"))
        put(quality.quality_summary(metrics, gold_rows), "data_quality_summary", True)
    return result


def run_all(
    spark: SparkSession, raw_dir: str, bronze_dir: str, silver_dir: str, gold_dir: str
) -> dict:
    """All three stages in one session; a failure stops the rest."""
    run_bronze(spark, raw_dir, bronze_dir)
    run_silver(spark, bronze_dir, silver_dir)
    return run_gold(spark, silver_dir, gold_dir)
