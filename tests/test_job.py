"""The batch job over folders, and the sources it uses."""

from __future__ import annotations

import hashlib
from datetime import datetime, timezone
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from tests.helpers import RAW_SCHEMA, raw_row, rows

from tallyforge.plans import gold, job, quality, silver, summaries, views
from tallyforge.sources import provenance, tables, versions


@pytest.fixture
def layers(tmp_path):
    return {name: str(tmp_path / name) for name in ("raw", "bronze", "silver", "gold")}


def published(spark, layers, layer, name):
    return spark.read.parquet(versions.table_path(spark, layers[layer], name))


def visible(folder):
    """Names in a folder, without the checksums that local file systems keep."""
    return {p.name for p in Path(folder).iterdir() if not p.name.endswith(".crc")}


def write_raw(spark, folder, attempts, merchants):
    Path(folder).mkdir(parents=True, exist_ok=True)
    spark.createDataFrame(attempts, RAW_SCHEMA).coalesce(1).write.mode("overwrite").parquet(
        f"{folder}/historical_transactions.parquet"
    )
    text = "merchant_id,merchant_name\n" + "".join(f"{k},{n}\n" for k, n in merchants)
    Path(folder, "merchants.csv").write_text(text)


GOOD = [
    raw_row(merchant_id=f"m{i % 7}" if i % 5 else None, purchase_amount=f"{i}.25",
            purchase_date=f"2017-0{i % 3 + 1}-1{i % 9} {i % 24:02d}:15:00", city_id=i % 4 - 1,
            state_id=i % 3 if i % 10 else None, category="AB "[i % 3], installments=i % 4,
            authorized_flag="YYN"[i % 3])
    for i in range(200)
]
MERCHANTS = [("m0", "Zero"), ("m1", "One"), ("m1", "Uno"), ("m2", " "), ("m3", "Three")]


def test_whole_job(spark, layers):
    write_raw(spark, layers["raw"], GOOD, MERCHANTS)
    result = job.run_all(
        spark, layers["raw"], layers["bronze"], layers["silver"], layers["gold"]
    )
    assert result["passed"] and result["gold_count"] == 200

    raw = spark.createDataFrame(GOOD, RAW_SCHEMA)
    merchants = spark.createDataFrame(MERCHANTS, "merchant_id string, merchant_name string")
    expected = silver.to_silver(raw, merchants)
    by = summaries.summaries_of(expected.transactions)
    for question in gold.QUESTIONS:
        name, frame = question.name, question.ask(by)
        written = published(spark, layers, "gold", name).drop("gold_load_timestamp")
        assert written.dtypes == frame.dtypes, name
        assert sorted(map(str, written.collect())) == sorted(map(str, frame.collect())), name

    path = versions.table_path(spark, layers["silver"], "dq.json")
    metrics = tables.read_json(spark, path, job.METRICS_SCHEMA).first()
    want = quality.quality_metrics(expected.transactions, expected.merchant_conflicts).first()
    assert metrics.asDict() == want.asDict()
    summary = published(spark, layers, "gold", "data_quality_summary")
    dropped = views.metric_value(summary, "Rows dropped").first()
    assert tuple(dropped) == (0, 0.0)
    samples = published(spark, layers, "gold", "data_quality_warning_samples")
    got = samples.drop("gold_load_timestamp").orderBy("check_name", "sample_rank").collect()
    assert got == quality.warning_samples(expected.transactions).collect()
    conflicts = published(spark, layers, "gold", "data_quality_merchant_conflicts")
    assert views.conflict_listing(conflicts).first()["source_names"] == "One | Uno"

    transactions = published(spark, layers, "silver", "transactions")
    assert {"bronze_load_timestamp", "silver_load_timestamp"} <= set(transactions.columns)
    assert transactions.select("silver_load_timestamp").distinct().count() == 1
    names = [r[0] for r in transactions.select("source_file_name").distinct().collect()]
    assert len(names) == 1 and names[0].endswith(".parquet")
    for layer in ("bronze", "silver", "gold"):
        assert visible(layers[layer]) == {"_log", "_leases", "_versions"}
        assert visible(f"{layers[layer]}/_leases") == set()
        assert len(visible(f"{layers[layer]}/_versions")) == 1
    listed = spark.read.json(versions.table_path(spark, layers["bronze"], "provenance.json"))
    digest = hashlib.sha256(Path(layers["raw"], "merchants.csv").read_bytes()).hexdigest()
    assert listed.filter(F.col("source") == "merchants.csv").first()["sha256"] == digest


def test_a_second_run_replaces_the_first(spark, layers):
    write_raw(spark, layers["raw"], GOOD, MERCHANTS)
    paths = [layers[n] for n in ("raw", "bronze", "silver", "gold")]
    job.run_all(spark, *paths)
    write_raw(spark, layers["raw"], GOOD[:50], MERCHANTS)
    assert job.run_all(spark, *paths)["gold_count"] == 50
    overview = published(spark, layers, "gold", "q5_overview").first()
    assert overview["recorded_attempts"] == 50


@pytest.mark.parametrize(
    ("bad", "message"),
    [
        ([raw_row(), raw_row(purchase_amount="x")], "invalid/null"),
        ([raw_row(purchase_date=None)], "invalid/null"),
    ],
)
def test_a_failed_check_keeps_the_published_silver(spark, layers, bad, message):
    write_raw(spark, layers["raw"], GOOD, MERCHANTS)
    job.run_bronze(spark, layers["raw"], layers["bronze"])
    job.run_silver(spark, layers["bronze"], layers["silver"])
    write_raw(spark, layers["raw"], bad, MERCHANTS)
    job.run_bronze(spark, layers["raw"], layers["bronze"])
    with pytest.raises(ValueError, match=message):
        job.run_silver(spark, layers["bronze"], layers["silver"])
    assert published(spark, layers, "silver", "transactions").count() == 200
    current = Path(versions.current_version(spark, layers["silver"]))
    assert visible(current) == {"transactions", "merchant_lookup", "merchant_conflicts", "dq.json"}
    assert visible(current.parent) == {current.name}


def test_empty_source(spark, layers):
    write_raw(spark, layers["raw"], [raw_row()], MERCHANTS)
    spark.createDataFrame([], RAW_SCHEMA).write.mode("overwrite").parquet(
        f"{layers['raw']}/historical_transactions.parquet"
    )
    job.run_bronze(spark, layers["raw"], layers["bronze"])
    with pytest.raises(ValueError, match="empty"):
        job.run_silver(spark, layers["bronze"], layers["silver"])
    assert versions.current_version(spark, layers["silver"]) is None


def test_missing_inputs_are_named(spark, layers):
    with pytest.raises(FileNotFoundError, match="Bronze.*historical_transactions.*merchants.csv"):
        job.run_bronze(spark, layers["raw"], layers["bronze"])
    with pytest.raises(FileNotFoundError, match="Silver"):
        job.run_silver(spark, layers["bronze"], layers["silver"])
    with pytest.raises(FileNotFoundError, match="Gold.*dq.json"):
        job.run_gold(spark, layers["silver"], layers["gold"])


def test_other_time_zones_are_refused(spark, layers):
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        with pytest.raises(ValueError, match="must be UTC"):
            job.run_silver(spark, layers["bronze"], layers["silver"])
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


# Sources


def test_digests_of_files(spark, tmp_path):
    contents = {f"f{i}.bin": bytes([i]) * (1000 * i + 1) for i in range(5)}
    (tmp_path / "a b").mkdir()
    for name, data in contents.items():
        (tmp_path / "a b" / name).write_bytes(data)
    got = rows(provenance.digests(spark, str(tmp_path)))
    assert {(r["bytes"], r["sha256"]) for r in got} == {
        (len(data), hashlib.sha256(data).hexdigest()) for data in contents.values()
    }
    assert {r["file"] for r in got} == {f"a b/{name}" for name in contents}
    inner = rows(provenance.digests(spark, str(tmp_path / "a b")))
    assert {r["file"] for r in inner} == set(contents)


def test_manifest_tells_subfolders_apart(spark, tmp_path):
    def folder(name, first, second):
        for part, data in (("k=a", first), ("k=b", second)):
            (tmp_path / name / part).mkdir(parents=True)
            (tmp_path / name / part / "data.bin").write_bytes(data)
        return str(tmp_path / name)

    (tmp_path / "one").mkdir()
    (tmp_path / "one" / "data.bin").write_bytes(b"1")
    sources = {
        "here": folder("here", b"1", b"2"),
        "swapped": folder("swapped", b"2", b"1"),
        "folder": str(tmp_path / "one"),
        "file": str(tmp_path / "one" / "data.bin"),
    }
    got = {r["source"]: r["sha256"] for r in rows(provenance.manifest(spark, sources))}
    assert len(set(got.values())) == 4
    assert got["file"] == hashlib.sha256(b"1").hexdigest()


def test_manifest_depends_on_names_and_contents(spark, tmp_path):
    def folder(name, files):
        path = tmp_path / name
        path.mkdir()
        for file, data in files.items():
            (path / file).write_bytes(data)
        return str(path)

    a = folder("a", {"x": b"1", "y": b"2"})
    same = folder("same", {"y": b"2", "x": b"1"})
    swapped = folder("swapped", {"x": b"2", "y": b"1"})
    listed = rows(provenance.manifest(spark, {"a": a, "same": same, "swapped": swapped}))
    got = {r["source"]: r for r in listed}
    assert got["a"]["sha256"] == got["same"]["sha256"] != got["swapped"]["sha256"]
    assert len(got["a"]["sha256"]) == 64
    assert (got["a"]["files"], got["a"]["bytes"]) == (2, 2)


def test_load_metadata(spark, tmp_path):
    path = str(tmp_path / "one.csv")
    Path(path).write_text("a,b\n1,x\n")
    at = datetime(2026, 1, 2, 3, 4, 5, tzinfo=timezone.utc)
    read = tables.read_csv(spark, path)
    assert read.dtypes == [("a", "string"), ("b", "string")]
    marked = tables.with_load_metadata(read, "bronze", at, source_file=True)
    row = marked.select("source_file_name", F.col("bronze_load_timestamp").cast("string")).first()
    assert tuple(row) == ("one.csv", "2026-01-02 03:04:05")
    typed = tables.read_csv(spark, path, "a int, b string")
    assert typed.first()["a"] == 1


def test_one_row_json(spark, tmp_path):
    path = str(tmp_path / "row.json")
    frame = spark.range(1).select(
        F.lit(Decimal("12345678901234567890.12")).alias("b"), F.lit(3).alias("a"),
        F.lit("2026-01-02").cast("date").alias("c"),
    )
    tables.write_json(frame, path)
    text = next(Path(path).glob("part-*.json")).read_text().strip()
    assert text == '{"a":3,"b":"12345678901234567890.12","c":"2026-01-02"}'
    back = tables.read_json(spark, path, "b decimal(38,2)").first()[0]
    assert back == Decimal("12345678901234567890.12")


def test_bronze_spreads_on_demand(spark, layers):
    write_raw(spark, layers["raw"], GOOD, MERCHANTS)
    job.run_bronze(spark, layers["raw"], layers["bronze"], spread=3)
    path = Path(versions.table_path(spark, layers["bronze"], "historical_transactions"))
    assert len(list(path.glob("part-*.parquet"))) == 3


def test_a_failed_bronze_keeps_the_last_version(spark, layers, monkeypatch):
    write_raw(spark, layers["raw"], GOOD, MERCHANTS)
    job.run_bronze(spark, layers["raw"], layers["bronze"])

    def broken(*_):
        raise OSError("no digests today")

    monkeypatch.setattr(job.provenance, "manifest", broken)
    write_raw(spark, layers["raw"], GOOD[:9], MERCHANTS)
    with pytest.raises(OSError, match="no digests"):
        job.run_bronze(spark, layers["raw"], layers["bronze"])
    assert published(spark, layers, "bronze", "historical_transactions").count() == 200


def test_a_crash_between_tables_leaves_the_last_version(spark, layers):
    """A driver that dies leaves a half-written version, which no reader looks at."""
    write_raw(spark, layers["raw"], GOOD, MERCHANTS)
    job.run_bronze(spark, layers["raw"], layers["bronze"])
    half = f"{layers['bronze']}/_versions/half"
    spark.range(3).write.parquet(f"{half}/historical_transactions")
    assert published(spark, layers, "bronze", "historical_transactions").count() == 200
    job.run_bronze(spark, layers["raw"], layers["bronze"])
    kept = visible(f"{layers['bronze']}/_versions")
    assert len(kept) == 2 and "half" not in kept


def test_overlapping_runs_of_a_layer(spark, layers, monkeypatch):
    """A run that ends while another of its layer is half-way: the later one stays, the other says so."""
    write_raw(spark, layers["raw"], GOOD, MERCHANTS)
    original, inner = provenance.manifest, []

    def meanwhile(*arguments):
        if not inner:
            inner.append(True)
            write_raw(spark, layers["raw"], GOOD[:60], MERCHANTS)
            job.run_bronze(spark, layers["raw"], layers["bronze"])
        return original(*arguments)

    monkeypatch.setattr(job.provenance, "manifest", meanwhile)
    with pytest.raises(versions.Superseded):
        job.run_bronze(spark, layers["raw"], layers["bronze"])
    assert published(spark, layers, "bronze", "historical_transactions").count() == 60
    assert len(visible(f"{layers['bronze']}/_versions")) == 1


def test_broken_lines_are_published_beside_the_merchants(spark, layers):
    write_raw(spark, layers["raw"], GOOD, [*MERCHANTS, ("m5", "Five,and more")])
    with open(f"{layers['raw']}/merchants.csv", "a") as file:
        file.write("m6\n")
    job.run_bronze(spark, layers["raw"], layers["bronze"])
    merchants = published(spark, layers, "bronze", "merchants")
    assert {r["merchant_id"] for r in merchants.collect()} == {"m0", "m1", "m2", "m3"}
    assert set(merchants.columns) == {"merchant_id", "merchant_name", "source_file_name", "bronze_load_timestamp"}
    rejected = published(spark, layers, "bronze", "rejected_merchants").collect()
    assert {(r["file"], r["record"], r["reason"]) for r in rejected} == {
        ("merchants.csv", "m5,Five,and more", "wrong number of fields"),
        ("merchants.csv", "m6", "wrong number of fields"),
    }
    assert "merchants_parsed" not in visible(versions.current_version(spark, layers["bronze"]))
    before = versions.current_version(spark, layers["bronze"])
    with pytest.raises(ValueError, match="2 lines rejected, 1 allowed .wrong number of fields: 2"):
        job.run_bronze(spark, layers["raw"], layers["bronze"], most_rejected=1)
    assert versions.current_version(spark, layers["bronze"]) == before


def test_published_tables_are_clustered_and_activity_is_counted(spark, layers):
    write_raw(spark, layers["raw"], GOOD, MERCHANTS)
    job.run_all(spark, *(layers[n] for n in ("raw", "bronze", "silver", "gold")))
    leaders = published(spark, layers, "gold", "q1_top_merchants")
    keys = [(r["year_month"], -9 if r["city_id"] is None else r["city_id"], r["rank"]) for r in leaders.collect()]
    assert keys == sorted(keys)
    attempts = published(spark, layers, "silver", "transactions")
    wanted = [F.count_distinct("city_id").alias("city_count"), F.count_distinct("merchant_id").alias("merchant_count")]
    want = attempts.groupBy(F.date_format("purchase_date", "yyyy-MM").alias("year_month")).agg(*wanted)
    got = published(spark, layers, "gold", "active_by_month").drop("gold_load_timestamp")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    overall = published(spark, layers, "gold", "active_overall").drop("gold_load_timestamp")
    assert overall.collect() == attempts.agg(*wanted).collect()
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0


def test_gold_scans_silver_three_times(spark, layers, monkeypatch):
    write_raw(spark, layers["raw"], GOOD, MERCHANTS)
    job.run_bronze(spark, layers["raw"], layers["bronze"])
    job.run_silver(spark, layers["bronze"], layers["silver"])
    asked = []
    for module, name in (
        (summaries, "small_summary"), (summaries, "merchant_summary"), (quality, "warning_samples"),
    ):
        def once(attempts, original=getattr(module, name), name=name):
            asked.append(name)
            return original(attempts)

        monkeypatch.setattr(module, name, once)

    def never(*_):
        raise AssertionError("Silver is not read again")

    monkeypatch.setattr("tallyforge.operators.reconcile.reconcile", never)
    assert job.run_gold(spark, layers["silver"], layers["gold"])["passed"]
    assert sorted(asked) == ["merchant_summary", "small_summary", "warning_samples"]


def test_counters_seen_twice_are_recounted(spark, layers, monkeypatch):
    """Should tasks repeated after a lost executor report twice, the written rows decide."""

    class Twice(job.Observation):
        @property
        def get(self):
            return {name: value * 2 for name, value in super().get.items()}

    write_raw(spark, layers["raw"], GOOD, MERCHANTS)
    job.run_bronze(spark, layers["raw"], layers["bronze"])
    want = job.run_silver(spark, layers["bronze"], layers["silver"])
    merged = job.run_silver(spark, layers["bronze"], layers["silver"], broadcast_bytes=0)
    assert merged == want
    monkeypatch.setattr(job, "Observation", Twice)
    assert job.run_silver(spark, layers["bronze"], layers["silver"]) == want
    assert want["row_count"] == 200


def test_a_lookup_that_multiplies_rows_is_refused(spark, layers, monkeypatch):
    write_raw(spark, layers["raw"], GOOD, MERCHANTS)
    job.run_bronze(spark, layers["raw"], layers["bronze"])
    original = silver.merchant_lookup

    def doubled(merchants):
        lookup = original(merchants)
        return lookup.unionByName(lookup)

    monkeypatch.setattr(job.silver, "merchant_lookup", doubled)
    with pytest.raises(Exception, match="more than one row for merchant_id m"):
        job.run_silver(spark, layers["bronze"], layers["silver"])
    assert versions.current_version(spark, layers["silver"]) is None


def test_command_line(spark, layers, monkeypatch):
    from tallyforge import __main__ as command

    write_raw(spark, layers["raw"], GOOD, MERCHANTS)
    for stage in ("bronze", "silver"):
        arguments = ["tallyforge", stage]
        for name, path in layers.items():
            arguments += [f"--{name}-dir", path]
        monkeypatch.setattr("sys.argv", arguments)
        command.main()
    assert published(spark, layers, "silver", "transactions").count() == 200
