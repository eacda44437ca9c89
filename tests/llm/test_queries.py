"""Every query against its SQL or a brute-force version: on the driver's tables, on odd cases, on nothing."""

import math
from pathlib import Path

import duckdb
import pytest
from tests.llm import brute

from tallyforge.llm import registry

FOLDER = "/root/testdata/sf0.001"
EXACT = {"op2_suffix_dedup", "op6_minhash", "op8_pitman_yor", "op9_quality_classifier"}
FOLDERS = ["driver", "odd", "empty"]


@pytest.fixture(params=FOLDERS)
def folder(request):
    if request.param == "driver":
        if not Path(FOLDER).exists():
            pytest.skip("driver tables are not here")
        return FOLDER
    return request.getfixturevalue(request.param)


def rows_of(spark, name, folder, *columns):
    frame = registry.queries()[name](spark, folder)
    return [tuple(r) for r in (frame.select(*columns) if columns else frame).collect()]


def documents(spark, folder):
    frame = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    return [tuple(r) for r in frame.collect()]


def in_order(rows):
    return sorted(rows, key=lambda row: [(x is not None, str(x)) for x in row])


def test_every_query_has_a_reference():
    assert set(registry.queries()) == set(registry.oracle_sql()) | EXACT
    assert len(registry.queries()) == 13


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_matches_sql(spark, folder, name):
    connection = duckdb.connect()
    for table in ("documents", "benchmark", "conversations", "labels"):
        path = Path(folder, f"{table}.parquet")
        files = path if path.is_file() else path / "*.parquet"
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{files}'")
    frame = registry.queries()[name](spark, folder)
    columns = sorted(frame.columns)
    listed = ", ".join(f'"{c}"' for c in columns)
    found = connection.sql(f"SELECT {listed} FROM ({registry.oracle_sql()[name]})")
    assert found.columns == columns
    got = in_order(tuple(r) for r in frame.select(*columns).collect())
    want = in_order(found.fetchall())
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g == w, (columns, g, w)


def test_near_duplicates(spark, folder):
    columns = ("doc_id", "n_shingles", "component_id", "kept")
    got = rows_of(spark, "op6_minhash", folder, *columns)
    assert in_order(got) == in_order(brute.near_duplicates(documents(spark, folder)))


def test_repeated_bytes(spark, folder):
    columns = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    got = rows_of(spark, "op2_suffix_dedup", folder, *columns)
    assert in_order(got) == in_order(brute.repeated_bytes(documents(spark, folder)))


def test_language_model(spark, folder):
    columns = ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
    got = rows_of(spark, "op8_pitman_yor", folder, *columns)
    want = brute.base_scores(documents(spark, folder))
    place = lambda r: (str(r[0]), r[2], r[3], round(r[5], 6))
    assert len(got) == len(want)
    for g, w in zip(sorted(got, key=place), sorted(want, key=place)):
        assert g[:5] == w[:5]
        assert math.isclose(g[5], w[5], rel_tol=1e-9, abs_tol=1e-9)
        assert g[6] <= 0 and math.isfinite(g[6])


def test_classifier_scores_every_row(spark, folder):
    got = rows_of(spark, "op9_quality_classifier", folder, "doc_id", "score", "kept")
    assert sorted(str(r[0]) for r in got) == sorted(str(i) for i, _ in documents(spark, folder))
    assert all(0 <= score <= 1 for _, score, _ in got)
    blank = {13, 14, 15}
    assert not [r for r in got if folder != FOLDER and r[0] in blank and r[2]]
