"""Ids that doubles cannot hold beside nulls, clashing columns, and results under other session settings."""

import json
import random

import pytest
from tests.llm import brute
from tests.llm.conftest import prose

from tallyforge.llm import (
    line_dedup,
    mixing,
    near_duplicates,
    pitman_yor,
    registry,
    sharding,
    suffix_dedup,
    tool_calls,
    weak_labels,
)

FOLDER = "/root/testdata/sf0.001"
LARGE = 2**53


def near_copies():
    """Two near copies and two other texts, with ids that differ in the bits that a double drops."""
    base = prose(31, 400)
    edited = base.split(" ")
    edited[200] = "changed"
    return [(LARGE + 1, base), (LARGE + 3, " ".join(edited)), (LARGE + 5, prose(32, 80)), (LARGE + 7, "")]


OPERATORS = {
    "suffix": (suffix_dedup.repeated_spans, ["doc_id", "n_bytes", "n_removed", "spans", "kept_sha256"]),
    "near": (near_duplicates.near_duplicates, ["doc_id", "n_shingles", "component_id", "kept"]),
    "model": (pitman_yor.scores, ["doc_id", "held_out", "n_tokens"]),
    "classifier": (weak_labels.classify, ["doc_id", "pattern"]),
}


@pytest.mark.parametrize("name", OPERATORS)
@pytest.mark.parametrize("clash", [False, True])
def test_large_ids_beside_null(spark, name, clash):
    """The rows of all other ids are the same with and without a row that has none."""
    operator, columns = OPERATORS[name]

    def result(rows):
        frame = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
        if clash:
            taken = ("pattern", "node", "label", "score", "kept", "text_id", "anchor", "part", "bucket", "text_key")
            frame = frame.selectExpr("*", *(f"'x' as `{c}`" for c in taken))
        found = operator(frame).select(columns).collect()
        return sorted(str(r) for r in found if r["doc_id"] is not None), found

    alone, _ = result(near_copies())
    beside, all_rows = result([*near_copies(), (None, "nobody's words")])
    assert alone == beside
    assert {r["doc_id"] for r in all_rows} == {LARGE + 1, LARGE + 3, LARGE + 5, LARGE + 7, None}
    if name == "near":
        assert {r["doc_id"]: r["component_id"] for r in all_rows}[LARGE + 3] == LARGE + 1
    if name == "suffix":
        want = {r[0]: r[2] for r in brute.repeated_bytes(near_copies())}
        assert {r["doc_id"]: r["n_removed"] for r in all_rows if r["doc_id"]} == want
        assert want[LARGE + 1] > 0
    if name == "model":
        assert {r["doc_id"]: r["held_out"] for r in all_rows} == {
            i: pitman_yor.is_held_out(i) for i in {r["doc_id"] for r in all_rows}
        }


def test_large_conversations_beside_null(spark):
    call = json.dumps({"tool_calls": [{"id": "a", "name": "t", "arguments": {}}]})
    result = json.dumps({"tool_call_id": "a", "content": 1})
    rows = [(LARGE + 1, 2**53 + 1, "assistant", call), (LARGE + 1, 2**53 + 3, "tool", result), (None, None, "user", "x")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").coalesce(1)
    frame = frame.selectExpr("*", "'x' as level", "'x' as call_id", "'x' as kind")
    found = tool_calls.linked_calls(frame, {"t": {"type": "object"}}).collect()
    assert [(r["conv_id"], r["call_turn"], r["result_turn"], r["status"]) for r in found] == [
        (LARGE + 1, 2**53 + 1, 2**53 + 3, "linked")
    ]


def test_json_that_utf8_or_json_cannot_write(spark):
    """Half a surrogate pair in ids, names and arguments; numbers that JSON has no name for."""
    texts = [
        '{"tool_calls": [{"id": "\\ud800", "name": "t", "arguments": {"\\udfff": "x\\ud8001"}}]}',
        '{"tool_calls": [{"id": "b", "name": "t", "arguments": {"x": NaN}}]}',
        '{"tool_calls": [{"id": "c", "name": "t", "arguments": {"x": 1e999}}]}',
        '{"tool_calls": [{"id": "\\ud83d\\ude00", "name": "\\udc00", "arguments": {}}]}',
    ]
    rows = [(1, i, "assistant", x) for i, x in enumerate(texts)]
    rows += [(1, 9, "tool", '{"tool_call_id": "\\ud800", "content": "\\udbff"}'), (1, 10, "tool", '{"content": Infinity}')]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    closed = {"t": {"type": "object", "properties": {}, "additionalProperties": False}}
    found = {r["call_id"]: r for r in tool_calls.linked_calls(frame, closed).collect()}
    assert set(found) == {"\\ud800", "\U0001f600", None}
    first = found["\\ud800"]
    assert first["status"] == "linked" and first["problem"] == "arguments.\\udfff: unknown"
    assert json.loads(first["json"]) == {
        "call": {"id": "\ud800", "name": "t", "arguments": {"\udfff": "x\ud8001"}},
        "result": "\udbff",
    }
    assert found[None]["problem"] == "result is not an object"


@pytest.mark.parametrize("name", ["op3_mixing", "op4_line_dedup", "op5_sharding", "op7_tool_calls"])
def test_positions_do_not_depend_on_the_rows_of_a_file(spark, name):
    query = registry.queries()[name]
    want = sorted(map(str, query(spark, FOLDER).collect()))
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "20")
    try:
        assert sorted(map(str, query(spark, FOLDER).collect())) == want
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")


def test_clashing_columns_of_the_native_operators(spark, clashing):
    """The operators that the pipeline's test does not reach with such columns."""
    plain = clashing.select("doc_id", "text", "lang", "source")
    cut = lambda frame: sorted(str(r["text"]) for r in line_dedup.without_repeated_lines(frame).collect())
    assert cut(clashing) == cut(plain)
    placed = lambda frame: sorted(
        (str(r["doc_id"]), r["shard"]) for r in sharding.sharded(frame).select("doc_id", "shard").collect()
    )
    assert placed(clashing) == placed(plain)
    mixed = lambda frame: sorted(str(r["text"]) for r in mixing.mixed(frame).collect())
    assert mixed(clashing) == mixed(plain)


def test_votes_posteriors_and_scores_by_plain_means(spark):
    """The classifier's parts, row by row in one process."""
    chance = random.Random(9)
    texts = [prose(40 + i, chance.randint(5, 300)) for i in range(40)]
    texts += ["BUY NOW!!! $$$ " * chance.randint(5, 60) for _ in range(20)] + ["", None, texts[0], texts[0]]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r for r in weak_labels.classify(frame).collect()}
    patterns = ["".join("-0+"[v + 1] for v in weak_labels.votes(x)) for x in texts]
    assert [found[i]["pattern"] for i in range(len(texts))] == patterns
    counts = {p: patterns.count(p) for p in patterns}
    good, _ = weak_labels.posteriors(counts)
    assert [found[i]["posterior"] for i in range(len(texts))] == pytest.approx([good[p] for p in patterns])
    assert found[0]["score"] == found[len(texts) - 1]["score"]
    assert all(0 <= r["score"] <= 1 for r in found.values())
    # The scorer agrees with the posteriors that it was fitted on.
    sure = [i for i, p in enumerate(patterns) if texts[i] and abs(good[p] - 0.5) > 0.4]
    agreed = sum((found[i]["score"] >= 0.5) == (good[patterns[i]] >= 0.5) for i in sure)
    assert agreed >= 0.9 * len(sure) > 0
