"""The methods inside the operators, on small made-up inputs."""

import json
import math
import random
from collections import Counter

import numpy as np
import pandas as pd
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tests.llm.conftest import prose

from tallyforge.llm import (
    decontamination,
    line_dedup,
    mixing,
    near_duplicates,
    pitman_yor,
    sharding,
    suffix_dedup,
    tool_calls,
    weak_labels,
)
from tallyforge.llm.components import components
from tallyforge.llm.shingles import WordHashes, shingle_set
from tallyforge.llm.suffix_arrays import common_prefixes, suffix_array


# Sharding


def test_growing_moves_rows_only_into_the_new_shard(spark):
    frame = spark.range(5000).select(F.col("id").alias("key"))
    for shards in (1, 2, 7, 40):
        moved = sharding.shard(frame, "key", shards).filter("shard <> grown_shard")
        assert {r["grown_shard"] for r in moved.select("grown_shard").distinct().collect()} == {shards}
        assert abs(moved.count() / 5000 - 1 / (shards + 1)) < 0.05


def test_slots_are_gapless_with_a_hot_key(spark):
    frame = spark.range(3000).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("key"))
    got = sharding.shard(frame, "key", 4).groupBy("shard").agg(
        F.count("*").alias("n"), F.countDistinct("slot").alias("d"), F.max("slot").alias("last")
    )
    assert all(r["n"] == r["d"] == r["last"] + 1 for r in got.collect())


# Mixing


def test_targets_and_copies(spark):
    chance = random.Random(5)
    rows = [(f"s{s}", i, chance.randint(0, 90)) for s, n in enumerate((400, 30, 600, 5)) for i in range(n)]
    rows += [(None, i, 40) for i in range(50)]
    frame = spark.createDataFrame(rows, "source string, doc_id long, size long")
    got = [r.asDict() for r in mixing.copies(frame, ["doc_id"]).collect()]
    total = sum(size for *_, size in rows)
    taken, target, full = Counter(), {}, {}
    for r in got:
        assert 0 <= r["copies"] <= 3
        taken[r["source"]] += r["copies"] * r["size"]
        target[r["source"]], full[r["source"]] = r["target"], r["source_size"]
    assert math.isclose(sum(target.values()), total)
    assert all(target[s] <= 3 * full[s] + 1e-9 for s in target)
    assert all(abs(taken[s] - target[s]) <= 90 for s in target)
    free = [s for s in target if target[s] < 3 * full[s]]
    weight = {"s0": 5, "s1": 2, "s2": 1, "s3": 5, None: 2}
    assert len({round(target[s] / weight[s], 6) for s in free}) == 1
    again = mixing.copies(frame.repartition(7), ["doc_id"]).collect()
    assert Counter(map(str, got)) == Counter(str(r.asDict()) for r in again)


# Suffix arrays


@settings(max_examples=60, deadline=None)
@given(st.binary(min_size=1, max_size=60), st.integers(1, 4))
def test_suffix_array_and_prefixes(part, times):
    data = part * times
    order = suffix_array(np.frombuffer(data, np.uint8))
    assert list(order) == sorted(range(len(data)), key=lambda i: data[i:])
    found = common_prefixes(np.frombuffer(data, np.uint8), order)
    for k in range(1, len(data)):
        a, b = data[order[k - 1] :], data[order[k] :]
        same = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert found[k] == same


@pytest.mark.parametrize("size", [1, 40_000])
def test_passages_across_shards(spark, monkeypatch, size):
    """A shared passage in different surroundings; with tiny shards its anchors are dealt over many."""
    from tests.llm import brute

    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", size if size > 1 else 3000)
    passage, line = prose(50, 110), "a short line that everybody has, again and again and again"
    documents = [
        (i, prose(100 + i, 40 + 5 * i) + ("\n" + passage if i % 3 else "\n" + line) + "\n" + prose(200 + i, 60))
        for i in range(30)
    ]
    frame = spark.createDataFrame(documents, "doc_id long, text string")
    columns = ("doc_id", "n_bytes", "n_removed", F.size("spans"), "kept_sha256")
    got = sorted(tuple(r) for r in suffix_dedup.repeated_spans(frame).select(*columns).collect())
    want = brute.repeated_bytes(documents)
    assert got == want and sum(r[2] > 600 for r in want) == 20


def test_merge_finds_strings_of_several_shards():
    rows = pd.DataFrame(
        {
            "anchor": [1, 1, 1, 1, 2],
            "snippet": [5, 6, 7, 8, 9],
            "first": pd.array([0, 0, 3, None, 0], "Int32"),
            "last": pd.array([0, 0, 3, None, 0], "Int32"),
            "shard": [0, 1, 1, 2, 1],
            "high": [10, 10, 11, 10, 10],
            "low": [1, 1, 1, 1, 1],
        }
    )
    assert suffix_dedup.merge_range(rows)["snippet"].tolist() == [5, 6]


def test_a_shard_sends_one_row_a_range():
    """However many strings a shard of a frequent anchor holds, it lists them in one row a range."""
    bodies = [prose(i, 300).encode() for i in range(20)] + [prose(3, 300).encode()[100:]]
    rows = pd.DataFrame(
        {
            "shard": 7,
            "parts": 2,
            "anchor": 1,
            "snippet": range(len(bodies)),
            "body": bodies,
        }
    )
    got = suffix_dedup._shard_repeats(rows, 3)
    assert sorted(got["range"].fillna(-1)) == [-1, 0, 1, 2]
    lists = got[got["range"].notna()]
    strings = {b[i : i + 400] for b in bodies for i in range(len(b) - 399)}
    assert sum(map(len, lists["highs"])) == len(strings)
    runs = got[got["range"].isna()].iloc[0]
    found = sorted(zip(runs["snippets"], runs["firsts"], runs["lasts"]))
    assert found == [(3, 100, len(bodies[3]) - 400), (20, 0, len(bodies[20]) - 400)]


@pytest.mark.parametrize("frequent", [1, 10])
def test_frequent_anchors_are_dealt(spark, monkeypatch, frequent):
    monkeypatch.setattr(suffix_dedup, "FREQUENT", frequent)
    places = spark.range(60).selectExpr("id % 7 % 3 AS anchor", "cast(id AS string) AS text_id", "cast(id AS int) AS first")
    counts = places.groupBy("anchor").count().filter("anchor < 2")
    got = suffix_dedup._meet(places, counts, "count", "left_semi")
    assert sorted(got.collect()) == sorted(places.filter("anchor < 2").collect())
    got = suffix_dedup._meet(places, counts, "count", "inner").select(*places.columns, "count")
    assert sorted(got.collect()) == sorted(places.join(counts, "anchor").select(got.columns).collect())


# Lines


def test_runs_and_texts(spark):
    a, b, c = ("the first line of it", "and the second one", "then comes a third")
    long = "one line of more than ten words is a run of its own here"
    rows = [
        (1, f"{a}\n{b}\n{c}\n\nend one"),
        (2, f"start\n{b}\n\n{c}\nend two"),
        (3, f"{a}\nsolo\n{long}"),
        (4, f"{long}\n{a}\n{b}\n{c}"),
        (5, None),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    _, runs = line_dedup.repeated_runs(frame)
    found = {(r["doc"]["doc_id"], r["start"], r["end"], r["first"]["doc"]["doc_id"]) for r in runs.collect()}
    assert {(2, 1, 3, 1), (4, 0, 1, 3), (4, 1, 4, 1)} <= found
    texts = {r["doc_id"]: r["text"] for r in line_dedup.without_repeated_lines(frame).collect()}
    assert texts == {1: rows[0][1], 2: "start\n\nend two", 3: rows[2][1], 4: "", 5: None}


# Near duplicates


def test_chunks_meet_within_the_distance():
    chance = np.random.default_rng(1)
    one = chance.integers(0, 2**16, (40, near_duplicates.SYMBOLS)).astype(np.uint16)
    other = one.copy()
    for row in other:
        row[chance.choice(len(row), 2 * near_duplicates.BANDS - 1, replace=False)] += 1
    frame = lambda s, n: pd.DataFrame({"node": range(n, n + 40), "symbols": [x.tobytes() for x in s]})
    first, second = (
        next(near_duplicates._entries(iter([frame(s, n)]))).groupby("node")["key"].agg(set)
        for s, n in ((one, 0), (other, 100))
    )
    assert all(first[i] & second[100 + i] for i in range(40))


def test_blocks_find_what_one_group_finds(spark, monkeypatch):
    from tests.llm import brute

    chance, base = random.Random(3), prose(60, 150).split()
    documents = []
    for i in range(160):
        words = list(base)
        for _ in range(i % 5):
            words[chance.randrange(150)] = f"w{chance.randrange(6)}"
        documents.append((i, " ".join(words)))
    want = sorted(brute.near_duplicates(documents))
    assert 1 < sum(r[3] for r in want) < 150
    frame = spark.createDataFrame(documents, "doc_id long, text string")
    for block in (1024, 16):
        monkeypatch.setattr(near_duplicates, "BLOCK", block)
        got = near_duplicates.near_duplicates(frame).select("doc_id", "n_shingles", "component_id", "kept")
        assert sorted(tuple(r) for r in got.collect()) == want


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 560)] + [(7, 3)]
    random.Random(2).shuffle(links)
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    want = {i: 100 for i in range(100, 161)} | {i: 500 for i in range(500, 560)} | {3: 3, 7: 3}
    assert {r["node"]: r["label"] for r in got} == want and len(got) == len(want)
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_short_texts_are_one_shingle():
    memo = WordHashes()
    assert len(shingle_set("a b c", memo)) == 1 and len(shingle_set("a b c d e f", memo)) == 2
    assert shingle_set(" \n", memo).size == shingle_set(None, memo).size == 0
    assert (shingle_set("A b\tC", memo) == shingle_set("a  b c", memo)).all()
    assert (shingle_set("É b c", memo) != shingle_set("é b c", memo)).all()


# Decontamination


def test_edited_items_and_clean_documents(spark):
    item = prose(70, 44).replace("\n", " ")
    words = item.split()
    edited = [*words[:43], "changed"]
    rows = [
        (1, prose(71, 80) + " " + item + " " + prose(72, 30)),
        (2, prose(73, 80) + "\n" + item.upper()),
        (3, " ".join(edited) + " " + prose(74, 80)),
        (4, " ".join(words[:20]) + " " + prose(75, 80)),
        (5, prose(76, 300)),
        (6, " ".join(words[2:])),
    ]
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    benchmark = spark.createDataFrame([(9, item), (8, prose(77, 30))], "item_id long, text string")
    got = {r["doc_id"]: r for r in decontamination.contaminated(documents, benchmark).collect()}
    assert set(got) == {1, 2, 3, 6}
    assert got[1]["similarity"] == got[2]["similarity"] == 1 and got[1]["start"] == 80
    assert got[1]["distance"] == 0 < got[3]["distance"] <= decontamination.RADIUS
    kept = decontamination.without_contaminated(documents, benchmark)
    assert sorted(r["doc_id"] for r in kept.collect()) == [4, 5]


def test_turns_of_items_change_nothing(spark, monkeypatch):
    rows = [(i, prose(80 + i, 60)) for i in range(20)]
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    items = [(i, " ".join(t.split()[10:40])) for i, t in rows[::2]]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    whole = decontamination.contaminated(documents, benchmark).collect()
    monkeypatch.setattr(decontamination, "TURN_SHINGLES", 100)
    assert sorted(decontamination.contaminated(documents, benchmark).collect()) == sorted(whole)
    assert len(whole) == 10


# Tool calls


SCHEMAS = {
    "add": {
        "type": "object",
        "required": ["x"],
        "properties": {"x": {"type": "integer", "minimum": 0}, "tags": {"type": "array", "items": {"type": "string"}}},
        "additionalProperties": False,
    }
}


def call(i, arguments, after=(), name="add"):
    return {"id": i, "name": name, "arguments": arguments, "after": list(after)}


def test_calls_are_linked_ordered_and_checked(spark):
    def asks(*calls):
        return json.dumps({"tool_calls": list(calls)})

    def answers(i, content):
        return json.dumps({"tool_call_id": i, "content": content})

    messages = [
        (1, 0, "assistant", asks(call("a", {"x": 1}), call("b", '{"tags": ["é"], "x": 2}', ["a"]))),
        (1, 1, "tool", answers("a", {"z": 1, "y": [True, None]})),
        (1, 2, "assistant", asks(call("c", {"x": -1}, ["b", "a"]), call("a", {"x": 3}))),
        (1, 3, "tool", answers("b", "ok")),
        (1, 4, "tool", answers("a", 2)),
        (1, 5, "tool", answers("ghost", None)),
        (2, 0, "assistant", asks(call("p", {"x": 1}, ["q"]), call("q", {"x": 1}, ["p"]))),
        (2, 1, "assistant", asks(call("r", {"x": "1"}), call("s", {}, name="no"), call(None, {"x": 1}))),
        (None, 0, "tool", answers("early", 1)),
        (None, 1, "assistant", asks(call("early", {"x": 1, "u": 2}, ["unknown"]))),
        (3, 0, "assistant", "{not json"),
        (3, 1, "assistant", None),
        (3, 2, None, "{}"),
        (3, 3, "tool", "[1]"),
    ]
    frame = spark.createDataFrame(messages, "conv_id long, turn long, role string, text string")
    got = {(r["conv_id"], r["call_id"], r["nth"]): r for r in tool_calls.linked_calls(frame, SCHEMAS).collect()}
    status = {key: (r["status"], r["level"], r["valid"]) for key, r in got.items()}
    assert status == {
        (1, "a", 0): ("linked", 0, True),
        (1, "b", 0): ("linked", 1, True),
        (1, "c", 0): ("no_result", 2, False),
        (1, "a", 1): ("linked", 0, True),
        (1, "ghost", 0): ("no_call", None, None),
        (2, "p", 0): ("no_result", None, True),
        (2, "q", 0): ("no_result", None, True),
        (2, "r", 0): ("no_result", 0, False),
        (2, "s", 0): ("no_result", 0, False),
        (2, None, None): ("no_id", None, False),
        (None, "early", 0): ("early", 0, False),
        (3, None, None): ("no_id", None, None),
    }
    assert got[1, "b", 0]["json"] == (
        '{"call":{"arguments":{"tags":["é"],"x":2},"id":"b","name":"add"},"result":"ok"}'
    )
    assert got[1, "a", 0]["json"].endswith('"result":{"y":[true,null],"z":1}}')
    assert got[1, "c", 0]["problem"] == "arguments.x: below minimum"
    assert got[2, "r", 0]["problem"] == "arguments.x: not integer"
    assert got[2, "s", 0]["problem"] == "unknown tool"
    assert got[None, "early", 0]["problem"] == "arguments.u: unknown"


# Language model


def test_probabilities_add_up(spark):
    """Over all words and the unknown one, in every context, the model's probabilities make one."""
    rows = [(i, prose(i % 6, 40)) for i in range(30)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    state, known = pitman_yor.train(frame, 1)
    scorer = pitman_yor.Scorer(known, state.first()["blob"])
    everything = np.append(np.arange(len(scorer.words)), -1)
    assert len(scorer.words) == known["words"]
    for context in range(0, pitman_yor.CONTEXTS, 17):
        _, logs = scorer.tokens(everything, np.full(len(everything), context))
        assert math.isclose((10**logs).sum(), 1, rel_tol=1e-9)


def test_every_word_is_a_context_of_its_own(spark):
    """Words with the same ending do not share a restaurant, and each one's probabilities make one."""
    rows = [(i, f"ending{i % 2} " + ("left " if i % 2 else "right ") * 3) for i in range(40)]
    rows = [(i, t.replace("ending0", "a-thing").replace("ending1", "b-thing")) for i, t in rows]
    state, known = pitman_yor.train(spark.createDataFrame(rows, "doc_id long, text string"), 1)
    scorer = pitman_yor.Scorer(known, state.first()["blob"])
    number = {w: xxhash.xxh3_64_intdigest(w) for w in (b"a-thing", b"b-thing", b"left", b"right")}
    place = {w: int(np.flatnonzero(scorer.words == np.uint64(h))[0]) for w, h in number.items()}
    at = np.array([place[b"left"], place[b"right"]])
    for context, likelier in ((b"a-thing", 1), (b"b-thing", 0)):
        _, logs = scorer.tokens(at, np.full(2, number[context], np.uint64))
        assert logs[likelier] > logs[1 - likelier] + 1
    everything = np.append(np.arange(len(scorer.words)), -1)
    for context in scorer.contexts:
        _, logs = scorer.tokens(everything, np.full(len(everything), context))
        assert math.isclose((10**logs).sum(), 1, rel_tol=1e-9)


def test_held_out_text_of_the_same_kind_is_likelier(spark):
    rows = [(i, " ".join(prose(i % 9, 60).split()[i % 7 :])) for i in range(150)]
    got = pitman_yor.perplexity(pitman_yor.scores(spark.createDataFrame(rows, "doc_id long, text string")))
    held = {r["held_out"]: r for r in got.collect()}
    assert held[True]["model"] < 0.8 * held[True]["base"]


def test_frequent_words_and_buckets_change_nothing(spark, monkeypatch):
    rows = [(i, prose(i, 50) + " the" * 30) for i in range(40)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    whole = {r["doc_id"]: r for r in pitman_yor.scores(frame).collect()}
    monkeypatch.setattr(pitman_yor, "FREQUENT", 1)  # no word is that frequent
    for r in pitman_yor.scores(frame).collect():
        assert math.isclose(r["score"], whole[r["doc_id"]]["score"], rel_tol=1e-9)
        assert r["n_known"] == whole[r["doc_id"]]["n_known"]


def test_seating_follows_the_process():
    rng = np.random.default_rng(4)
    customers, weight, discount = np.full(4000, 300), 0.7, 0.3
    found = pitman_yor.seat(customers, np.full(4000, weight), discount, rng).mean()
    expected = 1.0
    for n in range(1, 300):
        expected += weight / (n - discount * expected + weight)
    assert abs(found - expected) < 0.15
    assert (pitman_yor.seat(np.ones(5, int), np.ones(5), 0.5, rng) == 1).all()


# Weak labels


def test_estimated_accuracies_beat_the_votes():
    chance = random.Random(9)
    counts, truth = Counter(), Counter()
    for _ in range(20000):
        good = chance.random() < 0.8
        votes = "".join(
            "0" if chance.random() < 0.2 else "-+"[(chance.random() < right) == good]
            for right in (0.95, 0.9, 0.85, 0.97, 0.6)
        )
        counts[votes] += 1
        truth[votes, good] += 1
    found, _ = weak_labels.posteriors(counts)
    right = sum(truth[v, p >= 0.5] for v, p in found.items()) / 20000
    assert right > 0.96
    assert weak_labels.posteriors({}) == ({}, pytest.approx(np.zeros((0, 2, 3))))


def test_classifier_on_labelled_documents(spark):
    from pathlib import Path

    folder = "/root/testdata/sf0.01"
    if not Path(folder).exists():
        pytest.skip("driver tables are not here")
    scored = weak_labels.op9_quality_classifier(spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    right = scored.join(labels, "doc_id").agg(F.avg((F.col("kept") == (F.col("quality") == 1)).cast("int")))
    assert right.first()[0] > 0.97
