"""The pipeline against a plain version, stage by stage, and its handling of odd tables."""

import random
from collections import Counter

import numpy as np
import pytest
from tests.llm import brute
from tests.llm.conftest import CLASHING

import corpus_pipeline
from tallyforge.llm import decontamination, mixing, near_duplicates, quality_rules, registry
from tallyforge.llm.common import stage

FOLDER = "/root/testdata/sf0.001"


def rows(frame):
    return Counter(str(r) for r in frame.collect())


def test_stages_by_plain_means(spark):
    """Each stage's decisions, computed row by row or by the queries that have SQL, on what came in."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    steps = dict(corpus_pipeline.STAGES)
    assert list(steps) == ["quality rules", "near duplicates", "decontamination", "mixing", "sharding"]

    ruled = stage(steps["quality rules"](spark, docs, FOLDER), "t")
    verdict = registry.queries()["op10_quality_rules"](spark, FOLDER).filter("kept")
    assert sorted(r["doc_id"] for r in ruled.collect()) == sorted(r["doc_id"] for r in verdict.collect())
    assert not [r for r in ruled.collect() if quality_rules.facts_of(r["text"])[0] < 50]

    apart = stage(steps["near duplicates"](spark, ruled, FOLDER), "t")
    pairs = [(r["doc_id"], r["text"]) for r in ruled.collect()]
    want = [r[0] for r in brute.near_duplicates(pairs, corpus_pipeline.NEAR) if r[3]]
    assert sorted(r["doc_id"] for r in apart.collect()) == sorted(want)

    clean = stage(steps["decontamination"](spark, apart, FOLDER), "t")
    benchmark = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    hit = {r["doc_id"] for r in decontamination.contaminated(apart, benchmark).collect()}
    assert {r["doc_id"] for r in apart.collect()} - {r["doc_id"] for r in clean.collect()} == hit

    mixed = stage(steps["mixing"](spark, clean, FOLDER), "t")
    sized = clean.select("doc_id", "source", mixing.word_count(clean["text"]).alias("size"))
    often = {r["doc_id"]: r["copies"] for r in mixing.copies(sized, ["doc_id"]).collect() if r["copies"]}
    assert Counter(r["doc_id"] for r in mixed.collect()) == Counter(often)
    assert mixed.columns == docs.columns

    placed = steps["sharding"](spark, mixed, FOLDER).collect()
    assert Counter(r["doc_id"] for r in placed) == Counter(often)
    for shard in range(8):
        slots = sorted(r["slot"] for r in placed if r["shard"] == shard)
        assert slots == list(range(len(slots)))
    assert rows(corpus_pipeline.run(spark, FOLDER).drop("slot")) == Counter(
        str(r) for r in spark.createDataFrame(placed).drop("slot").collect()
    )


def test_copies_of_four_fifths_go(spark):
    """Pairs with similarities on both sides of 0.80 and 0.85, as brute force groups them at 80 percent."""
    chance = random.Random(80)
    documents = []
    for i in range(60):
        words = [f"w{chance.randrange(10**6)}" for _ in range(200)]
        documents.append((2 * i, " ".join(words)))
        for place in chance.sample(range(10, 190, 10), 2 + i % 6):
            words[place] = "changed"
        documents.append((2 * i + 1, " ".join(words)))
    kept = {p: sorted(r[0] for r in brute.near_duplicates(documents, p) if r[3]) for p in (80, 85)}
    assert 60 < len(kept[80]) < len(kept[85]) < 120
    frame = spark.createDataFrame(documents, "doc_id long, text string")
    step = dict(corpus_pipeline.STAGES)["near duplicates"]
    assert sorted(r["doc_id"] for r in step(spark, frame, FOLDER).collect()) == kept[80]


@pytest.mark.parametrize("percent", [50, 80, 85, 95])
def test_links_are_lost_by_the_stated_chance(percent):
    """Signatures with symbols that differ independently, as those of sets on the limit do."""
    size, near = near_duplicates.SYMBOLS, percent / 100
    bands, farthest = near_duplicates.layout(percent)
    away = np.random.default_rng(percent).random((200_000, size)) >= near
    met = (away.reshape(len(away), bands, -1).sum(axis=2) <= 1).any(axis=1)
    assert met.all() and (away.sum(axis=1) <= farthest).all()
    assert near_duplicates.layout(85) == (12, 30) and near_duplicates.layout(80) == (14, 36)


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_odd_tables_pass_each_stage(spark, odd, clashing, name):
    step = dict(corpus_pipeline.STAGES)[name]
    out = step(spark, clashing, odd)
    last = name == "sharding"
    added = ("shard", "grown_shard", "slot") if last else ()
    assert [c for c in out.columns if c not in added] == [c for c in clashing.columns if c not in added]
    texts = Counter(r["text"] for r in clashing.collect())
    found = Counter(r["text"] for r in out.collect())
    assert set(found) <= set(texts)
    if last:
        assert found == texts
    if name == "near duplicates":
        assert found[None] == texts[None]  # texts without words are linked with nothing
        with_words = sorted(t for t in texts if brute.shingles(t))
        groups = sum(r[3] for r in brute.near_duplicates(list(enumerate(with_words))))
        assert sum(found[t] for t in with_words) == groups


def test_clashing_names_reach_nothing(spark, odd, clashing):
    """Further columns change no decision of a stage."""
    plain = spark.read.parquet(f"{odd}/documents.parquet")
    for name, step in corpus_pipeline.STAGES[:3]:
        want = Counter(r["text"] for r in step(spark, plain, odd).collect())
        got = Counter(r["text"] for r in step(spark, clashing, odd).collect())
        assert got == want, name
    assert len(CLASHING) == len(set(CLASHING))


def test_empty_tables_pass_through(spark, empty):
    out = corpus_pipeline.run(spark, empty)
    assert out.collect() == []
    assert out.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"]
