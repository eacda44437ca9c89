"""Clusters of more texts than a block: those that hang on one text, and those that do not."""

import random

import pytest
from tests.llm import brute
from tests.llm.conftest import prose

from tallyforge.llm import near_duplicates


def crowd(kind):
    chance = random.Random(kind)
    base = prose(61, 400).split()
    documents = []
    for i in range(150):
        words = list(base)
        if kind == "chain":  # each differs a little from the one before, and much from the first
            base = words
            words[chance.randrange(len(words))] = f"w{i}"
            words[chance.randrange(len(words))] = f"v{i}"
        else:
            for _ in range(chance.randint(0, 3)):
                words[chance.randrange(len(words))] = f"w{i}"
        documents.append((i, " ".join(words)))
    other = prose(62, 300)
    return [*documents, (200, other), (201, other + " more"), (202, prose(63, 50)), (203, None)]


@pytest.mark.parametrize("kind", ["copies", "chain"])
@pytest.mark.parametrize("block", [1024, 16])
def test_blocks_of_a_cluster(spark, monkeypatch, kind, block):
    monkeypatch.setattr(near_duplicates, "BLOCK", block)
    documents = crowd(kind)
    frame = spark.createDataFrame(documents, "doc_id long, text string").repartition(4)
    got = near_duplicates.near_duplicates(frame).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert sorted(map(tuple, got)) == sorted(brute.near_duplicates(documents))


def test_near_copies_of_one_text_make_no_block_pairs(spark, monkeypatch):
    """All texts of a cluster that hang on one text: no group of two blocks is formed."""
    monkeypatch.setattr(near_duplicates, "BLOCK", 16)
    met = []
    original = near_duplicates.stage

    def watched(frame, label):
        out = original(frame, label)
        if label == "routed":
            met.append(out.filter("low >= 0").count())
        return out

    monkeypatch.setattr(near_duplicates, "stage", watched)
    near_duplicates.near_duplicates(spark.createDataFrame(crowd("copies"), "doc_id long, text string")).collect()
    assert met == [0]
