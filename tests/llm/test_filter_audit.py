"""The audit against filters that are applied one after the other, and its counters."""

import itertools
import random
import re
from collections import Counter

import numpy as np
import pytest

from tallyforge.llm import filter_audit as audit


def failing(text, doc_id, least):
    """The letters of the filters that a text fails."""
    body = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", body)
    return {
        letter
        for letter, fails in {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", body)) > 3 * len(body),
            "D": re.search("[#$%&*|]", body) is not None,
            "E": doc_id is not None and least[body] is not None and doc_id > least[body],
        }.items()
        if fails
    }


def brute(documents, labels):
    """Rows of the query from (doc_id, text, lang) and (doc_id, quality, toxic), by running every order."""
    least = {}
    for i, text, _ in documents:
        known = least.setdefault(text or "", i)
        if known is None or i is not None and i < known:
            least[text or ""] = i
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    parts = {}
    for i, text, lang in documents:
        parts.setdefault(lang or "", []).append((failing(text, i, least), i in good, i in toxic))
    out, removals = [], Counter()
    for part, docs in parts.items():
        for order in itertools.permutations("ABCDE"):
            left = docs
            for step, letter in enumerate(order, 1):
                gone = [d for d in left if letter in d[0]]
                left = [d for d in left if letter not in d[0]]
                removals[part, letter] += len(gone)
                fails = sum(letter in d[0] for d in docs)
                alone = sum(d[0] == {letter} for d in docs)
                out.append(
                    (part, "".join(order), step, len(left), len(gone), fails - len(gone), alone)
                    + (sum(d[1] for d in gone), sum(d[2] for d in gone))
                )
    return sorted((*r, removals[r[0], r[1][r[2] - 1]]) for r in out)


@pytest.mark.parametrize("which", ["plain", "clashing"])
def test_every_order_of_odd_documents(spark, odd, clashing, which):
    documents = clashing if which == "clashing" else spark.read.parquet(f"{odd}/documents.parquet")
    labels = spark.read.parquet(f"{odd}/labels.parquet")
    rows = [tuple(r) for r in documents.select("doc_id", "text", "lang").collect()]
    got = sorted(tuple(r) for r in audit.audit(documents, labels).collect())
    assert got == brute(rows, [tuple(r) for r in labels.collect()])


def test_ids_beyond_doubles_beside_null(spark):
    """Copies whose ids a double cannot tell apart: the smaller one stays, whatever stands beside it."""
    text = " ".join(f"word{i}" for i in range(300))
    rows = [(2**53 + 1, text, "x"), (2**53 + 2, text, "x"), (None, text, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(1)
    failed = audit.with_failures(frame).collect()
    assert {r["doc_id"]: r["failed"] for r in failed} == {2**53 + 1: 0, 2**53 + 2: 16, None: 0}


def test_a_hot_text_fails_once_less_than_it_occurs(spark):
    frame = spark.range(3000).selectExpr("id as doc_id", "'the same' as text", "cast(null as string) as lang")
    labels = spark.createDataFrame([], "doc_id long, quality long, toxic long")
    row = audit.audit(frame, labels).filter("filter_order = 'EABCD' and step = 1").first()
    assert (row["part"], row["kept"], row["removed"]) == ("", 1, 2999)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 31, 1000, 4097])
def test_carry_save_counts(n):
    chance = random.Random(n)
    words = np.array([chance.getrandbits(32) for _ in range(n)], np.uint32)
    want = [sum(int(w) >> b & 1 for w in words) for b in range(32)]
    assert audit.positional_popcounts(words).tolist() == want


def test_survival_words():
    for failed, subset in itertools.product(range(32), repeat=2):
        assert (int(audit.SURVIVES[failed]) >> subset & 1) == (failed & subset == 0)
