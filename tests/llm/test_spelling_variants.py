"""Spelling variants against edit distances of all pairs, and what the blocks must not lose."""

import itertools
import random
import re
import zlib
from collections import Counter

import pytest

from tallyforge.llm import spelling_variants as spelling


def one_edit(a, b):
    """Whether two words differ by exactly one inserted, deleted or replaced code point."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(documents):
    """Rows of the query from (doc_id, text)."""
    count = Counter()
    for doc_id, text in documents:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            count[run] += 1
    words = {w: n for w, n in count.items() if len(w) >= 5 and n >= 3}
    return forms(words)


def forms(words):
    near = {w: [] for w in words}
    for a, b in itertools.combinations(words, 2):
        if abs(len(a) - len(b)) < 2 and one_edit(a, b):
            near[a].append(b)
            near[b].append(a)
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 2 * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out)


def crowded(seed, n):
    """Words over three letters, so that most are near many others; counts that make long chains."""
    chance = random.Random(seed)
    words = {"".join(chance.choice("abé") for _ in range(chance.randint(5, 8))) for _ in range(n)}
    return {w: 3 * 2 ** chance.randint(0, 12) + chance.randint(0, 1) for w in sorted(words)}


def frame_of(spark, words):
    return spark.createDataFrame(list(words.items()), "word string, n long")


def test_documents(spark, odd):
    chance = random.Random(5)
    letters = ["color", "colour", "colours", "COLOUR", "coulour", "naïvely", "naively", "ÀBCDE", "àbcde", "x×y÷zab"]
    texts = [(i if i % 9 else None, " ".join(chance.choices(letters, k=60)) + "Ācolor\U0001f600colour") for i in range(120)]
    texts += [(500, "y" * 5000 + " " + "y" * 5001 + " ")] * 3 + [(501, None), (502, "")]
    frame = spark.createDataFrame(texts, "doc_id long, text string").withColumnsRenamed({})
    frame = frame.selectExpr("*", *(f"'x' as `{c}`" for c in ("word", "n", "near", "form", "root", "head", "left")))
    got = sorted(tuple(r) for r in spelling.variants(spelling.vocabulary(frame)).collect())
    assert got == brute(texts)
    assert any(r[1] for r in got) and any(len(r[0]) > 4000 for r in got)


@pytest.mark.parametrize("most", [4096, 40, 3])
def test_blocks_of_any_size(spark, monkeypatch, most):
    """Words that share beginnings and ends, with blocks that are cut once, often or to the last letter."""
    monkeypatch.setattr(spelling, "BLOCK_WORDS", most)
    words = crowded(7, 700)
    got = sorted(tuple(r) for r in spelling.variants(frame_of(spark, words).coalesce(3)).collect())
    assert got == forms(words)
    assert max(r[4] for r in got) > 8
    if most == 3:
        sizes = spelling.blocks(frame_of(spark, words)).groupBy(*spelling.BLOCK).count()
        # What is still larger has a single free letter.
        assert sizes.filter("count > 3 and shorter - left - right > 1").isEmpty()


def test_chains_have_one_root(spark):
    """A long chain of words, each one edit from the next and twice as frequent."""
    word, words = "aaaaa", {}
    for step in range(14):
        words[word] = 3 * 2**step
        word += "bcdefghijklmnop"[step]
    got = {r["word"]: r for r in spelling.variants(frame_of(spark, words)).collect()}
    assert {r["root"] for r in got.values()} == {max(words, key=words.get)}


@pytest.mark.parametrize("seed", range(6))
def test_index_finds_all_pairs(seed):
    words = list(crowded(seed, 300))
    for shorter in (5, 6, 7):
        members = [w for w in words if len(w) in (shorter, shorter + 1)]
        want = {
            (i, j)
            for i, a in enumerate(members)
            for j, b in enumerate(members)
            if len(a) == shorter and one_edit(a, b)
        }
        found = list(spelling.one_edit_apart(members, shorter))
        assert len(found) == len(set(found)) and set(found) == want


def test_nothing(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.variants(spelling.vocabulary(frame)).collect() == []
