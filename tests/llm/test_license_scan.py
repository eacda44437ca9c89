"""License phrases and notices: planted copies, edits and near misses."""

import random
import re

import pytest

from tallyforge.llm import license_scan
from tallyforge.llm.license_scan import TEMPLATES, Template

BASE = {"gpl": "gnu general public license", "apache": "apache license", "cc-by": "cc by", "mit": "mit license"}
NOTICE = {t.label: t.words for t in TEMPLATES if t.gram == 5}


def base_places(text):
    """n_words, and the base phrases' places and labels, word by word."""
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    found = []
    for label, phrase in BASE.items():
        want = phrase.split()
        found += [(i, label) for i in range(len(words)) if words[i : i + len(want)] == want]
    return len(words), sorted(found)


def scanned(spark, texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r["doc_id"]: r for r in license_scan.scan(frame).collect()}


def filler(seed, n):
    chance = random.Random(seed)
    return ["".join(chance.choice("abcdefgh") for _ in range(7)) for _ in range(n)]


TEXTS = [
    None,
    "",
    " -- ",
    "cc by",
    "CC-BY 4.0 and again cc.by, cc by",
    "The MIT License",
    "mitlicense mit licensee MIT\nLICENSE",
    "GNU General Public License",
    "gnu general public licensed, gnu general license",
    "gnu  GENERAL\tpublic--license (gnu general public license)",
    "Licensed under the Apache License, Version 2.0.",
    "mİt license, Kit: gnu general public license",
    "é漢 mit license é漢",
    "cc cc by by",
    "SPDX-License-Identifier: MIT",
    "x " * 30_000 + "apache license",
]


@pytest.mark.parametrize("which", ["plain", "odd"])
def test_base_columns(spark, odd, which):
    if which == "odd":
        texts = [r["text"] for r in spark.read.parquet(f"{odd}/documents.parquet").collect()]
    else:
        texts = TEXTS
    got = scanned(spark, texts)
    for i, text in enumerate(texts):
        n, found = base_places(text)
        row = got[i]
        assert (row["n_words"], row["n_base"]) == (n, len(found)), text
        assert row["first_word"] == (found[0][0] if found else None)
        assert row["last_word"] == (found[-1][0] if found else None)
        assert row["base_labels"] == ",".join(sorted({x for _, x in found}))
        assert set(filter(None, row["base_labels"].split(","))) <= set(row["labels"].split(","))
        assert 0 <= row["score"] <= 1 and (row["score"] > 0) == (row["labels"] != "")


def test_phrases_of_other_licenses(spark):
    got = scanned(spark, ["SPDX-License-Identifier: MIT", "under CC BY-NC 4.0", "GNU Lesser General Public License v3"])
    assert [got[i]["labels"] for i in range(3)] == ["mit", "cc-by,cc-by-nc", "lgpl"]
    assert [got[i]["base_labels"] for i in range(3)] == ["", "cc-by", ""]


@pytest.mark.parametrize("label", sorted(set(NOTICE)))
def test_whole_notices_inside_other_text(spark, label):
    text = " ".join([*filler(1, 50), *NOTICE[label], *filler(2, 50)])
    row = scanned(spark, [text.upper()])[0]
    assert label in row["labels"].split(",") and row["score"] == 1.0


def test_edited_notices(spark):
    """A few words more, a few less and one replaced are the same notice; half of it is not."""
    words = NOTICE["mit"]
    more = words[:30] + ["really", "quite"] + words[30:]
    less = words[:20] + words[24:]
    other = words[:40] + ["elsewhere"] + words[41:]
    shuffled = random.Random(1).sample(words, len(words))
    texts = [" ".join(filler(3, 9) + x + filler(4, 9)) for x in (more, less, other, words[: len(words) // 2], shuffled)]
    got = scanned(spark, texts)
    assert [got[i]["labels"] for i in range(5)] == ["mit", "mit", "mit", "", ""]
    assert all(0.8 <= got[i]["score"] < 1 for i in range(3))


def test_two_copies_are_two_spans(spark):
    words = NOTICE["bsd"]
    frame = spark.createDataFrame([(1, " ".join(words + filler(5, 3) + words))], "doc_id long, text string")
    found = license_scan.spans(license_scan.votes(frame, TEMPLATES), TEMPLATES).orderBy("start").collect()
    assert [(r["label"], r["start"], r["end"]) for r in found] == [
        ("bsd", 0, len(words)),
        ("bsd", len(words) + 3, 2 * len(words) + 3),
    ]


def test_templates_of_ones_own(spark):
    own = (Template("poem", "Tyger, tyger, burning bright", base=True, gram=3),)
    frame = spark.createDataFrame([(1, "o tyger tyger burning bright"), (2, "tyger burning bright")], "doc_id long, text string")
    got = {r["doc_id"]: (r["labels"], r["first_word"]) for r in license_scan.scan(frame, own).collect()}
    assert got == {1: ("poem", 1), 2: ("", None)}


def test_many_places_in_one_text(spark):
    row = scanned(spark, ["cc by " * 20_000])[0]
    assert (row["n_base"], row["first_word"], row["last_word"], row["score"]) == (20_000, 0, 39_998, 1.0)


def test_ids_null_repeated_beyond_doubles_and_clashing_columns(spark):
    rows = [(2**53 + 1, "mit license"), (None, "cc by"), (None, None), (2**53 + 1, "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    frame = frame.selectExpr("*", *(f"'x' as `{c}`" for c in ("row", "words", "template", "place", "at", "hash", "gram")))
    got = sorted((str(r["doc_id"]), r["labels"]) for r in license_scan.scan(frame).collect())
    assert got == [(str(2**53 + 1), ""), (str(2**53 + 1), "mit"), ("None", ""), ("None", "cc-by")]
