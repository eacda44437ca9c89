"""How the filters of a corpus interact: what each removes in any order, beside and without the others.

A document that fails the filters of a bit set ``failed`` survives a subset of the filters if the
two have no bit in common.  Its survival word has a bit for each of the 32 subsets of five
filters.  Tasks add up these words bit by bit with carry-save adders, apart for each part and
label, so that a part leaves a task as 32 counts however many documents it has.  Every question
about an order of the filters is a difference of two such counts.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage

#: Fixed by the contract: the filters in the order of their bits, and their limits.
FILTERS = "ABCDE"
LEAST_WORDS = 200
LEAST_DISTINCT_PERCENT = 50
MOST_CAPITALS_PERCENT = 3
SYMBOLS = re.compile(rb"[#$%&*|]")
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
IDENTICAL = 1 << FILTERS.index("E")

#: Bit s of SURVIVES[failed]: whether a document that fails ``failed`` passes all filters in s.
SUBSETS = np.arange(1 << len(FILTERS), dtype=np.uint32)
SURVIVES = np.array(
    [np.bitwise_or.reduce((SUBSETS & failed == 0).astype(np.uint32) << SUBSETS) for failed in SUBSETS],
    dtype=np.uint32,
)
#: Whose survivors are counted: all documents, those of good quality, toxic ones.
LABELS = ("all", "good", "toxic")
#: Parts that a task holds counts for at once; beyond, it hands them on and starts anew.
PARTS_HELD = 4_096


def failed_alone(text: str | None) -> int:
    """Bits of the filters A to D, which a text fails or passes by itself; null is empty."""
    body = (text or "").encode()
    words = body.split()
    capitals = len(body) - len(body.translate(None, CAPITALS))
    return (
        (len(words) < LEAST_WORDS)
        | (100 * len(set(words)) < LEAST_DISTINCT_PERCENT * len(words)) << 1
        | (100 * capitals > MOST_CAPITALS_PERCENT * len(text or "")) << 2
        | (SYMBOLS.search(body) is not None) << 3
    )


def _measured(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").to_pylist()
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("part"),
                pa.array([failed_alone(x) for x in texts], pa.int32()),
                pa.array([hashlib.sha256((x or "").encode()).digest() for x in texts], pa.binary()),
            ],
            ["doc_id", "part", "failed", "digest"],
        )


def with_failures(documents: DataFrame) -> DataFrame:
    """``doc_id, part, failed`` of every document; identity is that of whole texts, by SHA-256.

    Each text's smallest id is joined back by id and text, not by text alone: however many copies a
    text has, they do not meet.  A document without an id has no smaller one beside it and passes E,
    and is no smaller one itself; rows with equal id and text pass E together.
    """
    told = documents.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), "text")
    kind = documents.schema["doc_id"].dataType.simpleString()
    measured = stage(
        told.mapInArrow(_measured, f"doc_id {kind}, part string, failed int, digest binary"), "measured"
    )
    firsts = measured.groupBy("digest").agg(F.min("doc_id").alias("_first"))
    firsts = firsts.filter(F.col("_first").isNotNull()).withColumnRenamed("digest", "_digest")
    met = (F.col("doc_id") == F.col("_first")) & (F.col("digest") == F.col("_digest"))
    later = F.col("doc_id").isNotNull() & F.col("_first").isNull()
    failed = F.col("failed").bitwiseOR(F.when(later, IDENTICAL).otherwise(0))
    return measured.join(firsts, met, "left").select("doc_id", "part", failed.alias("failed"))


def with_labels(failed: DataFrame, labels: DataFrame) -> DataFrame:
    """Add ``good`` and ``toxic``; of several rows for an id one that says so is enough."""
    said = labels.groupBy(F.col("doc_id").alias("_id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("_good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("_toxic"),
    )
    return failed.join(said, F.col("doc_id") == F.col("_id"), "left").select(
        "part",
        "failed",
        F.coalesce("_good", F.lit(False)).alias("good"),
        F.coalesce("_toxic", F.lit(False)).alias("toxic"),
    )


def positional_popcounts(words: np.ndarray) -> np.ndarray:
    """In how many of the 32-bit words each bit is set.

    A carry-save adder turns three words into a word of sums and one of carries, which weigh twice as
    much: 32 counters advance at once, and two words a weight are left in the end.
    """
    bits = np.arange(32, dtype=np.uint32)
    counts, weight = np.zeros(32, np.int64), 1
    while len(words):
        carries = []
        while len(words) > 2:
            third = len(words) // 3
            a, b, c = words[:third], words[third : 2 * third], words[2 * third : 3 * third]
            half = a ^ b
            carries.append((a & b) | (half & c))
            words = np.concatenate([half ^ c, words[3 * third :]])
        counts += weight * ((words[:, None] >> bits) & 1).sum(axis=0, dtype=np.int64)
        words, weight = np.concatenate(carries) if carries else words[:0], 2 * weight
    return counts


def _survivors(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, np.ndarray] = {}

    def handed_on() -> pa.RecordBatch:
        places = len(LABELS) * 32
        return pa.RecordBatch.from_arrays(
            [
                pa.array([p for p in held for _ in range(places)], pa.string()),
                pa.array(np.tile(np.arange(places, dtype=np.int32), len(held))),
                pa.array(np.concatenate([c.ravel() for c in held.values()] or [np.zeros(0, np.int64)])),
            ],
            ["part", "place", "n"],
        )

    for batch in batches:
        coded = batch.column("part").dictionary_encode()
        codes = coded.indices.to_numpy(zero_copy_only=False)
        words = SURVIVES[batch.column("failed").to_numpy(zero_copy_only=False)]
        chosen = [np.ones(len(words), bool)]
        chosen += [batch.column(c).to_numpy(zero_copy_only=False) for c in LABELS[1:]]
        order = np.argsort(codes, kind="stable")
        ends = np.cumsum(np.bincount(codes, minlength=len(coded.dictionary)))
        for part, rows in zip(coded.dictionary.to_pylist(), np.split(order, ends[:-1])):
            counts = held.setdefault(part, np.zeros((len(LABELS), 32), np.int64))
            for label, which in enumerate(chosen):
                counts[label] += positional_popcounts(words[rows[which[rows]]])
        if len(held) > PARTS_HELD:
            yield handed_on()
            held.clear()
    yield handed_on()


def survivors(labelled: DataFrame) -> DataFrame:
    """``part, counts``: survivors of each subset of the filters, at place 32 * label + subset."""
    counted = labelled.mapInArrow(_survivors, "part string, place int, n long")
    summed = counted.groupBy("part", "place").agg(F.sum("n").alias("n"))
    entries = F.collect_list(F.struct("place", "n"))  # 96 at most
    return summed.groupBy("part").agg(F.map_from_entries(entries).alias("counts"))


def _bit(letter: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1), F.ascii(letter) - ord(FILTERS[0]))


def by_order(counted: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step; see ``op13_filter_audit`` for the columns."""
    every = (1 << len(FILTERS)) - 1
    letter = [F.substring("filter_order", i + 1, 1) for i in range(len(FILTERS))]
    own = _bit(F.col("_filter"))
    rows = (
        counted.withColumn("filter_order", F.explode(F.array(*map(F.lit, map("".join, permutations(FILTERS))))))
        .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
        .withColumn("_filter", F.substring(F.col("filter_order"), F.col("step"), F.lit(1)))
        .withColumn(
            "_before", sum((F.when(F.col("step") > i + 1, _bit(x)).otherwise(0) for i, x in enumerate(letter)), F.lit(0))
        )
    )

    def left(subset: Column, label: str = "all") -> Column:
        return F.element_at("counts", subset + 32 * LABELS.index(label))

    def lost(before: Column, label: str = "all") -> Column:
        return left(before, label) - left(before.bitwiseOR(own), label)

    # A set of filters comes, in any order, just before a given one in so many orders, by its size.
    n = len(FILTERS)
    turns = F.array(*(F.lit(factorial(size) * factorial(n - 1 - size)) for size in range(n)))
    others = F.filter(F.sequence(F.lit(0), F.lit(every)), lambda s: s.bitwiseAND(own) == 0)
    shapley = F.aggregate(
        others, F.lit(0).cast("long"), lambda so_far, s: so_far + F.get(turns, F.bit_count(s)) * lost(s)
    )
    before = F.col("_before")
    return rows.select(
        "part",
        "filter_order",
        "step",
        left(before.bitwiseOR(own)).alias("kept"),
        lost(before).alias("removed"),
        (lost(F.lit(0)) - lost(before)).alias("redundant"),
        lost(F.lit(every) - own).alias("unique_fails"),
        lost(before, "good").alias("good_lost"),
        lost(before, "toxic").alias("toxic_lost"),
        shapley.alias("shapley"),
    )


def audit(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The filters' effect in every order, per part of ``documents``.

    Only ``doc_id, text, lang`` and ``doc_id, quality, toxic`` are read, so further columns of any name
    do no harm.  A null or empty text has no words: it fails A alone, and E if an id below has one too.
    Null and empty parts are one part.  Labels of ids that no document has, or of none, count
    nowhere; each row of a repeated document counts.  Texts of any length are taken whole.  Without
    documents there are no parts and no rows.
    """
    return by_order(survivors(with_labels(with_failures(documents), labels)))


def op13_filter_audit(spark, sf_dir: str) -> DataFrame:
    """Five filters over all documents, in all 120 orders: what each step keeps, removes and loses."""
    documents, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    return audit(documents, labels)


SQL = r"""
WITH body AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
),
firsts AS (SELECT text, min(doc_id) AS first FROM body GROUP BY text),
said AS (
  SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic
  FROM labels GROUP BY doc_id
),
flagged AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    (CASE WHEN len(w) < 200 THEN 'A' ELSE '' END)
    || (CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END)
    || (CASE WHEN 100 * length(regexp_replace(b.text, '[^A-Z]+', '', 'g')) > 3 * length(b.text) THEN 'C' ELSE '' END)
    || (CASE WHEN regexp_matches(b.text, '[#$%&*|]') THEN 'D' ELSE '' END)
    || (CASE WHEN coalesce(b.doc_id > first, false) THEN 'E' ELSE '' END) AS fails
  FROM body b JOIN firsts f ON b.text = f.text LEFT JOIN said ON b.doc_id = said.doc_id
),
kinds AS (
  SELECT part, good, toxic, fails, count(*) AS n FROM flagged GROUP BY ALL
),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
),
steps AS (
  SELECT filter_order, s::INTEGER AS step, filter_order[s] AS own, substr(filter_order, 1, s - 1) AS before
  FROM orders, range(1, 6) t(s)
),
judged AS (
  SELECT part, filter_order, step, own, n, good, toxic, fails, contains(fails, own) AS fail,
    len(list_filter(range(1, step), lambda i: contains(fails, before[i]))) = 0 AS reached
  FROM kinds, steps
),
counted AS (
  SELECT part, filter_order, step, own,
    coalesce(sum(n) FILTER (reached AND NOT fail), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (reached AND fail), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (NOT reached AND fail), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (fails = own), 0)::BIGINT AS unique_fails,
    coalesce(sum(n) FILTER (reached AND fail AND good), 0)::BIGINT AS good_lost,
    coalesce(sum(n) FILTER (reached AND fail AND toxic), 0)::BIGINT AS toxic_lost
  FROM judged GROUP BY ALL
)
SELECT * EXCLUDE (own), (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley FROM counted
"""
