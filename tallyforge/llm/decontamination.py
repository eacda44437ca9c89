"""Benchmark decontamination by SimHash of item-sized windows.

For each length of benchmark items, windows of as many words slide over the documents.  A window's
64-bit SimHash is taken over its five-word shingles, weighted by how often they occur in it.  The
items' fingerprints are indexed in six blocks of 10 or 11 bits; each block is entered with all its
values up to four bits away, so that by pigeonhole every fingerprint within ``RADIUS`` = 29 bits shares
an entry with the window.  Candidates are verified by their exact weighted-shingle similarity, the
sum of the smaller weights over the sum of the larger ones, which must reach 0.8.

A window without any shingle of an item of its length has similarity 0, and one that starts with
other shingles does not lose when it is moved on to the first it shares.  So only windows that start
with such a shingle are made.  At a similarity of 0.8 the expected distance is under 10 bits, and a
window beyond ``RADIUS``, which the exact check would not see, comes with a chance near 2 in a billion
(bits taken as independent).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, lowered, same, small, stage

SHINGLE = 5
PERCENT = 80
BLOCK_BITS, BLOCK_ERRORS = (11, 11, 11, 11, 10, 10), 4
RADIUS = len(BLOCK_BITS) * (BLOCK_ERRORS + 1) - 1

#: Shingles of the items that are held in memory at a time; larger benchmarks take several turns.
TURN_SHINGLES = 400_000


def words(text: Column) -> Column:
    """Words in lower case (A-Z); none for null."""
    found = F.regexp_extract_all(lowered(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))
    return found


def shingles(listed: Column, size: int) -> Column:
    """Hashes of all runs of ``size`` words, in order."""
    none = F.array().cast("array<bigint>")

    def runs(w: Column) -> Column:  # a bound variable, so that the words are found only once
        starts = F.sequence(F.lit(1), F.size(w) - (size - 1))
        return F.when(
            F.size(w) >= size, F.transform(starts, lambda i: F.xxhash64(F.slice(w, i, size)))
        ).otherwise(none)

    return F.element_at(F.transform(F.array(listed), runs), 1)


def simhash(hashes: Column) -> Column:
    """64-bit SimHash of an array of hashes, each occurrence of weight 1.

    Bits k and k + 32 are counted together, in the two halves of one number.
    """
    halves = F.lit(0x0000000100000001)

    def counted(k: int) -> Column:
        return F.aggregate(
            hashes,
            F.lit(0).cast("long"),
            lambda total, h: total + F.shiftrightunsigned(h, k).bitwiseAND(halves),
        )

    size, result = F.size(hashes), F.lit(0).cast("long")
    for k in range(32):
        counts = counted(k)
        low = counts.bitwiseAND(F.lit(0xFFFFFFFF))
        high = F.shiftrightunsigned(counts, 32)
        for count, bit in ((low, k), (high, k + 32)):
            mark = F.shiftleft(F.lit(1).cast("long"), bit)
            result = result.bitwiseOR(F.when(2 * count > size, mark).otherwise(F.lit(0).cast("long")))
    return result


def occurrences(hashes: Column) -> Column:
    """The hashes with repeats told apart, so that sets of them stand for weights."""
    told = F.transform(
        hashes,
        lambda h, i: F.xxhash64(h, F.size(F.filter(F.slice(hashes, 1, i), lambda o: o == h))),
    )
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.transform(hashes, lambda h: F.xxhash64(h, F.lit(0)))).otherwise(told)


def blocks(fingerprint: Column) -> Column:
    """Array of (block, value) of a fingerprint."""
    return F.array(
        *(
            F.struct(
                F.lit(b).alias("block"),
                F.shiftrightunsigned(fingerprint, sum(BLOCK_BITS[:b]))
                .bitwiseAND(F.lit(2**bits - 1))
                .alias("value"),
            )
            for b, bits in enumerate(BLOCK_BITS)
        )
    )


def _index(items: DataFrame) -> DataFrame:
    """Every block of every item's fingerprint with all its values up to ``BLOCK_ERRORS`` bits away."""
    values = F.get(F.array(*(F.lit(2**bits) for bits in BLOCK_BITS)), F.col("b.block"))
    masks = F.filter(F.sequence(F.lit(0), values - 1), lambda m: F.bit_count(m) <= BLOCK_ERRORS)
    prints = items.select("n_words", F.col("print").alias("item_print")).distinct()
    entered = prints.withColumn("b", F.explode(blocks(F.col("item_print"))))
    return entered.withColumn("mask", F.explode(masks)).select(
        "n_words",
        "item_print",
        F.col("b.block").alias("block"),
        F.col("b.value").bitwiseXOR(F.col("mask").cast("long")).alias("value"),
    )


def _windows(documents: DataFrame, items: DataFrame, size: int) -> DataFrame:
    """Windows of the documents that start with a shingle of an item, cut to the item's length."""
    lengths = stage(
        items.select(F.explode("hashes").alias("hash"), "n_words").distinct(), "item_shingles"
    )
    hashed = documents.select("doc_id", "text_key", shingles(words(F.col("text")), size).alias("hashes"))
    placed = hashed.select("doc_id", "text_key", "hashes", F.posexplode("hashes").alias("start", "hash"))
    window = F.slice("hashes", F.col("start") + 1, F.col("n_words") - (size - 1))
    cut = placed.join(small(lengths), "hash").select(
        "doc_id", "text_key", "start", "n_words", window.alias("window")
    )
    return stage(cut.withColumn("print", simhash(F.col("window"))), "windows")


def _matches(documents: DataFrame, items: DataFrame, size: int) -> DataFrame:
    windows = _windows(documents, items, size)
    looked = windows.select("n_words", "print").distinct().withColumn(
        "b", F.explode(blocks(F.col("print")))
    ).select("n_words", "print", F.col("b.block").alias("block"), F.col("b.value").alias("value"))
    near = (
        looked.join(_index(items), ["n_words", "block", "value"])
        .withColumn("distance", F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))))
        .filter(F.col("distance") <= RADIUS)
        .select("n_words", "print", "item_print", "distance")
        .distinct()
    )
    near = stage(near, "near")
    held = items.select(
        "item_id", "n_words", F.col("print").alias("item_print"), occurrences(F.col("hashes")).alias("item_weights")
    )
    candidates = windows.join(near, ["n_words", "print"]).join(held, ["n_words", "item_print"])
    weights = occurrences(F.col("window"))
    shared = F.size(F.array_intersect(weights, "item_weights")).cast("long")
    measured = candidates.withColumn("shared", shared).withColumn(
        "joint", F.size("window") + F.size("item_weights") - F.col("shared")
    )
    return measured.filter(100 * F.col("shared") >= PERCENT * F.col("joint")).select(
        "doc_id",
        "text_key",
        "item_id",
        "start",
        "n_words",
        "distance",
        (F.col("shared") / F.col("joint")).alias("similarity"),
    )


def contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each text and item it contains: the best window, the first if several are.

    ``start`` counts words from 0.  Items of fewer than five words have one shingle, the whole item;
    items without words match nothing, nor do texts without words or null.  Items with equal texts
    match alike.  Rows repeated with id and text count as one text (``text_key``).  Empty tables
    give no rows; columns other than doc_id, text, item_id are not looked at.
    """
    documents = documents.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    listed = benchmark.select("item_id", words(F.col("text")).alias("w")).filter(F.size("w") > 0)
    sized = stage(
        listed.withColumn("n_words", F.size("w")).withColumn("size", F.least("n_words", F.lit(SHINGLE))),
        "items",
    )
    found = None
    for row in sized.groupBy("size").agg(F.sum(F.col("n_words")).alias("n")).orderBy("size").collect():
        size, turns = row["size"], -(-row["n"] // TURN_SHINGLES)
        hashed = sized.filter(F.col("size") == size).withColumn("hashes", shingles(F.col("w"), size))
        items = stage(
            hashed.withColumn("print", simhash(F.col("hashes")))
            .withColumn("turn", F.pmod(F.xxhash64("hashes"), F.lit(turns)))
            .drop("w", "size"),
            "prints",
        )
        for turn in range(turns):
            more = _matches(documents, items.filter(F.col("turn") == turn), size)
            found = more if found is None else found.union(more)
    if found is None:
        return documents.sparkSession.createDataFrame(
            [],
            "doc_id long, text_key long, item_id long, start int, n_words int, distance int, similarity double",
        )
    best = F.max(F.struct("similarity", (-F.col("start")).alias("back"), "distance"))
    return found.groupBy("doc_id", "text_key", "item_id", "n_words").agg(best.alias("best")).select(
        "doc_id",
        "text_key",
        "item_id",
        (-F.col("best.back")).alias("start"),
        "n_words",
        "best.distance",
        "best.similarity",
    )


def without_contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that contain no item; columns as given."""
    hits = stage(contaminated(documents, benchmark).select("doc_id", "text_key").distinct(), "hits")
    keyed = documents.withColumn("_llm_key", F.xxhash64("text"))
    hits = hits.withColumnRenamed("text_key", "_llm_key")
    return keyed.join(small(hits), same(keyed, hits, ["doc_id", "_llm_key"]), "left_anti").drop("_llm_key")


def op1_decontamination(spark, sf_dir: str) -> DataFrame:
    """All documents against all benchmark items."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = contaminated(documents, benchmark)
    return found.select("doc_id", "item_id", "start", "n_words", "similarity")


SQL = r"""
WITH items AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM benchmark
),
sized AS (SELECT item_id, w, len(w) AS n, least(len(w), 5) AS size FROM items WHERE len(w) > 0),
item_grams AS (
  SELECT item_id, n, size, w[i:i + size - 1] AS gram FROM sized, unnest(range(1, n - size + 2)) AS t(i)
),
docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM (SELECT DISTINCT doc_id, text FROM documents)
),
grams AS (
  SELECT r, size, i - 1 AS p, w[i:i + size - 1] AS gram
  FROM docs, (SELECT DISTINCT size FROM sized), unnest(range(1, len(w) - size + 2)) AS t(i)
),
starts AS (SELECT DISTINCT r, g.size, p, n FROM grams g JOIN item_grams i ON g.size = i.size AND g.gram = i.gram),
windowed AS (
  SELECT s.r, s.size, s.p, s.n, g.gram, count(*) AS c
  FROM starts s JOIN grams g ON g.r = s.r AND g.size = s.size AND g.p BETWEEN s.p AND s.p + s.n - s.size
  GROUP BY ALL
),
totals AS (SELECT r, size, p, n, sum(c) AS c FROM windowed GROUP BY ALL),
weighed AS (SELECT item_id, n, size, gram, count(*) AS c FROM item_grams GROUP BY ALL),
shared AS (
  SELECT w.r, w.size, w.p, w.n, i.item_id, sum(least(w.c, i.c))::BIGINT AS s
  FROM windowed w JOIN weighed i ON w.n = i.n AND w.size = i.size AND w.gram = i.gram GROUP BY ALL
),
measured AS (
  SELECT s.*, (t.c + s.n - s.size + 1 - s.s)::BIGINT AS joint FROM shared s JOIN totals t USING (r, size, p, n)
),
best AS (
  SELECT * FROM measured WHERE 100 * s >= 80 * joint
  QUALIFY row_number() OVER (PARTITION BY r, item_id ORDER BY s / joint DESC, p) = 1
)
SELECT doc_id, item_id, p::INTEGER AS start, n::INTEGER AS n_words, s / joint AS similarity
FROM best JOIN docs USING (r)
"""
