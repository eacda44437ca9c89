"""Near-duplicate groups by MinHash signatures and a multi-index Hamming join.

A text's signature has ``SYMBOLS`` symbols of 16 bits, each from the smallest of the permuted hashes
of its shingles.  It is cut into chunks of like width (``layout``).  Two signatures that differ in fewer
than twice as many symbols as there are chunks differ in at most one symbol of some chunk (pigeonhole), so
each chunk is entered once for each symbol left out: all pairs within that distance share an entry, and
most pairs beyond it that still reach the similarity do.  The wanted similarity decides on the chunks and on the
distance up to which signatures are compared: a link at that similarity is lost by either cut with a
probability of at most ``MISS``.  At 0.85 these are 12 chunks (2.7e-7) and 30 symbols (6.9e-7), at 0.80
14 chunks (3.3e-7) and 36 symbols (5.1e-7).

Entries hold many texts, and a pair meets in many of them.  So entries are not turned into pairs: the texts
that share entries, directly or through others, make a cluster (each entry links its texts with one
of them, and components are found by contraction).  Clusters are packed into groups of about
``BLOCK`` texts, where signatures within that distance are compared on the full shingle sets, the nearest
first, and pairs already connected are passed over.  A larger cluster is cut into blocks, and every
two blocks meet in a group of their own.  Only links that connect leave a group, fewer than it has texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_long, as_text, same, small, stage
from .components import components
from .shingles import WordHashes, mixed, shingle_set

SYMBOLS = 84

#: Percent of the union that the intersection must reach.
PERCENT = 85

#: The most probable loss of a link of just that similarity, by each of the two cuts.
MISS = 7e-7

#: Texts in a block.
BLOCK = 1024


def layout(percent: int) -> tuple[int, int]:
    """Chunks of a signature, and the symbols that a link of ``percent`` may differ in.

    The fewest chunks and symbols that lose a link of just that similarity with at most ``MISS`` each.
    """
    alike = percent / 100
    lost = lambda bands, w: (1 - alike**w - w * alike ** (w - 1) * (1 - alike)) ** bands
    chunks = (n for n in range(1, SYMBOLS + 1) if SYMBOLS % n == 0)
    bands = next((n for n in chunks if lost(n, SYMBOLS // n) <= MISS), SYMBOLS)
    beyond, farthest = 0.0, SYMBOLS
    while farthest:
        beyond += comb(SYMBOLS, farthest) * (1 - alike) ** farthest * alike ** (SYMBOLS - farthest)
        if beyond > MISS:
            break
        farthest -= 1
    return bands, farthest


#: Chunks at ``PERCENT``.
BANDS = layout(PERCENT)[0]

_DRAW = np.random.default_rng(6).integers(0, 2**64, (3, SYMBOLS), np.uint64)
_FLIP, _TIMES, _WEIGHT = _DRAW[0], _DRAW[1] | np.uint64(1), _DRAW[2] | np.uint64(1)

SKETCH_TYPE = "doc_id string, text_key long, n_shingles long, node long, symbols binary"
SET_TYPE = "node long, symbols binary, shingles array<long>"


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One row of ``SYMBOLS`` 16-bit symbols for each non-empty set."""
    joined = np.concatenate(sets)
    starts = np.concatenate(([0], np.cumsum([len(s) for s in sets])[:-1]))
    out = np.empty((len(sets), SYMBOLS), np.uint16)
    for k in range(SYMBOLS):
        least = np.minimum.reduceat((joined ^ _FLIP[k]) * _TIMES[k], starts)
        out[:, k] = mixed(least) >> np.uint64(48)
    return out


def _sketches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    memo = WordHashes()
    for batch in batches:
        for at in range(0, len(batch), 256):
            part = batch.iloc[at : at + 256]
            sets = [shingle_set(x, memo) for x in part["text"]]
            full = [s for s in sets if len(s)]
            rows = iter(signatures(full)) if full else iter(())
            yield pd.DataFrame(
                {
                    "doc_id": part["doc_id"],
                    "text_key": part["text_key"],
                    "n_shingles": [len(s) for s in sets],
                    "node": pd.array(
                        [
                            np.uint64(xxhash.xxh3_64_intdigest(s.tobytes())).astype(np.int64) if len(s) else None
                            for s in sets
                        ],
                        "Int64",
                    ),
                    "symbols": [next(rows).tobytes() if len(s) else None for s in sets],
                }
            )


def _entries(batches: Iterator[pd.DataFrame], bands: int = BANDS) -> Iterator[pd.DataFrame]:
    place = np.arange(SYMBOLS, dtype=np.uint64).reshape(bands, -1)
    for batch in batches:
        for at in range(0, len(batch), 2048):
            part = batch.iloc[at : at + 2048]
            symbols = np.frombuffer(b"".join(part["symbols"]), np.uint16).reshape(-1, SYMBOLS)
            terms = (symbols.astype(np.uint64) * _WEIGHT).reshape(-1, *place.shape)
            rest = terms.sum(axis=2, dtype=np.uint64)[:, :, None] - terms
            keys = mixed(rest ^ mixed(place + np.uint64(1)))
            yield pd.DataFrame(
                {
                    "key": keys.reshape(-1).view(np.int64),
                    "node": np.repeat(part["node"].to_numpy(), SYMBOLS),
                }
            )


def _sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    memo = WordHashes()
    for batch in batches:
        for at in range(0, len(batch), 256):
            part = batch.iloc[at : at + 256]
            sets = [shingle_set(x, memo).view(np.int64) for x in part["text"]]
            yield pd.DataFrame({"node": part["node"], "symbols": part["symbols"], "shingles": sets})


def with_text_key(documents: DataFrame) -> DataFrame:
    """doc_id, text and a 64-bit key of the text; rows alike in all of them count as one text."""
    return documents.select("doc_id", "text", F.xxhash64("text").alias("text_key"))


def distances(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Differing symbols of every signature on the left with every one on the right."""
    total = np.zeros((len(left), len(right)), np.uint8)
    for k in range(SYMBOLS):
        total += left[:, k, None] != right[None, :, k]
    return total


def reaches(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether the sorted sets share ``percent`` of their union."""
    if len(a) > len(b):
        a, b = b, a
    if 100 * len(a) < percent * len(b):
        return False
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    common = int((b[at] == a).sum())
    return 100 * common >= percent * (len(a) + len(b) - common)


def connect(
    symbols: np.ndarray, sets: list[np.ndarray], side: np.ndarray, percent: int
) -> list[tuple[int, int]]:
    """Links that connect the texts as all links would; none between texts of the same ``side`` > 0.

    Candidates are verified by increasing distance; before each part those whose texts are
    connected by now are dropped.
    """
    here = np.arange(len(sets))
    rows, columns = (here, here) if not side.any() else (here[side == 1], here[side == 2])
    far = distances(symbols[rows], symbols[columns])
    i, j = np.nonzero(far <= layout(percent)[1])
    order = np.argsort(far[i, j], kind="stable")
    a, b = rows[i[order]], columns[j[order]]
    if not side.any():
        a, b = a[a < b], b[a < b]
    label, links, step = here.copy(), [], 64
    while len(a):
        for x, y in zip(a[:step].tolist(), b[:step].tolist()):
            if label[x] != label[y] and reaches(sets[x], sets[y], percent):
                links.append((x, y))
                label[label == label[y]] = label[x]
        a, b = a[step:], b[step:]
        apart = label[a] != label[b]
        a, b = a[apart], b[apart]
        step = min(2 * step, 8192)
    return links


def _connector(percent: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, own in rows.groupby("cluster", sort=False):
            node = own["node"].to_numpy()
            symbols = np.frombuffer(b"".join(own["symbols"]), np.uint16).reshape(-1, SYMBOLS)
            sets = [x.view(np.uint64) for x in own["shingles"]]
            links = connect(symbols, sets, own["side"].to_numpy(), percent)
            out += [(node[x], node[y]) for x, y in links]
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return run


def groups(nodes: DataFrame, documents: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``node`` and ``label`` of all nodes that are linked with another one.

    ``nodes``: one row for each distinct shingle set, with its signature and one of its documents.
    """
    bands, _ = layout(percent)
    found = nodes.select("node", "symbols").mapInPandas(
        lambda batches: _entries(batches, bands), "key long, node long"
    )
    shared = found.groupBy("key").count().filter("count > 1").select("key")
    met = stage(found.join(shared, "key", "left_semi"), "met")
    first = met.groupBy("key").agg(F.min("node").alias("b"))
    star = met.join(first, "key").select(F.col("node").alias("a"), "b")
    clusters = components(star)

    # Which groups a text goes to: its cluster's, or one for each block its block has to meet.
    sizes = clusters.groupBy("label").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    placed = stage(
        clusters.join(sizes, "label").select(
            "node", F.col("label").alias("cluster"), "blocks", F.pmod(F.xxhash64("node"), "blocks").alias("own")
        ),
        "clusters",
    )
    chosen = nodes.join(placed.select("node"), "node", "left_semi")
    wanted = stage(chosen.select("node", "symbols", "doc_id", "text_key"), "wanted")
    keyed = with_text_key(documents)
    texts = keyed.join(small(wanted, 100_000), same(keyed, wanted, ["doc_id", "text_key"])).select(
        "node", "symbols", "text"
    )
    sets = stage(texts.mapInPandas(_sets, SET_TYPE), "sets")
    if sets.count() > wanted.count():
        sets = stage(sets.dropDuplicates(["node"]), "sets")  # rows repeated with id and text

    direct = _star_links(star, placed.filter("blocks > 1"), sets, percent)
    if direct is not None:
        placed = placed.join(_settled(placed, direct), "cluster", "left_anti")
    packs = -(-placed.count() // BLOCK)
    meets = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    alone = F.col("blocks") == 1
    routed = stage(
        placed.withColumn("other", meets).select(
            "node",
            "cluster",
            F.when(alone, F.pmod(F.xxhash64("cluster"), F.lit(max(packs, 1)))).otherwise(F.col("cluster")).alias("pack"),
            F.when(alone, -1).otherwise(F.least("own", "other")).alias("low"),
            F.when(alone, -1).otherwise(F.greatest("own", "other")).alias("high"),
            F.when(F.col("own") < F.col("other"), 1).when(F.col("own") > F.col("other"), 2).otherwise(0).alias("side"),
        ),
        "routed",
    )

    meeting = sets.join(small(routed), "node").groupBy("pack", "low", "high")
    links = stage(meeting.applyInPandas(_connector(percent), "a long, b long"), "links")
    return components(links if direct is None else links.union(direct))


def _star_links(star: DataFrame, large: DataFrame, sets: DataFrame, percent: int) -> DataFrame | None:
    """The verified links of nodes in ``large`` clusters with the nodes that their entries hang on.

    That is a few pairs a node, however many nodes a cluster has.
    """
    if large.isEmpty():
        return None
    pairs = star.filter("a <> b").join(large.select(F.col("node").alias("a")), "a", "left_semi").distinct()
    sized = lambda name: sets.select(F.col("node").alias(name), F.col("shingles").alias(f"{name}_set"))
    both = pairs.join(sized("a"), "a").join(sized("b"), "b")
    shared = F.size(F.array_intersect("a_set", "b_set"))
    joint = F.size("a_set") + F.size("b_set") - shared
    return stage(both.filter(100 * shared >= percent * joint).select("a", "b"), "direct")


def _settled(placed: DataFrame, direct: DataFrame) -> DataFrame:
    """The clusters all of whose nodes the ``direct`` links already connect: no more pairs are needed there."""
    reached = components(direct).select("node", "label")
    joined = placed.join(reached, "node", "left").withColumn("label", F.coalesce("label", "node"))
    ends = joined.filter("blocks > 1").groupBy("cluster").agg(
        F.min("label").alias("low"), F.max("label").alias("high")
    )
    return stage(ends.filter("low = high").select("cluster"), "settled")


def near_duplicates(documents: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row, with its text_key and group label.

    ``component_id`` is the smallest doc_id linked directly or through others.  Texts without words
    are linked with nothing.  A null doc_id never names a component; a component of nulls only has
    a null id.  ``kept`` tells whether the row carries its component's id, null included; rows
    repeated with id and text are alike and all have the same result.  An empty table gives no rows.
    Texts of any length are taken whole; columns other than ``doc_id`` and ``text`` are not looked at.
    """
    keyed = with_text_key(documents)
    read = as_text(keyed, "doc_id").mapInPandas(_sketches, SKETCH_TYPE)
    sketches = stage(as_long(read, "doc_id"), "sketches")
    nodes = stage(
        sketches.filter("n_shingles > 0").groupBy("node").agg(
            F.min("n_shingles").alias("n_shingles"),
            F.min("symbols").alias("symbols"),
            F.min(F.struct("doc_id", "text_key")).alias("one"),
        ).select("node", "n_shingles", "symbols", "one.doc_id", "one.text_key"),
        "nodes",
    )
    labels = groups(nodes, documents, percent)
    slim = sketches.select("doc_id", "text_key", "n_shingles", "node")
    placed = stage(
        slim.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")), "placed"
    )
    # Stored, so that the join has two plain sides, of which Spark can split a large group's.
    heads = stage(
        placed.filter("label is not null").groupBy("label").agg(F.min("doc_id").alias("head")), "heads"
    )
    joined = placed.join(heads, "label", "left").withColumn(
        "component_id", F.when(F.col("label").isNull(), F.col("doc_id")).otherwise(F.col("head"))
    )
    return joined.select(
        "doc_id",
        "n_shingles",
        "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
        "text_key",
        "label",
    )


def one_of_each(documents: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The documents without all but one of each component; columns as given.

    The one with the smallest doc_id stays.  Where rows share that id, or all ids are null, any
    one of them stays.  Documents without words all stay.
    """
    found = stage(near_duplicates(documents, percent), "found")
    alike = found.filter("kept and label is not null")
    shared = alike.groupBy("label").count().filter("count > 1").select("label")
    keys = ["doc_id", "_llm_key"]
    crowded = stage(
        alike.join(shared, "label", "left_semi")
        .select("doc_id", F.col("text_key").alias("_llm_key"), F.col("label").alias("_llm_label"))
        .distinct(),
        "crowded",
    )
    gone = found.filter("not kept").select("doc_id", F.col("text_key").alias("_llm_key"))
    apart = stage(gone.union(crowded.select(keys)).distinct(), "apart")
    keyed = documents.withColumn("_llm_key", F.xxhash64("text"))
    rest = keyed.join(small(apart), same(keyed, apart, keys), "left_anti").select(documents.columns)
    if crowded.isEmpty():
        return rest
    one = keyed.join(small(crowded), same(keyed, crowded, keys)).dropDuplicates(["_llm_label"])
    return rest.union(one.select(*(keyed[c] for c in documents.columns)))


def op6_minhash(spark, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_duplicates(documents).drop("text_key", "label")
