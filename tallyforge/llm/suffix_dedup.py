"""Removal of byte strings that repeat anywhere, by sharded suffix arrays.

Shards have to be such that a string and its copies meet.  Each string of ``LENGTH`` bytes is
therefore given an anchor, the 64-byte piece in it with the smallest hash (the last of equals): copies
have the same anchor at the same place.  The strings of one text that share an anchor form a snippet.
Snippets whose anchor occurs nowhere else are done; equal snippets repeat as a whole and are
entered once.  What is left is dealt into shards of a few megabytes by anchor.  A shard sorts its
suffixes by Larsson and Sadakane's refinement and takes common prefixes by Kasai's rule; stretches of
the suffix array with common prefixes of ``LENGTH`` and more are the strings that repeat.

An anchor with too many snippets for one shard is dealt over several.  Each of them lists its different
strings by their 128-bit digests; the lists are cut into ranges, of which a shard sends one packed row each, and
within a range a binary search of each list in the merged one finds the strings that other shards have as well.

A text is known by the first 128 bits of its SHA-256.  Copies of a whole text of ``LENGTH`` bytes or more
go altogether, so that only one of them is read again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_long, as_text, same, small, stage
from .shingles import mixed
from .suffix_arrays import common_prefixes, suffix_array

LENGTH = 400
_LEVELS = 6
GRAM = 2**_LEVELS
_PIECE = 2**22

#: Bytes of snippets in a shard, and digests in a range of the merge.
SHARD_BYTES = 400_000
RANGE_ROWS = 200_000

#: Places of an anchor from which on they are dealt over ``DEALS`` tasks where they meet its counts.
FREQUENT = 5_000
DEALS = 64

_DRAW = np.random.default_rng(2).integers(0, 2**64, 256 + _LEVELS, np.uint64) | np.uint64(1)
_BYTES, _TIMES = _DRAW[:256], _DRAW[256:]

TEXT_TYPE = (
    "doc_id string, n_bytes long, sha string, text_id binary, "
    "anchors array<struct<anchor:long,snippet:long,first:int,last:int>>"
)
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def text_bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def anchors(data: bytes) -> list[tuple[int, int, int, int]]:
    """(hash of the anchor, hash of the snippet, first and last start of its strings) in order."""
    found = []
    for base in range(0, max(len(data) - LENGTH + 1, 0), _PIECE):
        piece = np.frombuffer(data, np.uint8)[base : base + _PIECE + LENGTH - 1]
        grams, step = _BYTES[piece], 1
        for level in range(_LEVELS):
            grams = grams[:-step] * _TIMES[level] + grams[step:]
            step *= 2
        grams = mixed(grams)
        low = np.uint64(2**24 - 1)
        least = (grams & ~low) | (low - np.arange(len(grams), dtype=np.uint64))
        width, span = LENGTH - GRAM + 1, 1
        while 2 * span <= width:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        if span < width:
            least = np.minimum(least[: span - width], least[width - span :])
        at = (low - (least & low)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        last = np.concatenate([first[1:], [len(at)]]) - 1
        hashes = grams[at[first]].view(np.int64).tolist()
        for h, a, b in zip(hashes, (first + base).tolist(), (last + base).tolist()):
            digest = xxhash.xxh3_64_intdigest(data[a : b + LENGTH])
            found.append((h, digest - 2**64 if digest >= 2**63 else digest, a, b))
    return found


def _texts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for at in range(0, len(batch), 512):
            part = batch.iloc[at : at + 512]
            bodies = [text_bytes(x) for x in part["text"]]
            digests = [hashlib.sha256(x) for x in bodies]
            yield pd.DataFrame(
                {
                    "doc_id": part["doc_id"],
                    "n_bytes": [len(x) for x in bodies],
                    "sha": [x.hexdigest() for x in digests],
                    "text_id": [x.digest()[:16] for x in digests],
                    "anchors": [
                        [dict(zip(("anchor", "snippet", "first", "last"), x)) for x in anchors(b)]
                        for b in bodies
                    ],
                }
            )


def _snippets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for text, wanted in zip(batch["text"], batch["wanted"]):
            data = text_bytes(text)
            yield pd.DataFrame(
                [
                    (x["shard"], x["parts"], x["anchor"], x["snippet"], data[x["first"] : x["last"] + LENGTH])
                    for x in wanted
                ],
                columns=["shard", "parts", "anchor", "snippet", "body"],
            )


REPEAT_TYPE = (
    "shard long, range long, anchors array<long>, snippets array<long>, firsts array<int>, "
    "lasts array<int>, highs array<long>, lows array<long>"
)
_PACKED = [x.split()[0] for x in REPEAT_TYPE.split(", ")]

#: Stands for no start in the packed lists.
_NOWHERE = -1


def _runs(hit: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    return list(zip(edges[::2].tolist(), (edges[1::2] - 1).tolist()))


def _packed(shard: int, place: int | None, columns: list[np.ndarray]) -> tuple:
    kinds = (np.int64, np.int64, np.int32, np.int32, np.int64, np.int64)
    return (shard, place, *(np.asarray(c, k) for c, k in zip(columns, kinds)))


def _shard_repeats(rows: pd.DataFrame, ranges: int) -> pd.DataFrame:
    """Strings of the shard's snippets that repeat in it, as stretches of starts in a snippet: one row.

    Further rows, one for each of the ``ranges`` met, list the digests of the different strings of anchors that are
    dealt over several shards; ``firsts`` is there the start of a string found once, else ``_NOWHERE``.
    """
    rows = rows.drop_duplicates(["anchor", "snippet"])  # a document repeated with id and text
    bodies = rows["body"].tolist()
    shard = int(rows["shard"].iloc[0])
    sizes = np.array([len(x) for x in bodies])
    ends = np.cumsum(sizes)
    data = np.frombuffer(b"".join(bodies), np.uint8)
    order = suffix_array(data)
    group = np.cumsum(common_prefixes(data, order) < LENGTH)
    class_of = np.empty(len(data), np.int64)
    class_of[order] = group
    owner = np.repeat(np.arange(len(bodies)), sizes)
    starts = np.flatnonzero(np.arange(len(data)) + LENGTH <= np.repeat(ends, sizes))
    times = np.bincount(class_of[starts], minlength=group[-1] + 1)
    hit = np.zeros(len(data), bool)
    hit[starts] = times[class_of[starts]] > 1
    anchors, snippets = rows["anchor"].to_numpy(np.int64), rows["snippet"].to_numpy(np.int64)
    begin, out = ends - sizes, []
    # A snippet's last start lies before its end, so that no run reaches into the next snippet.
    runs = np.array(_runs(hit), np.int64).reshape(-1, 2)
    if len(runs):
        own = owner[runs[:, 0]]
        at = (runs - begin[own][:, None]).T
        out.append(_packed(shard, None, [anchors[own], snippets[own], *at, [], []]))
    split = rows["parts"].to_numpy() > 1
    if split.any():
        mine = starts[split[owner[starts]]]
        _, one = np.unique(class_of[mine], return_index=True)
        mine, body = mine[one], data.tobytes()
        digests = b"".join(xxhash.xxh3_128_digest(body[p : p + LENGTH]) for p in mine.tolist())
        high, low = np.frombuffer(digests, np.int64).reshape(-1, 2).T
        own = owner[mine]
        first = np.where(times[class_of[mine]] == 1, mine - begin[own], _NOWHERE)
        place = high.astype(np.uint64) % np.uint64(ranges)
        by = np.argsort(place, kind="stable")
        for part in np.split(by, np.flatnonzero(np.diff(place[by])) + 1):
            columns = [anchors[own[part]], snippets[own[part]], first[part], [], high[part], low[part]]
            out.append(_packed(shard, int(place[part[0]]), columns))
    return pd.DataFrame(out, columns=_PACKED).astype({"range": "Int64"})


def merge_range(rows: pd.DataFrame) -> pd.DataFrame:
    """Of the shards' lists in one range, the strings that more than one of them has."""
    parts = [rows[["anchor", "high", "low"]].to_numpy(np.int64)]
    table = np.ascontiguousarray(parts[0]).view([("anchor", "i8"), ("high", "i8"), ("low", "i8")]).reshape(-1)
    names = np.unique(table, return_inverse=True)[1].reshape(-1)
    merged = np.sort(names)
    shared = np.zeros(len(rows), bool)
    for _, own in pd.Series(np.arange(len(rows))).groupby(rows["shard"].to_numpy()):
        listed = names[own.to_numpy()]
        found = np.searchsorted(merged, listed, "right") - np.searchsorted(merged, listed, "left")
        shared[own.to_numpy()] = found > 1
    return rows[shared & rows["first"].notna().to_numpy()]


def _merge_lists(rows: pd.DataFrame) -> pd.DataFrame:
    """``merge_range`` for the packed lists of one range: one row with what is shared."""
    sizes = [len(x) for x in rows["highs"]]
    joined = {k: np.concatenate(rows[f"{k}s"].tolist()) for k in ("anchor", "snippet", "first", "high", "low")}
    table = pd.DataFrame(joined | {"shard": np.repeat(rows["shard"].to_numpy(), sizes)})
    table["first"] = table["first"].astype("Int32").mask(table["first"] == _NOWHERE)
    found = merge_range(table)
    if not len(found):
        return pd.DataFrame(columns=_PACKED).astype({"shard": "int64", "range": "Int64"})
    first = found["first"].to_numpy(np.int32)
    columns = [found["anchor"], found["snippet"], first, first, [], []]
    return pd.DataFrame([_packed(-1, None, columns)], columns=_PACKED).astype({"range": "Int64"})


def _meet(places: DataFrame, counts: DataFrame, size: str, how: str) -> DataFrame:
    """``places`` joined with ``counts`` by anchor; those of an anchor with a large ``size`` in many tasks.

    Anchors with ``FREQUENT`` places or more are few, whatever the rest.
    """
    deal = F.when(F.col(size) >= FREQUENT, F.lit(DEALS)).otherwise(1)
    often = counts.filter(F.col(size) >= FREQUENT).select("anchor", F.lit(True).alias("_often"))
    marked = places.join(small(often), "anchor", "left")
    salted = marked.withColumn(
        "_deal", F.when(F.col("_often"), F.pmod(F.xxhash64("text_id", "first"), F.lit(DEALS))).otherwise(F.lit(0).cast("long"))
    )
    dealt = counts.withColumn("_deal", F.explode(F.sequence(F.lit(0).cast("long"), (deal - 1).cast("long"))))
    return salted.drop("_often").join(dealt, ["anchor", "_deal"], how).drop("_deal")


def _cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = []
        for text_id, text, starts in zip(batch["text_id"], batch["text"], batch["starts"]):
            data, spans = text_bytes(text), []
            for first, last in sorted((x["first"], x["last"]) for x in starts):
                if spans and first <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], last + LENGTH)
                else:
                    spans.append([first, last + LENGTH])
            kept, at = hashlib.sha256(), 0
            for first, end in spans:
                kept.update(data[at:first])
                at = end
            kept.update(data[at:])
            out.append((text_id, sum(b - a for a, b in spans), spans, kept.hexdigest()))
        yield pd.DataFrame(out, columns=["text_id", "n_removed", "spans", "kept_sha256"])


def repeated_spans(documents: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, spans (arrays of [start, end) in bytes) and kept_sha256 of each row.

    A null text counts as empty.  Repeated rows are copies of each other: with ``LENGTH`` bytes or
    more both go.  Ids may be null or repeated; texts of any length are taken whole; an empty table
    gives no rows; other columns are not looked at.
    """
    read = as_text(documents.select("doc_id", "text"), "doc_id").mapInPandas(_texts, TEXT_TYPE)
    texts = stage(as_long(read, "doc_id"), "texts")
    occurring = texts.select("text_id", F.explode("anchors").alias("a")).select("text_id", "a.*")
    again = stage(occurring.groupBy("anchor").count().filter("count > 1"), "again")
    met = stage(_meet(occurring, again, "count", "left_semi"), "met")

    snippets = stage(
        met.groupBy("anchor", "snippet").agg(
            F.count(F.lit(1)).alias("times"), F.min(F.struct("text_id", "first", "last")).alias("one")
        ),
        "snippets",
    )
    size = F.col("one.last") - F.col("one.first") + LENGTH
    kinds = snippets.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds"), F.sum(size).alias("bytes"))
    kinds = stage(kinds.filter("kinds > 1"), "kinds")
    shards = -(-(kinds.agg(F.sum("bytes")).first()[0] or 0) // SHARD_BYTES)
    parts = F.ceil(F.col("bytes") / SHARD_BYTES)
    part = F.pmod(F.xxhash64("snippet"), F.col("parts"))
    ones = snippets.select("anchor", "snippet", "times", "one.*")
    dealt = stage(
        _meet(ones, kinds.withColumn("parts", parts).select("anchor", "kinds", "parts"), "kinds", "inner").select(
            "anchor",
            "snippet",
            "times",
            "parts",
            "text_id",
            "first",
            "last",
            F.pmod(F.xxhash64("anchor", part), F.lit(max(shards, 1))).alias("shard"),
        ),
        "dealt",
    )

    owners = texts.select("text_id", "doc_id").join(met.select("text_id").distinct(), "text_id", "left_semi")
    owners = stage(owners.groupBy("text_id").agg(F.min("doc_id").alias("doc_id")), "owners")
    sha = F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256)
    named = documents.select("doc_id", "text", F.unhex(F.substring(sha, 1, 32)).alias("text_id"))
    bodies = stage(
        named.join(small(owners), same(named, owners, ["text_id", "doc_id"])).select(named["text_id"], "text"),
        "bodies",
    )
    if bodies.count() > owners.count():
        bodies = stage(bodies.dropDuplicates(["text_id"]), "bodies")

    wanted = dealt.groupBy("text_id").agg(
        F.collect_list(F.struct("shard", "parts", "anchor", "snippet", "first", "last")).alias("wanted")
    )
    cut = bodies.join(wanted, "text_id").select("text", "wanted").mapInPandas(
        _snippets, "shard long, parts long, anchor long, snippet long, body binary"
    )
    strings = dealt.filter("parts > 1").agg(F.sum(F.col("last") - F.col("first") + 1)).first()[0] or 0
    ranges = max(1, -(-strings // RANGE_ROWS))
    packed = cut.groupBy("shard").applyInPandas(lambda rows: _shard_repeats(rows, ranges), REPEAT_TYPE)
    repeats = stage(packed, "repeats")
    merged = repeats.filter("range is not null").groupBy("range").applyInPandas(_merge_lists, REPEAT_TYPE)
    zipped = F.arrays_zip("anchors", "snippets", "firsts", "lasts")
    found = repeats.filter("range is null").union(merged).select(F.explode(zipped).alias("x")).select(
        F.col("x.anchors").alias("anchor"),
        F.col("x.snippets").alias("snippet"),
        F.col("x.firsts").alias("from"),
        F.col("x.lasts").alias("to"),
    )

    whole = met.join(snippets.filter("times > 1").select("anchor", "snippet"), ["anchor", "snippet"], "left_semi")
    inside = found.join(dealt.filter("times = 1"), ["anchor", "snippet"])
    starts = whole.select("text_id", "first", "last").union(
        inside.select("text_id", F.col("first") + F.col("from"), F.col("first") + F.col("to"))
    )
    by_text = starts.groupBy("text_id").agg(F.collect_list(F.struct("first", "last")).alias("starts"))
    removed = stage(
        bodies.join(by_text, "text_id").mapInPandas(
            _cut, "text_id binary, n_removed long, spans array<array<long>>, kept_sha256 string"
        ),
        "removed",
    )
    copied = stage(
        texts.groupBy("text_id").count().filter("count > 1").select("text_id", F.lit(True).alias("copied")),
        "copied",
    )
    rows = texts.select("doc_id", "n_bytes", "sha", "text_id")
    rows = rows.join(removed, "text_id", "left").join(small(copied), "text_id", "left")
    gone = F.col("copied").isNotNull() & (F.col("n_bytes") >= LENGTH)
    everything = F.array(F.array(F.lit(0).cast("long"), F.col("n_bytes")))
    nothing = F.array().cast("array<array<bigint>>")
    return rows.select(
        "doc_id",
        "n_bytes",
        F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(gone, everything).otherwise(F.coalesce("spans", nothing)).alias("spans"),
        F.when(gone, F.lit(EMPTY_SHA)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
    )


def op2_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    """Bytes removed from every document."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = repeated_spans(documents)
    return found.select(
        "doc_id",
        "n_bytes",
        "n_removed",
        F.size("spans").cast("long").alias("n_spans"),
        "kept_sha256",
        "spans",
    )
