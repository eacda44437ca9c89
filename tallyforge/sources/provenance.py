"""Byte sizes and SHA-256 digests of source files, and of rows, computed by Spark tasks."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyforge.sources.tables import absolute, is_file

_CONTENT_LIMIT = "spark.sql.sources.binaryFile.maxLength"

#: Leaves of the tree of a large file, children of a node, and levels: enough for a file of a pebibyte.
CHUNK_BYTES = 1 << 20
FANOUT = 1024
LEVELS = 3

#: Splits of large files whose places are broadcast, a few dozen bytes each; beyond, they are joined.
_BROADCAST_SPLITS = 500_000
_BOM = b"\xef\xbb\xbf"


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """Every file below ``path``; contents are read only where they are used."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)


def digests(spark: SparkSession, path: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``file, bytes, sha256`` of every file; ``file`` is its path below ``path``.

    Spark's own readers open the files, so any file system they know will do.  A file that fits in
    one value has its plain SHA-256.  A larger one, by the session's limit for that, is read in
    parallel and has the root of a tree over its chunks, as ``tree-<chunk bytes>-<root>``.  Empty files,
    of which Spark's readers make no rows, are not listed.
    """
    files = list_files(spark, path)
    limit = int(spark.conf.get(_CONTENT_LIMIT, str(2**31 - 1)))
    inside = F.regexp_replace("path", "^[^:/]+:(//[^/]*)?", "")
    below = F.substr(inside, F.lit(len(absolute(spark, path)) + 2))
    named = [below.alias("file"), F.col("length").alias("bytes")]
    whole = files.filter(F.col("length") <= limit).select(*named, F.sha2("content", 256).alias("sha256"))
    large = files.filter(F.col("length") > limit).select(*named, F.col("_metadata.file_path").alias("_path"))
    if large.isEmpty():
        return whole
    roots = tree_roots(chunk_digests(spark, path, limit, chunk_bytes)).select(
        F.col("path").alias("_of"), F.concat(F.lit(f"tree-{chunk_bytes}-"), "digest").alias("sha256")
    )
    treed = large.join(roots, F.col("_path") == F.col("_of"), "left")
    return whole.unionByName(treed.select("file", "bytes", "sha256"))


def _setting_bytes(spark: SparkSession, name: str) -> int:
    """A size among the settings for files, such as 128MB."""
    text = spark.conf.get(f"spark.sql.files.{name}")
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(text)


def _large_lines(spark: SparkSession, path: str, limit: int) -> DataFrame:
    """The bytes of files above ``limit``, cut behind line feeds, with the split that each piece begins in.

    Cutting at line feeds is how Spark finds its way in from the middle of a file; nothing else about
    the bytes matters, they need not be text.
    """
    text = spark.read.option("recursiveFileLookup", True).option("lineSep", "\n").text(path)
    return text.filter(F.col("_metadata.file_size") > limit).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("value").cast("binary").alias("line"),
    )


def _block_places(lines: DataFrame) -> DataFrame:
    """Where the first line of each split begins, as ``path, block, start, size, bom``.

    A line counts with its line feed, which the last of a file may lack.  The reader leaves out a
    byte order mark at a file's beginning, which the sum of all lines tells by three bytes.
    """
    sums = lines.groupBy("path", "size", "block").agg(
        F.sum(F.octet_length("line").cast("long") + 1).alias("_bytes")
    )
    whole = Window.partitionBy("path")
    earlier = whole.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_bytes").over(earlier), F.lit(0))
    missing = F.col("size") - F.sum("_bytes").over(whole)
    placed = sums.withColumns({"_before": before, "_missing": missing})
    marked = F.col("_missing").isin(len(_BOM), len(_BOM) - 1)
    return placed.select(
        "path",
        "block",
        (F.col("_before") + F.when(marked & (F.col("_before") > 0), len(_BOM)).otherwise(0)).alias("start"),
        # A file that its name's ending has Spark decompress has another size; its text counts then.
        F.when(marked | F.col("_missing").isin(0, -1), F.col("size")).otherwise(2**62).alias("size"),
        (marked & (F.col("_before") == 0)).alias("bom"),
    )


def _chunks_of(batches: Iterable[pa.RecordBatch], chunk_bytes: int) -> Iterator[pa.RecordBatch]:
    """Digests of the chunks that lie in a split as a whole, and the bytes of those that reach over its ends."""
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary())
    names = ["path", "chunk", "at", "digest", "part"]
    split, at, held = None, 0, bytearray()
    out: list[tuple] = []

    def cut(last: bool) -> None:
        """Take all whole chunks off the bytes held, and what is left too if it is the split's ``last``."""
        nonlocal at
        taken = 0
        while taken < len(held):
            chunk = (at + taken) // chunk_bytes
            size = (chunk + 1) * chunk_bytes - (at + taken)
            if len(held) - taken < size and not last:
                break
            piece = bytes(held[taken : taken + size])
            if len(piece) == chunk_bytes:
                out.append((split[0], chunk, 0, hashlib.sha256(piece).hexdigest(), None))
            else:
                out.append((split[0], chunk, at + taken, None, piece))
            taken += len(piece)
        del held[:taken]
        at += taken

    for batch in batches:
        paths, blocks, starts, sizes, boms = (
            batch.column(c).to_pylist() for c in ("path", "block", "start", "size", "bom")
        )
        lines = batch.column("line").to_pylist()
        first = 0
        while first < len(lines):
            now = (paths[first], blocks[first])
            end = first + 1
            while end < len(lines) and (paths[end], blocks[end]) == now:
                end += 1
            if now != split:
                cut(last=True)
                split, at = now, starts[first]
                held += _BOM if boms[first] else b""
            held += b"\n".join(lines[first:end]) + b"\n"
            del held[max(0, sizes[first] - at) :]  # no line feed behind the last line
            cut(last=False)
            first = end
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out), kinds)], names)
            out.clear()
    cut(last=True)
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out), kinds)], names)


def chunk_digests(spark: SparkSession, path: str, limit: int, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``path, chunk, digest`` of every file above ``limit``: the SHA-256 of each ``chunk_bytes`` bytes.

    Chunks are counted from the file's first byte, so the result is the same however Spark splits the
    file.  A task reads its split line by line, knows from the sums of the splits before it where it is in
    the file, and sends on one digest a chunk, and the bytes of at most two that it shares.  A file's lines may
    have up to 2 GiB, which only their number of bytes without a line feed can exceed.
    """
    lines = _large_lines(spark, path, limit)
    least = min(_setting_bytes(spark, name) for name in ("maxPartitionBytes", "openCostInBytes"))
    sizes = list_files(spark, path).filter(F.col("length") > limit)
    splits = sizes.agg(F.sum(F.ceil(F.col("length") / least) + 1)).first()[0] or 0
    columns = ["path", "block", "start", "size", "bom", "line"]
    if splits <= _BROADCAST_SPLITS:
        # A broadcast leaves the lines of a split in their order.
        located = lines.drop("size").join(F.broadcast(_block_places(lines)), ["path", "block"]).select(columns)
    else:
        numbered = lines.drop("size").withColumn("_order", F.monotonically_increasing_id())
        joined = numbered.join(_block_places(lines), ["path", "block"])
        keys = ["path", "block"]
        located = joined.repartition(*keys).sortWithinPartitions(*keys, "_order").select(columns)
    pieces = located.mapInArrow(
        lambda batches: _chunks_of(batches, chunk_bytes),
        "path string, chunk long, at long, digest string, part binary",
    )
    parts = F.array_sort(F.collect_list(F.when(F.col("part").isNotNull(), F.struct("at", "part"))))
    joined_up = F.aggregate("parts", F.lit(b""), lambda so_far, x: F.concat(so_far, x["part"]))
    return (
        pieces.groupBy("path", "chunk")
        .agg(F.max("digest").alias("digest"), parts.alias("parts"))
        .select("path", "chunk", F.coalesce("digest", F.sha2(joined_up, 256)).alias("digest"))
    )


def tree_roots(chunks: DataFrame, fanout: int = FANOUT, levels: int = LEVELS) -> DataFrame:
    """``path, digest``: a node is the SHA-256 of its children's digests in hex, in order, at most ``fanout``."""
    nodes = chunks
    for _ in range(levels):
        children = F.array_sort(F.collect_list(F.struct("chunk", "digest")))
        up = F.floor(F.col("chunk") / fanout).cast("long").alias("chunk")
        grouped = nodes.groupBy("path", up).agg(children.alias("_children"))
        text = F.array_join(F.col("_children.digest"), "")
        nodes = grouped.select("path", "chunk", F.sha2(text, 256).alias("digest"))
    return nodes.select("path", "digest")


def _words(digest: Column) -> list[Column]:
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(8)]


def combined(digest: Column) -> Column:
    """Aggregate: one digest for a set of SHA-256 digests, whatever their number and order.

    The eight 32-bit words of the digests are added modulo 2^32, so the state is eight sums.
    """
    sums = [F.pmod(F.sum(w), F.lit(1 << 32)) for w in _words(digest)]
    return F.concat(*(F.lpad(F.lower(F.hex(s)), 8, "0") for s in sums))


def row_digests(frame: DataFrame, group: str, columns: list[str]) -> DataFrame:
    """Rows and combined digest of each group; a row's digest is that of its values, joined by '|'."""
    entry = F.sha2(F.concat_ws("|", *(F.col(c).cast("string") for c in columns)), 256)
    return frame.groupBy(group).agg(
        F.count(F.lit(1)).alias("row_count"), combined(entry).alias("sha256")
    )


def manifest(spark: SparkSession, sources: dict[str, str]) -> DataFrame:
    """One row per source: file count, bytes and a digest.

    A file has its own SHA-256, or its tree's root (see ``digests``).  A folder's combines, for each
    file, the digest of its path below the folder and its own digest: a folder of one file is not that
    file, and files that change places change the digest.
    """
    listed = None
    for name, path in sources.items():
        files = digests(spark, path).withColumns(
            {"source": F.lit(name), "alone": F.lit(is_file(spark, path))}
        )
        listed = files if listed is None else listed.unionByName(files)
    entry = F.sha2(F.concat_ws(":", "file", "sha256"), 256)
    sums = listed.groupBy("source", "alone").agg(
        F.count(F.lit(1)).alias("files"),
        F.sum("bytes").alias("bytes"),
        F.max("sha256").alias("_only"),
        combined(entry).alias("_all"),
    )
    return sums.select(
        "source", "files", "bytes", F.when(F.col("alone"), F.col("_only")).otherwise(F.col("_all")).alias("sha256")
    )
