"""Groups of spelling variants: words one letter apart, each led to its more frequent form.

The vocabulary is cut into blocks by intact pieces: two words one edit apart share the first or the
last half of the shorter one's length.  In a block, a bit-sliced position index has a bit set over the
block's words for each (position, letter).  A word is matched against all of them at once: reading
it letter by letter, one set holds the words met without an error, one those with a letter
replaced, and one those with a letter more, which are met one position further on.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small, stage

#: Fixed by the contract.
LEAST_LETTERS = 5
LEAST_OCCURRENCES = 3
MISSPELT = 97

#: Latin-1 bytes as letters: A-Z in lower case, U+00C0 to U+00FF as they are, all else a space.
LETTERS = bytes(
    x + 32 if 65 <= x <= 90 else x if 97 <= x <= 122 or x >= 0xC0 else 32 for x in range(256)
)
#: Words counted in a task before the counts are handed on.
WORDS_HELD = 200_000
#: Words of a block that one index holds; larger blocks are cut further, until the words of a block have
#: one free letter, or two, of 91.
BLOCK_WORDS = 4_096
BLOCK = ["shorter", "left", "right", "head", "tail"]


def misspelt(run: bytes, seed: int) -> bytes:
    """The contract's word of a lower-cased run (Latin-1); ``seed`` is the crc32 of ``<doc_id>:``."""
    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), seed)
    if h % MISSPELT:
        return run
    return run[: h % len(run)] + run[h % len(run) + 1 :]


def _occurrences(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter[bytes] = Counter()

    def handed_on() -> pa.RecordBatch:
        words = pa.array([w.decode("latin-1") for w in held], pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(held.values(), pa.int64())], ["word", "n"])

    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            # Code points beyond Latin-1 become question marks, which are no letters either.
            runs = Counter((text or "").encode("latin-1", "replace").translate(LETTERS).split())
            seed = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
            for run, n in runs.items():
                if len(run) >= LEAST_LETTERS:
                    word = misspelt(run, seed)
                    if len(word) >= LEAST_LETTERS:
                        held[word] += n
            if len(held) > WORDS_HELD:
                yield handed_on()
                held.clear()
    yield handed_on()


def vocabulary(documents: DataFrame) -> DataFrame:
    """``word, n``: the words of all whole texts with at least three occurrences overall."""
    counted = documents.select("doc_id", "text").mapInArrow(_occurrences, "word string, n long")
    summed = counted.groupBy("word").agg(F.sum("n").alias("n"))
    return stage(summed.filter(F.col("n") >= LEAST_OCCURRENCES), "vocabulary")


def _cut(left: Column, right: Column) -> list[Column]:
    """A word's block by its first ``left`` and last ``right`` letters."""
    tail = F.when(right > 0, F.expr("right(word, right)")).otherwise("")
    return [F.substring(F.col("word"), F.lit(1), left).alias("head"), tail.alias("tail")]


def _placed(frame: DataFrame, pieces: list[Column]) -> DataFrame:
    """Rows once per piece: a struct of ``shorter``, ``left`` and ``right``."""
    spread = frame.select("word", "n", F.explode(F.array(*pieces)).alias("_piece"))
    flat = spread.select("word", "n", "_piece.*")
    return flat.select("*", *_cut(F.col("left"), F.col("right")))


def _piece(shorter: Column, left: Column, right: Column) -> Column:
    return F.struct(shorter.alias("shorter"), left.alias("left"), right.alias("right"))


def blocks(words: DataFrame) -> DataFrame:
    """Every word once per block that it belongs to: as a word of the shorter or the longer length.

    A block is of words with ``shorter`` letters or one more that begin and end alike.  Where it has
    more than ``BLOCK_WORDS`` words, the free letters in between are halved again in the same way, so
    that no pair is lost and a common beginning never gathers in one task.
    """
    length, none = F.length("word"), F.lit(0)
    own, longer = F.floor(length / 2).cast("int"), F.floor((length - 1) / 2).cast("int")
    pieces = [
        _piece(length, own, none),
        _piece(length, none, own),
        _piece(length - 1, longer, none),
        _piece(length - 1, none, longer),
    ]
    open_ = _placed(words, pieces).filter(F.col("shorter") >= LEAST_LETTERS)
    done: DataFrame | None = None
    while True:
        open_ = stage(open_, "blocks")
        free = F.col("shorter") - F.col("left") - F.col("right")
        sizes = open_.groupBy(*BLOCK).agg(F.count(F.lit(1)).alias("size"))
        large = stage(sizes.filter((F.col("size") > BLOCK_WORDS) & (free > 1)).drop("size"), "large")
        if large.isEmpty():
            return open_ if done is None else done.unionByName(open_)
        fitting = open_.join(small(large), BLOCK, "left_anti")
        done = fitting if done is None else done.unionByName(fitting)
        half = F.floor(free / 2).cast("int")
        further = [
            _piece(F.col("shorter"), F.col("left") + half, F.col("right")),
            _piece(F.col("shorter"), F.col("left"), F.col("right") + half),
        ]
        again = _placed(open_.join(small(large), BLOCK, "left_semi"), further)
        open_ = again.dropDuplicates(["word", "shorter", "left", "right"])


def one_edit_apart(words: list[str], shorter: int) -> Iterator[tuple[int, int]]:
    """Pairs (i, j) of the ``shorter`` words i and words j, as long or one letter longer, one edit apart.

    The words are distinct.  Pairs of words equally long come in both orders.
    """
    index: dict[tuple[int, str], int] = {}
    lengths: dict[int, int] = {}
    for i, word in enumerate(words):
        lengths[len(word)] = lengths.get(len(word), 0) | 1 << i
        for place in enumerate(word):
            index[place] = index.get(place, 0) | 1 << i
    everyone, as_long, one_longer = (1 << len(words)) - 1, lengths.get(shorter, 0), lengths.get(shorter + 1, 0)
    for i, word in enumerate(words):
        if len(word) != shorter:
            continue
        myself = 1 << i
        exact, replaced, added = everyone, 0, 0
        for at, letter in enumerate(word):
            here, ahead = index[at, letter], index.get((at + 1, letter), 0)
            replaced = replaced & here | exact
            added = (added | exact) & ahead
            exact &= here
            if exact | replaced | added == myself:
                break
        else:
            found = replaced & as_long | (added | exact) & one_longer
            found &= ~myself
            while found:
                j = found.bit_length() - 1
                yield i, j
                found ^= 1 << j


def _near(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near pairs of sorted blocks, which may go on from one batch to the next."""

    def rows() -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(batch.column(c).to_pylist() for c in [*BLOCK, "word", "n"]))

    def table(out: list[list]) -> pa.RecordBatch:
        kinds = (pa.string(), pa.string(), pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array(x, kind) for x, kind in zip(out, kinds)], ["word", "near", "near_n"]
        )

    out: list[list] = [[], [], []]
    for block, members in groupby(rows(), key=lambda row: row[: len(BLOCK)]):
        # A word can come to a block by several ways of cutting.
        words, counts = map(list, zip(*dict(row[len(BLOCK) :] for row in members).items()))
        for i, j in one_edit_apart(words, block[0]) if len(words) > 1 else ():
            both = [(i, j)] if len(words[i]) == len(words[j]) else [(i, j), (j, i)]
            for a, b in both:
                for column, value in zip(out, (words[a], words[b], counts[b])):
                    column.append(value)
        if len(out[0]) > 10_000:
            yield table(out)
            out = [[], [], []]
    yield table(out)


def near_words(words: DataFrame) -> DataFrame:
    """``word, near, near_n``: every two words of a vocabulary that are one edit apart, both ways."""
    sorted_ = blocks(words).repartition(*BLOCK).sortWithinPartitions(*BLOCK)
    pairs = sorted_.mapInArrow(_near, "word string, near string, near_n long")
    # Two words may share both halves, or several blocks of a large one.
    return pairs.repartition("word").dropDuplicates(["word", "near"])


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of every word with a form: the end of its chain, by jumps of doubled length.

    Along a chain occurrences double at least, so that it has an end after a few dozen steps.
    """
    jumps = stage(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = jumps.select(F.col("word").alias("_from"), F.col("root").alias("_to"))
        doubled = jumps.join(onward, F.col("root") == F.col("_from"), "left").select(
            "word", F.coalesce("_to", "root").alias("root"), F.col("_to").isNotNull().alias("moved")
        )
        jumps = stage(doubled, "roots")
        if jumps.filter("moved").isEmpty():
            return jumps.drop("moved")


def variants(words: DataFrame) -> DataFrame:
    """Each word of a stored vocabulary ``word, n`` with its form and root; see the query for columns."""
    preferred = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form")))
    near = near_words(words).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), preferred.alias("_first")
    )
    joined = words.join(near.withColumnRenamed("word", "_word"), F.col("word") == F.col("_word"), "left")
    better = -F.col("_first.less") >= 2 * F.col("n")
    told = stage(
        joined.select(
            "word",
            F.when(better, F.col("_first.form")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(better, -F.col("_first.less")).alias("form_n"),
        ),
        "variants",
    )
    ends = roots(told.filter(F.col("form").isNotNull())).withColumnRenamed("word", "_word")
    return told.join(ends, F.col("word") == F.col("_word"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def op11_spelling_variants(spark, sf_dir: str) -> DataFrame:
    """All words of all documents with their near words, form and root.

    Null and empty texts have no words; a null id is spelt as nothing in the hash.  A repeated
    document counts as often as it stands there.  Texts and runs of letters of any length are taken
    whole.  Of near words with equal counts the first in code-point order counts.  Without
    documents there are no words and no rows; columns other than ``doc_id`` and ``text`` are not read.
    """
    return variants(vocabulary(spark.read.parquet(f"{sf_dir}/documents.parquet")))


SQL = r"""
WITH RECURSIVE poly AS (
  SELECT i, i::UBIGINT AS c, 0 AS k FROM range(256) t(i)
  UNION ALL
  SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END, k + 1
  FROM poly WHERE k < 8
),
crc_table AS (SELECT list(c ORDER BY i) AS cs FROM poly WHERE k = 8),
runs AS (
  SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{C0}-\x{FF}]+')) AS run
  FROM documents
),
counted AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
  FROM runs GROUP BY ALL
),
spelled AS (
  SELECT run, n, list_transform(
    list_filter(string_split(regexp_replace(
      hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)), '(..)', '\1,', 'g'), ','), lambda x: x <> ''),
    lambda x: ('0x' || x)::UBIGINT) AS bytes
  FROM counted WHERE length(run) >= 5
),
hashed AS (
  SELECT run, n, xor(list_reduce(
      list_concat([4294967295::UBIGINT], bytes),
      lambda c, x: xor(c >> 8, cs[(xor(c, x) & 255)::INT + 1])), 4294967295::UBIGINT)::BIGINT AS h
  FROM spelled, crc_table
),
said AS (
  SELECT CASE WHEN h % 97 = 0
    THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n
  FROM hashed
),
words AS (
  SELECT word, sum(n)::BIGINT AS n FROM said WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
),
cut AS (
  SELECT word, n, substr(word, 1, i) AS head, substr(word, i + 2) AS tail
  FROM words, range(0, length(word)) t(i)
),
near AS (
  SELECT a.word, b.word AS near, b.n FROM cut a JOIN cut b ON a.head = b.head AND a.tail = b.tail AND a.word <> b.word
  UNION
  SELECT c.word, w.word, w.n FROM cut c JOIN words w ON w.word = c.head || c.tail
  UNION
  SELECT w.word, c.word, c.n FROM cut c JOIN words w ON w.word = c.head || c.tail
),
best AS (
  SELECT word, count(*) AS n_near, first(near ORDER BY n DESC, near) AS form, max(n) AS form_n
  FROM near GROUP BY word
),
told AS (
  SELECT word, CASE WHEN form_n >= 2 * n THEN form END AS form, n, coalesce(n_near, 0)::BIGINT AS n_near,
    CASE WHEN form_n >= 2 * n THEN form_n END AS form_n
  FROM words LEFT JOIN best USING (word)
),
walk AS (
  SELECT word, word AS root, form AS onward FROM told
  UNION ALL
  SELECT walk.word, told.word, told.form FROM walk JOIN told ON walk.onward = told.word
)
SELECT told.word, form, root, n, n_near, form_n
FROM told JOIN walk ON told.word = walk.word AND walk.onward IS NULL
"""
