"""Language-model scores by a hierarchical Pitman-Yor model.

Each previous word, and the start of a text, is a restaurant, and all of them share one parent, the restaurant of
words without context, whose own base is uniform over the known words and one unknown.  A training token is a
customer of its context's restaurant; each table that serves a word there is a customer of the
parent.  The seating is sampled by Gibbs sweeps: all customers of a word in a restaurant get up and are
seated again one after the other, a new table with the weight (strength + discount * tables) times the
parent's probability of the word.  In a sweep all cells (word and context) are drawn side by side, given
the totals of the sweep before.  After the first ones are passed over, the sweeps' predictive probabilities
are averaged.

Cells lie in a grid of buckets, by the hashes of word and context, as many as the bytes of the input call for: so the
cells of a frequent word are dealt over a row of it, those of a frequent context over a column.  A block of documents
sends each bucket its cells and how often each document has them; cells that only held-out documents have come along
without customers.  Totals of words and contexts lie in nodes by hash.  Buckets and nodes write letters to each
other: after a sweep a bucket sends the tables of its words and contexts, and gets the sums of all buckets back, in
an order that both keep.  Cells with one customer have one table and are not drawn.  At the end each bucket
scores its cells and sends every block sums for each document.
"""

from __future__ import annotations

import json
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_text, stage
from .shingles import words_of

#: Most nodes that the totals of words and contexts are dealt to.
CONTEXTS = 256
STRENGTH = 1.0
PASSED, SAMPLED = 1, 2

BLOCK_TOKENS = 700_000
BLOCK_DOCUMENTS = 20_000
BUCKET_BYTES = 8_000_000

#: A cell that a block has so often is sent as counts of its documents, others token by token.
FREQUENT = 1000

#: Seated one by one up to here, then in stretches of a quarter of those seated (binomial draws).
SINGLY = 48

_END = b" end"  # no word holds a blank

#: In place of a previous word's hash at the start of a text.
START = np.uint64(0)

CELL_TYPE = (
    "bucket long, part long, blob binary, uses binary, doc_ids array<string>, held array<boolean>, sizes array<long>"
)
CELL_SCHEMA = pa.schema(
    {
        "bucket": pa.int64(),
        "part": pa.int64(),
        "blob": pa.binary(),
        "uses": pa.binary(),
        "doc_ids": pa.list_(pa.string()),
        "held": pa.list_(pa.bool_()),
        "sizes": pa.list_(pa.int64()),
    }
)
LETTER_TYPE = "side string, at long, kind string, turn int, sender long, blob binary, totals array<double>"
STATE_TYPE = "bucket long, blob binary"
SCORE_TYPE = (
    "doc_id string, held_out boolean, n_tokens long, n_known long, base_sum double, score double"
)


def _columns(kind: str) -> list[str]:
    return [x.split()[0] for x in kind.split(", ")]


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as bytes: the first byte of all numbers, then the second, and so on, which packs well."""
    head = json.dumps([[a.dtype.str, len(a)] for a in arrays]).encode()
    planes = (np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.dtype.itemsize).T for a in arrays)
    body = b"".join(x.tobytes() for x in planes)
    return len(head).to_bytes(4, "little") + head + zstandard.compress(body, 1)


def unpack(blob: bytes) -> list[np.ndarray]:
    size = int.from_bytes(blob[:4], "little")
    body, out, at = zstandard.decompress(blob[4 + size :]), [], 0
    for kind, length in json.loads(blob[4 : 4 + size]):
        width = np.dtype(kind).itemsize
        planes = np.frombuffer(body, np.uint8, length * width, at).reshape(width, length)
        out.append(np.frombuffer(planes.T.tobytes(), kind))
        at += length * width
    return out


def _steps(index: np.ndarray) -> np.ndarray:
    """Growing numbers as distances."""
    return np.diff(index, prepend=0).astype(np.uint32)


def _unstepped(sizes: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """The numbers of several ``_steps`` that follow each other, ``sizes`` being their lengths."""
    total = np.concatenate([[0], np.cumsum(steps.astype(np.int64))])
    sizes = sizes.astype(np.int64)
    return total[1:] - np.repeat(total[np.cumsum(sizes) - sizes], sizes)


def _joined(parts: list[list[np.ndarray]], at: int) -> np.ndarray:
    return np.concatenate([p[at] for p in parts])


def is_held_out(doc_id: str | int | None) -> bool:
    """Whether crc32 of the id's text leaves 2 when divided by 7; a missing id's text is empty."""
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 == 2


class Block:
    """Tokens of some documents, as numbers in the block's own vocabulary."""

    def __init__(self) -> None:
        self.vocabulary: dict[bytes, int] = {_END: 0}
        self.ids: list[np.ndarray] = []
        self.doc_ids: list[str | None] = []
        self.n = 0

    def add(self, doc_id: str | None, text: str | None) -> None:
        found = self.vocabulary
        words = words_of(text)
        for word in set(words):
            if word not in found:
                found[word] = len(found)
        ids = np.fromiter(map(found.__getitem__, words), np.int32, len(words))
        self.ids.append(np.append(ids, np.int32(0)))
        self.doc_ids.append(doc_id)
        self.n += len(words) + 1

    def full(self) -> bool:
        return self.n >= BLOCK_TOKENS or len(self.ids) >= BLOCK_DOCUMENTS

    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Hash of each word; word, previous word and document of each token; tokens of each document.

        The end, which no token follows, stands as previous word at the start of a text.
        """
        hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in self.vocabulary], np.uint64)
        sizes = np.array([len(x) for x in self.ids])
        ids = np.concatenate(self.ids)
        return hashes, ids, np.roll(ids, 1), np.repeat(np.arange(len(sizes), dtype=np.uint16), sizes), sizes


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    block = Block()
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            some = batch.slice(at, 500)
            for doc_id, text in zip(some.column("doc_id").to_pylist(), some.column("text").to_pylist()):
                block.add(doc_id, text)
                if block.full():
                    yield block
                    block = Block()
    if block.ids:
        yield block


def _ranked(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hashes in order, and the place of each."""
    order = np.argsort(hashes)
    place = np.empty(len(order), np.int32)
    place[order] = np.arange(len(order), dtype=np.int32)
    return hashes[order], place


def block_cells(block: Block, part: int, grid: tuple[int, int]) -> pd.DataFrame:
    """A row for each bucket with the block's cells there and their documents, and one with the documents."""
    hashes, ids, before, docs, sizes = block.arrays()
    held = [is_held_out(x) for x in block.doc_ids]
    contexts = hashes.copy()
    contexts[0] = START
    words, place = _ranked(hashes)
    word = place[ids]
    contexts, place = _ranked(contexts)
    context = place[before]
    n, high = len(words), np.uint64(32)
    row = ((words >> high) % np.uint64(grid[0])).astype(np.int64)
    column = ((contexts >> high) % np.uint64(grid[1])).astype(np.int64)
    key = (row * grid[1])[word]
    key += column[context]
    for index in (word, context):
        key *= n
        key += index
    del ids, before, word, context, index
    order = np.argsort(key, kind="stable")  # tokens stand by document, so a cell's do too
    key, doc = key[order], docs[order]
    del order, docs
    fresh = np.concatenate([[True], key[1:] != key[:-1]])
    cells, cell = key[fresh], np.cumsum(fresh, dtype=np.int32) - 1
    fresh[1:] |= doc[1:] != doc[:-1]
    fresh |= np.bincount(cell)[cell] < FREQUENT
    first = np.flatnonzero(fresh)
    times = np.diff(np.append(first, len(key))).astype(np.uint32)
    doc = doc[first]
    entries = np.bincount(cell[first])
    ends = np.cumsum(entries)
    bucket, rest = np.divmod(cells, n * n)
    word, context = np.divmod(rest, n)
    flags = np.array(held, np.uint8)
    rows = [(-1 - part, part, None, None, block.doc_ids, held, sizes.tolist())]
    for own in np.split(np.arange(len(cells)), np.flatnonzero(np.diff(bucket)) + 1):
        names, index = np.unique(word[own], return_inverse=True)
        befores, at = np.unique(context[own], return_inverse=True)
        blob = pack(
            words[names],
            np.bincount(index).astype(np.uint32),
            contexts[befores],
            at.astype(np.uint32),
            entries[own].astype(np.uint32),
        )
        there = slice(ends[own[0]] - entries[own[0]], ends[own[-1]])
        uses = pack(doc[there], times[there], flags)
        rows.append((int(bucket[own[0]]), part, blob, uses, None, None, None))
    return pd.DataFrame(rows, columns=_columns(CELL_TYPE))


def merge_cells(rows: pd.DataFrame) -> pd.DataFrame:
    """One row for a bucket: its words, contexts, cells and training counts; where each block uses the cells.

    The row of a block's documents stays as it is.
    """
    if rows["bucket"].iloc[0] < 0:
        return rows
    rows = rows.sort_values("part")
    parts, uses = [unpack(x) for x in rows["blob"]], [unpack(x) for x in rows["uses"]]
    words, contexts = np.unique(_joined(parts, 0)), np.unique(_joined(parts, 2))
    keys = [
        np.repeat(np.searchsorted(words, p[0]), p[1]) * len(contexts) + np.searchsorted(contexts, p[2])[p[3]]
        for p in parts
    ]
    sizes = np.array([len(k) for k in keys])
    keys = np.concatenate(keys)
    cells = np.unique(keys)
    index = np.searchsorted(cells, keys).astype(np.int32)
    del keys
    entries, times = _joined(parts, 4), _joined(uses, 1)
    learned = np.concatenate([u[2][u[0]] == 0 for u in uses])
    counts = np.bincount(np.repeat(index, entries), times * learned, len(cells)).astype(np.int64)
    word, context = np.divmod(cells, len(contexts))
    served = np.bincount(word, minlength=len(words))
    used = pack(
        rows["part"].to_numpy(np.int64),
        sizes.astype(np.uint32),
        np.array([len(u[0]) for u in uses], np.uint32),
        np.concatenate([_steps(x) for x in np.split(index, np.cumsum(sizes)[:-1])]),
        entries,
        _joined(uses, 0),
        times,
    )
    blob = pack(words, served.astype(np.uint32), contexts, context.astype(np.uint32), counts)
    row = (rows["bucket"].iloc[0], -1, blob, used, None, None, None)
    return pd.DataFrame([row], columns=_columns(CELL_TYPE))


def seat(customers: np.ndarray, weight: np.ndarray, discount: float, rng) -> np.ndarray:
    """Tables that the customers of one word sit at, ``weight`` being that of a new table."""
    tables = np.ones(len(customers), np.int64)
    active, n = np.flatnonzero(customers > 1), 1
    while len(active):
        w, t = weight[active], tables[active]
        if n < SINGLY:
            step = 1
            tables[active] += rng.random(len(active)) < w / (n - discount * t + w)
        else:
            step = n // 4
            often = np.minimum(customers[active] - n, step)
            tables[active] += rng.binomial(often, w / (n + often / 2 - discount * t + w))
        n += step
        active = active[customers[active] > n]
    return tables


def _dealt(hashes: np.ndarray, nodes: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the hashes by node and hash, and how many each node has."""
    node = ((hashes & np.uint64(2**32 - 1)) % np.uint64(nodes)).astype(np.int64)
    return np.lexsort((hashes, node)), np.bincount(node, minlength=nodes)


def _letters(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=_columns(LETTER_TYPE))


def _to_nodes(kind: str, turn: int, bucket: int, sizes: tuple, *values: tuple) -> list[tuple]:
    """A letter to each node; ``values`` are pairs of arrays, of the words and of the contexts, in ``_dealt`` order."""
    pieces = [np.split(x, np.cumsum(n)[:-1]) for pair in values for x, n in zip(pair, sizes)]
    return [
        ("nodes", node, kind, turn, bucket, pack(*arrays), None) for node, arrays in enumerate(zip(*pieces))
    ]


def _open(nodes: int):
    """First letters of each bucket: to itself what it draws, to the nodes its words and contexts and a table a cell."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for bucket, blob in zip(batch["bucket"], batch["blob"]):
                words, served, contexts, context, counts = unpack(blob)
                word = np.repeat(np.arange(len(words)), served)
                (w_order, w_sizes), (c_order, c_sizes) = _dealt(words, nodes), _dealt(contexts, nodes)
                word, context = np.argsort(w_order)[word], np.argsort(c_order)[context]
                total = lambda index, x, like: np.bincount(index, x, len(like)).astype(np.int64)
                sizes, one, more = (w_sizes, c_sizes), counts == 1, counts > 1
                fixed = pack(
                    word[more].astype(np.uint32),
                    context[more].astype(np.uint32),
                    counts[more],
                    total(word, one, words),
                    total(context, one, contexts),
                    w_sizes,
                    c_sizes,
                )
                sums = [float(counts.sum()), float(one.sum()), float((counts == 2).sum())]
                names = (words[w_order], contexts[c_order])
                customers = (total(word, counts, words), total(context, counts, contexts))
                tables = (total(word, counts > 0, words), total(context, counts > 0, contexts))
                yield _letters(
                    [("cells", bucket, "fixed", -1, bucket, fixed, sums)]
                    + _to_nodes("names", -1, bucket, sizes, names, customers)
                    + _to_nodes("tables", -1, bucket, sizes, tables)
                )

    return run


def _of(rows: pd.DataFrame, kind: str, turn: int | None = None) -> list[list[np.ndarray]]:
    """The contents of the letters of a kind, by sender."""
    own = rows[(rows["kind"] == kind) & (True if turn is None else rows["turn"] == turn)]
    return [unpack(x) for x in own.sort_values("sender")["blob"]]


def _meet(rows: pd.DataFrame) -> pd.DataFrame:
    """A node's first letters: to itself the places of all buckets' names, to the buckets the training counts."""
    node, names = int(rows["at"].iloc[0]), _of(rows, "names")
    senders = np.sort(rows.loc[rows["kind"] == "names", "sender"].to_numpy(np.int64))
    every = np.unique(np.concatenate([x for p in names for x in p[:2]]))
    words, contexts = ([np.searchsorted(every, p[i]) for p in names] for i in (0, 1))
    count = np.bincount(np.concatenate(words), _joined(names, 2), len(every)).astype(np.int64)
    customers = np.bincount(np.concatenate(contexts), _joined(names, 3), len(every)).astype(np.int64)
    fixed = pack(
        senders,
        np.array([len(every)]),
        np.array([len(x) for x in words], np.uint32),
        np.array([len(x) for x in contexts], np.uint32),
        np.concatenate([_steps(x) for x in words]),
        np.concatenate([_steps(x) for x in contexts]),
    )
    sums = [float((count > 0).sum())]
    out = [("nodes", node, "fixed", -1, node, fixed, None), ("totals", node, "words", -1, node, None, sums)]
    for sender, w, c in zip(senders.tolist(), words, contexts):
        out.append(("cells", sender, "counts", -1, node, pack(count[w], customers[c]), None))
    return _letters(out)


def _tell(turn: int, known: dict):
    """A node adds up the buckets' tables, seats its words' own customers and tells the buckets of both.

    Totals: the parent's customers and tables, words with one and with two customers.
    """

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        node = int(rows["at"].iloc[0])
        senders, size, w_sizes, c_sizes, words, contexts = _of(rows, "fixed")[0]
        words, contexts = _unstepped(w_sizes, words), _unstepped(c_sizes, contexts)
        letters = _of(rows, "tables")
        customers = np.bincount(words, _joined(letters, 0), size[0]).astype(np.int64)
        tables = np.bincount(contexts, _joined(letters, 1), size[0]).astype(np.int64)
        own = (customers > 0).astype(np.int64)
        if turn >= 0:
            fresh, d0 = known["fresh"], known["root_discount"]
            rng = np.random.default_rng([8, turn, node, 1])
            there = np.flatnonzero(customers)
            own[there] = seat(customers[there], np.full(len(there), fresh), d0, rng)
        sums = [customers.sum(), own.sum(), (customers == 1).sum(), (customers == 2).sum()]
        out = [("totals", node, "tables", turn, node, None, [float(x) for x in sums])]
        ends = zip(np.split(words, np.cumsum(w_sizes)[:-1]), np.split(contexts, np.cumsum(c_sizes)[:-1]))
        for sender, (w, c) in zip(senders.tolist(), ends):
            out.append(("cells", sender, "told", turn, node, pack(customers[w], own[w], tables[c]), None))
        return _letters(out)

    return run


def _sweep(turn: int, known: dict):
    """Seat all cells of a bucket anew."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        bucket, d = int(rows["at"].iloc[0]), known["discount"]
        word, context, times, w_ones, c_ones, w_sizes, c_sizes = _of(rows, "fixed")[0]
        told = _of(rows, "told")
        p = (_joined(told, 0) - known["root_discount"] * _joined(told, 1) + known["fresh"]) / known["root"]
        weight = (STRENGTH + d * _joined(told, 2)[context]) * p[word]
        tables = seat(times, weight, d, np.random.default_rng([8, turn, bucket]))
        sums = tuple(
            ones + np.bincount(index, tables, len(ones)).astype(np.int64)
            for index, ones in ((word, w_ones), (context, c_ones))
        )
        mine = [("cells", bucket, "seated", turn, bucket, pack(tables), None)] if turn >= PASSED else []
        return _letters(mine + _to_nodes("tables", turn, bucket, (w_sizes, c_sizes), sums))

    return run


def _sampled(rows: pd.DataFrame, known: dict, nodes: int) -> list[np.ndarray]:
    """A bucket's cells with the tables of the sampled sweeps, and the totals of its words and contexts."""
    words, served, contexts, context, counts = _of(rows, "cells")[0]
    w_order, c_order = _dealt(words, nodes)[0], _dealt(contexts, nodes)[0]

    def placed(values: np.ndarray, order: np.ndarray) -> np.ndarray:
        out = np.empty_like(values)
        out[order] = values
        return out

    numbers = _of(rows, "counts")
    out = [placed(_joined(numbers, 0), w_order), placed(_joined(numbers, 1), c_order)]
    # Letters of the buckets list the cells as they are here, only with other numbers for words and contexts.
    for turn in range(PASSED, PASSED + SAMPLED):
        told = _of(rows, "told", turn)
        tables = (counts > 0).astype(np.int64)
        tables[counts > 1] = _of(rows, "seated", turn)[0][0]
        parents = _joined(told, 0) - known["root_discount"] * _joined(told, 1)
        out += [tables, placed(parents, w_order), placed(_joined(told, 2), c_order)]
    return [words, served, contexts, context, counts, *out]


class Scorer:
    """Averaged predictive probabilities of the words of one bucket."""

    def __init__(self, known: dict, state: bytes | list[np.ndarray]) -> None:
        arrays = unpack(state) if isinstance(state, bytes) else state
        self.words, served, self.contexts, context, counts, self.times, customers, *sampled = arrays
        d, samples = known["discount"], known["samples"]
        self.word, self.context = np.repeat(np.arange(len(self.words)), served), context.astype(np.int64)
        self.cells = self.word * len(self.contexts) + self.context
        there = STRENGTH + customers
        self.mean = np.zeros(len(counts))
        for tables in sampled[::3]:
            self.mean += (counts - d * tables) / there[context] / SAMPLED
        self.parent = np.array([(r + s["fresh"]) / s["root"] for r, s in zip(sampled[1::3], samples)])
        self.back = np.array([(STRENGTH + d * t) / there for t in sampled[2::3]])
        self.unknown = np.array([s["fresh"] / s["root"] for s in samples])

    def tokens(self, word: np.ndarray, context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Training count and log10 probability of each token.

        Words are given by place, -1 for unknown ones, contexts by the hash of the previous word, or ``START``.
        """
        context = np.asarray(context).astype(np.uint64)
        place = np.minimum(np.searchsorted(self.contexts, context), len(self.contexts) - 1)
        met = self.contexts[place] == context
        known = word >= 0
        some = np.where(known, word, 0)
        parent = np.where(known, self.parent[:, some], self.unknown[:, None])
        back = np.where(met, self.back[:, place], 1.0)
        key = some * len(self.contexts) + place
        at = np.minimum(np.searchsorted(self.cells, key), len(self.cells) - 1)
        own = np.where(known & met & (self.cells[at] == key), self.mean[at], 0.0)
        return np.where(known, self.times[some], 0), np.log10(own + (back * parent).mean(axis=0))


def _score(known: dict, nodes: int):
    """Sums of a bucket's cells for the documents of each block."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        scorer = Scorer(known, _sampled(rows, known, nodes))
        times, logs = scorer.tokens(scorer.word, scorer.contexts[scorer.context])
        base = np.log10(times + 1)
        parts, sizes, entries, steps, often, doc, n = unpack(rows["uses"].dropna().iloc[0])
        cell = np.repeat(_unstepped(sizes, steps).astype(np.int32), often)
        out, end = [], np.cumsum(entries.astype(np.int64))
        for part, a, b in zip(parts.tolist(), (end - entries).tolist(), end.tolist()):
            met, own = np.unique(doc[a:b], return_inverse=True)
            c, weight = cell[a:b], n[a:b].astype(np.int64)
            sums = [np.bincount(own, weight * x[c]) for x in (base, logs, times > 0)]
            out.append((part, pack(met, *sums[:2], sums[2].astype(np.int64))))
        return pd.DataFrame(out, columns=["part", "blob"])

    return run


def _gather(rows: pd.DataFrame, sums: pd.DataFrame) -> pd.DataFrame:
    """The documents of a block with the sums from all buckets."""
    if not len(rows):
        return pd.DataFrame(columns=_columns(SCORE_TYPE))
    row = rows.iloc[0]
    base, score, known = (np.zeros(len(row["doc_ids"]), k) for k in (float, float, np.int64))
    for blob in sums["blob"]:
        met, more_base, more_score, more_known = unpack(blob)
        base[met] += more_base
        score[met] += more_score
        known[met] += more_known
    return pd.DataFrame(
        {
            "doc_id": list(row["doc_ids"]),
            "held_out": list(row["held"]),
            "n_tokens": list(row["sizes"]),
            "n_known": known,
            "base_sum": base,
            "score": score,
        }
    )


def _summed(letters: DataFrame, size: int) -> list[float]:
    """The element-wise sum of the letters' totals; zeros without letters."""
    each = letters.select(F.posexplode("totals").alias("at", "x")).groupBy("at").agg(F.sum("x").alias("x"))
    return [r["x"] for r in each.orderBy("at").collect()] or [0.0] * size


def _discount(once: float, twice: float) -> float:
    return min(0.95, max(0.05, once / (once + 2 * twice))) if once else 0.5


def _merged(documents: DataFrame, buckets: int) -> DataFrame:
    """The cells of all documents by bucket, and the documents of each block."""
    rows = max(1, math.isqrt(buckets))
    grid = (rows, -(-buckets // rows))

    def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for number, block in enumerate(_blocks(batches)):
            cells = block_cells(block, task * 2**32 + number, grid)
            yield pa.RecordBatch.from_pandas(cells, CELL_SCHEMA, preserve_index=False)

    sent = documents.mapInArrow(scatter, CELL_TYPE)
    return stage(sent.groupBy("bucket").applyInPandas(merge_cells, CELL_TYPE), "cells")


def _nodes(buckets: int) -> int:
    return max(1, min(CONTEXTS, buckets // 8))


def _trained(merged: DataFrame, nodes: int) -> tuple[DataFrame, dict]:
    """The letters that tell each bucket (``at``) its sampled state, and the totals that hold for all."""
    state = merged.filter("bucket >= 0")
    opened = stage(state.select("bucket", "blob").mapInPandas(_open(nodes), LETTER_TYPE), "opened")
    fixed = opened.filter("kind = 'fixed'")
    tokens, once, twice = _summed(fixed, 3)
    met = stage(opened.filter("kind = 'names'").groupBy("at").applyInPandas(_meet, LETTER_TYPE), "met")
    places = met.filter("kind = 'fixed'")
    (words,) = _summed(met.filter("kind = 'words'"), 1)
    known = {"tokens": int(tokens), "words": int(words), "discount": _discount(once, twice), "samples": []}
    tables, kept = opened.filter("kind = 'tables'"), [met.filter("kind = 'counts'")]
    for turn in range(-1, PASSED + SAMPLED):
        if turn >= 0:
            drawn = fixed.unionByName(told).groupBy("at").applyInPandas(_sweep(turn, known), LETTER_TYPE)
            seated = stage(drawn, "seated")
            tables = seated.filter("kind = 'tables'")
            kept.append(seated.filter("kind = 'seated'"))
        heard = places.unionByName(tables).groupBy("at").applyInPandas(_tell(turn, known), LETTER_TYPE)
        answers = stage(heard, "answers")
        told = answers.filter("kind = 'told'")
        customers, own, alone, paired = _summed(answers.filter("side = 'totals'"), 4)
        if turn < 0:
            known["root_discount"] = _discount(alone, paired)
        known["root"] = STRENGTH + customers
        known["fresh"] = (STRENGTH + known["root_discount"] * own) / (known["words"] + 1)
        if turn >= PASSED:
            known["samples"].append({"root": known["root"], "fresh": known["fresh"]})
            kept.append(told)
    letters = state.select(F.col("bucket").alias("at"), F.lit("cells").alias("kind"), F.lit(-1).alias("sender"), "blob", "uses")
    for more in kept:
        letters = letters.unionByName(more.select("at", "kind", "turn", "sender", "blob"), allowMissingColumns=True)
    return letters, known


def train(documents: DataFrame, buckets: int) -> tuple[DataFrame, dict]:
    """The buckets' cells as sampled, and the totals that hold for all of them."""
    nodes = _nodes(buckets)
    letters, known = _trained(_merged(as_text(documents.select("doc_id", "text"), "doc_id"), buckets), nodes)

    def finish(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"bucket": rows["at"].iloc[:1], "blob": [pack(*_sampled(rows, known, nodes))]})

    return letters.groupBy("at").applyInPandas(finish, STATE_TYPE), known


def scores(documents: DataFrame) -> DataFrame:
    """The contract's columns for every row; ``score`` is the log10 probability of text and end.

    Learns from all rows that are not held out, repeated rows each.  A null text is empty and has its end
    only; a null id counts as an empty text for the division.  Without training rows every token
    has the uniform probability.  An empty table gives no rows.  Texts of any length are taken whole; columns
    other than ``doc_id`` and ``text`` are not looked at.
    """
    documents = as_text(documents.select("doc_id", "text"), "doc_id")
    size = documents.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(8, -(-size // BUCKET_BYTES))
    merged = _merged(documents, buckets)
    nodes = _nodes(buckets)
    letters, known = _trained(merged, nodes)
    sums = letters.groupBy("at").applyInPandas(_score(known, nodes), "part long, blob binary")
    held = merged.filter("bucket < 0").select("part", "doc_ids", "held", "sizes")
    found = held.groupBy("part").cogroup(sums.groupBy("part")).applyInPandas(_gather, SCORE_TYPE)
    total = F.log10(F.lit(float(known["tokens"] + known["words"] + 1)))
    return found.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(known["tokens"]).cast("long").alias("train_tokens"),
        (F.col("base_sum") - F.col("n_tokens") * total).alias("base_score"),
        "score",
    )


def perplexity(scored: DataFrame) -> DataFrame:
    """Tokens and perplexity of the training and the held-out part, by model and by base."""
    power = lambda c: F.pow(F.lit(10.0), -F.sum(c) / F.sum("n_tokens"))
    return scored.groupBy("held_out").agg(
        F.sum("n_tokens").alias("n_tokens"), power("score").alias("model"), power("base_score").alias("base")
    )


def op8_pitman_yor(spark, sf_dir: str) -> DataFrame:
    """Scores of all documents."""
    return scores(spark.read.parquet(f"{sf_dir}/documents.parquet"))
