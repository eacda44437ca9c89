"""Quality classifier trained on weak labels.

Overlapping heuristics vote good (1), bad (-1) or nothing (0) on each text.  Expectation-maximisation over
the counts of their vote patterns estimates how often each vote is given to good and to bad texts, and with
it every pattern's posterior probability of a good text.  The posteriors are the soft labels of a
linear scorer on hashed features (words and their shapes), which scores every text.

Votes and scores cover all documents, and so do the pattern counts; there are at most 3 to the number
of heuristics of them.  Only the scorer is fitted on a sample, of at most ``TRAIN_ROWS`` documents that the
hash of text and id chooses.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_long, as_text, same, stage
from .quality_rules import SPACES, SYMBOLS, repeated_words

#: Heuristic: value at or below which it votes bad, value from which it votes good (or the other
#: way round where the first is the larger).
HEURISTICS = {
    "length": (5, 50),
    "repetition": (0.3, 0.1),
    "symbols": (0.1, 0.03),
    "marked_words": (0.25, 0.05),
    "plain_words": (0.6, 0.85),
    "capitals": (0.3, 0.12),
    "exclamations": (0.15, 0.03),
    "variety": (0.25, 0.4),
    "lines": (0.3, 0.1),
    "endings": (0.2, 0.6),
}

#: Documents the scorer is fitted on, its hashed features and its passes over the sample.
TRAIN_ROWS = 20_000
FEATURES = 2**16
PASSES = 8

KEPT_FROM = 0.5


#: A word with a symbol in it, and one of letters with at most one mark of punctuation after it.
_MARKED = re.compile(rf"(?<![^{SPACES}])[^{SPACES}{SYMBOLS}]*[{SYMBOLS}][^{SPACES}]*")
_PLAIN = re.compile(rf"(?<![^{SPACES}])[^\W\d_]+[.,;:!?]?(?![^{SPACES}])")


def measures(text: str | None) -> dict[str, float]:
    """The value of each heuristic; a text without words has the worst of all."""
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()
    n = len(words)
    if not n:
        return {name: float(bad > good) for name, (bad, good) in HEURISTICS.items()}
    marked = len(_MARKED.findall(text))
    lines = [x.strip(SPACES) for x in text.split("\n") if x.strip(SPACES)]
    upper = sum(map(str.isupper, text))
    letters = max(1, sum(map(str.isalpha, text)))
    return {
        "length": n,
        "repetition": repeated_words(words) / n,
        "symbols": sum(map(text.count, SYMBOLS)) / n,
        "marked_words": marked / n,
        "plain_words": len(_PLAIN.findall(text)) / n,
        "capitals": upper / letters,
        "exclamations": text.count("!") / n,
        "variety": len(set(words)) / min(n, 200),
        "lines": 1 - len(set(lines)) / len(lines),
        "endings": sum(x.endswith((".", "!", "?", '"', ":")) for x in lines) / len(lines),
    }


def votes(text: str | None) -> list[int]:
    found = measures(text)
    out = []
    for name, (bad, good) in HEURISTICS.items():
        value, sign = found[name], 1 if bad < good else -1
        out.append(-1 if sign * value <= sign * bad else int(sign * value >= sign * good))
    return out


def _vote_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        pattern = ["".join("-0+"[v + 1] for v in votes(x)) for x in batch["text"]]
        yield pd.DataFrame({"doc_id": batch["doc_id"], "text_key": batch["text_key"], "pattern": pattern})


def posteriors(counts: dict[str, int], rounds: int = 200) -> tuple[dict[str, float], np.ndarray]:
    """Probability of a good text for each pattern, and P(vote | bad, good) of each heuristic.

    Starts with every text that has a bad vote as probably bad; votes are taken as independent given
    the class.  An added count of one for every vote keeps probabilities off 0 and 1.
    """
    patterns = sorted(counts)
    if not patterns:
        return {}, np.zeros((0, 2, 3))
    seen = np.array([["-0+".index(c) for c in p] for p in patterns])
    number = np.array([counts[p] for p in patterns], float)
    good = np.where((seen == 0).any(1), 0.1, 0.9)
    chosen = np.stack([seen == v for v in range(3)], 2)
    for _ in range(rounds):
        weights = np.stack([(1 - good) * number, good * number])
        given = 1 + np.einsum("cp,pjv->jcv", weights, chosen.astype(float))
        given /= given.sum(2, keepdims=True)
        prior = (1 + weights.sum(1)) / (2 + number.sum())
        logs = np.log(prior)[:, None] + np.einsum("jcv,pjv->cp", np.log(given), chosen.astype(float))
        new = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -700, 700)))
        moved, good = np.abs(new - good).max(), new
        if moved < 1e-9:
            break
    return dict(zip(patterns, good.tolist())), given


def shape(word: str) -> str:
    """The kinds of characters in a word, runs of a kind once: A, a, 9, others as they are."""
    kinds = "".join(
        "9" if c.isdigit() else ("A" if c.isupper() else "a") if c.isalpha() else c for c in word
    )
    return re.sub(r"(.)\1+", r"\1", kinds)


class Slots(dict):
    """Feature slots of the words seen lately: the word's own and its shape's."""

    MOST = 300_000

    def __missing__(self, word: bytes) -> tuple[int, int]:
        if len(self) >= self.MOST:
            self.clear()
        form = shape(word.decode("utf-8", "replace")).encode()
        pair = (
            xxhash.xxh3_64_intdigest(word.lower(), 1) % FEATURES,
            xxhash.xxh3_64_intdigest(form, 2) % FEATURES,
        )
        self[word] = pair
        return pair


def features(text: str | None, slots: Slots) -> tuple[np.ndarray, np.ndarray]:
    """Slots and values; words and shapes have length 1 each, so that long texts weigh no more."""
    words = (text or "").encode("utf-8", "surrogatepass").split()
    if not words:
        return np.empty(0, np.int64), np.empty(0)
    pairs = np.array(list(map(slots.__getitem__, words)))
    at, value = [], []
    for column in pairs.T:
        slot, times = np.unique(column, return_counts=True)
        at.append(slot)
        value.append(times / math.sqrt(float((times * times).sum())))
    return np.concatenate(at), np.concatenate(value)


def fit(rows: pd.DataFrame) -> pd.DataFrame:
    """Logistic regression on soft labels by stochastic gradients with per-slot steps; one row out.

    The rows are a bounded sample; they are read in the order of their hash, so that reruns agree.
    """
    rows = rows.sort_values(["draw", "text_key", "doc_id"])
    slots = Slots()
    examples = [features(x, slots) for x in rows["text"]]
    labels = rows["posterior"].to_numpy()
    weights, bias, power = np.zeros(FEATURES), 0.0, np.full(FEATURES, 1e-8)
    bias_power = 1e-8
    for _ in range(PASSES):
        for (at, value), label in zip(examples, labels):
            error = 1 / (1 + math.exp(-max(-30.0, min(30.0, float(weights[at] @ value) + bias)))) - label
            step = error * value
            power[at] += step * step
            weights[at] -= 0.5 * step / np.sqrt(power[at])
            bias_power += error * error
            bias -= 0.5 * error / math.sqrt(bias_power)
    return pd.DataFrame({"weights": [np.append(weights, bias).astype(np.float32).tobytes()]})


def classify(documents: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, text_key, pattern, posterior, score and kept (score of ``KEPT_FROM`` or more) of every row.

    A null or empty text has no features and gets the scorer's bias alone, and is not kept.  Rows
    repeated with id and text get equal scores.  An empty table gives no rows.  Texts of any length are
    taken whole; columns other than ``doc_id`` and ``text`` are not looked at.
    """
    spark = documents.sparkSession
    keyed = documents.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    voted = stage(
        as_long(
            as_text(keyed, "doc_id").mapInPandas(_vote_rows, "doc_id string, text_key long, pattern string"),
            "doc_id",
        ),
        "votes",
    )
    counted = voted.groupBy("pattern").count().collect()  # at most 3 ** len(HEURISTICS) rows
    good, _ = posteriors({r["pattern"]: r["count"] for r in counted})
    total = sum(r["count"] for r in counted)
    if not total:
        return voted.select(
            "*", F.lit(0.0).alias("posterior"), F.lit(0.0).alias("score"), F.lit(False).alias("kept")
        )
    table = F.broadcast(spark.createDataFrame(sorted(good.items()), "pattern string, posterior double"))
    # The share aims below the bound; the limit after the sort by hash only cuts the rare excess.
    draw = F.xxhash64("text_key", "doc_id")
    share = min(1.0, 0.9 * train_rows / total)
    drawn = voted.distinct().withColumn("draw", draw).filter(
        F.pmod(F.col("draw"), F.lit(2**20)) < int(share * 2**20)
    )
    sample = stage(
        drawn.orderBy("draw", "text_key", "doc_id").limit(train_rows).join(table, "pattern"), "sample"
    )
    key = ["doc_id", "text_key"]
    same_text = keyed["doc_id"].eqNullSafe(sample["doc_id"]) & (keyed["text_key"] == sample["text_key"])
    texts = keyed.join(F.broadcast(sample), same_text).select(
        keyed["doc_id"], keyed["text_key"], "text", "draw", "posterior"
    )
    once = texts.dropDuplicates(key).withColumn("one", F.lit(1))
    fitted = once.groupBy("one").applyInPandas(fit, "weights binary").first()
    blob = fitted["weights"] if fitted else np.zeros(FEATURES + 1, np.float32).tobytes()

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        weights = np.frombuffer(blob, np.float32).astype(float)
        slots = Slots()
        for batch in batches:
            scores, filled = [], []
            for text in batch["text"]:
                at, value = features(text, slots)
                z = float(weights[at] @ value) + float(weights[-1])
                scores.append(1 / (1 + math.exp(-max(-30.0, min(30.0, z)))))
                filled.append(len(at) > 0)
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"],
                    "text_key": batch["text_key"],
                    "score": scores,
                    "kept": [f and s >= KEPT_FROM for f, s in zip(filled, scores)],
                }
            )

    scored = as_long(
        as_text(keyed, "doc_id").mapInPandas(
            score, "doc_id string, text_key long, score double, kept boolean"
        ),
        "doc_id",
    )
    # Equal texts have equal votes, which were taken once.
    known = voted.distinct().join(table, "pattern", "left")
    return scored.join(known, same(scored, known, key)).select(
        scored["doc_id"], scored["text_key"], "pattern", "posterior", "score", "kept"
    )


def op9_quality_classifier(spark, sf_dir: str) -> DataFrame:
    """Votes, posterior and score of every document."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return classify(documents).drop("text_key")
