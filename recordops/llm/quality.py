"""Quality classifier from weak labels.

Eight heuristic labellers vote good, bad or nothing on each text. Expectation-maximisation
over the vote patterns of all rows (at most 3**8, counted in Spark) estimates how often
each labeller gives each vote for good and for bad texts, without any true label. The
posterior of a pattern is the soft label with which a logistic scorer over hashed word
features is trained, on a bounded sample of rows chosen by the hash of their id. All rows
are then scored; a row is kept if its score is at least `threshold`.

A text without words (null and empty ones too) has the score 0 and is not kept. Rows are
scored one by one, so repeated rows repeat. Very long texts are read whole.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordops.llm.base import LOWER, NOT_BLANK, RunHash, bounded, flat_bytes, slices, word_hashes, word_spans

GOOD, BAD, NONE = 1, 2, 0
WIDTH = 1 << 12  # hashed features
SHORT = 12  # texts of fewer words have marks at many of them anyway
SAMPLE = 2000  # rows on which the scorer is trained, at most about so many
#: Bytes by kind: other, lower case, upper case, digit, symbol, mark of a sentence, line of a table.
KIND = np.zeros(256, np.uint8)
KIND[0x61:0x7B], KIND[0x41:0x5B], KIND[0x30:0x3A] = 1, 2, 3
KIND[[*b"#$%&*+<=>@^_~{}[]\\/"]] = 4
KIND[[*b".,;:!?'\"()-"]] = 5
KIND[[*b"|"]] = 6
KIND[0x80:] = 1
#: For each labeller: the largest value for good, the smallest for bad.
LIMITS = {
    "symbols": (0.01, 0.04),  # symbols by bytes of words
    "capitals": (0.15, 0.3),  # capitals by letters
    "repeats": (0.03, 0.12),  # words equal to the one before
    "echoes": (0.03, 0.12),  # words equal to the one before the last
    "bars": (0.02, 0.08),  # words that hold a bar
    "plain": (0.02, 0.08),  # words without letters and digits
    "marks": (0.3, 0.5),  # words that end in a mark
    "shouts": (0.04, 0.12),  # words that end in two marks or a symbol
}


def measures(data: np.ndarray, offsets: np.ndarray):
    """What the labellers look at, a row for each text, and the hashed features: text, feature, count."""
    n = len(offsets) - 1
    starts, ends, before = word_spans(data, offsets, NOT_BLANK)
    words = np.diff(before)
    text = np.repeat(np.arange(n), words)
    kind = KIND[data]
    sums = [np.concatenate([[0], np.cumsum(kind == k)]) for k in range(1, 7)]
    lower, upper, digit, symbol, mark, bar = [s[ends] - s[starts] for s in sums]
    length = ends - starts
    hashes = word_hashes(LOWER[data], starts, ends)
    again = np.zeros(len(starts), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (text[1:] == text[:-1])
    echo = np.zeros(len(starts), bool)
    echo[2:] = (hashes[2:] == hashes[:-2]) & (text[2:] == text[:-2])
    last = kind[ends - 1] if len(ends) else np.zeros(0, np.uint8)
    second = kind[np.maximum(ends - 2, starts)] if len(ends) else last
    by = lambda x: np.bincount(text, x, n)
    size = np.maximum(by(length), 1)
    many = np.maximum(words, 1)
    letters = np.maximum(by(lower + upper), 1)
    table = np.stack([by(symbol) / size, by(upper) / letters, by(again) / many, by(echo) / many, by(bar > 0) / many, by(lower + upper + digit == 0) / many, by(last == 5) / many, by((last == 4) | ((last == 5) & (second == 5) & (length > 1))) / many], 1)
    # features: the shape of a word (its kinds without repetition), alone and after the shape before it
    step = np.ones(len(data), bool)
    step[1:] = kind[1:] != kind[:-1]
    step[starts] = True
    kept = np.flatnonzero(step)
    shapes = RunHash(kind[kept].astype(np.uint64))(np.searchsorted(kept, starts), np.searchsorted(kept, ends))
    shapes = shapes + again.astype(np.uint64) * np.uint64(0x51ED270B) + np.minimum(length // 8, 4).astype(np.uint64)
    pairs = np.zeros_like(shapes)
    pairs[1:] = np.where(text[1:] == text[:-1], shapes[:-1] * np.uint64(31) + shapes[1:], 0)
    feature = np.concatenate([shapes, pairs * np.uint64(0x9E3779B97F4A7C15)]) >> np.uint64(52)
    cell, count = np.unique(np.tile(text, 2) * WIDTH + feature.astype(np.int64), return_counts=True)
    return words, table, cell, count


def votes(words: np.ndarray, table: np.ndarray) -> np.ndarray:
    limits = np.array(list(LIMITS.values()))
    out = np.where(table <= limits[:, 0], GOOD, np.where(table >= limits[:, 1], BAD, NONE))
    out[(words < SHORT)[:, None] & (out == BAD) & (np.array(list(LIMITS)) == "marks")] = NONE
    return np.where(words[:, None] > 0, out, NONE)


@dataclass
class Model:
    prior: float  # share of good texts
    chances: np.ndarray  # labeller x (bad, good) x vote
    weights: np.ndarray
    bias: float

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """Probability that texts of these votes are good."""
        m = np.arange(patterns.shape[1])
        log = np.log(self.chances[m, :, patterns]).sum(1) + np.log([1 - self.prior, self.prior])
        return 1 / (1 + np.exp(np.clip(log[:, 0] - log[:, 1], -700, 700)))

    def scores(self, n: int, cell: np.ndarray, count: np.ndarray) -> np.ndarray:
        text, feature, value = features(n, cell, count)
        return 1 / (1 + np.exp(-np.bincount(text, self.weights[feature] * value, n) - self.bias))


def features(n: int, cell: np.ndarray, count: np.ndarray):
    """Square roots of counts, scaled to length one in each text, less in texts of fewer than 20 words."""
    text, feature = cell // WIDTH, cell % WIDTH
    value, total = np.sqrt(count), np.maximum(np.bincount(text, count, n), 1)
    return text, feature, value * (np.minimum(1.0, total / 40) / np.sqrt(total))[text]


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = 60) -> Model:
    """Expectation-maximisation from the number of votes for bad."""
    good = np.array([0.98, 0.3, 0.02])[np.minimum((patterns == BAD).sum(1), 2)]
    model = Model(0.5, np.zeros((patterns.shape[1], 2, 3)), np.zeros(WIDTH), 0.0)
    for _ in range(rounds):
        share = np.stack([counts * (1 - good), counts * good], 1)
        model.prior = float(np.clip(share[:, 1].sum() / max(share.sum(), 1), 1e-3, 1 - 1e-3))
        for v in (NONE, GOOD, BAD):
            model.chances[:, :, v] = (patterns == v).T.astype(float) @ share + 0.5
        model.chances /= model.chances.sum(2, keepdims=True)
        good = model.posterior(patterns)
    return model


def train(model: Model, rows: list[tuple[float, np.ndarray, np.ndarray]], rounds: int = 300, rate: float = 8.0) -> None:
    """Logistic regression on soft labels by gradient descent with momentum."""
    n = max(len(rows), 1)
    x = np.zeros((n, WIDTH), np.float32)
    y = np.zeros(n, np.float32)
    for i, (label, at, count) in enumerate(rows):
        x[i, at] = np.sqrt(count) / np.sqrt(count.sum())
        y[i] = label
        x[i] *= min(1.0, count.sum() / 40)  # little text, little weight
    weights, speed, bias = np.zeros(WIDTH, np.float32), np.zeros(WIDTH, np.float32), 0.0
    for _ in range(rounds):
        gap = (1 / (1 + np.exp(-(x @ weights + bias))) - y)
        speed = 0.9 * speed - rate / n * (x.T @ gap) - 1e-4 * weights
        weights += speed
        bias -= 0.5 * float(gap.mean())
    model.weights, model.bias = weights.astype(np.float64), bias


def fit(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", sample: int = SAMPLE) -> Model:
    """The labellers' accuracies from all rows, the scorer from a sample of `sample` rows at most.

    Rows are drawn by a digest of id and text, so the sample does not depend on how rows are
    dealt out; rows of the same id and text are drawn once, rows without id like all others.
    """
    digest = F.xxhash64(F.coalesce(F.col(id_column).cast("string"), F.lit("-")), F.col(text_column).cast("binary"))
    rows = bounded(docs).select(digest.alias("digest"), F.col(text_column).cast("binary").alias("text"))

    def vote(batches):
        for batch in batches:
            for a, b in slices(batch.column(0)):
                data, offsets = flat_bytes(batch.column(0)[a:b])
                words, table, _, _ = measures(data, offsets)
                kinds, counts = np.unique(votes(words, table)[words > 0] @ 3 ** np.arange(8), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.int64()), pa.array(counts, pa.int64())], names=["pattern", "n"])

    counted = rows.select("text").mapInArrow(vote, "pattern long, n long").groupBy("pattern").agg(F.sum("n").alias("n"))
    found = sorted((r["pattern"], r["n"]) for r in counted.collect())  # at most 3**8 rows
    patterns = (np.array([p for p, _ in found], np.int64)[:, None] // 3 ** np.arange(8)) % 3
    counts = np.array([c for _, c in found], np.float64)
    model = estimate(patterns.reshape(-1, 8), counts)
    share = min(1.0, 1.25 * sample / max(counts.sum(), 1))

    def picked(batches):
        for batch in batches:
            for a, b in slices(batch.column(1)):
                data, offsets = flat_bytes(batch.column(1)[a:b])
                words, table, cell, count = measures(data, offsets)
                edges = np.searchsorted(cell, np.arange(b - a + 1) * WIDTH)
                seen = votes(words, table) @ 3 ** np.arange(8)
                keep = [i for i in range(b - a) if words[i]]
                yield pa.RecordBatch.from_arrays([batch.column(0)[a:b].take(pa.array(keep, pa.int64())), pa.array(seen[keep], pa.int64()), pa.array([cell[edges[i] : edges[i + 1]] % WIDTH for i in keep], pa.list_(pa.int64())), pa.array([count[edges[i] : edges[i + 1]] for i in keep], pa.list_(pa.int64()))], names=["digest", "pattern", "at", "n"])

    chosen = rows.filter(F.shiftrightunsigned("digest", 24) <= int(share * (1 << 40)))
    chosen = chosen.mapInArrow(picked, "digest long, pattern long, at array<long>, n array<long>").dropDuplicates(["digest"])
    drawn = chosen.orderBy("digest").limit(sample).collect()  # rows of at most WIDTH counts
    labels = model.posterior((np.array([r["pattern"] for r in drawn], np.int64)[:, None] // 3 ** np.arange(8)) % 3) if drawn else []
    train(model, sorted(((float(y), np.array(r["at"], np.int64), np.array(r["n"], np.float64)) for y, r in zip(labels, drawn)), key=lambda r: (r[0], r[1].tolist(), r[2].tolist())))
    return model


def score(docs: DataFrame, model: Model, threshold: float = 0.5, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """All columns of `docs` with `quality_score` and `quality_kept`, which replace columns of those names."""
    docs = bounded(docs).drop("quality_score", "quality_kept")
    held = docs.sparkSession.sparkContext.broadcast(model)  # WIDTH weights, whatever the input

    @F.pandas_udf("double")
    def scored(texts):
        import pandas as pd

        column = pa.array(texts, pa.binary())
        out = np.zeros(len(column))
        for a, b in slices(column):
            data, offsets = flat_bytes(column[a:b])
            words, _, cell, count = measures(data, offsets)
            out[a:b] = np.where(words > 0, held.value.scores(b - a, cell, count), 0.0)
        return pd.Series(out)

    docs = docs.withColumn("quality_score", scored(F.col(text_column).cast("binary")))
    return docs.withColumn("quality_kept", F.col("quality_score") >= threshold)
