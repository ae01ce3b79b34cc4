"""Document quality from bytes: a small convolutional network in numpy.

A text's bytes are cut into overlapping chunks that cover all of it. Bytes are embedded, filters run
over windows of bytes, and each filter's greatest answer in a chunk is kept. Over the chunks of a
document the greatest and the mean are combined into one probability.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linernotes.llm.common import held_out, named, slices, spread_pieces


@dataclass(frozen=True)
class Shape:
    chunk: int = 256
    step: int = 224
    width: int = 8
    stride: int = 2
    embedded: int = 8
    filters: int = 32

    @property
    def positions(self) -> int:
        return (self.chunk - self.width) // self.stride + 1


@dataclass(frozen=True)
class Fit:
    """sample_rows bounds the labelled rows that are fitted on, pieces what is seen of each.

    The rarer class weighs more, by the root of how much rarer it is.
    """

    sample_rows: int = 4000
    pieces: int = 8
    batch: int = 64
    steps: int = 800
    rate: float = 0.01
    seed: int = 7


SHAPE = Shape()


def chunks_of(data: bytes | None, shape: Shape = SHAPE) -> np.ndarray:
    """(chunks, bytes) of a whole text, the last one filled up with zeros; an empty text has one chunk."""
    data = data or b""
    n = max(1, -(-(len(data) - (shape.chunk - shape.step)) // shape.step))
    padded = np.zeros((n - 1) * shape.step + shape.chunk, np.uint8)
    padded[: len(data)] = np.frombuffer(data, np.uint8)
    return np.lib.stride_tricks.sliding_window_view(padded, shape.chunk)[:: shape.step]


class Network:
    def __init__(self, weights: dict[str, np.ndarray], shape: Shape = SHAPE):
        self.w, self.shape = weights, shape

    @classmethod
    def fresh(cls, base_rate: float, seed: int, shape: Shape = SHAPE) -> Network:
        rng = np.random.default_rng(seed)
        size = shape.width * shape.embedded
        normal = lambda *dims, scale: (rng.standard_normal(dims) * scale).astype(np.float32)
        return cls({
            "embedding": normal(256, shape.embedded, scale=0.5),
            "filters": normal(size, shape.filters, scale=size**-0.5),
            "bias": np.zeros(shape.filters, np.float32),
            "combine": normal(2 * shape.filters, scale=0.1),
            "offset": np.array([np.log(base_rate / (1 - base_rate))], np.float32),
        }, shape)

    def windows(self, rows: np.ndarray) -> np.ndarray:
        """(rows, positions, width * embedded)"""
        s = self.shape
        x = np.take(self.w["embedding"], rows, axis=0).reshape(len(rows), -1)
        view = np.lib.stride_tricks.sliding_window_view(x, s.width * s.embedded, axis=1)
        return np.ascontiguousarray(view[:, :: s.stride * s.embedded])

    def pooled(self, rows: np.ndarray, block: int = 256) -> np.ndarray:
        """(rows, filters): each filter's greatest answer in each chunk."""
        out = np.empty((len(rows), self.shape.filters), np.float32)
        for i in range(0, len(rows), block):
            seen = self.windows(rows[i : i + block])
            answers = (seen.reshape(-1, seen.shape[2]) @ self.w["filters"]).reshape(*seen.shape[:2], -1)
            out[i : i + block] = answers.max(axis=1)
        return np.maximum(out + self.w["bias"], 0)

    def combined(self, pooled: np.ndarray, starts: np.ndarray) -> np.ndarray:
        counts = np.diff(np.append(starts, len(pooled)))[:, None]
        return np.hstack([np.maximum.reduceat(pooled, starts), np.add.reduceat(pooled, starts) / counts])

    def scores(self, texts: list[bytes | None]) -> np.ndarray:
        """The probability of label 1 of whole texts."""
        rows = [chunks_of(t, self.shape) for t in texts]
        starts = np.cumsum([0, *map(len, rows[:-1])])
        pooled = np.vstack([self.pooled(np.concatenate(g)) for g in grouped(rows, 1024)])
        logit = self.combined(pooled, starts) @ self.w["combine"] + self.w["offset"]
        return 1 / (1 + np.exp(-logit.astype(np.float64)))

    def gradients(self, rows: np.ndarray, starts: np.ndarray, labels: np.ndarray, weights: np.ndarray | float = 1.0) -> dict[str, np.ndarray]:
        """Of the mean weighted log loss."""
        s, w = self.shape, self.w
        seen = self.windows(rows)
        answers = (seen.reshape(-1, seen.shape[2]) @ w["filters"]).reshape(*seen.shape[:2], -1)
        best = answers.argmax(axis=1)
        raw = np.take_along_axis(answers, best[:, None, :], axis=1)[:, 0] + w["bias"]
        pooled = np.maximum(raw, 0)
        features = self.combined(pooled, starts)
        error = (1 / (1 + np.exp(-(features @ w["combine"] + w["offset"]))) - labels) * weights / len(labels)
        counts = np.diff(np.append(starts, len(rows)))
        doc = np.repeat(np.arange(len(starts)), counts)
        back = error[:, None] * w["combine"][None, :]
        greatest, mean = back[:, : s.filters], back[:, s.filters :]
        is_first = pooled == features[doc, : s.filters]
        shares = np.add.reduceat(is_first.astype(np.float32), starts)
        grad = is_first * (greatest / shares)[doc] + (mean / counts[:, None])[doc]
        grad = np.where(raw > 0, grad, 0).astype(np.float32)
        at = np.arange(len(rows))[:, None]
        winners = seen[at, best]  # (rows, filters, width * embedded)
        inputs = (grad[:, :, None] * w["filters"].T[None]).reshape(-1, s.embedded)
        places = best[:, :, None] * s.stride + np.arange(s.width)
        embedding = np.zeros_like(w["embedding"])
        np.add.at(embedding, rows[at[:, :, None], places].reshape(-1), inputs)
        return {
            "embedding": embedding,
            "filters": np.einsum("rf,rfk->kf", grad, winners, optimize=True),
            "bias": grad.sum(axis=0),
            "combine": error @ features,
            "offset": np.array([error.sum()], np.float32),
        }


def grouped(rows: list[np.ndarray], size: int) -> Iterator[list[np.ndarray]]:
    group, total = [], 0
    for r in rows:
        group.append(r)
        total += len(r)
        if total >= size:
            yield group
            group, total = [], 0
    if group:
        yield group


def fit(samples: list[list[bytes]], labels: np.ndarray, settings: Fit = Fit(), shape: Shape = SHAPE) -> Network:
    """A network fitted on documents' pieces. Without two classes it answers the base rate everywhere."""
    rate = float(np.clip(labels.mean(), 0.01, 0.99)) if len(labels) else 0.5
    net = Network.fresh(rate, settings.seed, shape)
    if len(set(labels.tolist())) < 2:
        net.w["combine"][:] = 0
        return net
    rows = [np.concatenate([chunks_of(p, shape)[:1] for p in pieces or [b""]]) for pieces in samples]
    odds = np.sqrt((1 - labels.mean()) / labels.mean())
    weights = np.where(labels == 1, max(odds, 1), max(1 / odds, 1)).astype(np.float32)
    rng = np.random.default_rng(settings.seed)
    first = {k: np.zeros_like(v) for k, v in net.w.items()}
    second = {k: np.zeros_like(v) for k, v in net.w.items()}
    for t in range(1, settings.steps + 1):
        picked = rng.choice(len(rows), min(settings.batch, len(rows)), replace=False)
        own = [rows[i] for i in picked]
        starts = np.cumsum([0, *map(len, own[:-1])])
        rate = settings.rate * (1 - t / (settings.steps + 1))
        for k, g in net.gradients(np.concatenate(own), starts, labels[picked], weights[picked]).items():
            first[k] += 0.1 * (g - first[k])
            second[k] += 0.001 * (g * g - second[k])
            net.w[k] = (net.w[k] - rate * (first[k] / (1 - 0.9**t)) / (np.sqrt(second[k] / (1 - 0.999**t)) + 1e-8)).astype(np.float32)
    return net


def learn(docs: DataFrame, labels: DataFrame, settings: Fit = Fit(), shape: Shape = SHAPE) -> Network:
    """Fits on a bounded sample of the labelled documents that are not held out.

    The sample is the documents whose ids have the smallest hashes, of rows that repeat an id the one
    with the smallest text. Labels without a value or a document don't count; of repeated labels of one
    document the mean decides.
    """
    usable = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(5, 0))
    sample = (
        usable.groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(settings.sample_rows)
    )
    # At most sample_rows rows of two numbers. Rows that repeat an id are one sample, so what is gathered is bounded too.
    pieces = (
        docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
        .groupBy("doc_id", "label").agg(F.min(spread_pieces(F.coalesce("text", F.lit("")), settings.pieces, shape.chunk)).alias("pieces"))
    )
    rows = sorted(pieces.collect(), key=lambda r: r["doc_id"])
    return fit([[p.encode() for p in r["pieces"]] for r in rows], np.array([r["label"] for r in rows], np.float32), settings, shape)


def score(text: Column, net: Network, spark: SparkSession) -> Column:
    """The probability of good quality of whole texts; null and empty texts are one empty chunk."""
    sent = spark.sparkContext.broadcast(net)

    @F.pandas_udf("double")
    def scored(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in series:
            yield pd.Series(np.concatenate([sent.value.scores(part) for part in slices(batch, 1 << 22)] or [np.empty(0)]))

    return scored(text.cast("binary"))


def quality_scores(docs: DataFrame, labels: DataFrame, settings: Fit = Fit(), threshold: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted) of each row of docs (doc_id, text).

    Repeated rows give repeated results, rows without an id are scored too, no rows give none. Very long
    texts are scored whole, a chunk at a time. Other columns are ignored.
    Labels (doc_id, quality) without rows, or all alike, give every text the base rate.
    """
    net = learn(docs, labels, settings)
    scored = docs.select("doc_id", score(F.col("text"), net, docs.sparkSession).alias("score"))
    return scored.select("doc_id", held_out(5, 0).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, settings: Fit = Fit(), threshold: float = 0.3) -> DataFrame:
    """The rows of docs that the classifier doesn't reject, with all their columns, whatever their names.

    Null and empty texts are judged as texts without words, repeated rows alike, rows without an id too.
    """
    net = learn(docs, labels, settings)
    return docs.withColumn("__quality", score(F.col("text"), net, docs.sparkSession)).filter(F.col("__quality") >= threshold).select(named(docs))
