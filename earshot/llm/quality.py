"""Quality classifier: a convolutional network over bytes, in numpy.

A text is its UTF-8 bytes in chunks of `CHUNK` that overlap and cover all of it. Every byte has a learned vector;
learned filters over `WIDTH` bytes slide along a chunk, pass a rectifier and are max-pooled per chunk. The mean
and the maximum of the chunks' pooled values make one vector per text, and a logistic unit its probability.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.llm.common import as_bytes, map_texts, resident

CHUNK, OVERLAP, WIDTH, STEP = 512, 64, 8, 4
BATCH_BYTES = 1 << 20
BLOCK = 64  # chunks at once: what is made of them stays in a core's cache


def chunks(text: bytes) -> np.ndarray:
    """Overlapping chunks that cover the text, zero-filled at the end; one for an empty text."""
    step = CHUNK - OVERLAP
    n = max(1, -(-(len(text) - OVERLAP) // step))
    flat = np.zeros((n - 1) * step + CHUNK, np.uint8)
    flat[: len(text)] = np.frombuffer(text, np.uint8)
    return np.lib.stride_tricks.sliding_window_view(flat, CHUNK)[::step]


@dataclass
class ByteNet:
    vectors: np.ndarray  # 256 x size of a byte's vector
    filters: np.ndarray  # WIDTH * size x number of filters
    bias: np.ndarray
    head: np.ndarray  # weights of mean and maximum, then the intercept
    scale: np.ndarray  # centre and spread of the pooled values

    def responses(self, rows: np.ndarray, shift: int) -> np.ndarray:
        """Filter responses at every STEP-th place from `shift`: chunks x places x filters."""
        n, size = len(rows), self.vectors.shape[1]
        places = (CHUNK - shift) // STEP
        blocks = self.vectors[rows[:, shift : shift + places * STEP]].reshape(n * places, STEP * size)
        halves = [(blocks @ part).reshape(n, places, -1) for part in np.split(self.filters, WIDTH // STEP)]
        return sum(h[:, k : places - (WIDTH // STEP - 1) + k] for k, h in enumerate(halves))

    def pooled(self, rows: np.ndarray) -> np.ndarray:
        """Max-pooled responses of each chunk, over every place.

        Places come first, so one place's chunks are one small product with both halves of the filters: too small for BLAS to
        start threads, and sums and maxima run over whole rows. The values are those of `responses`.
        """
        n, size, k = len(rows), self.vectors.shape[1], self.filters.shape[1]
        halves = np.concatenate(np.split(self.filters, WIDTH // STEP), 1)
        top = np.full((n, k), -np.inf, np.float32)
        for shift in range(STEP):
            places = (CHUNK - shift) // STEP
            by_place = rows[:, shift : shift + places * STEP].reshape(n, places, STEP).transpose(1, 0, 2)
            both = self.vectors.take(by_place, axis=0).reshape(places, n, STEP * size) @ halves
            np.maximum(top, (both[:-1, :, :k] + both[1:, :, k:]).max(0), out=top)
        return np.maximum(top + self.bias, 0)

    def features(self, texts: list[bytes]) -> np.ndarray:
        split = [chunks(t) for t in texts]
        first = np.cumsum([0, *[len(s) for s in split]])[:-1]
        rows = np.concatenate(split)
        pooled = np.concatenate([self.pooled(rows[a : a + BLOCK]) for a in range(0, len(rows), BLOCK)])
        mean = np.add.reduceat(pooled, first) / np.array([len(s) for s in split])[:, None]
        return np.concatenate([mean, np.maximum.reduceat(pooled, first)], 1)

    def scores(self, texts: list[bytes]) -> np.ndarray:
        x = (self.features(texts) - self.scale[0]) / self.scale[1]
        return 1 / (1 + np.exp(-np.clip(x @ self.head[:-1] + self.head[-1], -30, 30)))


def train(texts: list[bytes], labels: np.ndarray, *, filters: int = 32, size: int = 8, epochs: int = 14, per_text: int = 4, seed: int = 6) -> ByteNet:
    """Filters by gradient descent on chunks drawn from all over each text, then the head on whole texts.

    The gradient of a max-pool reaches one place per chunk and filter, so a step costs little more than scoring.
    Classes weigh alike.
    """
    rng = np.random.default_rng(seed)
    net = ByteNet(
        rng.normal(0, 0.3, (256, size)).astype(np.float32), rng.normal(0, 0.3, (WIDTH * size, filters)).astype(np.float32),
        np.zeros(filters, np.float32), np.zeros(2 * filters + 1), np.stack([np.zeros(2 * filters), np.ones(2 * filters)]),
    )
    split = [chunks(t) for t in texts]
    weight = np.where(labels == 1, 0.5 / max(1, (labels == 1).sum()), 0.5 / max(1, (labels == 0).sum())) * len(labels)
    out = np.zeros(filters + 1, np.float32)
    params = [net.vectors, net.filters, net.bias, out]
    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in params]
    turn = 0
    for epoch in range(epochs):
        order = rng.permutation(len(texts))
        for a in range(0, len(order), 32):
            mine = order[a : a + 32]
            rows = np.stack([split[i][c] for i in mine for c in rng.integers(len(split[i]), size=per_text)])
            shift = int(rng.integers(STEP))
            response = net.responses(rows, shift)
            place = response.argmax(1)  # chunks x filters
            raw = np.take_along_axis(response, place[:, None], 1)[:, 0] + net.bias
            hidden = np.maximum(raw, 0).reshape(len(mine), per_text, filters)
            mean = hidden.mean(1)
            p = 1 / (1 + np.exp(-np.clip(mean @ out[:-1] + out[-1], -30, 30)))
            error = ((p - labels[mine]) * weight[mine] / len(mine)).astype(np.float32)
            g_out = np.r_[mean.T @ error, error.sum()].astype(np.float32)
            g_hidden = np.repeat(error[:, None] * out[None, :-1] / per_text, per_text, 0) * (raw > 0)
            start = shift + place * STEP
            windows = rows[np.arange(len(rows))[:, None, None], start[:, :, None] + np.arange(WIDTH)]  # chunks x filters x WIDTH
            seen = net.vectors[windows].reshape(len(rows), filters, WIDTH * size)
            g_filters = np.einsum("cfw,cf->wf", seen, g_hidden)
            g_seen = g_hidden[:, :, None] * net.filters.T[None]
            g_vectors = np.zeros_like(net.vectors)
            np.add.at(g_vectors, windows.ravel(), g_seen.reshape(-1, size))
            turn += 1
            for param, grad, (m, v) in zip(params, (g_vectors, g_filters, g_hidden.sum(0), g_out), moments):
                m += 0.1 * (grad - m)
                v += 0.001 * (grad * grad - v)
                param -= 0.01 * (m / (1 - 0.9**turn)) / (np.sqrt(v / (1 - 0.999**turn)) + 1e-8)
    features = np.concatenate([net.features(texts[a : a + 64]) for a in range(0, len(texts), 64)]).astype(np.float64)
    net.scale = np.stack([features.mean(0), features.std(0) + 1e-3])
    net.head = _logistic((features - net.scale[0]) / net.scale[1], labels, np.ones(len(labels)))
    return net


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 2.0, steps: int = 30) -> np.ndarray:
    """Weights and intercept by Newton's method with a ridge on the weights."""
    x1 = np.concatenate([x, np.ones((len(x), 1))], 1)
    keep = ridge * np.eye(x1.shape[1])
    keep[-1, -1] = 1e-3
    w = np.zeros(x1.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x1 @ w, -30, 30)))
        gradient = x1.T @ (weight * (p - y)) + keep @ w
        step = np.linalg.solve((x1 * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x1 + keep, gradient)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit_quality(
    docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", label_id: str = "doc_id", label: str = "quality", per_class: int = 1_200
) -> ByteNet | None:
    """Train on a bounded sample of the labelled rows: at most about `per_class` of each class, drawn by a hash of
    the key, whole texts. Classes keep their share in the final probability. Rows without key, label or text are
    not used; None if no labelled row is left.
    """
    known = labels.filter(F.col(label).isin(0, 1)).groupBy(F.col(label_id).alias("id")).agg(F.max(F.col(label)).alias("label"))
    known = known.filter("id IS NOT NULL")
    counts = {r.label: r["count"] for r in known.groupBy("label").count().collect()}
    if not counts:
        return None
    draw = F.pmod(F.xxhash64(F.col("id"), F.lit("quality sample")), F.lit(1 << 30))
    bound = F.when(F.col("label") == 1, F.lit(int(min(1.0, per_class / max(1, counts.get(1, 0))) * (1 << 30)))).otherwise(
        F.lit(int(min(1.0, per_class / max(1, counts.get(0, 0))) * (1 << 30)))
    )
    drawn = known.withColumn("draw", draw).filter(F.col("draw") < bound).select("id", "label", "draw")
    # about 2 * per_class rows by the draw above, so the broadcast is bounded
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).filter("text IS NOT NULL").join(F.broadcast(drawn), "id")
    once = rows.groupBy("id", "label", "draw").agg(F.max("text").alias("text"))  # a key gives one text, however many rows it has
    picked = sorted(once.collect(), key=lambda r: (r.draw, r.id))
    if not picked:
        return None
    texts, y = [r.text.encode("utf-8", "replace") for r in picked], np.array([r.label for r in picked])
    net = train(texts, y)
    for value, sign in ((1, 1), (0, -1)):  # the sample may hold other shares of the classes than the table
        kept = (y == value).sum()
        if kept and counts.get(value):
            net.head[-1] += sign * np.log(counts[value] / kept)
    return net


def score_quality(docs: DataFrame, net: ByteNet | None, *, doc_id: str = "doc_id", text: str = "text", threshold: float = 0.3) -> DataFrame:
    """doc_id, score (0 to 1, higher: label 1 likelier) and predicted (1 if score >= threshold), one row per row of
    `docs`. Null and empty texts are scored as one chunk of zeros; without a model every score is 0.5."""

    def make():
        resident(None, None)
        def step(texts: pa.Array):
            raw = as_bytes(texts)
            scores = net.scores(raw) if net else np.full(len(raw), 0.5)
            return (pa.array(scores.astype(np.float64)),)

        return step

    scored = map_texts(docs, {"doc_id": doc_id}, text, make, "score double", BATCH_BYTES)
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
