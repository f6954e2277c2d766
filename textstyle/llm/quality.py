"""Document quality by a byte-level convolutional network in numpy.

Filters of ``WIDTH`` bytes slide over the whole text; its positions are dealt
to chunks of ``CHUNK``, each reading ``WIDTH - 1`` bytes of the next, so that
no position is missed. Each filter is rectified and max-pooled within every
chunk; the mean and the maximum over the chunks go through one linear layer
and a calibrated sigmoid to one probability. A filter has a weight for each
byte value at each of its places, so a convolution is a sum of table rows, and
its gradient touches the rows of the winning positions only.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from textstyle.llm.tables import check_names, fit_in_task, raw_texts, take_per_class

#: Labelled documents of each class that the network is fitted on, at most.
SAMPLE_ROWS = 1200
WIDTH, FILTERS, CHUNK = 5, 24, 1024
#: Chunks that are convolved at once.
SLAB = 8
MADE = ["score"]

_EPOCHS, _BATCH, _RATE, _DECAY = 8, 16, 0.02, 1e-4
#: Share of training texts of which a random part of 32 to 512 bytes is shown.
_CROPPED = 0.3


@dataclass
class Network:
    tables: np.ndarray  # WIDTH x 256 x FILTERS
    bias: np.ndarray  # FILTERS
    dense: np.ndarray  # 2 x FILTERS: of the mean and of the maximum
    offset: float
    scale: float = 1.0  # calibration of the logit
    shift: float = 0.0

    def pool(self, text: bytes, where: bool = False):
        """Chunk maxima, and on request the positions they were found at."""
        raw = np.frombuffer(text + bytes(WIDTH), np.uint8)
        n = max(1, len(text))
        maxima, places = [], []
        for at in range(0, n, SLAB * CHUNK):
            size = min(SLAB * CHUNK, n - at)
            total = self.tables[0].take(raw[at : at + size], axis=0)
            for k in range(1, WIDTH):
                total += self.tables[k].take(raw[at + k : at + k + size], axis=0)
            starts = np.arange(0, size, CHUNK)
            maxima.append(np.maximum.reduceat(total, starts, axis=0))
            if where:
                places += [at + s + total[s : s + CHUNK].argmax(axis=0) for s in starts]
        pooled = np.maximum(np.concatenate(maxima) + self.bias, 0)
        return (pooled, np.stack(places), raw) if where else pooled

    def logit(self, pooled: np.ndarray) -> float:
        return float(self.dense[0] @ pooled.mean(0) + self.dense[1] @ pooled.max(0) + self.offset)

    def score(self, text: bytes) -> float:
        return float(_sigmoid(self.scale * self.logit(self.pool(text)) + self.shift))


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class _Adam:
    def __init__(self, values: list[np.ndarray]):
        self.values, self.step = values, 0
        self.m = [np.zeros_like(v) for v in values]
        self.s = [np.zeros_like(v) for v in values]

    def apply(self, gradients: list[np.ndarray]) -> None:
        self.step += 1
        for v, g, m, s in zip(self.values, gradients, self.m, self.s):
            m += 0.1 * (g - m)
            s += 0.001 * (g * g - s)
            rate = _RATE * np.sqrt(1 - 0.999**self.step) / (1 - 0.9**self.step)
            v -= rate * (m / (np.sqrt(s) + 1e-8) + _DECAY * v)


def fit(rows: list[tuple[int, float, bytes]]) -> Network:
    """A network from ``(label, weight, text)``; weights restore class shares.

    Filters learn from both classes alike; a tenth of the rows, unseen by
    them, calibrates the probability with the weights.
    """
    rng = np.random.default_rng(0)
    net = Network(
        rng.normal(0, 0.2, (WIDTH, 256, FILTERS)).astype(np.float32),
        np.zeros(FILTERS, np.float32),
        rng.normal(0, 0.2, (2, FILTERS)).astype(np.float32),
        0.0,
    )
    if not rows:
        return net
    order = rng.permutation(len(rows))
    held, own = order[: len(rows) // 10], order[len(rows) // 10 :]
    labels = [rows[i][0] for i in own]
    even = {y: len(own) / (2 * labels.count(y)) for y in set(labels)}
    offset = np.zeros(1, np.float32)
    adam = _Adam([net.tables, net.bias, net.dense, offset])
    for _ in range(_EPOCHS):
        rng.shuffle(own)
        for at in range(0, len(own), _BATCH):
            gradients = [np.zeros_like(v) for v in adam.values]
            for i in own[at : at + _BATCH]:
                y, _, text = rows[i]
                if rng.random() < _CROPPED and len(text) > 64:  # short texts are judged too
                    size = int(min(len(text), 32 * 2 ** (4 * rng.random())))
                    start = int(rng.integers(len(text) - size + 1))
                    text = text[start : start + size]
                _backward(net, y, text, even[y] / _BATCH, gradients)
            adam.apply(gradients)
            net.offset = float(offset[0])
    if len(held):
        logits = np.array([net.logit(net.pool(rows[i][2])) for i in held])
        net.scale, net.shift = _platt(
            logits, np.array([rows[i][0] for i in held]), np.array([rows[i][1] for i in held])
        )
    return net


def _backward(net: Network, y: int, text: bytes, weight: float, gradients: list) -> None:
    pooled, places, raw = net.pool(text, where=True)
    mean, top, n = pooled.mean(0), pooled.argmax(0), len(pooled)
    error = weight * (_sigmoid(net.logit(pooled)) - y)
    tables, bias, dense, offset = gradients
    dense[0] += error * mean
    dense[1] += error * pooled.max(0)
    offset += error
    back = np.repeat((error * net.dense[0] / n)[None], n, axis=0)
    back[top, np.arange(FILTERS)] += error * net.dense[1]
    back *= pooled > 0
    bias += back.sum(0)
    filters = np.broadcast_to(np.arange(FILTERS), places.shape)
    for k in range(WIDTH):
        np.add.at(tables[k], (raw[places + k], filters), back)


def _platt(logits, y, weight) -> tuple[float, float]:
    """Scale and shift of the logit with the least log loss; targets smoothed."""
    weight = weight / weight.sum()
    good = (weight * y).sum()
    target = np.where(y == 1, 1 - 0.5 / (len(y) + 2), 0.5 / (len(y) + 2))
    scale, shift = 1.0, float(np.log((good + 1e-3) / (1 - good + 1e-3)) / 2)
    for _ in range(50):  # Newton's method, damped
        p = _sigmoid(scale * logits + shift)
        g, h = weight * (p - target), weight * np.maximum(p * (1 - p), 1e-6)
        grad = np.array([(g * logits).sum() + 1e-3 * (scale - 1), g.sum()])
        hess = np.array([[(h * logits**2).sum() + 1e-3, (h * logits).sum()],
                         [(h * logits).sum(), h.sum() + 1e-6]])
        step = np.clip(np.linalg.solve(hess, grad), -1, 1)
        scale, shift = max(scale - step[0], 0.05), shift - step[1]
    return float(scale), float(shift)


def train(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    sample_rows: int = SAMPLE_ROWS,
) -> Network:
    """Fits on at most ``sample_rows`` labelled documents of each class.

    ``labels`` holds the rows that may be learned from; null ids and labels
    are left out and an id with several labels is used once a label. Picked
    labels are joined to ``docs`` by broadcast, as their number is bounded.
    Without any label the network stays as it began.
    """
    label = F.col(label_col).cast("int").alias("y")
    known = labels.select(F.col(id_col).alias("id"), label).where("id IS NOT NULL AND y IS NOT NULL")
    known = known.distinct()
    sizes = known.groupBy("y").agg(F.count("*").alias("of"))
    picked = take_per_class(known, "y", ["id"], sample_rows).join(F.broadcast(sizes), "y")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = rows.join(F.broadcast(picked), "id")
    # A repeated id brings further rows: the bound holds for them as well.
    rows = take_per_class(rows, "y", ["id", "text"], sample_rows)
    sample = rows.select(
        "y", (F.col("of") / F.lit(float(sample_rows))).alias("w"),
        F.coalesce("text", F.lit("")).cast("binary").alias("t"),
    )
    return pickle.loads(fit_in_task(sample, lambda r: pickle.dumps(fit(_weighted(r)))))


def _weighted(rows: list[tuple]) -> list[tuple]:
    """A class stands for all its labels, however many rows were picked."""
    n = {y: sum(r[0] == y for r in rows) for y in {r[0] for r in rows}}
    return [(y, w / n[y], text) for y, w, text in rows]


def rate(docs: DataFrame, network: Network, *, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score``, the probability of label 1, of each whole text.

    No shuffle. A null text is scored like an empty one. An input column named
    ``score`` is refused.
    """
    check_names(docs, MADE)
    schema = StructType(docs.schema.fields + StructType.fromDDL("score double").fields)
    arrow = to_arrow_schema(schema)
    sent = docs.sparkSession.sparkContext.broadcast(network)

    def run(batches):
        for batch in batches:
            scores = [sent.value.score(t) for t in raw_texts(batch.column(text_col))]
            columns = [c.cast(f.type) for c, f in zip(batch.columns, arrow)]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(scores, pa.float64())], schema=arrow
            )

    return docs.mapInArrow(run, schema)
