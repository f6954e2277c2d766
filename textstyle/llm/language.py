"""Language identification from character n-grams.

Features are TF-IDF weights of hashed n-grams of letters (other characters
count as one blank), one to three characters long. A sparse multinomial
logistic regression is trained on them with follow-the-regularised-leader and
elastic-net penalties; then one temperature, fitted on a tenth of the sample
that the weights have not seen, calibrates its probabilities.
"""

from __future__ import annotations

import pickle
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from textstyle.llm.tables import check_names, fit_in_task, take_per_class

#: Labelled documents of each language that the model is fitted on, at most.
SAMPLE_ROWS = 800
UNDETERMINED = "und"
MADE = ["lang_pred", "score"]

_BITS = 16
_ORDERS = (1, 2, 3)
_EPOCHS, _ALPHA, _BETA, _L1, _L2 = 4, 0.5, 1.0, 1e-3, 1e-4
_MIX = np.uint64(0x9E3779B97F4A7C15)  # the golden ratio, for multiplicative hashing


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def counts_of(text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
    """Hashed n-grams and how often they occur; None without any letter."""
    if not text:
        return None
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), "<u4")
    is_letter = _letters()[points]
    if not is_letter.any():
        return None
    points = np.where(is_letter, points, 32)
    keep = np.ones(len(points), bool)
    keep[1:] = is_letter[1:] | is_letter[:-1]  # one blank for a run of them
    ends = np.flatnonzero(is_letter)[[0, -1]]
    keep[: ends[0]] = keep[ends[1] + 1 :] = False
    points = np.concatenate([[32], points[keep], [32]]).astype(np.uint64)
    counts, key = np.zeros(1 << _BITS, np.int64), points
    for n in _ORDERS:
        if n > 1:
            key = (key[:-1] << np.uint64(21)) | points[n - 1 :]
        hashed = ((key + np.uint64(n)) * _MIX) >> np.uint64(64 - _BITS)
        counts += np.bincount(hashed.astype(np.int64), minlength=1 << _BITS)
    found = np.flatnonzero(counts)
    return found, counts[found]


class Model:
    """Languages, IDF, weights and temperature."""

    def __init__(self, languages: list[str], idf: np.ndarray, weights, temperature: float):
        self.languages, self.idf, self.temperature = languages, idf, temperature
        self.weights = weights  # features x languages

    def vector(self, counts) -> tuple[np.ndarray, np.ndarray]:
        found, n = counts
        x = (1 + np.log(n)) * self.idf[found]
        return found, x / max(np.sqrt(x @ x), 1e-12)

    def logits(self, counts) -> np.ndarray:
        found, x = self.vector(counts)
        return x @ self.weights[found]

    def predict(self, text: str | None) -> tuple[str, float]:
        counts = counts_of(text)
        if counts is None or not self.languages:
            return UNDETERMINED, 0.0
        p = _softmax(self.logits(counts) / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit(rows: list[tuple[str, str]]) -> Model:
    """A model from ``(language, text)`` rows."""
    known = [(lang, c) for lang, text in rows if (c := counts_of(text)) is not None]
    languages = sorted({lang for lang, _ in known})
    size = 1 << _BITS
    df = np.zeros(size)
    for _, (found, _) in known:
        df[found] += 1
    model = Model(languages, np.log((1 + len(known)) / (1 + df)) + 1, np.zeros((size, 0)), 1.0)
    if not languages:
        return model
    index = {lang: k for k, lang in enumerate(languages)}
    data = [(index[lang], *model.vector(c)) for lang, c in known]
    order = np.random.default_rng(0).permutation(len(data))
    held = order[: len(data) // 10]
    model.weights = _ftrl(data, order[len(held) :], size, len(languages))
    if len(held):
        logits = np.stack([data[i][2] @ model.weights[data[i][1]] for i in held])
        model.temperature = _temperature(logits, np.array([data[i][0] for i in held]))
    return model


def _ftrl(data, order, size: int, classes: int) -> np.ndarray:
    """Follow the regularised leader, proximal form, a step to a document."""
    z, n = np.zeros((size, classes)), np.zeros((size, classes))

    def weights(rows):
        shrunk = np.sign(z[rows]) * np.maximum(np.abs(z[rows]) - _L1, 0)
        return -shrunk / ((_BETA + np.sqrt(n[rows])) / _ALPHA + _L2)

    rng = np.random.default_rng(1)
    for _ in range(_EPOCHS):
        for i in rng.permutation(order):
            y, found, x = data[i]
            w = weights(found)
            error = _softmax(x @ w)
            error[y] -= 1
            g = x[:, None] * error
            root = np.sqrt(n[found] + g * g)
            z[found] += g - (root - np.sqrt(n[found])) / _ALPHA * w
            n[found] += g * g
    return weights(slice(None))


def _temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The one with the least log loss, searched on a logarithmic grid.

    Targets leave one row in ``len(y) + 2`` to the other classes, so that a
    sample without errors does not make every answer certain.
    """
    grid = np.exp(np.linspace(np.log(0.05), np.log(5), 93))
    doubt = 1 / (len(y) + 2)
    target = np.full(logits.shape, doubt / max(1, logits.shape[1] - 1))
    target[np.arange(len(y)), y] = 1 - doubt
    loss = [-(target * np.log(np.maximum(_softmax(logits / t), 1e-12))).sum() for t in grid]
    return float(grid[int(np.argmin(loss))])


def train(
    labelled: DataFrame,
    *,
    key: list[str],
    text_col: str = "text",
    lang_col: str = "lang",
    sample_rows: int = SAMPLE_ROWS,
) -> Model:
    """Fits on at most ``sample_rows`` rows a language, the first by a hash of ``key``.

    Rows without language or text are left out. Fitting takes one task, whose
    memory that bound limits; without labelled rows every text is undetermined.
    """
    rows = labelled.select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text"),
        *[F.col(k).alias(f"key{i}") for i, k in enumerate(key)],
    ).where("lang IS NOT NULL AND text IS NOT NULL")
    sample = take_per_class(rows, "lang", [f"key{i}" for i in range(len(key))], sample_rows)
    model = fit_in_task(sample.select("lang", "text"), lambda r: pickle.dumps(fit(r)))
    return pickle.loads(model)


def identify(docs: DataFrame, model: Model, *, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the calibrated probability.

    Whole texts, no shuffle. A text that is null or has no letter is ``und``
    with score 0. An input column named like a result is refused.
    """
    check_names(docs, MADE)
    made = StructType.fromDDL("lang_pred string, score double")
    schema = StructType(docs.schema.fields + made.fields)
    arrow = to_arrow_schema(schema)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            texts = batch.column(text_col)
            found = [sent.value.predict(t.as_py()) for t in texts]
            columns = [c.cast(f.type) for c, f in zip(batch.columns, arrow)]
            columns += [pa.array([x[k] for x in found], arrow.field(MADE[k]).type) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return docs.mapInArrow(run, schema)
