"""Quality classifier: naive Bayes support vectors over n-gram indicators.

The indicators are 1- to 3-grams of token shapes (case pattern, leading and trailing
marks, length class, equal to the token before or not) and single tokens, hashed to
a fixed number of columns.  Each column is scaled by the log ratio of its smoothed
class counts; a linear hinge-loss model is then fitted on the scaled indicators by
dual coordinate descent, and its margin is mapped to a probability on rows that the
descent did not see.

Fitting uses a bounded sample of labelled rows (``sample_rows``, see ``labelled_sample``)
outside the held-out fold; scoring covers every row and whole text.

Nulls and odd input: a null text counts as empty and gets the score of no
indicators; rows with a null id are scored and count as held out; null labels are
ignored, of conflicting labels of one id the larger holds; with no label, or labels
of one class only, every score is that class's share (0.5 without labels); an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import RecentCache, held_out

BITS = 18
#: Longest text that takes part in fitting; every text is scored whole.
SAMPLE_CHARS = 200_000
_MIX = np.uint64(0x9E3779B97F4A7C15)
_EDGE = re.compile(r"^([\W_]*)(.*?)([\W_]*)$", re.S)


def token_shape(token: str) -> str:
    lead, core, trail = _EDGE.match(token).groups()
    if not core:
        case = "s"
    elif core.isdigit():
        case = "d"
    elif core.islower():
        case = "l"
    elif core.isupper():
        case = "U" if len(core) > 1 else "C"
    elif core[0].isupper() and core[1:].islower():
        case = "C"
    else:
        case = "m"
    return f"{lead[-2:]}{case}{min(len(core).bit_length(), 5)}{trail[:3]}"


class _Tokens(RecentCache):
    """token -> 64-bit code: 32 bits of the token over 32 bits of its shape."""

    limit = 60_000

    def make(self, token: str) -> int:
        return zlib.crc32(token.encode("utf-8", "replace")) << 32 | zlib.crc32(token_shape(token).encode("utf-8", "replace"))


_tokens = _Tokens()


def forget_tokens() -> None:
    """For the end of a task.  A function of the module, since tasks would get a copy of the cache itself."""
    _tokens.forget()


def indicators(text: str | None) -> np.ndarray:
    """Sorted distinct column numbers of a text; the whole text counts."""
    words = (text or "").split()
    n = len(words)
    if not n:
        return np.zeros(0, np.uint32)
    codes = np.fromiter(map(_tokens.__getitem__, words), np.uint64, n)
    shape = (codes & np.uint64(0xFFFFFFFF)) << np.uint64(1)
    shape[1:] |= (codes[1:] == codes[:-1]).astype(np.uint64)
    one = (shape + np.uint64(1)) * _MIX
    grams = [one, (codes >> np.uint64(32)) * _MIX ^ np.uint64(1 << 63)]
    if n > 1:
        two = (one[:-1] ^ (one[1:] >> np.uint64(7))) * _MIX
        grams.append(two)
        if n > 2:
            grams.append((two[:-1] ^ (one[2:] >> np.uint64(13))) * _MIX)
    return np.unique((np.concatenate(grams) >> np.uint64(64 - BITS)).astype(np.uint32))


def log_count_ratios(rows: list[np.ndarray], y: np.ndarray, alpha: float = 1.0) -> np.ndarray:
    """log of the smoothed share of a column among the indicators of class 1 against class 0."""
    counts = np.zeros((2, 1 << BITS), np.int64)
    for c in (0, 1):
        held = [r for r, v in zip(rows, y, strict=True) if v == c]
        for at in range(0, len(held), 500):  # the whole sample at once would be copied as 64-bit numbers
            counts[c] += np.bincount(np.concatenate(held[at : at + 500]), minlength=1 << BITS)
    q, p = counts + alpha
    return np.log(p / p.sum()) - np.log(q / q.sum())


def dual_coordinate_descent(
    rows: list[np.ndarray], scale: np.ndarray, y: np.ndarray, c: float = 1.0, epochs: int = 12, seed: int = 7
) -> tuple[np.ndarray, float]:
    """Weights and bias of the L1-loss support vector machine on scaled indicators.

    One dual variable a row, boxed by c times the class weight; the last column is a constant.
    """
    w, bias = np.zeros(len(scale)), 0.0
    sign = np.where(y == 1, 1.0, -1.0)
    share = max(min(y.mean(), 1 - 1e-6), 1e-6)
    top = np.where(y == 1, c * 0.5 / share, c * 0.5 / (1 - share))
    norms = np.array([v @ v + 1.0 for v in (scale[r] for r in rows)])
    alpha, rng = np.zeros(len(rows)), np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            r, s = rows[i], sign[i]
            v = scale[r]  # for all rows at once they would take twice what the sample takes
            gradient = s * (w[r] @ v + bias) - 1.0
            new = min(max(alpha[i] - gradient / norms[i], 0.0), top[i])
            step = (new - alpha[i]) * s
            if step:
                w[r] += step * v
                bias += step
                alpha[i] = new
                moved = max(moved, abs(step))
        if moved < 1e-4:
            break
    return w, bias


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> np.ndarray:
    """Newton steps for a ridge logistic model; the last coefficient is the constant."""
    a = np.hstack([x, np.ones((len(x), 1))])
    coef = np.zeros(a.shape[1])
    penalty = np.full(a.shape[1], ridge)
    for _ in range(steps):
        p = sigmoid(a @ coef)
        gradient = a.T @ (y - p) - penalty * coef
        step = np.linalg.solve((a.T * (p * (1 - p))) @ a + np.diag(penalty), gradient)
        coef += step
        if np.abs(step).max() < 1e-7:
            break
    return coef


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, rows: int) -> DataFrame:
    """At most ``rows`` labelled documents outside the held-out fold: doc_id, text, y.

    They are chosen by the smallest hashes of ids among the first ``4 * rows`` labels that
    one document bears; an id of several rows tells no text and is left out, and so are
    texts of over ``SAMPLE_CHARS`` characters.  Both lists of ids are bounded and broadcast;
    no text is shuffled.
    """
    first = lambda df, n: df.orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
    marked = labels.filter(F.col(label_col).isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max(label_col).cast("int").alias("y"))
    borne = docs.select("doc_id").join(F.broadcast(first(marked, 4 * rows)), "doc_id").groupBy("doc_id").agg(F.max("y").alias("y"), F.count("*").alias("n"))
    picked = first(borne.filter("n = 1"), rows).select("doc_id", "y")
    texts = docs.select("doc_id", "text").filter(F.coalesce(F.length("text"), F.lit(0)) <= SAMPLE_CHARS)
    return texts.join(F.broadcast(picked), "doc_id").select("doc_id", "text", "y")


class QualityModel:
    """Fitted weights over indicator columns, and the map from margin to probability."""

    def __init__(self, weights: np.ndarray, bias: float, slope: float, offset: float):
        self.weights, self.bias, self.slope, self.offset = weights.astype(np.float32), bias, slope, offset

    @classmethod
    def fit(cls, rows: list[np.ndarray], y: np.ndarray, seed: int = 7) -> QualityModel:
        if len(set(y.tolist())) < 2:
            share = float(y.mean()) if len(y) else 0.5
            share = min(max(share, 1e-3), 1 - 1e-3)
            return cls(np.zeros(1 << BITS), 0.0, 0.0, float(np.log(share / (1 - share))))
        order = np.random.default_rng(seed).permutation(len(y))
        cut = max(2, len(y) * 4 // 5)
        train, rest = order[:cut], order[cut:]
        if len(set(y[train].tolist())) < 2:
            train = order
        if len(set(y[rest].tolist())) < 2:
            rest = order
        seen = [rows[i] for i in train]
        scale = log_count_ratios(seen, y[train])
        w, bias = dual_coordinate_descent(seen, scale, y[train], seed=seed)
        model = cls(w * scale, bias, 1.0, 0.0)
        margin = np.array([model.margin(rows[i]) for i in rest])
        slope, offset = fit_logistic(margin[:, None], y[rest].astype(float), ridge=0.05)
        return cls(w * scale, bias, float(max(slope, 0.0)), float(offset))

    def margin(self, columns: np.ndarray) -> float:
        return float(self.weights[columns].sum()) + self.bias

    def score(self, text: str | None) -> float:
        return float(sigmoid(np.float64(self.slope * self.margin(indicators(text)) + self.offset)))


def fit_quality(docs: DataFrame, labels: DataFrame, label_col: str = "quality", sample_rows: int = 12_000) -> QualityModel:
    """Fits on the bounded sample; indicators are made on the executors and arrive as packed bytes.

    These stay one Arrow column, of which the rows are views: so the driver holds them once and gives them back whole.
    """

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "x": [indicators(t).tobytes() for t in batch["text"]], "y": batch["y"]})
        forget_tokens()

    sample = labelled_sample(docs, labels, label_col, sample_rows).mapInPandas(pack, "doc_id long, x binary, y int").toArrow()
    sample = sample.sort_by("doc_id")
    model = QualityModel.fit([np.frombuffer(x.as_buffer(), np.uint32) for x in sample["x"]], sample["y"].to_numpy().astype(int))
    del sample
    pa.default_memory_pool().release_unused()
    return model


def _scored(docs: DataFrame, model, schema: T.StructType, text_col: str) -> DataFrame:
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = pa.array([model.value.score(t.as_py()) for t in batch[text_col]], pa.float64())
            yield pa.RecordBatch.from_arrays([*(batch[n] for n in schema.names[:-1]), made], schema.names)
        forget_tokens()

    return docs.mapInArrow(score, schema)


def classify_quality(
    docs: DataFrame, labels: DataFrame, label_col: str = "quality", threshold: float = 0.3, sample_rows: int = 12_000
) -> DataFrame:
    """One row a document: doc_id, held_out, score, predicted."""
    model = docs.sparkSession.sparkContext.broadcast(fit_quality(docs, labels, label_col, sample_rows))
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("score", T.DoubleType())])
    scored = _scored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), model, schema, "text")
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def quality_filter(
    docs: DataFrame, labels: DataFrame, label_col: str = "quality", threshold: float = 0.3, sample_rows: int = 12_000
) -> DataFrame:
    """The documents with a score of ``threshold`` or more, columns as they were; no shuffle."""
    model = docs.sparkSession.sparkContext.broadcast(fit_quality(docs, labels, label_col, sample_rows))
    name = "score"
    while name in docs.columns:
        name = f"_{name}"
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])
    return _scored(docs, model, schema, "text").filter(F.col(name) >= threshold).drop(name)
