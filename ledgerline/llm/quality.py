"""Quality by nearest-neighbour voting among labelled latent-semantic vectors.

A document becomes hashed counts of its words and of their shapes (letters, digits and
signs, runs collapsed), weighted by log count and inverse document frequency, with one column more for words said twice in a row, and is
projected to the leading singular directions of the labelled sample. Every document is
compared with all labelled vectors by exact cosines, in blocks; its score is the mean
label of the nearest ones, weighted by a power of the similarity.

What is broadcast has a fixed bound: ``sample`` labelled rows times ``rank`` numbers and
one projection of ``DIMS`` times ``rank``. Fitting uses at most ``sample`` labelled rows,
the first in the order of a hash of their id.

Defined cases: NULL or empty texts score the mean label; NULL labels and labels of
unknown documents are not used; contradicting labels of one document are averaged; without
any label every score is 0.5. Repeated rows get the same score each. Input columns named
like output columns are replaced.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import without

DIMS = 2048
#: One column counts repeated words; so much more than one word it weighs.
REPEAT = 6.0
OUT = ("held_out", "score", "predicted")


def _shape(token: str) -> str:
    kinds = ["A" if c.isupper() else "a" if c.isalpha() else "9" if c.isdigit() else c for c in token]
    return "".join(c for i, c in enumerate(kinds) if i == 0 or c != kinds[i - 1])


class _Places(dict):
    """Token to its two hashed columns; forgets when full, so memory is bounded."""

    def __missing__(self, token: str) -> tuple[int, int]:
        if len(self) > 400_000:
            self.clear()
        half = DIMS // 2
        word = zlib.crc32(token.lower().encode()) % half
        at = (word, half + zlib.crc32(b"shape " + _shape(token).encode()) % (half - 1))
        self[token] = at
        return at


_PLACES = _Places()


def counts_of(text: str | None) -> np.ndarray:
    """Hashed counts of words and shapes, as logarithms."""
    tokens = (text or "").split()
    found = Counter(tokens)
    if not found:
        return np.zeros(DIMS, np.float32)
    at = np.array([_PLACES[t] for t in found], np.int64)
    n = np.fromiter(found.values(), np.float64, len(found))
    both = np.bincount(at[:, 0], n, DIMS) + np.bincount(at[:, 1], n, DIMS)
    both[DIMS - 1] = sum(map(str.__eq__, tokens, tokens[1:]))  # words said twice in a row
    logs = np.log1p(both)
    logs[DIMS - 1] *= REPEAT
    return logs.astype(np.float32)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


class Model:
    """Projection, labelled vectors and labels."""

    def __init__(self, x: np.ndarray, labels: np.ndarray, rank: int = 64, nearest: int = 25, power: float = 8.0):
        self.labels, self.nearest, self.power = labels.astype(np.float64), nearest, power
        self.prior = float(labels.mean()) if len(labels) else 0.5
        if not len(labels):
            return
        self.idf = np.log((1 + len(x)) / (1 + (x > 0).sum(0))).astype(np.float32) + 1
        z = _unit(x * self.idf)
        start = np.random.default_rng(5).standard_normal((DIMS, min(rank + 16, len(x))))
        q = z @ start
        for _ in range(3):  # subspace iteration towards the leading right singular vectors
            q, _ = np.linalg.qr(z @ (z.T @ q))
        _, _, right = np.linalg.svd(q.T @ z, full_matrices=False)
        self.project = right[:rank].T.astype(np.float32)
        self.vectors = _unit(z @ self.project).astype(np.float32)

    def scores(self, x: np.ndarray) -> np.ndarray:
        if not len(self.labels):
            return np.full(len(x), 0.5)
        known = x.any(1)
        near = _unit(_unit(x * self.idf) @ self.project) @ self.vectors.T
        k = min(self.nearest, near.shape[1])
        least = np.partition(near, near.shape[1] - k, axis=1)[:, -k][:, None]
        weight = np.where(near >= least, np.maximum(near, 0), 0).astype(np.float64) ** self.power
        total = weight.sum(1)
        vote = np.where(total > 0, weight @ self.labels / np.maximum(total, 1e-300), self.prior)
        return np.clip(np.where(known, vote, self.prior), 0.0, 1.0)


def held_out(id_col: str = "doc_id") -> Column:
    """Rows never learned from: crc32 of the id as text is divisible by five."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def fit(
    docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", sample: int = 4000
) -> Model:
    """Fit on at most ``sample`` labelled documents that are not held out."""
    usable = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
    usable = usable.groupBy(F.col(id_col).alias("_id")).agg(F.avg(label_col).alias("_y"))
    chosen = usable.orderBy(F.xxhash64("_id"), "_id").limit(sample)
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    rows = texts.join(F.broadcast(chosen), "_id").groupBy("_id", "_y").agg(F.min("_text").alias("_text"))

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            x = [counts_of(t) for t in b["_text"]]
            yield pd.DataFrame({
                "_id": b["_id"].astype(str), "_y": b["_y"],
                "at": [np.flatnonzero(v).astype(np.uint16).tobytes() for v in x],
                "v": [v[v != 0].tobytes() for v in x],
            })

    got = rows.mapInPandas(features, "_id string, _y double, at binary, v binary").collect()
    got.sort(key=lambda r: r["_id"])
    x = np.zeros((len(got), DIMS), np.float32)
    for i, r in enumerate(got):
        x[i, np.frombuffer(r["at"], np.uint16)] = np.frombuffer(r["v"], np.float32)
    return Model(x, np.array([r["_y"] for r in got], np.float64))


def classify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", accept: float = 0.3) -> DataFrame:
    """All rows with ``held_out``, ``score`` and ``predicted`` (1 from ``accept`` on)."""
    flagged = without(docs, *OUT).withColumn("held_out", held_out(id_col))
    schema = T.StructType([*flagged.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                b = whole.slice(at, 256)
                texts = b.column(b.schema.get_field_index(text_col)).cast(pa.string()).to_pylist()
                score = model.scores(np.stack([counts_of(t) for t in texts]))
                cols = [*b.columns, pa.array(score), pa.array((score >= accept).astype(np.int32))]
                yield pa.RecordBatch.from_arrays(cols, names=[*b.schema.names, "score", "predicted"])

    return flagged.mapInArrow(vote, schema)


def keep_good(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", accept: float = 0.3) -> DataFrame:
    """The accepted rows, with the columns of the input."""
    names = [f"c{i}_{c}" for i, c in enumerate(docs.columns)]
    at = [names[docs.columns.index(c)] for c in (id_col, text_col)]
    return classify(docs.toDF(*names), model, *at, accept=accept).where("predicted = 1").select(*names).toDF(*docs.columns)
