"""Pack documents along a Hilbert curve through a space of hashed document vectors.

Token counts are projected to ``AXES`` signed sums with hashed signs, scaled by their length, and
the point's place on a Hilbert curve is the sort key, so that similar documents come
to lie next to each other. Spark sorts by range of (key, id): copies of one text, which
share a key, are spread by their id. Each range is cut into sequences of ``length`` ids without a gap; only
the last sequence of a range is shorter, and the number of ranges follows from the
bytes of text. Documents are cut wherever a sequence ends; every id lies in one piece.

Tokenised documents are written once to the shared folder, because sorting by range
reads its input twice.

Defined cases: NULL or empty text is the closing id alone; NULL ids sort first; repeated
rows are packed each; an empty table gives an empty result. Only id and text are read,
so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import stored, text_bytes, width
from ledgerline.llm.tokens import VOCABULARY, token_ids

AXES, BITS = 4, 12


def hilbert_index(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place of integer points (rows) on the Hilbert curve through the cube of side 2**bits.

    Undoes the rotations of each level from the coarsest bit down, then reads the
    Gray code of the transposed coordinates.
    """
    x = points.astype(np.int64).T.copy()
    n = len(x)
    top = 1 << (bits - 1)
    q = top
    while q > 1:
        low = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(high, low, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    q = top
    while q > 1:
        turn ^= np.where((x[n - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= turn
    key = np.zeros_like(turn)
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def _signs() -> np.ndarray:
    return np.random.default_rng(11).choice([-1.0, 1.0], (1 << 16, AXES)).astype(np.float32)


def curve_points(ids: np.ndarray, signs: np.ndarray) -> np.ndarray:
    """Grid point of one document: signed sums of log counts over their length."""
    which, n = np.unique(ids, return_counts=True)
    w = np.log1p(n).astype(np.float32)
    z = w @ signs[which] / max(float(np.sqrt((w * w).sum())), 1e-9)
    return ((1 / (1 + np.exp(-z))) * ((1 << BITS) - 1)).astype(np.int64)


PIECES = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
    T.StructField("doc_tokens", T.LongType()), T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType()),
    T.StructField("ids", T.BinaryType()),
])


def tokenised(docs: DataFrame, id_col: str, text_col: str, vocabulary: str, with_key: bool = True) -> DataFrame:
    """``id``, ``key`` on the curve, ``n`` tokens and ``ids`` (unsigned 16 bit) of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, signs = token_ids(vocabulary), _signs() if with_key else None
        for whole in batches:
            for at in range(0, whole.num_rows, 64):
                b = whole.slice(at, 64)
                blobs = [cache.document(t) for t in b.column(1).to_pylist()]
                key = np.zeros(len(blobs), np.int64)
                if with_key:
                    key = hilbert_index(np.stack([curve_points(np.frombuffer(x, np.uint16), signs) for x in blobs]))
                n = np.array([len(x) // 2 for x in blobs], np.int64)
                cols = [b.column(0), pa.array(key), pa.array(n), pa.array(blobs, pa.binary())]
                yield pa.RecordBatch.from_arrays(cols, names=["id", "key", "n", "ids"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    fields = [rows.schema["id"], T.StructField("key", T.LongType()), T.StructField("n", T.LongType()), T.StructField("ids", T.BinaryType())]
    return rows.mapInArrow(run, T.StructType(fields))


def pack_along_curve(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 1024, vocabulary: str = VOCABULARY, range_bytes: int = 12_000_000
) -> DataFrame:
    """One row per piece: ``doc_id``, ``start``, ``length``, ``doc_tokens``, ``sequence_id``, ``offset`` and ``ids``.

    ``ids`` are unsigned 32 bit little-endian numbers. A sequence lies in one range, so
    ``sequence_id`` is the range's number times 2**32 plus the number inside it.
    """
    ranges = width(text_bytes(docs, text_col), range_bytes)
    rows = stored(tokenised(docs, id_col, text_col, vocabulary), "curve-tokens")
    ordered = rows.repartitionByRange(ranges, "key", "id").sortWithinPartitions("key", "id")
    ordered = ordered.select(F.spark_partition_id().cast("long").alias("range"), "id", "n", "ids")
    schema = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType), *PIECES.fields[1:]])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filled = sequence = 0
        for whole in batches:
            for at in range(0, whole.num_rows, 64):
                b = whole.slice(at, 64)
                out: dict[str, list] = {f.name: [] for f in schema.fields}
                for area, doc, n, blob in zip(*(b.column(i).to_pylist() for i in range(4))):
                    ids, start = np.frombuffer(blob, np.uint16).astype("<u4"), 0
                    while start < n:
                        take = min(n - start, length - filled)
                        row = (doc, start, take, n, (area << 32) + sequence, filled, ids[start : start + take].tobytes())
                        for name, value in zip(out, row):
                            out[name].append(value)
                        start, filled = start + take, filled + take
                        if filled == length:
                            filled, sequence = 0, sequence + 1
                yield pa.RecordBatch.from_pydict(out, schema=_arrow(schema))

    return ordered.mapInArrow(cut, schema)


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def piece_digests(pieces: DataFrame) -> DataFrame:
    """The pieces with ``ids_crc32`` in place of the ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
