"""Token matrices by best-fit-decreasing packing.

Documents are tokenised where they are read and cut losslessly into pieces of at most
``length`` ids. Full pieces are rows of their own; the others, longest first, go into
the row with the least room that still holds them, which a segment tree over the free
capacities finds in log(length) steps. A task packs what it has read each time
``window_tokens`` ids have come together, so nothing is shuffled and memory is bounded
by the window and one document.

Each row of the matrix has ``length`` little-endian unsigned 32 bit ids (filled up with the
closing id), the cumulative segment lengths, and positions that start again at 0 with every segment.

Defined cases: NULL or empty text is the closing id alone; repeated rows and rows without id
are packed like any other; an empty table gives an empty result. Only id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.tokens import END, VOCABULARY, token_ids


class Capacities:
    """How many open rows have each free capacity; finds the least capacity of at least ``need``."""

    def __init__(self, most: int):
        self.leaves = 1 << most.bit_length()
        self.tree = [0] * (2 * self.leaves)

    def add(self, capacity: int, by: int) -> None:
        at = capacity + self.leaves
        while at:
            self.tree[at] += by
            at >>= 1

    def least(self, need: int) -> int | None:
        at = need + self.leaves
        if self.tree[at]:
            return need
        while at > 1:
            if at % 2 == 0 and self.tree[at + 1]:
                at += 1
                while at < self.leaves:
                    at = 2 * at if self.tree[2 * at] else 2 * at + 1
                return at - self.leaves
            at >>= 1
        return None


def best_fit(lengths: list[int], length: int) -> list[list[int]]:
    """Rows, each a list of piece numbers."""
    free = Capacities(length)
    open_: dict[int, list[int]] = {}
    rows: list[list[int]] = []
    for piece in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        need = lengths[piece]
        room = free.least(need)
        if room is None:
            room, row = length, len(rows)
            rows.append([])
        else:
            row = open_[room].pop()
            free.add(room, -1)
        rows[row].append(piece)
        if room > need:
            open_.setdefault(room - need, []).append(row)
            free.add(room - need, 1)
    return rows


def packed_matrix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 1024, vocabulary: str = VOCABULARY, window_tokens: int = 4_000_000
) -> DataFrame:
    """``sequence_id``, ``ids``, ``n_tokens``, ``cu_seqlens``, ``positions`` and the ``segments`` (id, start, length) of each row."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    segment = T.StructType([T.StructField(id_col, rows.schema["id"].dataType), T.StructField("start", T.LongType()), T.StructField("length", T.LongType())])
    schema = T.StructType([
        T.StructField("sequence_id", T.LongType()), T.StructField("ids", T.BinaryType()), T.StructField("n_tokens", T.LongType()),
        T.StructField("cu_seqlens", T.ArrayType(T.IntegerType())), T.StructField("positions", T.BinaryType()), T.StructField("segments", T.ArrayType(segment)),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        cache, area = token_ids(vocabulary), TaskContext.get().partitionId() << 32
        done = held = 0
        pieces: list[tuple] = []

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal done, held, pieces
            out: list[dict] = []
            for row in best_fit([len(p[2]) for p in pieces], length):
                own = [pieces[i] for i in row]
                ids = np.concatenate([p[2] for p in own])
                sizes = [len(p[2]) for p in own]
                full = np.full(length, END, "<u4")
                full[: len(ids)] = ids
                positions = np.concatenate([np.arange(n, dtype="<u4") for n in [*sizes, length - len(ids)]])
                out.append({
                    "sequence_id": area + done, "ids": full.tobytes(), "n_tokens": len(ids), "cu_seqlens": [0, *np.cumsum(sizes).tolist()],
                    "positions": positions.tobytes(), "segments": [{id_col: p[0], "start": p[1], "length": len(p[2])} for p in own],
                })
                done += 1
                if len(out) == 256:
                    yield pa.RecordBatch.from_pylist(out, schema=arrow)
                    out = []
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=arrow)
            held, pieces = 0, []

        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ids = np.frombuffer(cache.document(text), np.uint16)
                pieces += [(doc, at, ids[at : at + length]) for at in range(0, len(ids), length)]
                held += len(ids)
                if held >= window_tokens:
                    yield from flush()
        yield from flush()

    return rows.mapInArrow(run, schema)


def write_matrix(matrix: DataFrame, path: str) -> None:
    """Parquet files of matrix rows: ids, cumulative segment lengths and positions as fixed binary, with where they come from."""
    matrix.write.mode("errorifexists").option("compression", "zstd").parquet(path)


def matrix_digests(matrix: DataFrame) -> DataFrame:
    return matrix.select(
        "sequence_id", "n_tokens", "cu_seqlens", F.crc32("ids").alias("ids_crc32"), F.crc32("positions").alias("positions_crc32"), "segments"
    )
