"""Remove byte strings of ``LENGTH`` that also start in a document with a smaller id, by prefix doubling.

Suffixes are ranked by growing prefixes, and a suffix leaves as soon as its rank is unique.

* Round 1 ranks prefixes of ``FIRST`` bytes. Not every position need be ranked: each string of
  ``LENGTH`` bytes has a smallest prefix hash inside it, at the same place in every copy, so
  the positions of these minima (one in about fifteen) stand for all. Spark deals the (rank, id)
  pairs by rank and sorts them; ranks found in one document only leave.
* Round 2 pairs the ranks of a string's two halves, at an offset of half its length, for every string around a
  remaining position, which reaches the threshold. Pairs are sorted by rank and id within
  the partition of their first rank; every string whose first owner has a smaller id is covered. Ranks are
  hashes, so all strings of one rank are compared byte by byte before any counts as covered;
  where two strings share a rank, the bytes themselves are ranked.

Copies of a whole text are found by a digest before, and only the one with the smallest
id is ranked: all bytes of the others are covered. The work of one rank is then bounded by the
documents with different texts that share it; copies do not add to it.

Defined cases: NULL text is empty; texts under ``LENGTH`` bytes lose nothing; a row without id
neither loses nor covers anything. An id names one text: repeated rows get the same result
each. Only id and text are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import plain_text, small_or_plain, text_bytes, width

LENGTH, FIRST = 50, 20
REACH = LENGTH - FIRST
_BASE = 0x9E3779B97F4A7C15
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse, modulo 2**64."""
    if len(_POWERS.get("up", ())) < n:
        size = max(1 << 17, 1 << (n - 1).bit_length())
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            p = np.full(size, np.uint64(base))
            p[0] = 1
            _POWERS[name] = np.cumprod(p, dtype=np.uint64)
    return _POWERS["up"], _POWERS["down"]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * _M1
    x = (x ^ (x >> np.uint64(32))) * _M2
    return x ^ (x >> np.uint64(29))


def _sums(data: np.ndarray) -> np.ndarray:
    """Running sums from which the hash of any slice follows; works along the last axis."""
    _, down = _powers(data.shape[-1] + 1)
    out = np.zeros((*data.shape[:-1], data.shape[-1] + 1), np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * down[: data.shape[-1]], axis=-1, out=out[..., 1:])
    return out


def _slide(x: np.ndarray, span: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over every ``span`` neighbours."""
    done = 1
    while done * 2 <= span:
        x = pick(x[:-done], x[done:])
        done *= 2
    rest = span - done
    return pick(x[: len(x) - rest], x[rest:]) if rest else x


def anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions that stand for the strings around them, and the ranks (hashes) of their prefixes."""
    if len(data) < LENGTH:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    up, _ = _powers(len(data) + 1)
    s = _sums(data)
    h = _mixed((s[FIRST:] - s[:-FIRST]) * up[: len(data) - FIRST + 1])
    low = _slide(h, REACH + 1, np.minimum)
    edge = np.zeros(REACH, np.uint64)
    best = _slide(np.concatenate([edge, low, edge]), REACH + 1, np.maximum)
    at = np.flatnonzero(best == h)
    return at, h[at]


def _bytes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode(), np.uint8)


def _ranks(hashes: np.ndarray) -> np.ndarray:
    """Ranks of the first round: 48 bits, which travel in fewer bytes than 64. Two prefixes that share one by
    chance, some per million million pairs, go on to the second round, which tells them apart."""
    return (hashes >> np.uint64(16)).view(np.int64)


def _first_ranks(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for from_ in range(0, whole.num_rows, 64):
                b = whole.slice(from_, 64)
                ranks = [np.unique(_ranks(anchors(_bytes(t))[1])) for t in b.column(1).to_pylist()]
                ids = np.repeat(b.column(0).to_numpy(zero_copy_only=False), [len(r) for r in ranks])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(ranks)), pa.array(ids, b.column(0).type)], names=["rank", "id"])

    return docs.mapInArrow(run, T.StructType([T.StructField("rank", T.LongType()), docs.schema["id"]]))


_CONTEXT = T.StructType([T.StructField("rank", T.LongType()), T.StructField("id", T.LongType()), T.StructField("left", T.ByteType()),
                         T.StructField("right", T.ByteType()), T.StructField("around", T.BinaryType()), T.StructField("at", T.BinaryType())])


def _contexts(rows: DataFrame) -> DataFrame:
    """The bytes around every position whose rank is shared (rows: id, text, ranks), once for all the
    positions of a document that look alike, so a line said a thousand times is one row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for from_ in range(0, whole.num_rows, 64):
                b = whole.slice(from_, 64)
                parts, where = [], []
                for doc, text, ranks in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                    data = _bytes(text)
                    at, h = anchors(data)
                    h = _ranks(h)
                    mine = np.isin(h, ranks.values.to_numpy())
                    at, h = at[mine], h[mine]
                    if not len(at):
                        continue
                    around = np.lib.stride_tricks.sliding_window_view(np.pad(data, REACH), LENGTH + REACH)[at]
                    room = np.minimum(REACH, np.stack([at, len(data) - FIRST - at], 1)).astype(np.uint8)
                    wide = np.ascontiguousarray(np.concatenate([around, room], 1))
                    _, one, which, n = np.unique(wide.view(f"V{wide.shape[1]}").ravel(), return_index=True, return_inverse=True, return_counts=True)
                    alike = np.split(at[np.argsort(which, kind="stable")].astype("<u4"), np.cumsum(n)[:-1])
                    where += [x.tobytes() for x in alike]
                    parts.append((h[one], np.full(len(one), doc, np.int64), room[one, 0].view(np.int8), room[one, 1].view(np.int8), around[one]))
                if not parts:
                    continue
                cols = [np.concatenate(x) for x in zip(*parts)]
                wide = np.ascontiguousarray(cols.pop())
                fixed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(LENGTH + REACH), len(wide), [None, pa.py_buffer(wide)])
                yield pa.RecordBatch.from_arrays([*map(pa.array, cols), fixed.cast(pa.binary()), pa.array(where, pa.binary())], names=_CONTEXT.names)

    return rows.mapInArrow(run, _CONTEXT)


def _alike(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows with equal keys side by side, where each such group starts, and the number of each row's group."""
    order = np.argsort(key)
    new = np.ones(len(key), bool)
    new[1:] = key[order[1:]] != key[order[:-1]]
    return order, np.flatnonzero(new), np.cumsum(new) - 1


def covered_offsets(ids: np.ndarray, left: np.ndarray, right: np.ndarray, around: np.ndarray) -> np.ndarray:
    """For each position and each offset o: is the string that starts o bytes before it covered?"""
    up, _ = _powers(around.shape[1] + 1)
    s = np.ascontiguousarray(_sums(around).T)
    words = np.ascontiguousarray(around).view(np.uint64)
    half = LENGTH // 2
    out = np.zeros((len(ids), REACH + 1), bool)
    for o in range(REACH + 1):
        valid = np.flatnonzero((left >= o) & (right >= REACH - o))
        if not len(valid):
            continue
        a = REACH - o
        pair = [_mixed((s[x + half] - s[x])[valid] * up[x]) for x in (a, a + half)]
        order, start, group = _alike(_mixed(pair[0] * np.uint64(_BASE) + pair[1]))
        inside = np.zeros(around.shape[1], np.uint8)
        inside[a : a + LENGTH] = 255
        rows = valid[order]
        other = np.delete(np.arange(len(rows)), start)
        if ((words[rows[other]] ^ words[rows[start[group[other]]]]) & inside.view(np.uint64)).any():
            strings = np.ascontiguousarray(around[valid, a : a + LENGTH]).view(f"V{LENGTH}").ravel()
            order, start, group = _alike(np.unique(strings, return_inverse=True)[1])
            rows = valid[order]
        owner = ids[rows]
        out[rows[owner > np.minimum.reduceat(owner, start)[group]], o] = True
    return out


_SPANS = T.StructType([T.StructField("id", T.LongType()), T.StructField("from", T.LongType()), T.StructField("to", T.LongType())])


def _covered(contexts: DataFrame, tasks: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        whole = pa.Table.from_batches(got)
        ids = whole["id"].to_numpy()
        around = np.frombuffer(b"".join(whole["around"].to_pylist()), np.uint8).reshape(len(ids), -1)
        hit = covered_offsets(ids, whole["left"].to_numpy(), whole["right"].to_numpy(), around)
        edge = np.diff(np.pad(hit.astype(np.int8), ((0, 0), (1, 1))), axis=1)
        row, low = np.nonzero(edge == 1)
        _, high = np.nonzero(edge == -1)
        at = [np.frombuffer(x, "<u4").astype(np.int64) for x in whole["at"].to_pylist()]
        n = np.array([len(at[r]) for r in row], np.int64)
        pos = np.concatenate([at[r] for r in row]) if len(row) else np.zeros(0, np.int64)
        row, low, high = (np.repeat(x, n) for x in (row, low, high))
        for cut in range(0, len(pos), 100_000):
            part = slice(cut, cut + 100_000)
            cols = ids[row[part]], pos[part] - high[part] + 1, pos[part] - low[part] + LENGTH
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=_SPANS.names)

    return contexts.repartition(tasks, "rank").mapInArrow(run, _SPANS)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", task_bytes: int = 8_000_000) -> DataFrame:
    """One row per input row: id, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept``, the bytes that stay."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), plain_text(text_col).alias("text"))
    tasks = width(text_bytes(docs, text_col), task_bytes)
    digests = rows.where("id IS NOT NULL").select("id", F.sha2("text", 256).alias("digest"))
    first = digests.groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    copies = digests.join(first, "digest").where("id > first").select("id").distinct()
    copies = small_or_plain(copies, "repeat-copies")

    # Dealt by id once: the same exchange serves the search for contexts and the cutting.
    named = rows.where("id IS NOT NULL").repartition(tasks, "id")
    ranked = rows.where("id IS NOT NULL").join(copies, "id", "left_anti")
    same = W.partitionBy("rank")
    pairs = _first_ranks(ranked).repartition(tasks, "rank")
    pairs = pairs.select("rank", "id", F.min("id").over(same).alias("lo"), F.max("id").over(same).alias("hi")).where("lo < hi")
    shared = pairs.groupBy("id").agg(F.collect_list("rank").alias("ranks"))
    spans = _covered(_contexts(named.join(shared, "id").select("id", "text", "ranks")), tasks)
    per_doc = spans.groupBy("id").agg(F.collect_list(F.struct("from", "to")).alias("spans"))
    marked = named.join(per_doc, "id", "left").join(copies.withColumn("copy", F.lit(True)), "id", "left").select("id", "text", "spans", "copy")
    unnamed = rows.where("id IS NULL").select("id", "text", F.lit(None).cast(per_doc.schema["spans"].dataType).alias("spans"), F.lit(None).cast("boolean").alias("copy"))
    marked = marked.union(unnamed)
    schema = T.StructType([T.StructField(id_col, T.LongType()), T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()),
                           T.StructField("n_spans", T.LongType()), T.StructField("kept", T.BinaryType())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for from_ in range(0, whole.num_rows, 64):
                b = whole.slice(from_, 64)
                out: list[list] = [[], [], [], []]
                for text, spans_, copy in zip(*(b.column(k).to_pylist() for k in (1, 2, 3))):
                    data = _bytes(text)
                    gone = np.zeros(len(data) + 1, np.int64)
                    if copy and len(data) >= LENGTH:
                        gone[0], gone[-1] = 1, -1
                    for x in spans_ or ():
                        gone[x["from"]] += 1
                        gone[x["to"]] -= 1
                    off = np.cumsum(gone)[:-1] > 0
                    for at, value in enumerate((len(data), int(off.sum()), int((np.diff(np.r_[0, off.astype(np.int8)]) == 1).sum()), data[~off].tobytes())):
                        out[at].append(value)
                yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(x, t) for x, t in zip(out, [pa.int64()] * 3 + [pa.binary()]))], names=schema.names)

    return marked.mapInArrow(cut, schema)
