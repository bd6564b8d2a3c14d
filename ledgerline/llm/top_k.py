"""Exact top-k search with BM25: inverted indexes per shard, block-max WAND, exact merge.

Terms are runs of characters other than ASCII white space, control characters and punctuation, with A-Z
lowered, kept as 64 bit hashes. Document frequencies, the number of rows and the mean length are counted
over all rows, so every shard scores with the same statistics and shard results can be merged as they are.

The counted terms of all rows are stored once. A task reads its part of them and builds one shard after the other,
of ``shard_postings`` each, so its memory does not follow the size of the part. Queries come as broadcast chunks
of ``chunk_bytes``; each chunk costs one more pass over the stored terms.

A query's threshold is the score of the k-th best row met so far and only rises: from blocks to blocks, from shard to
shard and from level to level. Levels are parts of the rows, the next eight times the last; the threshold that one level has
reached goes to all tasks of the next, so the rows between the tasks and the merge follow the queries, not the queries
times the tasks. All but the last and largest level are read by one task for each shard.

The lists of a shard's frequent terms lie behind the pivot: they are also a table of impacts by document, with the largest
impact of each block of documents. The lists before the pivot are added up for a batch of queries at once. Where these sums and
the most that the terms behind the pivot can add stay below the threshold, the block is left out; for the other
blocks, those with the highest bounds first, the rest is one matrix product. What is skipped cannot be in the result, so it is exact.

Defined cases: NULL or empty texts have no terms and are never found, nor do they find anything; equal
scores (to six digits) are ordered by id; rows without id are searched and come first among equals, but do not query;
repeated rows are found one by one, and rows that share an id query together, with the terms of all; very long
texts are read whole, and a shard has at least one of them; an empty table gives an empty result. Only id and text are read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerline.llm.common import stored, width

K1, B = 1.2, 0.75
BLOCK_DOCS = 32
GROUP_BLOCKS = 8
FREQUENT = 16
MOST_FREQUENT = 1024
BATCH_CELLS = 600_000
BATCH_POSTINGS = 500_000
SLICE_ROWS = 256
LEVEL = 8
NO_ID = -(2**63)
_SPLIT = bytes.maketrans(
    bytes(range(33)) + b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~\x7f" + b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b" " * (33 + 33) + b"abcdefghijklmnopqrstuvwxyz"
)


class _Hashes(dict):
    def __missing__(self, term: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        self[term] = h = xxhash.xxh64_intdigest(term) - 2**63
        return h


_HASH = _Hashes()


def terms(text: str | None) -> Counter:
    return Counter((text or "").encode().translate(_SPLIT).split())


def indexed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id``, ``length`` in terms, and the different ``terms`` (hashes) with their ``counts``."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for from_ in range(0, whole.num_rows, SLICE_ROWS):  # counted words take many times the room of their text
                b = whole.slice(from_, SLICE_ROWS)
                found = [terms(t) for t in b.column(1).to_pylist()]
                hashes = [[_HASH[t] for t in c] for c in found]
                cols = [pa.array([sum(c.values()) for c in found], pa.int64()), pa.array(hashes, pa.list_(pa.int64())), pa.array([list(c.values()) for c in found], pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays([b.column(0), *cols], names=["id", "length", "terms", "counts"])

    return rows.mapInArrow(run, "id long, length long, terms array<long>, counts array<int>")


class Shard:
    """Postings of some documents; for the terms of many of them a table of impacts, with the largest of each block of documents."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray, sizes: np.ndarray, term: np.ndarray, tf: np.ndarray, mean: float):
        order = np.argsort(lengths, kind="stable")  # documents of like length have like impacts
        rows, to = len(ids), np.cumsum(sizes)
        self.ids = ids[order]
        at = _numbers((to - sizes)[order], to[order])
        term, tf, doc = term[at], tf[at], np.repeat(np.arange(rows, dtype=np.int32), sizes[order])
        del at
        by = np.argsort(term, kind="stable")
        term, self.doc, self.impact = term[by], doc[by], tf[by].astype(np.float64)
        del doc, tf, by
        norm = (K1 * (1 - B + B * lengths[order] / mean))[self.doc]
        norm += self.impact
        self.impact *= K1 + 1
        self.impact /= norm
        del norm
        self.start = np.append(0, np.flatnonzero(term[1:] != term[:-1]) + 1)
        self.end = np.append(self.start[1:], len(term))
        self.terms, self.term_max = term[self.start], np.maximum.reduceat(self.impact, self.start)
        df = self.end - self.start
        often = np.flatnonzero(df * FREQUENT >= rows)
        often = often[np.argsort(-df[often], kind="stable")][: min(MOST_FREQUENT, 2 * len(term) // rows)]
        self.row = np.full(len(self.terms), -1, np.int32)
        self.row[often] = np.arange(len(often))
        self.table = np.zeros((len(often), rows))
        post, row = _ranges(self.start[often], self.end[often], np.arange(len(often)))
        self.table[row, self.doc[post]] = self.impact[post]
        self.first = np.arange(0, rows, BLOCK_DOCS)
        self.table_max = np.maximum.reduceat(self.table, self.first, axis=1)

    def places(self, term: np.ndarray) -> np.ndarray:
        """Where terms stand among this shard's, -1 for those that it has not."""
        at = np.minimum(np.searchsorted(self.terms, term), len(self.terms) - 1)
        return np.where(self.terms[at] == term, at, -1).astype(np.int32)

    def improve(self, best: tuple[np.ndarray, np.ndarray], query: np.ndarray, weight: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The best ``k`` ids and scores among ``best`` and this shard's documents."""
        found = Best(1, k)
        found.add(np.zeros(len(best[0]), np.int64), *best)
        self.improve_all(found, np.array([0, len(query)]), self.places(query), weight)
        return found.rows(0, 1)[1:]

    def improve_all(self, best: Best, start: np.ndarray, place: np.ndarray, weight: np.ndarray) -> None:
        """``improve`` for many queries: query q has the terms from ``start[q]`` to ``start[q + 1]``."""
        step = max(1, BATCH_CELLS // max(len(self.ids), len(self.table)))
        for from_ in range(0, len(best.ids), step):
            to = min(from_ + step, len(best.ids))
            here = slice(start[from_], start[to])
            self._improved(best, from_, to, np.repeat(np.arange(to - from_), np.diff(start[from_ : to + 1])), place[here], weight[here])

    def _improved(self, best: Best, from_: int, to: int, query: np.ndarray, at: np.ndarray, weight: np.ndarray) -> None:
        n, (width, docs) = to - from_, self.table.shape
        query, at, weight = (x[at >= 0] for x in (query, at, weight))
        least = best.least(from_, to)
        able = np.bincount(query, self.term_max[at] * weight, n) >= least
        row = self.row[at]
        behind, ahead = row >= 0, (row < 0) & able[query]
        rest = np.bincount(query[behind] * width + row[behind], weight[behind], n * width).reshape(n, width)
        score = self._ahead(query[ahead], at[ahead], weight[ahead], n)
        bound = np.maximum.reduceat(score, self.first, axis=1) + rest @ self.table_max
        bound = np.maximum.reduceat(bound, np.arange(0, len(self.first), GROUP_BLOCKS), axis=1)
        bound[~able] = 0
        order = np.argsort(-bound.sum(0))
        done, groups = 0, 1
        while done < len(order):
            for g in order[done : done + groups].tolist():
                open_ = np.flatnonzero((bound[:, g] >= least) & (bound[:, g] > 0))
                if len(open_):
                    mine = slice(g * GROUP_BLOCKS * BLOCK_DOCS, (g + 1) * GROUP_BLOCKS * BLOCK_DOCS)
                    whole = score[open_, mine] + rest[open_] @ self.table[:, mine]
                    q, doc = np.nonzero((whole >= least[open_, None]) & (whole > 0))
                    best.add(from_ + open_[q], self.ids[mine][doc], np.round(whole[q, doc], 6))
            least = best.least(from_, to)
            done, groups = done + groups, groups * 4

    def _ahead(self, query: np.ndarray, at: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
        """What the terms before the pivot add to each document, a row for each query."""
        docs, lists = len(self.ids), self.end[at] - self.start[at]
        score = np.zeros((n, docs))
        before = np.cumsum(np.bincount(query, lists, n)) - np.bincount(query, lists, n)
        part = before // BATCH_POSTINGS
        for a in np.flatnonzero(np.diff(part, prepend=-1)).tolist():
            b = int(np.searchsorted(part, part[a], "right"))
            mine = slice(*np.searchsorted(query, (a, b)))
            post, w = _ranges(self.start[at[mine]], self.end[at[mine]], weight[mine])
            cell = np.repeat((query[mine] - a) * docs, lists[mine])
            cell += self.doc[post]
            w *= self.impact[post]
            score[a:b] = np.bincount(cell, w, (b - a) * docs).reshape(b - a, docs)
        return score


class Best:
    """The best ``k`` ids and scores of each query so far, in order. ``floor``: scores that ``k`` other documents are known to reach."""

    def __init__(self, queries: int, k: int, floor: np.ndarray | None = None):
        self.ids, self.scores, self.k = np.zeros((queries, k), np.int64), np.full((queries, k), -np.inf), k
        self.floor = np.zeros(queries) if floor is None else floor

    def add(self, query: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        if not len(query):
            return
        known = np.unique(query)
        held = self.scores[known] > -np.inf
        query = np.append(np.repeat(known, held.sum(1)), query)
        ids, scores = np.append(self.ids[known][held], ids), np.append(self.scores[known][held], scores)
        order = np.lexsort((ids, -scores, query))
        query = query[order]
        rank = np.arange(len(query)) - np.searchsorted(query, query)
        order, query, rank = order[rank < self.k], query[rank < self.k], rank[rank < self.k]
        self.ids[query, rank], self.scores[query, rank] = ids[order], scores[order]

    def least(self, from_: int, to: int) -> np.ndarray:
        """What a sum must reach to matter: the k-th best score less what rounding can hide."""
        return np.maximum(np.maximum(self.scores[from_:to, -1], self.floor[from_:to]) - 1e-6, 0.0)

    def rows(self, from_: int, to: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query numbers, ids and scores of some queries."""
        held = self.scores[from_:to] > -np.inf
        return from_ + np.nonzero(held)[0], self.ids[from_:to][held], self.scores[from_:to][held]


def _numbers(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """All numbers of several ranges."""
    n = end - start
    out = np.repeat(start - np.r_[0, np.cumsum(n)[:-1]], n)
    out += np.arange(len(out))
    return out


def _ranges(start: np.ndarray, end: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of several ranges, each with its range's weight."""
    return _numbers(start, end), np.repeat(weight, end - start)


def _shards(batches: Iterator[pa.RecordBatch], postings: int, mean: float) -> Iterator[Shard]:
    held: list[list[np.ndarray]] = []
    n = 0
    for whole in batches:
        for from_ in range(0, whole.num_rows, SLICE_ROWS):
            b = whole.slice(from_, SLICE_ROWS)
            term, count = b.column(2), b.column(3)
            held.append([b.column(0).fill_null(NO_ID).to_numpy(), b.column(1).to_numpy(), term.value_lengths().to_numpy(), term.flatten().to_numpy(), count.flatten().to_numpy()])
            n += len(held[-1][3])
            if n >= postings:
                yield _shard(held, mean)
                n = 0
    if n:
        yield _shard(held, mean)


def _shard(held: list[list[np.ndarray]], mean: float) -> Shard:
    """Takes the rows out of ``held``."""
    whole = [np.concatenate(x) for x in zip(*held)]
    held.clear()
    return Shard(*whole, mean)


def _found(index: DataFrame, shared: Broadcast, floor: Broadcast, k: int, postings: int, mean: float) -> DataFrame:
    """Per task: the best ``k`` rows for each query of the chunk, as far as they reach its floor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, start, known, which, weight = shared.value
        best = Best(len(ids), k, floor.value)
        for shard in _shards(batches, postings, mean):
            shard.improve_all(best, start, shard.places(known)[which], weight)
            del shard  # before the next is built
        for from_ in range(0, len(ids), 10_000):
            query, docs, score = best.rows(from_, from_ + 10_000)
            yield pa.RecordBatch.from_arrays([pa.array(ids[query]), pa.array(docs, mask=docs == NO_ID), pa.array(score)], names=["query_id", "doc_id", "score"])

    return index.mapInArrow(run, "query_id long, doc_id long, score double")


def _levels(index: DataFrame, postings: int, shard_postings: int) -> list[DataFrame]:
    """The rows of the index in parts that grow ``LEVEL`` times, the first of at most ``LEVEL`` shards or so. All but the last are read by a task for each shard, without a shuffle."""
    steps, share = 0, 1.0
    while postings * share > LEVEL * shard_postings:
        steps, share = steps + 1, share / LEVEL
    place = F.pmod(F.xxhash64("id", "length"), F.lit(LEVEL**steps))
    inside = [F.pmod(place, F.lit(LEVEL ** (steps - i))) == 0 for i in range(steps + 1)]
    parts = [index.where(inside[i] & ~inside[i - 1] if i else inside[0]) for i in range(steps + 1)]
    return [part.coalesce(width(postings * share * LEVEL**i, shard_postings)) for i, part in enumerate(parts[:-1])] + parts[-1:]


def _ranked(found: DataFrame) -> DataFrame:
    return found.withColumn("rank", F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))))


def search(
    docs: DataFrame, is_query: Column, k: int = 10, id_col: str = "doc_id", text_col: str = "text", shard_postings: int = 2_000_000, chunk_bytes: int = 32_000_000
) -> DataFrame:
    """``query_id``, ``rank`` from 1, ``doc_id`` and ``score`` of the best ``k`` rows for every row that ``is_query`` picks."""
    spark = docs.sparkSession
    index = stored(indexed(docs, id_col, text_col), "search-index")
    stats = index.agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("sum"), F.sum(F.size("terms")).alias("postings")).first()
    rows, mean = int(stats["n"]), max(1.0, float(stats["sum"] or 0) / max(1, int(stats["n"])))
    frequency = index.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    wanted = index.join(docs.where(is_query).select(F.col(id_col).cast("long").alias("id")).distinct(), "id", "left_semi")
    asked = wanted.select("id", F.explode(F.arrays_zip("terms", "counts")).alias("t")).select("id", F.col("t.terms").alias("term"), F.col("t.counts").alias("qtf"))
    idf = F.log(1 + (rows - F.col("df") + 0.5) / (F.col("df") + 0.5))
    queries = asked.join(frequency, "term").groupBy("id").agg(F.sort_array(F.collect_list(F.struct("term", (idf * F.col("qtf")).alias("w")))).alias("q"))
    queries = stored(queries.select("id", F.col("q.term").alias("term"), F.col("q.w").alias("w")), "search-queries")
    total = queries.agg(F.sum(F.size("term") * 16 + 16).alias("n")).first()["n"] or 0
    chunks, parts, levels = width(total, chunk_bytes), [], _levels(index, int(stats["postings"] or 0), shard_postings)
    for c in range(chunks):
        # Collected: the queries of one chunk, about chunk_bytes of them.
        got = queries.where(F.pmod(F.xxhash64("id"), F.lit(chunks)) == c).toArrow().combine_chunks()
        if got.num_rows:
            ids, term, w = (got.column(i).chunk(0) for i in range(3))
            start = np.append(0, np.cumsum(term.value_lengths().to_numpy()))
            known, which = np.unique(term.flatten().to_numpy(), return_inverse=True)
            shared = spark.sparkContext.broadcast((ids.to_numpy(), start, known, which.astype(np.int32), w.flatten().to_numpy()))
            numbers, floor, met = ids.to_numpy(), np.zeros(len(ids)), []
            order = np.argsort(numbers)
            for part in levels[:-1]:
                met.append(stored(_found(part, shared, spark.sparkContext.broadcast(floor), k, shard_postings, mean), "search-found"))
                # Collected: one score for each query of the chunk.
                last = _ranked(reduce(DataFrame.unionByName, met)).where(F.col("rank") == k).select("query_id", "score").toArrow()
                floor = np.zeros(len(ids))
                floor[order[np.searchsorted(numbers, last.column(0).to_numpy(), sorter=order)]] = last.column(1).to_numpy()
            parts += [*met, _found(levels[-1], shared, spark.sparkContext.broadcast(floor), k, shard_postings, mean)]
    if not parts:
        return spark.createDataFrame([], "query_id long, rank long, doc_id long, score double")
    best = _ranked(reduce(DataFrame.unionByName, parts)).where(F.col("rank") <= k)
    return best.select("query_id", F.col("rank").cast("long").alias("rank"), "doc_id", "score")
