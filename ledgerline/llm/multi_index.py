"""Approximate nearest neighbours by an inverted multi-index.

Vectors are cut into two halves, and each half is quantised by a codebook of its own. A vector lies in
the cell of its pair of centroids. A query sorts the centroids of either half by inner product and visits pairs
in the order of the summed products, with a heap, until the visited cells hold as many vectors as
the budget asks for. Only vectors of visited cells are compared exactly.

Codebooks are fitted on at most ``SAMPLE_VALUES`` numbers of sampled vectors; every vector is indexed.
The budget is measured, not guessed: ``SAMPLE_QUERIES`` queries are answered exactly against all vectors, and the budget
is the least number of vectors by which the traversal has met the share ``target`` of their neighbours.
Where neighbours hardly cluster, the budget grows until the target holds.

Work is dealt in blocks: cells lie in groups of about ``GROUP_VALUES`` numbers, a cell with more vectors than that is
spread over several, and a group that very many queries visit is copied for several parts of
them. A task holds one group and lets its queries stream by; it leaves out every run of cells
that no query visits. A query carries the sum at which its traversal ended, so a task knows the visited cells again.

Defined cases: vectors that are NULL, empty, zero, or hold NULL or non-finite numbers take no part, nor
do vectors of another length than the commonest (of equally common ones the longest). Rows with the query's
id are its own and no candidates. A query id on several rows is asked once, with the smallest vector.
Rows without id are candidates and come last among ties. Repeated rows are one candidate
each. An empty table gives an empty result. Only id and vector are read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerline.llm.common import stored, width

SAMPLE_VALUES = 1_500_000
SAMPLE_QUERIES = 200
GROUP_VALUES = 500_000
#: Queries of one group that one task answers.
PART_QUERIES = 100_000
#: Queries that one task sends through the cells.
TASK_QUERIES = 250
ROUNDS = 12
NO_ID = 2**63 - 1


@dataclass(frozen=True)
class MultiIndex:
    """Codebooks of both halves, vectors per cell, and how far a traversal goes."""

    dims: int
    rows: int
    books: tuple[np.ndarray, np.ndarray]
    counts: np.ndarray
    budget: int
    #: Share of true neighbours that sampled queries find with this budget.
    recall: float

    @property
    def cut(self) -> int:
        return self.dims // 2

    def centroid_sums(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Inner products of both halves with their centroids."""
        return vectors[:, : self.cut] @ self.books[0].T, vectors[:, self.cut :] @ self.books[1].T

    def cells(self, vectors: np.ndarray) -> np.ndarray:
        """The cell of each vector: nearest centroids of its halves."""
        first, second = (
            np.argmax(p - 0.5 * (b * b).sum(1), axis=1) for p, b in zip(self.centroid_sums(vectors), self.books)
        )
        return first * len(self.books[1]) + second

    def group_ranges(self) -> tuple[np.ndarray, np.ndarray, int]:
        """First and last group of each cell, and the number of groups."""
        size = max(1, GROUP_VALUES // self.dims)
        start = np.cumsum(self.counts) - self.counts
        last = np.maximum(start + self.counts - 1, start)
        return start // size, last // size, int(max(1, -(-int(self.counts.sum()) // size)))

    def traverse(self, first: np.ndarray, second: np.ndarray) -> tuple[list[int], float]:
        """Cells by falling sum until they hold ``budget`` vectors, and the last sum."""
        by_first, by_second = np.argsort(-first, kind="stable").tolist(), np.argsort(-second, kind="stable").tolist()
        a, b = first[by_first].tolist(), second[by_second].tolist()
        width, held = len(b), 0
        counts, out = self.counts, []
        heap, reached = [(-(a[0] + b[0]), 0, 0)], [0] * len(a)
        last = a[0] + b[0]
        while heap and held < self.budget:
            s, i, j = heapq.heappop(heap)
            last = -s
            cell = by_first[i] * width + by_second[j]
            if counts[cell]:
                held += int(counts[cell])
                out.append(cell)
            reached[i] = j + 1
            # A pair is pushed once both pairs before it are out.
            if j + 1 < width and (i == 0 or reached[i - 1] > j + 1):
                heapq.heappush(heap, (-(a[i] + b[j + 1]), i, j + 1))
            if i + 1 < len(a) and reached[i + 1] == j:
                heapq.heappush(heap, (-(a[i + 1] + b[j]), i + 1, j))
        return out, last


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id`` and ``vec`` of rows that take part, lengths aside."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vec"))
    v = F.col("vec")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.where(v.isNotNull() & (F.size(v) > 0)).where(~bad & F.exists(v, lambda x: x != 0))


def fit(rows: DataFrame, asked: DataFrame, many: int, k: int, target: float) -> MultiIndex | None:
    """The index of ``rows`` (from ``usable``) for queries like the ``many`` of ``asked``; None without rows."""
    lengths = rows.groupBy(F.size("vec").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    common = lengths.orderBy(F.desc("n"), F.desc("d")).first()
    if common is None:
        return None
    dims, n = int(common["d"]), int(common["n"])
    rows, asked = rows.where(F.size("vec") == dims), asked.where(F.size("vec") == dims)
    books = _codebooks(_matrix(_some(rows, n, max(1, SAMPLE_VALUES // dims)), dims))
    tried = _some(asked, many, SAMPLE_QUERIES)
    blank = MultiIndex(dims, n, books, np.zeros(len(books[0]) * len(books[1]), np.int64), 0, 1.0)
    seen = stored(_cells_and_truth(rows, blank, [NO_ID if r.id is None else r.id for r in tried], _matrix(tried, dims), k), "ann-fit")
    counts = blank.counts.copy()
    for r in seen.where("kind = 0").groupBy("cell").agg(F.sum("n").alias("n")).collect():  # at most one row a cell
        counts[r.cell] = r.n
    best = W.partitionBy("n").orderBy(F.desc("score"))
    truth = seen.where("kind = 1").withColumn("r", F.row_number().over(best)).where(F.col("r") <= k).collect()
    budget, recall = n, 1.0
    if truth:
        first, second = blank.centroid_sums(_matrix(tried, dims))
        met = {}
        for q in range(len(tried)):
            order = np.argsort(-(first[q][:, None] + second[q][None, :]).ravel(), kind="stable")
            met[q] = np.empty(len(order), np.int64)
            met[q][order] = np.cumsum(counts[order])
        needed = np.sort([met[r.n][r.cell] for r in truth])
        at = min(len(needed) - 1, int(np.ceil(target * len(needed))) - 1)
        budget, recall = max(int(needed[at]), k + 1), float((needed <= needed[at]).mean())
    return MultiIndex(dims, n, books, counts, budget, recall)


def _some(df: DataFrame, n: int, most: int) -> list:
    """A sample of at most ``most`` rows, the same in every run over the same files."""
    share = min(1.0, 1.1 * most / max(1, n))
    return (df if share == 1.0 else df.sample(fraction=share, seed=5)).limit(most).collect()


def _matrix(rows: list, dims: int) -> np.ndarray:
    return np.array([r.vec for r in rows], np.float64).reshape(len(rows), dims)


def _codebooks(sample: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One codebook for each half, by Lloyd's rounds over the sample."""
    rng, cut = np.random.default_rng(3), sample.shape[1] // 2
    size = max(1, int(np.ceil(np.sqrt(len(sample)) / 2)))
    out = []
    for half in (sample[:, :cut], sample[:, cut:]):
        book = np.unique(half[rng.permutation(len(half))[:size]], axis=0) if half.shape[1] else np.zeros((1, 0))
        for _ in range(ROUNDS if half.shape[1] else 0):
            nearest = np.argmax(half @ book.T - 0.5 * (book * book).sum(1), axis=1)
            sums = np.zeros_like(book)
            np.add.at(sums, nearest, half)
            held = np.bincount(nearest, minlength=len(book))
            book = np.where(held[:, None] > 0, sums / np.maximum(held, 1)[:, None], book)
        out.append(book)
    return out[0], out[1]


def _vectors(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)


def _ids(column: pa.Array) -> np.ndarray:
    return column.fill_null(NO_ID).to_numpy(zero_copy_only=False)


def _cells_and_truth(rows: DataFrame, index: MultiIndex, own: list[int], tried: np.ndarray, k: int) -> DataFrame:
    """Vectors per cell (kind 0), and the best ``k`` of each task for every sampled query with their cells (kind 1)."""
    mine = np.array(own, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros_like(index.counts)
        score, cell = np.full((len(tried), 0), -np.inf), np.zeros((len(tried), 0), np.int64)
        for b in batches:
            if not b.num_rows:
                continue
            ids, vectors = _ids(b.column(0)), _vectors(b.column(1), index.dims)
            cells = index.cells(vectors)
            counts += np.bincount(cells, minlength=len(counts))
            s = tried @ vectors.T
            s[mine[:, None] == ids[None, :]] = -np.inf
            score, cell = np.hstack([score, s]), np.hstack([cell, np.broadcast_to(cells, s.shape)])
            keep = np.argpartition(-score, min(k, score.shape[1]) - 1, axis=1)[:, :k]
            score, cell = np.take_along_axis(score, keep, 1), np.take_along_axis(cell, keep, 1)
        full = np.flatnonzero(counts)
        q, at = np.nonzero(score > -np.inf)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.r_[np.zeros(len(full), np.int32), np.ones(len(q), np.int32)].astype(np.int32)),
                pa.array(np.r_[full, cell[q, at]].astype(np.int32)),
                pa.array(np.r_[counts[full], q].astype(np.int64)),
                pa.array(np.r_[np.zeros(len(full)), score[q, at]]),
            ],
            names=["kind", "cell", "n", "score"],
        )

    return rows.mapInArrow(run, "kind int, cell int, n long, score double")


def _entries(rows: DataFrame, index: MultiIndex) -> DataFrame:
    """Every vector with its cell and group; the vectors of a large cell go round its groups."""
    first, last, _ = index.group_ranges()
    kind = rows.schema["vec"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = 7919 * (TaskContext.get().partitionId() if TaskContext.get() else 0)
        for b in batches:
            cells = index.cells(_vectors(b.column(1), index.dims)) if b.num_rows else np.zeros(0, np.int64)
            group = first[cells] + (turn + np.arange(b.num_rows)) % (last[cells] - first[cells] + 1)
            turn += b.num_rows
            yield pa.RecordBatch.from_arrays([pa.array(group, pa.int64()), b.column(0), b.column(1), pa.array(cells, pa.int32())], names=["group", "id", "vec", "cell"])

    return rows.mapInArrow(run, f"group long, id long, vec {kind}, cell int")


def _visits(asked: DataFrame, index: MultiIndex) -> DataFrame:
    """Every query with the groups of the cells it visits and the sum at which it stopped."""
    first, last, _ = index.group_ranges()
    kind = asked.schema["vec"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sums = index.centroid_sums(_vectors(b.column(1), index.dims)) if b.num_rows else ([], [])
            groups, ends = [], []
            for one, other in zip(*sums):
                cells, end = index.traverse(one, other)
                groups.append(sorted({g for c in cells for g in range(first[c], last[c] + 1)}))
                ends.append(end - 1e-9 * (1 + abs(end)))  # rounding may differ in another task
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(ends, pa.float64()), pa.array(groups, pa.list_(pa.int64()))], names=["id", "vec", "end", "groups"]
            )

    return asked.mapInArrow(run, f"id long, vec {kind}, end double, groups array<long>")


class _Group:
    """The vectors of one group, sorted by cell, with its runs of cells under one first centroid."""

    def __init__(self, index: MultiIndex, ids: list, vectors: list, cells: list):
        cell = np.concatenate(cells)
        by = np.argsort(cell, kind="stable")
        self.index, self.ids, self.vectors, self.cell = index, np.concatenate(ids)[by], np.concatenate(vectors)[by], cell[by]
        top = self.cell // len(index.books[1])
        self.starts = np.flatnonzero(np.r_[True, top[1:] != top[:-1]])
        self.ends = np.r_[self.starts[1:], len(top)]

    def best(self, ids: np.ndarray, vectors: np.ndarray, ends: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Best ``k`` of the group for each query, among the cells it visits."""
        first, second = self.index.centroid_sums(vectors)
        width = second.shape[1]
        score = np.full((len(ids), len(self.ids)), -np.inf)
        for a, z in zip(self.starts, self.ends):
            cells, at = np.unique(self.cell[a:z], return_inverse=True)
            visited = first[:, cells // width] + second[:, cells % width] >= ends[:, None]
            who = np.flatnonzero(visited.any(axis=1))
            if len(who):
                score[who, a:z] = np.where(visited[who][:, at], vectors[who] @ self.vectors[a:z].T, -np.inf)
        score[ids[:, None] == self.ids[None, :]] = -np.inf
        least = np.partition(score, -k, axis=1)[:, -k] if score.shape[1] > k else score.min(axis=1)
        for q in range(len(ids)):
            # Equal vectors may differ in the last bits of the block product, so ties are settled by one fixed sum.
            slack = 1e-9 * (1 + abs(least[q])) if np.isfinite(least[q]) else 0
            near = np.flatnonzero((score[q] >= least[q] - slack) & (score[q] > -np.inf))
            if len(near):
                exact = (self.vectors[near] * vectors[q]).sum(axis=1)
                order = np.lexsort((self.ids[near], -exact))[:k]
                yield q, self.ids[near[order]], exact[order]


def nearest(
    vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", target: float = 0.95, index: MultiIndex | None = None
) -> DataFrame:
    """``query_id``, ``rank`` from 1, ``vec_id`` and ``score`` of the ``k`` nearest rows found for every row that ``is_query`` picks."""
    rows = usable(vectors, id_col, vector_col)
    asked = usable(vectors.where(is_query), id_col, vector_col).where(F.col("id").isNotNull())
    many = asked.count()
    index = fit(rows, asked, many, k, target) if index is None else index
    if index is None:
        return rows.select(F.col("id").alias("query_id"), F.lit(0).alias("rank"), F.col("id").alias("vec_id"), F.lit(0.0).alias("score")).limit(0)
    rows, asked = rows.where(F.size("vec") == index.dims), asked.where(F.size("vec") == index.dims)
    once = asked.repartition(width(many, TASK_QUERIES), "id").groupBy("id").agg(F.min("vec").alias("vec"))
    visits = stored(_visits(once, index), "ann-queries")
    sent = visits.select(F.explode("groups").alias("group"), "id", "vec", "end")
    # A group that no query visits has no parts and is not moved.
    parts = stored(sent.groupBy("group").agg(F.ceil(F.count(F.lit(1)) / PART_QUERIES).alias("parts")), "ann-groups")
    units = int(parts.agg(F.coalesce(F.sum("parts"), F.lit(1)).alias("n")).first()["n"])
    theirs = sent.join(parts, "group").select("group", F.pmod(F.xxhash64("id"), "parts").alias("part"), F.lit(1).alias("kind"), "id", "vec", F.lit(0).alias("cell"), "end")
    mine = (
        _entries(rows, index).join(parts, "group")
        .select("group", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), F.lit(0).alias("kind"), "id", "vec", "cell", F.lit(0.0).alias("end"))
    )
    dealt = mine.unionByName(theirs).repartition(units, "group", "part").sortWithinPartitions("group", "part", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, group, held = None, None, ([], [], [])
        for b in batches:
            if not b.num_rows:
                continue
            key, kind = np.stack([b.column(0).to_numpy(), b.column(1).to_numpy()], axis=1), b.column(2).to_numpy()
            ids, matrix, cells, ends = _ids(b.column(3)), _vectors(b.column(4), index.dims), b.column(5).to_numpy(), b.column(6).to_numpy()
            marks = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(axis=1) | (kind[1:] != kind[:-1])])
            out: tuple[list, list, list] = ([], [], [])
            for a, z in zip(marks, np.r_[marks[1:], b.num_rows]):
                if unit != tuple(key[a]):
                    unit, group, held = tuple(key[a]), None, ([], [], [])
                if kind[a] == 0:
                    for to, part in zip(held, (ids, matrix, cells)):
                        to.append(part[a:z].copy())
                    continue
                group = _Group(index, *held) if group is None else group
                for low in range(a, z, 256):
                    some = slice(low, min(low + 256, z))
                    for q, found, score in group.best(ids[some], matrix[some], ends[some], k):
                        out[0].append(np.full(len(found), ids[low + q]))
                        out[1].append(found)
                        out[2].append(score)
            if out[0]:
                found = np.concatenate(out[1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(out[0]), pa.int64()), pa.array(found, pa.int64(), mask=found == NO_ID), pa.array(np.concatenate(out[2]))], names=["query_id", "vec_id", "score"]
                )

    each = dealt.mapInArrow(run, "query_id long, vec_id long, score double")
    best = W.partitionBy("query_id").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return each.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
