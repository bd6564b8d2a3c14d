"""Ranked lexical search by scanning the documents for the terms of all items at once.

There is no index of the documents. The terms of the items become one Aho-Corasick automaton, each
guarded by a space on either side, and texts are read with every character that belongs to no term turned to a
space, so a hit is a whole term. The automaton maps a hit to its term and the term to its items. A first scan counts
documents, terms and the documents of each item term; a second one counts again, scores with those
statistics, and keeps the best ``k`` documents of each item per task. The tasks' lists are merged exactly,
first within ``SALTS`` parts of an item and then across them.

Items are taken in chunks of about ``CHUNK_BYTES`` of terms: that bounds the automaton, which is broadcast, and what
the driver sees. Every chunk costs the two scans; a benchmark is usually one chunk.

Scores are whole numbers: a term weighs ``floor(1000 ln((2N+2)/(2df+1)))``, a document's length measure is
``100 - 50 + (50 n N) div L``, and a document scores the sum of ``w ((10^9 tf) div (1000 tf + 20 m))``.

Defined cases: NULL texts and texts without a term are no documents, and NULL items or items without
a term find nothing. Rows of an item with the same id, NULL included, are one item with the terms of all.
Each row of the documents is ranked by itself, repeated ones too; equal scores by id, rows without id first.
Very long texts are scanned whole. Empty tables give an empty result. Only ids and texts are read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerline.llm.common import stored, width

K = 50
CHUNK_BYTES = 32_000_000
SALTS = 32
#: Characters of no term become spaces, A-Z become a-z, all else stays, bytes of longer characters too.
_READ = bytes(
    32 if not (0x30 <= c <= 0x39 or 0x41 <= c <= 0x5A or 0x61 <= c <= 0x7A or c >= 0x80) else c + 32 if 0x41 <= c <= 0x5A else c for c in range(256)
)
_OUTSIDE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Different terms of each item: ``item_id``, ``term``."""
    low = F.translate(F.col(text_col).cast("string"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = F.explode(F.split(low, _OUTSIDE))
    return items.select(F.col(id_col).alias("item_id"), words.alias("term")).where(F.col("term") != "").distinct()


class Scanner:
    """Counts of the wanted terms in a text."""

    def __init__(self, terms: list[str]):
        self.automaton = ahocorasick.Automaton()
        for number, term in enumerate(terms):
            # Bytes as Latin letters: the scan then sees exactly the bytes of the text.
            self.automaton.add_word(f" {term.encode().decode('latin-1')} ", number)
        self.some = len(terms) > 0
        if self.some:
            self.automaton.make_automaton()

    def read(self, text: str) -> tuple[int, Counter]:
        """All terms of the text with repeats, and how often each wanted one occurs."""
        low = text.encode().translate(_READ)
        found = Counter(n for _, n in self.automaton.iter(f" {low.decode('latin-1')} ")) if self.some else Counter()
        return len(low.split()), found


def _scanner(shared: Broadcast) -> Scanner:
    """The automaton of the chunk, built once in each worker."""
    held = shared.value
    if "scanner" not in held:
        held["scanner"] = Scanner(held["terms"])
    return held["scanner"]


def _counted(docs: DataFrame, shared: Broadcast) -> DataFrame:
    """Per task: documents (term -1), all their terms (term -2), and documents of each wanted term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner, total, df = _scanner(shared), [0, 0], np.zeros(len(shared.value["terms"]), np.int64)
        for b in batches:
            for text in b.column(1):
                n, found = scanner.read(text.as_py() or "")
                total[0] += n > 0
                total[1] += n
                df[np.fromiter(found, np.int64, len(found))] += 1
        hit = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[-1, -2, hit].astype(np.int64)), pa.array(np.r_[total, df[hit]].astype(np.int64))], names=["term", "n"])

    return docs.mapInArrow(run, "term long, n long")


class Best:
    """The best ``k`` rows of every item so far: highest score first, then smallest id."""

    def __init__(self, items: int, k: int):
        self.k, self.least = k, np.zeros(items, np.int64)
        self.items, self.ids, self.scores = (np.zeros(0, np.int64) for _ in range(3))
        self.new: list[tuple[np.ndarray, int, np.ndarray]] = []
        self.waiting = 0

    def add(self, doc: int, scores: np.ndarray) -> None:
        # An id may win a tie, so scores equal to the least kept one go on.
        hit = np.flatnonzero((scores > 0) & (scores >= self.least))
        if len(hit):
            self.new.append((hit, doc, scores[hit]))
            self.waiting += len(hit)
            if self.waiting > 200_000:
                self.settle()

    def settle(self) -> None:
        items = np.concatenate([self.items, *[n[0] for n in self.new]])
        ids = np.concatenate([self.ids, *[np.full(len(n[0]), n[1]) for n in self.new]]).astype(np.int64)
        scores = np.concatenate([self.scores, *[n[2] for n in self.new]])
        by = np.lexsort((ids, -scores, items))
        items, ids, scores = items[by], ids[by], scores[by]
        start = np.searchsorted(items, items)
        keep = np.arange(len(items)) - start < self.k
        self.items, self.ids, self.scores, self.new, self.waiting = items[keep], ids[keep], scores[keep], [], 0
        full = np.bincount(self.items, minlength=len(self.least)) == self.k
        lows = np.full(len(self.least), np.iinfo(np.int64).max)
        np.minimum.at(lows, self.items, self.scores)
        self.least = np.where(full, lows, 0)


NO_ID = -(2**63)


def _ranked(docs: DataFrame, shared: Broadcast, k: int) -> DataFrame:
    """Per task: the best ``k`` documents of each item of the chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        scanner, weight, start, items = _scanner(shared), held["weight"], held["start"], held["items"]
        documents, length, best = held["documents"], held["length"], Best(held["count"], k)
        score = np.zeros(held["count"], np.int64)
        for b in batches:
            ids = b.column(0).fill_null(NO_ID).to_pylist()
            for doc, text in zip(ids, b.column(1)):
                n, found = scanner.read(text.as_py() or "")
                if not found:
                    continue
                term, tf = np.fromiter(found.keys(), np.int64, len(found)), np.fromiter(found.values(), np.int64, len(found))
                m = 100 - 50 + 50 * n * documents // length
                part = weight[term] * (1_000_000_000 * tf // (1000 * tf + 20 * m))
                sizes = start[term + 1] - start[term]
                to = np.arange(int(sizes.sum())) + np.repeat(start[term] - np.r_[0, np.cumsum(sizes)[:-1]], sizes)
                score[:] = 0
                np.add.at(score, items[to], np.repeat(part, sizes))
                best.add(doc, score)
        best.settle()
        yield pa.RecordBatch.from_arrays(
            [pa.array(best.items), pa.array(best.ids, mask=best.ids == NO_ID), pa.array(best.scores)], names=["item", "doc_id", "score"]
        )

    return docs.mapInArrow(run, "item long, doc_id long, score long")


def search(
    docs: DataFrame, items: DataFrame, k: int = K, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", chunk_bytes: int = CHUNK_BYTES
) -> DataFrame:
    """``item_id``, ``rank`` from 1, ``doc_id`` and ``score`` of the ``k`` best documents of every item."""
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    size = F.sum(F.octet_length("term") + 16)
    wanted = stored(item_terms(items, item_id_col, item_text_col), "lexical-terms")
    total = wanted.agg(size.alias("n")).first()["n"] or 0
    chunks, parts = width(total, chunk_bytes), []
    for c in range(chunks):
        # Collected: the terms of one chunk, about chunk_bytes of them.
        rows = wanted.where(F.pmod(F.xxhash64("item_id"), F.lit(chunks)) == c).collect()
        if rows:
            parts.append(_searched(spark, texts, rows, k, wanted.schema["item_id"].dataType.simpleString()))
    if not parts:
        return wanted.select("item_id", F.lit(1).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score")).limit(0)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _searched(spark, texts: DataFrame, rows: list, k: int, id_type: str) -> DataFrame:
    terms, names = sorted({r.term for r in rows}), list(dict.fromkeys(r.item_id for r in rows))
    number, item = {t: i for i, t in enumerate(terms)}, {x: i for i, x in enumerate(names)}
    pairs = np.array(sorted((number[r.term], item[r.item_id]) for r in rows), np.int64).reshape(-1, 2)
    start = np.searchsorted(pairs[:, 0], np.arange(len(terms) + 1))
    seen = _counted(texts, spark.sparkContext.broadcast({"terms": terms})).groupBy("term").agg(F.sum("n").alias("n"))
    found = {r.term: r.n for r in seen.collect()}  # at most one row a term
    documents, length = found.get(-1, 0), found.get(-2, 0)
    df = np.array([found.get(i, 0) for i in range(len(terms))], np.float64)
    weight = np.floor(1000 * np.log((2.0 * documents + 2) / (2 * df + 1))).astype(np.int64)
    shared = spark.sparkContext.broadcast(
        {"terms": terms, "weight": weight, "start": start, "items": pairs[:, 1], "count": len(names), "documents": documents, "length": max(1, length)}
    )
    each = _ranked(texts, shared, k).withColumn("salt", F.pmod(F.xxhash64("doc_id", "score"), F.lit(SALTS)))
    for by in (["item", "salt"], ["item"]):
        order = W.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
        each = each.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    # As many rows as the chunk has items.
    labels = spark.createDataFrame(list(enumerate(names)), f"item long, item_id {id_type}")
    return each.join(F.broadcast(labels), "item").select("item_id", "rank", "doc_id", "score")
