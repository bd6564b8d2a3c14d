"""Near duplicates by banded MinHash with odd sketches.

A document is the set of its distinct word shingles. Documents with equal sets form a
class; one representative of each goes on. ``SAMPLES`` MinHash values per class give
``BANDS`` band keys, and are folded into a bitmap of parities (an odd sketch): each
sample flips one bit, so equal samples cancel in the XOR of two sketches and the number
of set bits tells how many samples differ. Candidate pairs whose XOR has more than
``MOST_ODD`` bits are dropped. A second odd sketch folds the whole set, four bits to a
shingle: the bits of its XOR never outnumber the shingles in which two sets differ, so
it drops pairs without any loss. What is left is confirmed on the full sets.

Links, without all pairs of a bucket:

1. In every bucket each class is paired with the bucket's smallest one; confirmed
   pairs give components.
2. Buckets that still hold more than one component are compared in full, in blocks of
   about ``BLOCK`` classes, on sketches inside the tasks; only pairs of different
   components that pass the sketch leave a task, and are confirmed.

Two classes of similarity 0.8 share no band with probability (1 - 0.8**4)**32 = 5e-8, and the
bound on the samples' sketch lies above six standard deviations; both are properties of the method.

Defined cases: only A-Z are lowered and only ASCII white space separates words; a text
with fewer words than a shingle is one shingle; a text without words has an empty set and
is linked with nothing; so is a row without id. Repeated rows are one class. Only id and
text are read, so other columns cannot clash. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import small_or_plain, stored

SAMPLES, BANDS, SKETCH_WORDS = 128, 32, 8
MOST_ODD = 120  # of 512 bits
BLOCK = 512
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 400_000:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


_WORDS = _WordHashes()
_ODD_RNG = np.random.default_rng(3)
_A = _ODD_RNG.integers(0, 2**64, SAMPLES, np.uint64) | np.uint64(1)
_B = _ODD_RNG.integers(0, 2**64, SAMPLES, np.uint64)


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Sorted hashes of the distinct shingles."""
    found = (text or "").encode().lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(_WORDS.__getitem__, found), np.uint64, len(found))
    size = min(words, len(h))
    with np.errstate(over="ignore"):
        both = np.full(len(h) - size + 1, np.uint64(size))
        for i in range(size):
            both = _mixed(both * _STEP + h[i : len(h) - size + 1 + i])
    return np.unique(both)


def min_hashes(shingles: np.ndarray) -> np.ndarray:
    low = np.full(SAMPLES, np.uint64(2**64 - 1))
    with np.errstate(over="ignore"):
        for at in range(0, len(shingles), 2048):
            part = shingles[at : at + 2048]
            low = np.minimum(low, (part[None, :] * _A[:, None] + _B[:, None]).min(1))
    return low


def band_keys(samples: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        rows = samples.reshape(BANDS, -1)
        key = np.arange(BANDS, dtype=np.uint64) + np.uint64(1)
        for i in range(rows.shape[1]):
            key = _mixed(key * _STEP + rows[:, i])
    return key.view(np.int64)


def odd_sketch(samples: np.ndarray) -> np.ndarray:
    """Parities of the samples' bits, as 64 bit numbers."""
    with np.errstate(over="ignore"):
        bit = _mixed(samples + np.arange(SAMPLES, dtype=np.uint64) * _STEP) % np.uint64(64 * SKETCH_WORDS)
    odd = np.bincount(bit.astype(np.int64), minlength=64 * SKETCH_WORDS) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def whole_sketch(shingles: np.ndarray) -> np.ndarray:
    """Parities of all shingles; twice as many bits for twice as many shingles, so a long one folds to a short one."""
    size = max(64, 1 << (4 * len(shingles) - 1).bit_length())
    odd = np.bincount((shingles & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)


def folded(sketches: np.ndarray, words: int) -> np.ndarray:
    """Rows of whole sketches at a smaller size."""
    while sketches.shape[1] > words:
        half = sketches.shape[1] // 2
        sketches = sketches[:, :half] ^ sketches[:, half:]
    return sketches


class Sketches:
    """Sketches of some documents; tells which of them can be similar to one of them."""

    def __init__(self, n: list, samples: list[bytes], whole: list[bytes], percent: int):
        self.n, self.percent = np.array(n, np.int64), percent
        self.samples = np.frombuffer(b"".join(samples), np.uint64).reshape(len(n), SKETCH_WORDS)
        self.words = np.array([len(w) // 8 for w in whole], np.int64)
        self.whole = [np.frombuffer(w, np.uint64)[None, :] for w in whole]
        self.at: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for size in np.unique(self.words):
            which = np.flatnonzero(self.words == size)
            self.at[int(size)] = which, np.concatenate([self.whole[i] for i in which])

    def similar(self, k: int, among: np.ndarray) -> np.ndarray:
        n, p = self.n, self.percent
        fits = among & (100 * np.minimum(n, n[k]) >= p * np.maximum(n, n[k]))
        fits &= np.bitwise_count(self.samples ^ self.samples[k]).sum(1) <= MOST_ODD
        for size, (which, rows) in self.at.items():
            mine = fits[which]
            if mine.any():
                words = min(size, int(self.words[k]))
                odd = folded(rows[mine], words) ^ folded(self.whole[k], words)
                apart = np.bitwise_count(odd).sum(1).astype(np.int64)
                fits[which[mine]] = (100 + p) * apart <= (100 - p) * (n[which[mine]] + n[k])
        return np.flatnonzero(fits)


def signatures(docs: DataFrame, words: int, id_col: str, text_col: str) -> DataFrame:
    """``id``, ``n`` shingles, ``set_a`` and ``set_b`` (a hash of the set), ``bands`` and the sketches ``samples`` and ``whole``."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([
        rows.schema["id"], T.StructField("n", T.LongType()), T.StructField("set_a", T.LongType()), T.StructField("set_b", T.LongType()),
        T.StructField("bands", T.ArrayType(T.LongType())), T.StructField("samples", T.BinaryType()), T.StructField("whole", T.BinaryType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                b = whole.slice(at, 256)
                n, a, c, bands, samples, whole_ = [], [], [], [], [], []
                for t in b.column(1).to_pylist():
                    s = shingle_set(t, words)
                    d = xxhash.xxh3_128_intdigest(s.tobytes())
                    n.append(len(s))
                    a.append((d >> 64) - 2**63)
                    c.append((d & (2**64 - 1)) - 2**63)
                    low = min_hashes(s) if len(s) else None
                    bands.append(band_keys(low) if len(s) else [])
                    samples.append(odd_sketch(low).tobytes() if len(s) else b"")
                    whole_.append(whole_sketch(s).tobytes() if len(s) else b"")
                cols = [b.column(0), *(pa.array(x, pa.int64()) for x in (n, a, c)), pa.array(bands, pa.list_(pa.int64()))]
                cols += [pa.array(samples, pa.binary()), pa.array(whole_, pa.binary())]
                yield pa.RecordBatch.from_arrays(cols, names=["id", "n", "set_a", "set_b", "bands", "samples", "whole"])

    return rows.mapInArrow(run, schema)


def components(edges: DataFrame, label: str) -> DataFrame:
    """``v`` and ``root``, the smallest vertex that ``edges`` (``a``, ``b``) connect it with.

    Every round takes the smallest root among the neighbours and then the root of that root,
    so path lengths shrink fast; the state is a table written each round.
    """
    both = edges.select(F.col("a").alias("v"), F.col("b").alias("w")).union(edges.select(F.col("b"), F.col("a")))
    state = stored(both.groupBy("v").agg(F.least(F.min("w"), F.col("v")).alias("root")), label)
    both = stored(both, label)
    while True:
        theirs = both.join(state.select(F.col("v").alias("w"), F.col("root").alias("r")), "w").groupBy("v").agg(F.min("r").alias("r"))
        near = state.join(theirs, "v").select("v", F.least("root", "r").alias("mid"), F.col("root").alias("was"))
        jump = state.select(F.col("v").alias("mid"), F.col("root").alias("far"))
        now = stored(near.join(jump, "mid", "left").select("v", F.least("mid", "far").alias("root"), "was"), label)
        if now.where("root != was").isEmpty():
            return now.select("v", "root")
        state = now.select("v", "root")


def _confirmed(pairs: DataFrame, docs: DataFrame, words: int, id_col: str, text_col: str, percent: int) -> DataFrame:
    """Those pairs (``a``, ``b``) whose full sets meet the similarity."""
    ends = small_or_plain(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct(), "near-ends")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([texts.schema["id"], T.StructField("h", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 64):
                b = whole.slice(at, 64)
                sets = [shingle_set(t, words).view(np.int64) for t in b.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["id", "h"])

    sets = texts.join(ends, "id", "left_semi").mapInArrow(run, schema).dropDuplicates(["id"])
    full = pairs.join(sets.select(F.col("id").alias("a"), F.col("h").alias("ha")), "a")
    full = full.join(sets.select(F.col("id").alias("b"), F.col("h").alias("hb")), "b")
    both = F.size(F.array_intersect("ha", "hb"))
    return full.where(100 * both >= percent * (F.size("ha") + F.size("hb") - both)).select("a", "b")


def _star_pairs(buckets: DataFrame, full: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Each class of a bucket with the bucket's first class, once, where sketches allow."""
    pairs = buckets.join(full.select("key", F.col("first").alias("a")), "key").where("id != a")
    pairs = pairs.select("a", F.col("id").alias("b")).distinct()
    for end in "ab":
        side = reps.select(F.col("id").alias(end), F.col("n").alias(f"n{end}"), F.col("samples").alias(f"s{end}"), F.col("whole").alias(f"w{end}"))
        pairs = pairs.join(side, end)
    pairs = pairs.select("a", "b", "na", "nb", "sa", "sb", "wa", "wb")

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for n1, n2, s1, s2, w1, w2 in zip(*(batch.column(k).to_pylist() for k in range(2, 8))):
                keep.append(len(Sketches([n1, n2], [s1, s2], [w1, w2], percent).similar(0, np.array([False, True]))) > 0)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.mapInArrow(test, T.StructType([pairs.schema["a"], pairs.schema["b"]]))


def _block_pairs(buckets: DataFrame, reps: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components in one bucket that pass the sketch; blocks of a bucket meet block by block."""
    named = buckets.join(roots.select(F.col("v").alias("id"), "root"), "id", "left")
    named = named.select("key", "id", F.coalesce("root", "id").alias("root"))
    open_ = named.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("root").alias("lo"), F.max("root").alias("hi"))
    open_ = open_.where("lo != hi").select("key", F.ceil(F.col("n") / BLOCK).alias("blocks"))
    rows = named.join(open_, "key").join(reps.select("id", F.col("n").alias("size"), "samples", "whole"), "id")
    mine = F.pmod(F.xxhash64("id"), "blocks")
    spread = rows.withColumn("mine", mine).select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    spread = spread.select(
        "key", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"),
        F.struct("id", "root", "mine", "size", "samples", "whole").alias("m"),
    )
    met = spread.groupBy("key", "i", "j").agg(F.collect_list("m").alias("m")).select("i", "j", "m")
    kind = reps.schema["id"].dataType
    schema = T.StructType([T.StructField("a", kind), T.StructField("b", kind)])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, m in zip(*(batch.column(k).to_pylist() for k in range(3))):
                sketches = Sketches(*([x[c] for x in m] for c in ("size", "samples", "whole")), percent)
                ids = [x["id"] for x in m]
                _, root = np.unique(np.array([str(x["root"]) for x in m]), return_inverse=True)
                block, place = np.array([x["mine"] for x in m]), np.arange(len(m))
                a: list = []
                b: list = []
                for k in place:
                    if i != j and block[k] != i:
                        continue
                    for t in sketches.similar(k, (root != root[k]) & ((block == j) if i != j else (place > k))):
                        a.append(min(ids[k], ids[t]))
                        b.append(max(ids[k], ids[t]))
                arrow = batch.schema.field(2).type.value_type.field("id").type
                yield pa.RecordBatch.from_arrays([pa.array(a, arrow), pa.array(b, arrow)], names=["a", "b"])

    return met.mapInArrow(compare, schema).distinct()


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, ``n_shingles``, ``component_id`` and ``kept``."""
    marks = stored(signatures(docs, words, id_col, text_col), "near-signatures")
    usable = marks.where("n > 0 AND id IS NOT NULL")
    key = ["set_a", "set_b", "n"]
    classes = usable.groupBy(*key).agg(F.min("id").alias("rep"), *[F.first(c).alias(c) for c in ("bands", "samples", "whole")])
    reps = stored(classes.withColumnRenamed("rep", "id"), "near-classes")
    buckets = reps.select("id", F.explode("bands").alias("key"))
    full = buckets.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first")).where("n > 1")
    full = stored(full.select("key", "first"), "near-buckets")
    shared = stored(buckets.join(full, "key", "left_semi"), "near-members")
    first = stored(_star_pairs(shared, full, reps, percent), "near-pairs")
    links = stored(_confirmed(first, docs, words, id_col, text_col, percent), "near-links")
    roots = components(links, "near-roots")
    later = stored(_block_pairs(shared, reps, roots, percent).join(first, ["a", "b"], "left_anti"), "near-pairs")
    if not later.isEmpty():
        more = stored(_confirmed(later, docs, words, id_col, text_col, percent), "near-links")
        if not more.isEmpty():
            roots = components(links.union(more), "near-roots")
    named = reps.select(*key, "id").join(roots.select(F.col("v").alias("id"), "root"), "id", "left")
    named = named.select(*key, F.coalesce("root", "id").alias("component_id"))
    out = marks.select("id", *key).join(named, key, "left")
    own = F.when(F.col("id").isNull() | (F.col("n") == 0), F.col("id")).otherwise(F.col("component_id"))
    out = out.select("id", "n", own.alias("component_id"))
    return out.select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept")
    )


def drop_near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of which no near duplicate with a smaller id is linked, with the columns of the input."""
    dropped = near_duplicates(docs, words, percent, id_col, text_col).where("NOT kept").select(F.col(id_col).alias("_dropped"))
    dropped = small_or_plain(dropped.where("_dropped IS NOT NULL").distinct(), "near-dropped")
    return docs.join(dropped, docs[f"`{id_col}`"] == F.col("_dropped"), "left_anti")
