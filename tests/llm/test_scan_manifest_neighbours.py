"""Lexical search by scans, the Merkle manifest and the multi-index against plain versions."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import lexical, merkle, multi_index, queries
from ledgerline.llm.common import table
from tests.llm.test_dedup_mix_pack import ODD, SF, clashing, docs, odd  # noqa: F401
from tests.oracle import connect, duck_rows, spark_rows

WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def plain_search(rows, items, k):
    """(doc_id, text), (item_id, text) -> sorted (item_id, rank, doc_id, score)"""
    counted = [(i, Counter(WORD.findall(low(t or "")))) for i, t in rows]
    counted = [(i, c) for i, c in counted if c]
    n_all, length = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(WORD.findall(low(t or "")))
    out = []
    for i, terms in asked.items():
        scored = []
        for d, c in counted:
            m = 100 - 50 + 50 * sum(c.values()) * n_all // length
            s = sum(math.floor(1000 * math.log((2 * n_all + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in terms if t in c)
            if s > 0:
                scored.append((-s, d is not None, d or 0))
        out += [(i, r + 1, d if known else None, -s) for r, (s, known, d) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


def found(frame):
    return sorted([(r.item_id, r["rank"], r.doc_id, r.score) for r in frame.collect()], key=repr)


def test_search_equals_sql(spark):
    df, con = queries.op11_aho_corasick(spark, SF), connect(SF)
    assert spark_rows(df) == duck_rows(con, queries.OP11_SQL)


@pytest.mark.parametrize("chunk_bytes", [32_000_000, 400])
def test_search_whole_terms_ties_and_odd_rows(spark, odd, chunk_bytes):  # noqa: F811
    rows = [(r[0], r[1]) for r in ODD] + [(20, "Ab abab AB,ab;x"), (21, "ab"), (22, "ab"), (23, "naïve é ab1 1ab ÀB"), (24, "...")]
    items = [(1, "AB text"), (2, "é naïve"), (3, None), (4, ""), (None, "same"), (5, "word end"), (5, "here"), (6, "nowhere"), (7, "x ab1")]
    frame = clashing(spark.createDataFrame(rows, "doc_id bigint, text string"), "TERM", "rank", "item_id")
    asked = clashing(spark.createDataFrame(items, "item_id bigint, text string"), "Score", "doc_id")
    got = lexical.search(frame, asked, k=3, chunk_bytes=chunk_bytes)
    assert found(got) == plain_search(rows, items, 3)


def test_search_keeps_the_best_over_many_batches(spark):
    rng = np.random.default_rng(8)
    rows = [(int(i), " ".join(rng.choice(["a", "b", "c", "dd"], rng.integers(1, 6)))) for i in rng.permutation(3000)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    items = spark.createDataFrame([(1, "a b"), (2, "dd")], "item_id bigint, text string")
    assert found(lexical.search(frame, items, k=50)) == plain_search(rows, [(1, "a b"), (2, "dd")], 50)


def test_search_of_empty_tables(spark, odd):  # noqa: F811
    items = spark.createDataFrame([(1, "same")], "item_id bigint, text string")
    assert lexical.search(odd.limit(0), items).count() == 0
    none = lexical.search(odd, items.limit(0))
    assert none.count() == 0 and none.dtypes == lexical.search(odd, items).dtypes


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def plain_manifest(rows):
    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([digest(*out[-1][i : i + 16]) for i in range(0, len(out[-1]), 16)])
        return out

    def path(tree, i):
        out = []
        for nodes in tree[:-1]:
            a = i // 16 * 16
            out.append(("".join(nodes[a:i]), "".join(nodes[i + 1 : a + 16])))
            i //= 16
        return out

    by = {}
    for r in rows:
        by.setdefault(r["source"], []).append((r["doc_id"] is not None, r["doc_id"] or 0, digest(*[plain_field(r[c]) for c in merkle.FIELDS]), r))
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: levels([x[2] for x in sorted(by[s], key=lambda x: x[:3])]) for s in sources}
    above = levels([trees[s][-1][0] for s in sources])
    out = []
    for at, s in enumerate(sources):
        for i, (_, _, leaf, r) in enumerate(sorted(by[s], key=lambda x: x[:3])):
            steps, node = path(trees[s], i) + path(above, at), leaf
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0:
                node = digest(*[plain_field(low(r[c]) if c == "text" and r[c] is not None else r[c]) for c in merkle.FIELDS])
            for a, b in steps:
                node = digest(a, node, b)
            out.append((r["doc_id"], leaf, trees[s][-1][0], above[-1][0], digest(*[a + b for a, b in steps]), node, node == above[-1][0]))
    return sorted(out, key=repr)


def listed(frame):
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted([tuple(r) for r in frame.select(*names).collect()], key=repr)


def test_manifest_equals_sql(spark):
    df, con = queries.op12_merkle_manifest(spark, SF), connect(SF)
    assert spark_rows(df) == duck_rows(con, queries.OP12_SQL)


@pytest.mark.parametrize("digits,task_rows", [(3, 250_000), (1, 7)])
def test_manifest_over_tiers_and_tasks(spark, docs, monkeypatch, digits, task_rows):  # noqa: F811
    # Small blocks need several tiers, small tasks let a source go on over many of them.
    monkeypatch.setattr(merkle, "DIGITS", digits)
    monkeypatch.setattr(merkle, "TASK_ROWS", task_rows)
    hot = docs.withColumn("source", F.when(F.col("doc_id") % 3 == 0, "hot").when(F.col("doc_id") % 7 == 0, F.concat(F.lit("s"), "doc_id")).otherwise(F.col("source")))
    rows = hot.unionByName(hot.where("doc_id % 11 = 0"))  # repeated rows
    got = listed(merkle.manifest(rows))
    assert got == plain_manifest([r.asDict() for r in rows.collect()])
    assert {r[-1] for r in got} == {True, False}


def test_manifest_odd_rows(spark, odd):  # noqa: F811
    got = listed(merkle.manifest(clashing(odd, "RANK", "block", "steps", "leaf", "kids")))
    assert got == plain_manifest([r.asDict() for r in odd.collect()])
    assert merkle.manifest(odd.limit(0)).count() == 0
    one = odd.where("doc_id = 7")
    assert listed(merkle.manifest(one)) == plain_manifest([r.asDict() for r in one.collect()])


def plain_neighbours(rows, asked, k):
    """(vec_id, vector) -> {query_id: [(vec_id, score)]}, ties to the smaller id, rows without id last"""
    out = {}
    for q, v in asked:
        scored = sorted(((-float(np.dot(np.array(v, float), np.array(x, float))), i is None, i or 0) for i, x in rows if i != q))
        out[q] = [(None if gone else i, -s) for s, gone, i in scored[:k]]
    return out


def answers(frame):
    out = {}
    for r in sorted(frame.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def test_neighbours_recall_and_scores(spark):
    rows = [(r.vec_id, r.embedding) for r in table(spark, SF, "embeddings").collect()]
    want = plain_neighbours(rows, [r for r in rows if r[0] % 20 == 0], 20)
    got = answers(queries.op13_multi_index(spark, SF))
    assert got.keys() == want.keys()
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits / sum(len(w) for w in want.values()) >= 0.9
    vectors = {i: np.array(v, float) for i, v in rows}
    for q, found_ in got.items():
        assert len(found_) == 20 and all(abs(vectors[q] @ vectors[i] - s) < 1e-9 for i, s in found_)
        assert found_ == sorted(found_, key=lambda x: (-x[1], x[0]))


def test_neighbours_of_every_cell_are_exact(spark, monkeypatch):
    # With the whole table as budget nothing is left out, so hot cells, groups and parts must give the plain result.
    monkeypatch.setattr(multi_index, "GROUP_VALUES", 300)
    monkeypatch.setattr(multi_index, "PART_QUERIES", 3)
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.integers(-3, 4, 5)]) for i in range(300)]
    rows += [(1000 + i, [1.0, 2.0, 0.0, 0.0, 3.0]) for i in range(150)] + [(None, [2.0, 2.0, 2.0, 2.0, 2.0])] * 2 + rows[:4]
    rows = [r for r in rows if any(r[1])]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(4)
    got = answers(multi_index.nearest(frame, F.col("vec_id") % 20 == 0, k=7, target=1.0, index=None))
    asked = {i: v for i, v in rows if i is not None and i % 20 == 0}
    index = multi_index.fit(multi_index.usable(frame, "vec_id", "embedding"), multi_index.usable(frame.where("vec_id % 20 = 0"), "vec_id", "embedding"), len(asked), 7, 1.0)
    whole = multi_index.MultiIndex(index.dims, index.rows, index.books, index.counts, index.rows, 1.0)
    assert answers(multi_index.nearest(frame, F.col("vec_id") % 20 == 0, k=7, index=whole)) == plain_neighbours(rows, list(asked.items()), 7)
    assert got.keys() == asked.keys()


def test_traversal_goes_by_falling_sum():
    rng = np.random.default_rng(1)
    first, second = rng.normal(size=6), rng.normal(size=6)
    counts = rng.integers(0, 4, 36)
    index = multi_index.MultiIndex(2, int(counts.sum()), (np.zeros((6, 1)), np.zeros((6, 1))), counts, 20, 1.0)
    cells, end = index.traverse(first, second)
    sums = (first[:, None] + second[None, :]).ravel()
    order = [c for c in np.argsort(-sums) if counts[c]]
    n = int(np.searchsorted(np.cumsum(counts[order]), 20)) + 1
    assert cells == order[:n] and end == pytest.approx(sums[order[n - 1]])


def test_neighbours_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0, 0.0]), (20, [0.0, 1.0, 0.5]), (20, [0.0, 1.0, 0.5]), (1, None), (2, [nan, 1.0, 1.0]), (3, [inf, 1.0, 1.0]), (4, [0.0, 0.0, 0.0]), (5, []), (6, [1.0, None, 1.0]), (40, None), (7, [1.0, 2.0]), (8, [0.5, 0.5, 0.0])]
    frame = clashing(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>"), "CELL", "group", "vec", "id")
    got = answers(multi_index.nearest(frame, F.col("vec_id") % 20 == 0))
    assert got == {0: [(8, 0.5), (20, 0.0), (20, 0.0)], 20: [(8, 0.5), (0, 0.0)]}
    assert multi_index.nearest(frame.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    assert multi_index.nearest(frame.where("vec_id = 7"), F.col("vec_id") % 20 == 0).count() == 0
    alone = multi_index.nearest(frame.where("vec_id = 0"), F.col("vec_id") % 20 == 0)
    assert alone.count() == 0
    one = spark.createDataFrame([(0, [2.0]), (1, [3.0])], "vec_id bigint, embedding array<double>")
    assert answers(multi_index.nearest(one, F.col("vec_id") % 20 == 0)) == {0: [(1, 6.0)]}
