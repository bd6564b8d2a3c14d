"""Exact and near duplicates, mixing, quality votes and curve packing against plain versions."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from ledgerline.llm import curve_packing, exact_dedup, mixing, near_dedup, quality, queries
from ledgerline.llm.common import table
from tests.llm import brute

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
SF = "/root/testdata/sf0.01"

ODD = [
    (1, "same text here", "en", "a", 14),
    (2, "same  text\there", "en", "a", 14),
    (2, "same  text\there", "en", "a", 14),
    (3, None, None, None, None),
    (4, "", "en", None, 0),
    (5, " ", "en", "b", 1),
    (None, "same text here", "en", "b", 14),
    (None, "no id", "en", "b", 5),
    (6, "word " * 30_000, "en", "a", 150_000),
    (7, "word " * 30_000 + "end", "en", "a", 150_003),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, SF, "documents")


def clashing(df, *names):
    for n in names:
        df = df.withColumn(n, F.lit("theirs"))
    return df


def test_exact_dedup_against_plain(spark, docs):
    want = brute.exact([(r.doc_id, r.text) for r in docs.collect()])
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in queries.op10_exact_dedup(spark, SF).collect()}
    assert got == want


def test_exact_dedup_odd_rows(odd):
    got = [(r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.with_verdict(clashing(odd, "KEEP_ID", "_length")).collect()]
    assert Counter(got) == Counter([
        (1, 1, 4, True), (2, 1, 4, False), (2, 1, 4, False), (None, 1, 4, False), (3, 3, 2, True), (4, 3, 2, False),
        (5, 5, 1, True), (None, None, 1, True), (6, 6, 1, True), (7, 7, 1, True),
    ])
    again = odd.union(odd)
    left = exact_dedup.drop_exact_duplicates(clashing(again, "_id", "kept"))
    assert sorted(r.doc_id for r in left.collect() if r.doc_id) == [1, 3, 5, 6, 7]
    assert left.columns == clashing(odd, "_id", "kept").columns
    assert exact_dedup.with_verdict(odd.limit(0)).count() == 0


@pytest.mark.parametrize("words", [4, 5])
def test_near_duplicates_against_plain(spark, docs, words):
    want = brute.near([(r.doc_id, r.text) for r in docs.collect()], words)
    got = near_dedup.near_duplicates(docs, words)
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got.collect()} == want


def test_near_duplicates_chain_and_blocks(spark, monkeypatch):
    """A chain in which only neighbours are similar, met in blocks smaller than a bucket."""
    monkeypatch.setattr(near_dedup, "BLOCK", 4)
    rng = np.random.default_rng(1)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(60):
        words[(i * 6) % 400 : (i * 6) % 400 + 6] = [f"x{i}_{j}" for j in range(6)]
        rows.append((int(rng.integers(10**6)) * 100 + i, " ".join(words)))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_duplicates(frame, 4).collect()}
    assert got == brute.near(rows, 4)
    assert len({c for _, c, _ in got.values()}) == 1


def test_near_duplicates_odd_rows(odd):
    got = near_dedup.near_duplicates(clashing(odd, "component_id", "h"), 4).collect()
    assert len(got) == len(ODD)
    by = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got if r.doc_id}
    assert by == {1: (1, 1, True), 2: (1, 1, False), 3: (0, 3, True), 4: (0, 4, True), 5: (0, 5, True), 6: (1, 6, True), 7: (2, 7, True)}
    assert [r.component_id for r in got if r.doc_id is None] == [None, None]
    assert near_dedup.near_duplicates(odd.limit(0)).count() == 0


def test_odd_sketch_counts_differing_samples():
    rng = np.random.default_rng(2)
    a = rng.integers(0, 2**64, near_dedup.SAMPLES, np.uint64)
    b = a.copy()
    b[:20] = rng.integers(0, 2**64, 20, np.uint64)
    bits = np.bitwise_count(near_dedup.odd_sketch(a).view(np.uint64) ^ near_dedup.odd_sketch(b).view(np.uint64)).sum()
    assert 25 <= bits <= 40
    assert not (near_dedup.odd_sketch(a) ^ near_dedup.odd_sketch(a)).any()


def test_edf_period_equals_plain_and_stays_within_one_block():
    shares = mixing.period_shares({"a": 5.0, "b": 2.5, "c": 1.0, "d": 0.01}, 128)
    taken = mixing.edf_period(shares)
    order = sorted((t, s) for s, at in taken.items() for t in at)
    assert [s for _, s in order] == brute.earliest_deadline(shares, 128)
    assert [t for t, _ in order] == list(range(128))
    done = Counter()
    for t, s in order:
        done[s] += 1
        assert all(abs(done[x] - (t + 1) * shares[x] / 128) < 1 for x in shares)


def test_mix_holds_weights_until_a_source_ends(spark, docs):
    got = mixing.mix_sources(docs, {f"src{i}": i + 1 for i in range(20)}, block=2).collect()
    assert len(got) == docs.count() and len({r.position for r in got}) == len(got)
    slots = {(r.slot, r.source) for r in got if r.in_mix}
    end = len(slots)
    assert {t for t, _ in slots} == set(range(end)) and end > 50
    done = Counter()
    for t, s in sorted(slots):
        done[s] += 1
        assert all(abs(done[f"src{i}"] - (t + 1) * (i + 1) / 210) < 1.1 for i in range(20))
    for s in {r.source for r in got}:
        assert sorted(r.block for r in got if r.source == s) == [i // 2 for i in range(50)]


def test_mix_of_all_rows_against_plain(spark, docs):
    """Every row's block, slot, position and part in the mix, from plain numbering and a plain schedule."""
    hashed = docs.select("doc_id", "source", F.xxhash64("doc_id", "text", F.lit(17)).alias("h")).collect()
    by = {}
    for r in hashed:
        by.setdefault("null" if r.source is None else f"={r.source}", []).append((r.h % 256, r.h, r.doc_id))
    shares = mixing.period_shares({s: len(x) ** 0.7 for s, x in by.items()}, 1024)
    turns = {s: [i for i, owner in enumerate(brute.earliest_deadline(shares, 1024)) if owner == s] for s in shares}

    def slot_of(s, block):
        return block // shares[s] * 1024 + turns[s][block % shares[s]]

    end = min(slot_of(s, -(-len(x) // 8)) for s, x in by.items())
    want = {}
    for s, x in by.items():
        for r, (_, _, i) in enumerate(sorted(x)):
            slot = slot_of(s, r // 8)
            want[i] = (r // 8, slot, slot * 8 + r % 8, slot < end)
    got = {r.doc_id: (r.block, r.slot, r.position, r.in_mix) for r in mixing.mix_sources(docs).collect()}
    assert got == want and any(w[3] for w in want.values())


def test_mix_odd_rows(odd):
    got = mixing.mix_sources(clashing(odd, "Slot"), block=1).collect()
    assert len(got) == len(ODD)
    assert mixing.mixture(odd).columns == odd.columns
    assert mixing.mix_sources(odd.limit(0)).count() == 0
    with pytest.raises(ValueError, match="without a weight"):
        mixing.mix_sources(odd, {"a": 1.0})


def test_quality_held_out_accuracy(spark):
    got = queries.op3_quality_votes(spark, SF)
    labels = table(spark, SF, "labels")
    rows = got.join(labels, "doc_id").where("held_out").collect()
    right = sum(r.predicted == r.quality for r in rows)
    assert len(rows) > 50 and right / len(rows) >= 0.95
    assert got.where("score < 0 OR score > 1 OR predicted != IF(score >= 0.3, 1, 0)").isEmpty()


def test_quality_votes_against_plain(spark, docs):
    """Every score from cosines taken one by one with the vectors of labelled rows that are not held out."""
    rows = docs.select("doc_id", "text").collect()
    text = {r.doc_id: r.text for r in rows}
    labels = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    learned = [i for i in sorted(labels, key=str) if labels[i] is not None and i in text and zlib.crc32(str(i).encode()) % 5]
    model = quality.fit(docs, table(spark, SF, "labels"))
    assert model.labels.tolist() == [labels[i] for i in learned]
    spread = [math.log((1 + len(learned)) / (1 + n)) + 1 for n in sum((quality.counts_of(text[i]) > 0).astype(int) for i in learned)]

    def vector(t):
        x = (quality.counts_of(t) * np.array(spread)) @ model.project.astype(np.float64)
        return x / (math.sqrt(sum(v * v for v in x)) or 1.0)

    known = [(vector(text[i]), labels[i]) for i in learned]
    got = {r.doc_id: r for r in queries.op3_quality_votes(spark, SF).collect()}
    assert len(got) == len(rows)
    for i, t in text.items():
        mine = vector(t)
        near = sorted(((float(mine @ v), y) for v, y in known), key=lambda p: -p[0])
        # Equal similarities to the last one vote as well.
        near = [(max(c, 0.0) ** 8, y) for c, y in near if c >= near[24][0] - 1e-9]
        total = sum(w for w, _ in near)
        want = sum(w * y for w, y in near) / total if total and (t or "").split() else sum(y for _, y in known) / len(known)
        assert abs(got[i].score - want) < 1e-3, i
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and got[i].predicted == int(got[i].score >= 0.3)


def test_quality_odd_rows(spark, odd):
    labels = spark.createDataFrame([(1, 1), (1, 0), (6, 0), (99, 1), (None, 1), (4, None)], "doc_id bigint, quality int")
    model = quality.fit(odd, labels)
    got = quality.classify(clashing(odd, "SCORE"), model).collect()
    assert len(got) == len(ODD)
    assert {r.score for r in got if not (r.text or "").strip()} == {model.prior}
    none = quality.fit(odd, labels.limit(0))
    assert {r.score for r in quality.classify(odd, none).collect()} == {0.5}
    assert quality.classify(odd.limit(0), none).count() == 0


def check_pieces(rows, texts):
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {i: [*tok.encode(t or "", add_special_tokens=False).ids, 0] for i, t in texts}
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
        assert r.ids_crc32 == brute.crc32(ids[r.doc_id][r.start : r.start + r.length]) and r.doc_tokens == len(ids[r.doc_id])
    assert by_doc.keys() == ids.keys()
    for i, pieces in by_doc.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r.start):
            assert r.start == at and r.length > 0
            at += r.length
        assert at == len(ids[i])
    for pieces in by_seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024
    return by_seq


def test_curve_packing_is_lossless_and_dense(spark, docs):
    by_seq = check_pieces(queries.op5_curve_packing(spark, SF).collect(), [(r.doc_id, r.text) for r in docs.collect()])
    assert sum(sum(r.length for r in p) < 1024 for p in by_seq.values()) <= 1


def test_curve_packing_odd_rows(spark, odd):
    rows = odd.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]).withColumn("text", F.when(F.col("doc_id") == 5, F.lit("a  b\n c<|endoftext|> d")).otherwise(F.col("text")))
    got = curve_packing.piece_digests(curve_packing.pack_along_curve(clashing(rows, "ids", "key"))).collect()
    check_pieces(got, [(r.doc_id, r.text) for r in rows.collect()])
    assert curve_packing.pack_along_curve(odd.limit(0)).count() == 0
    assert curve_packing.pack_along_curve(odd).where("doc_id IS NULL").count() > 0


def test_hilbert_neighbours_differ_by_one_step():
    bits = 3
    grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * 4, indexing="ij"), -1).reshape(-1, 4)
    key = curve_packing.hilbert_index(grid, bits)
    order = grid[np.argsort(key)]
    assert sorted(key) == list(range(len(grid)))
    assert (np.abs(np.diff(order, axis=0)).sum(1) == 1).all()


def test_pipeline_stages_against_plain(spark):
    docs = table(spark, SF, "documents")
    text = {r.doc_id: r.text for r in docs.collect()}
    bad = {r.doc_id for r in table(spark, SF, "labels").where("quality = 0").collect()}
    good = corpus_pipeline.drop_low_quality(spark, docs, SF).cache()
    ids = {r.doc_id for r in good.collect()}
    assert good.columns == docs.columns and not ids & bad and len(text) - len(ids) < 0.25 * len(text)
    once = corpus_pipeline.drop_exact_copies(spark, good, SF).cache()
    kept = {r.doc_id for r in once.collect()}
    assert kept == {i for i, v in brute.exact([(i, text[i]) for i in ids]).items() if v[2]}
    apart = corpus_pipeline.drop_near_copies(spark, once, SF).cache()
    left = {r.doc_id for r in apart.collect()}
    assert left == {i for i, v in brute.near([(i, text[i]) for i in kept], 5).items() if v[2]}
    mixed = {r.doc_id for r in corpus_pipeline.mix(spark, apart, SF).collect()}
    assert mixed <= left and len(mixed) > 0.5 * len(left)
    packed = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in packed} == mixed
    check_pieces(packed, [(i, text[i]) for i in mixed])


def test_pipeline_on_an_empty_table(spark, odd):
    empty = odd.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0


def test_inner_names_of_exact_dedup_may_be_columns(odd):
    names = ("_id", "_member", "_same", "_m_length", "_head", "_n")
    got = exact_dedup.with_verdict(clashing(odd, *names))
    assert got.where("_member = 'theirs' AND _m_length = 'theirs' AND _n = 'theirs' AND _same >= 1").count() == len(ODD)
    plain = exact_dedup.with_verdict(odd)
    assert Counter(got.select(plain.columns).collect()) == Counter(plain.collect())


def test_inner_names_of_mixing_may_be_columns(odd):
    names = ("a", "P", "_s", "_h", "_r", "_b", "_t", "s", "t", "Slot")
    plain = mixing.mix_sources(odd)
    got = mixing.mix_sources(clashing(odd, *names))
    assert [c for c in got.columns if c in names] == [n for n in names if n != "Slot"]
    assert got.where(" AND ".join(f"{n} = 'theirs'" for n in names if n != "Slot")).count() == len(ODD)
    assert Counter(got.select(plain.columns).collect()) == Counter(plain.collect())
    assert mixing.mix_sources(odd.withColumnRenamed("source", "s"), source_col="s").columns[3] == "s"
