"""Page text, repeated byte strings, token matrices, licences and search against plain versions."""

import hashlib
import html
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerline.llm import best_fit, licences, queries, repeats, top_k, wrappers
from ledgerline.llm.common import table
from tests.llm.test_dedup_mix_pack import ODD, SF, clashing, odd  # noqa: F401
from tests.oracle import connect, duck_rows, spark_rows


def plain_repeats(rows, length=50):
    first, out = {}, {}
    data = sorted((i, (t or "").encode()) for i, t in rows)
    for i, b in data:
        for s in range(len(b) - length + 1):
            first.setdefault(b[s : s + length], i)
    for i, b in data:
        off = np.zeros(len(b), bool)
        for s in range(len(b) - length + 1):
            if first[b[s : s + length]] < i:
                off[s : s + length] = True
        runs = int((np.diff(np.r_[0, off.astype(int)]) == 1).sum())
        rest = bytes(x for x, o in zip(b, off) if not o)
        out[i] = (len(b), int(off.sum()), runs, hashlib.sha256(rest).hexdigest())
    return out


def repeats_of(frame):
    got = repeats.remove_repeats(frame).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("h")).collect()
    return [(r.doc_id, (r.n_bytes, r.n_removed, r.n_spans, r.h)) for r in got]


def test_repeats_against_plain(spark):
    docs = table(spark, SF, "documents")
    assert dict(repeats_of(docs)) == plain_repeats([(r.doc_id, r.text) for r in docs.collect()])


def test_repeats_compare_bytes(monkeypatch):
    """With a rank that all strings share, the bytes alone decide, and the result is the same."""
    rng = np.random.default_rng(8)
    n, wide = 300, repeats.LENGTH + repeats.REACH
    around = rng.integers(97, 123, (40, wide)).astype(np.uint8)[rng.integers(0, 40, n)]
    around[::7, -1] += 1
    ids, left, right = rng.integers(0, 90, n), rng.integers(0, repeats.REACH + 1, n), rng.integers(0, repeats.REACH + 1, n)
    got = repeats.covered_offsets(ids, left, right, around)
    owner: dict = {}
    strings = [(i, o, around[i, repeats.REACH - o :][: repeats.LENGTH].tobytes()) for i in range(n) for o in range(repeats.REACH + 1) if left[i] >= o and right[i] >= repeats.REACH - o]
    for i, o, x in strings:
        owner[o, x] = min(owner.get((o, x), ids[i]), ids[i])
    want = np.zeros_like(got)
    for i, o, x in strings:
        want[i, o] = ids[i] > owner[o, x]
    assert want.any() and (got == want).all()
    monkeypatch.setattr(repeats, "_mixed", lambda x: x & np.uint64(0))
    assert (repeats.covered_offsets(ids, left, right, around) == want).all()


def test_repeats_edges(spark):
    rng = np.random.default_rng(4)
    word = lambda n: "".join(rng.choice(list("abcdé"), n))
    passage = word(50)
    rows = [(1, word(30) + passage + word(9)), (2, passage), (3, passage[:49]), (4, "x" + passage + passage + "é"), (5, "ab" * 80), (6, "ab" * 60 + word(60)), (7, None), (8, "")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert dict(repeats_of(clashing(frame, "rank", "copy"))) == plain_repeats(rows)


def test_repeats_odd_rows(odd):  # noqa: F811
    got = repeats_of(odd)
    assert len(got) == len(ODD)
    assert all(v[1] == 0 for i, v in got if i is None)
    assert repeats_of(odd.limit(0)) == []


def test_page_text_against_plain(spark):
    got = {r.page_id: r.text for r in queries.op1_wrapper_text(spark, SF).collect()}
    for r in table(spark, SF, "pages").collect():
        inner = re.search(r"<article>(.*)</article>", r.html, re.S).group(1)
        inner = re.sub(r"<[^>]*>", "", re.sub(r"</?(p|br|h1)>", " ", inner))
        assert got[r.page_id] == " ".join(html.unescape(inner).split())


PAGE = """<!doctype html><html><head><title>t</title><script>if (a < b) "</p>"</script></head><body>
<header>Site</header><div class="cookie-notice">We use cookies</div><div id=box><p>Fixed line<p>{0} one &amp; two&nbsp;three
<div class="sidebar"><p>Side</div><p>{0} <b>bo</b>ld<br>next<form>Mail <input></form><section id="comments"><p>First!</section></div>
<footer>&copy; x</footer></body>"""


def test_page_text_without_article(spark):
    rows = [(i, f"http://h.example/{i}", PAGE.format(f"body{i}")) for i in range(12)]
    rows += [(90, None, None), (91, "http://other/", ""), (92, "not a url", "<p>alone &lt;tag&gt;<p>again"), (None, "http://h.example/x", PAGE.format("same"))]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = {r.page_id: (r.text, r.n_chars) for r in wrappers.extract_main_text(clashing(frame, "text", "host", "reference")).collect()}
    want = "body3 one & two three body3 bold next"
    assert got[3] == (want, len(want))
    assert got[90] == got[91] == ("", 0) and got[92][0] == "alone <tag> again" and got[None][0].startswith("same one")
    assert wrappers.extract_main_text(frame.limit(0)).count() == 0


TEASED = """<body><article class="teaser"><p>Read our new book, which we sell all year to all of our dear readers.</article>
<div id="x"><h2>Title {0}</h2><p>body {0} of the page<p>and more {0}</div><div>Made with care</div></body>"""


def test_page_text_follows_slots(spark):
    """The template decides, on hosts of few pages too: neither the article nor the lines around the slots are content."""
    rows = [(i, f"http://few.example/{i}", TEASED.format(f"n{i}")) for i in range(3)]
    rows += [(10 + i, "http://copies.example/", TEASED.format("same")) for i in range(12)]
    got = {r.page_id: r.text for r in wrappers.extract_main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert [got[i] for i in range(3)] == [f"Title n{i} body n{i} of the page and more n{i}" for i in range(3)]
    # Copies of one page tell nothing about it: all is slot, and the tag of the longer part decides.
    assert {got[10 + i] for i in range(12)} == {wrappers.main_text(wrappers.Tree(TEASED.format("same")), {}, set())}
    assert got[10].startswith("Read our new book") and "Title" not in got[10]


def test_page_text_holds_few_rows_and_trees(spark, monkeypatch):
    """A batch repeats its host's page and nodes in each row, and a task meets many hosts with long pages: neither is held whole."""
    steps: list = []
    frame = spark.createDataFrame([(1, "http://h/", "<p>x")], "page_id bigint, url string, html string")
    whole = type(frame).mapInArrow
    monkeypatch.setattr(type(frame), "mapInArrow", lambda self, run, schema: steps.append(run) or whole(self, run, schema))
    wrappers.extract_main_text(frame)
    monkeypatch.setattr(wrappers, "KEPT", 1 << 20, raising=False)
    monkeypatch.setattr(wrappers, "VOTES", 1000, raising=False)
    votes, texts = steps

    def measured(run, **columns):
        batch = pa.RecordBatch.from_pydict(columns)
        tracemalloc.start()
        try:
            out = sum(sum(b.column(b.num_columns - 1).to_pylist()) for b in run(iter([batch])))
            return out, tracemalloc.get_traced_memory()[1]
        finally:
            tracemalloc.stop()

    page = lambda i: f"<article><p>page {i}" + "<p>line" * 300 + "</article>"
    n = 80
    same, held = measured(votes, host=[f"h{i}" for i in range(n)], html=[page(i) for i in range(n)], reference=[page(-1 - i) for i in range(n)])
    assert (same, held < 8e6) == (300 * n, True)
    known = pa.array([[{"node": i, "constant": 1.0, "template": True} for i in range(1, 101)]], pa.list_(pa.struct({"node": pa.int64(), "constant": pa.float64(), "template": pa.bool_()})))
    n = 2000
    chars, held = measured(texts, c0=list(range(n)), c1=[""] * n, html=["<p>same<p>new"] * n, reference=["<p>same<p>old"] * n, nodes=pa.concat_arrays([known] * n))
    assert (chars, held < 8e6) == (len("new") * n, True)


@pytest.mark.parametrize(
    "given, want",
    [
        ('<article class="post has-sidebar"><p>body<p>text</article><div class="sidebar">s</div>', "body text"),
        ('<article><p>long body of text</p><section id="story-share-economy"><p>part</section><p class="share">x</article>', "long body of text part"),
        ('<div class="sidebar layout"><p>all of it</div><nav>n</nav>', "all of it"),
        ('<main class="banner"><h1>h</h1><p>most of the text</main><div class="comments"><p>first</div>', "h most of the text"),
        ('<article><p>short</article><section id="comments"><article class="comment">a long answer by a reader</article></section>', "short"),
        ("<div class=ad>only this", "only this"),
        ("<article></article><nav>menu</nav>", ""),
    ],
)
def test_names_do_not_drop_the_content(given, want):
    assert wrappers.main_text(wrappers.Tree(given), {}, set()) == want


def test_best_fit_matrix_is_lossless(spark, tmp_path):
    docs = table(spark, SF, "documents")
    matrix = best_fit.packed_matrix(docs)
    best_fit.write_matrix(matrix, str(tmp_path / "m"))
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {r.doc_id: [*tok.encode(r.text, add_special_tokens=False).ids, 0] for r in docs.collect()}
    got: dict = {i: {} for i in want}
    rows = spark.read.parquet(str(tmp_path / "m")).collect()
    for r in rows:
        ids, pos = np.frombuffer(r.ids, "<u4"), np.frombuffer(r.positions, "<u4")
        assert len(ids) == len(pos) == 1024 and not ids[r.n_tokens :].any()
        assert r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens and len(r.cu_seqlens) == len(r.segments) + 1
        for a, b, s in zip(r.cu_seqlens, r.cu_seqlens[1:], r.segments):
            assert b - a == s.length and pos[a:b].tolist() == list(range(b - a))
            got[s.doc_id][s.start] = ids[a:b].tolist()
    assert {i: [x for at in sorted(p) for x in p[at]] for i, p in got.items()} == want
    assert len({r.sequence_id for r in rows}) == len(rows) and sum(r.n_tokens for r in rows) / len(rows) > 0.9 * 1024


def test_best_fit_equals_plain_choice():
    rng = np.random.default_rng(6)
    lengths = rng.integers(1, 65, 300).tolist()
    rooms: list[int] = []
    for n in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= n]
        if fits:
            rooms.remove(min(fits))
        rooms.append((min(fits) if fits else 64) - n)
    rows = best_fit.best_fit(lengths, 64)
    assert sorted(64 - sum(lengths[i] for i in r) for r in rows) == sorted(rooms)
    assert sorted(i for r in rows for i in r) == list(range(300))


def test_best_fit_odd_rows(odd):  # noqa: F811
    out = best_fit.packed_matrix(clashing(odd, "segments")).select(F.explode("segments").alias("s")).select("s.*").collect()
    assert Counter(r.doc_id for r in out if r.start == 0) == Counter(r[0] for r in ODD)
    assert best_fit.packed_matrix(odd.limit(0)).count() == 0


@pytest.mark.parametrize("name", ["op8_licence_scan", "op9_top_k_search", "op10_exact_dedup"])
def test_query_equals_sql(spark, name):
    got, want = spark_rows(queries.QUERIES[name](spark, SF)), duck_rows(connect(SF), queries.ORACLES[name])
    assert got == want and got[1]


def test_licences_odd_rows(spark, odd):  # noqa: F811
    text = licences.TEMPLATES["MIT-grant"].replace(" to deal", "\nto deal").replace(" without", "\nwithout")
    rows = spark.createDataFrame([(1, f"intro\n\n{text}\n\nend"), (2, None), (3, "word"), (4, "Released under the  mit LICENSE!\nx")], "doc_id bigint, text string")
    got = [(r.doc_id, r.kind, r.unit, r.licence) for r in licences.find_licences(clashing(rows, "kind", "unit")).collect()]
    assert sorted(got) == [(1, "paragraph", 1, "MIT-grant"), (4, "line", 0, "MIT")]
    assert licences.find_licences(odd).count() == 0 and licences.find_licences(odd.limit(0)).count() == 0


@pytest.mark.parametrize("least", [0.5, 0.6, 0.7, 0.75, 0.8, 0.9, 0.95])
def test_licences_that_just_reach_the_coefficient(spark, least):
    """Units with all bigrams of a template and more, and units with a part of them: every size whose coefficient is enough counts."""
    name = [f"w{i}" for i in range(41)]
    templates = {f"T{n}": " ".join(name[: n + 1]) for n in range(1, 41)}
    units = [" ".join(name[: n + 1]) + "".join(f" x{i}" for i in range(more)) for n in range(1, 41) for more in (0, 1, 2, 5, 9)]
    got = licences.find_licences(spark.createDataFrame([(1, "\n".join(units))], "doc_id bigint, text string"), templates, least)
    want = {}
    for unit, text in enumerate(units):
        grams = set(licences.template_bigrams(text))
        for licence, template in templates.items():
            own = set(licences.template_bigrams(template))
            if (dice := 2.0 * len(grams & own) / (len(grams) + len(own))) >= least:
                want[unit, licence] = dice
    assert {(r.unit, r.licence): r.dice for r in got.collect()} == want and len(want) > 200


def test_search_odd_rows_and_shards(spark, odd):  # noqa: F811
    got = top_k.search(clashing(odd, "terms", "w"), F.col("doc_id") > 0, k=3, shard_postings=50, chunk_bytes=200).collect()
    by = {(r.query_id, r["rank"]): r.doc_id for r in got if r.query_id == 1}
    assert by == {(1, 1): None, (1, 2): 1, (1, 3): 2}
    assert not {r.query_id for r in got} & {3, 4, 5}
    assert top_k.search(odd.limit(0), F.col("doc_id") > 0).count() == 0
    docs = table(spark, SF, "documents")
    one, many = (top_k.search(docs, F.col("doc_id") % 50 == 0, shard_postings=n, chunk_bytes=m) for n, m in ((10**9, 10**9), (2_000, 3_000)))
    assert spark_rows(one) == spark_rows(many)


def test_search_skips_nothing_that_counts():
    """Shards met one after the other, with ties and repeated documents, give what scoring all of them gives."""
    rng = np.random.default_rng(11)
    texts = [np.unique(np.minimum(rng.zipf(1.3, rng.integers(1, 60)), 400)) for _ in range(900)]
    texts[500:520] = [texts[3]] * 20
    tfs = [rng.integers(1, 4, len(t)) for t in texts]
    tfs[500:520] = [tfs[3]] * 20
    ids, lengths = rng.permutation(900), np.array([int(n.sum()) for n in tfs])
    mean = float(lengths.mean())
    shards = []
    for from_ in range(0, 900, 300):
        part = slice(from_, from_ + 300)
        shards.append(top_k.Shard(ids[part], lengths[part], np.array([len(t) for t in texts[part]]), np.concatenate(texts[part]), np.concatenate(tfs[part]), mean))
    for q in range(0, 900, 30):
        weight = rng.random(len(texts[q])) * 5 + 0.1
        of = dict(zip(texts[q].tolist(), weight))
        want = []
        for i, t, n, length in zip(ids.tolist(), texts, tfs, lengths):
            hits = [of[x] * c * 2.2 / (c + 1.2 * (0.25 + 0.75 * length / mean)) for x, c in zip(t.tolist(), n.tolist()) if x in of]
            if hits:
                want.append((-round(sum(hits), 6), i))
        best = (np.zeros(0, np.int64), np.zeros(0))
        for shard in shards:
            best = shard.improve(best, texts[q], weight, 7)
        want = sorted(want)[:7]
        assert best[0].tolist() == [i for _, i in want] and np.allclose(best[1], [-s for s, _ in want], atol=2e-6)


def test_search_counts_words_of_few_rows_at_a_time(spark):
    """What a worker holds while it counts words does not follow the rows of a batch."""
    import tracemalloc

    class Rows:
        select, mapInArrow = (lambda self, *cols: self), (lambda self, run, schema: run)

    run = top_k.indexed(Rows(), "doc_id", "text")
    texts = [" ".join(f"w{i * j % 40_009}" for j in range(1, 101)) for i in range(1, 4_001)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(4_000), pa.int64()), pa.array([None, *texts[1:]])], names=["id", "text"])
    list(run(iter([batch])))  # fills what is kept between batches
    tracemalloc.start()
    lengths = [n for b in run(iter([batch])) for n in b.column(1).to_pylist()]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert lengths == [0] + [100] * 3_999 and peak < 20e6


def test_search_sends_no_rows_for_each_task(spark, monkeypatch):
    """Rows before the merge follow the queries, not the queries times the tasks; ids may repeat or be null."""
    word = F.concat(F.lit("w"), F.floor(F.pow(F.pmod(F.xxhash64("doc_id", "i"), F.lit(1000)) / 1000, 3) * 300).cast("string"))
    docs = spark.range(2_000, numPartitions=1).withColumnRenamed("id", "doc_id").withColumn("i", F.explode(F.sequence(F.lit(1), F.lit(25)))).select("doc_id", word.alias("w"))
    docs = docs.groupBy("doc_id").agg(F.concat_ws(" ", F.collect_list("w")).alias("text"))
    docs = docs.union(docs.where("doc_id < 40")).union(docs.where("doc_id < 40").withColumn("doc_id", F.lit(None).cast("long")))
    docs = docs.repartition(64).localCheckpoint()
    found, real = [], top_k._found
    monkeypatch.setattr(top_k, "_found", lambda *args: found.append(real(*args)) or found[-1])
    packed = "spark.sql.files.openCostInBytes", "spark.sql.files.maxPartitionBytes"
    for key in packed:
        spark.conf.set(key, "1k")
    try:
        many = {tuple(r) for r in top_k.search(docs, F.col("doc_id") % 20 == 0, shard_postings=2_000).collect()}
        before = sum(x.count() for x in found)
    finally:
        for key in packed:
            spark.conf.unset(key)
    one = {tuple(r) for r in top_k.search(docs.coalesce(1), F.col("doc_id") % 20 == 0, shard_postings=10**9).collect()}
    assert many == one and len(one) == 1_000
    assert before < 20_000


def test_crc_of_positions(spark):
    row = best_fit.matrix_digests(best_fit.packed_matrix(spark.createDataFrame([(1, "")], "doc_id bigint, text string"))).first()
    assert row.positions_crc32 == zlib.crc32(np.r_[0, np.arange(1023)].astype("<u4").tobytes()) and row.n_tokens == 1


def test_deep_and_long_pages(spark):
    deep = "<body><article><p>" + "<b>" * 5000 + "deep" + "</b>" * 5000 + "</p></article></body>"
    long = "<body><article>" + "".join(f"<p class='c{i % 7}'>line {i}</p>" for i in range(20_000)) + "</article></body>"
    other = "<body><article>" + "".join(f"<p class='c{i % 5}'>line {i}</p>" for i in range(15_000)) + "</article></body>"
    rows = [(1, "http://a.x/1", other), (2, "http://a.x/2", deep), (3, "http://a.x/3", long)]
    got = {r.page_id: r.text for r in wrappers.extract_main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert got[2] == "deep"
    assert got[3] == " ".join(f"line {i}" for i in range(20_000)) and got[1] == " ".join(f"line {i}" for i in range(15_000))


@pytest.mark.parametrize("n", [60, 600, 2_000])
def test_matching_is_one_at_any_length(n):
    """A child that moved from the start to the end costs one pair, however long the lists are."""
    lines = "".join(f"<p>line {i}</p>" for i in range(n))
    one, two = (wrappers.Tree(f"<body>{x}</body>") for x in (f"<h2>t</h2>{lines}", f"{lines}<h2>t</h2>"))
    pairs = wrappers.matched(one.root, two.root)
    assert sum(x.tag == "p" for x, _ in pairs) == n and not any(x.tag == "h2" for x, _ in pairs)


def test_matching_does_not_follow_the_kept_part(monkeypatch):
    pages = ["<body>" + "".join(f"<p class=c{i * i // k % 3}>{i}</p>" + "<div><p>x</div>" * (i % k == 1) for i in range(40)) + "</body>" for k in (3, 4, 5, 7)]

    def pairs():
        return [sorted((x.index, y.index) for x, y in wrappers.matched(wrappers.Tree(a).root, wrappers.Tree(b).root)) for a in pages for b in pages]

    whole = pairs()
    monkeypatch.setattr(wrappers, "TABLE", 20)
    assert pairs() == whole
