"""Registered queries of the operators in this folder, and SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import best_fit, curve_packing, exact_dedup, lexical, licences, merkle, mixing, multi_index, near_dedup, quality, repeats, top_k, wrappers
from ledgerline.llm.common import table


def op1_wrapper_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.extract_main_text(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "source", *mixing.OUT)


def op3_quality_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.classify(docs, model).select("doc_id", *quality.OUT)


def op4_odd_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), words=4)


def op5_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curve_packing.piece_digests(curve_packing.pack_along_curve(table(spark, sf_dir, "documents")))


def op6_prefix_doubling(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op7_best_fit_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit.matrix_digests(best_fit.packed_matrix(table(spark, sf_dir, "documents")))


def op8_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.find_licences(table(spark, sf_dir, "documents"))


def op9_top_k_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k.search(table(spark, sf_dir, "documents"), F.col("doc_id") % 50 == 0)


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    digest = F.sha2(exact_dedup.normalised("text"), 256)
    out = exact_dedup.with_verdict(docs, carry={"doc_id": F.col("doc_id"), "text_sha256": digest})
    return out.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op11_aho_corasick(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents")).drop("source")


def op13_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


OP10_SQL = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM t WINDOW w AS (PARTITION BY norm)
"""


def _values(rows: list[tuple[str, str]]) -> str:
    return ", ".join("('{}', '{}')".format(*(v.replace("'", "''") for v in row)) for row in rows)


OP8_SQL = rf"""
WITH template AS (
  SELECT licence, list(bigram) AS grams, count(*) AS n
  FROM (VALUES {_values([(n, g) for n, t in licences.TEMPLATES.items() for g in licences.template_bigrams(t)])}) v(licence, bigram) GROUP BY licence),
parts AS (
  SELECT doc_id, 'line' AS kind, string_split(text, chr(10)) AS p FROM documents
  UNION ALL SELECT doc_id, 'paragraph', string_split(text, chr(10) || chr(10)) FROM documents WHERE contains(text, chr(10) || chr(10))),
units AS (SELECT doc_id, kind, unnest(p) AS t, generate_subscripts(p, 1) - 1 AS unit FROM parts),
words AS (
  SELECT doc_id, kind, unit, regexp_extract_all(translate(t, '{licences.UPPER}', '{licences.LOWER}'), '[a-z0-9]+') AS w
  FROM units WHERE kind = 'line' OR contains(t, chr(10))),
grams AS (SELECT doc_id, kind, unit, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS g FROM words WHERE len(w) > 1),
scored AS (
  SELECT doc_id, kind, unit, licence, 2.0::DOUBLE * len(list_intersect(g, grams)) / (len(g) + n) AS dice
  FROM grams JOIN template ON len(g) BETWEEN n / 1.5 - 0.001 AND n * 1.5 + 0.001)
SELECT doc_id, kind, unit, licence, dice FROM scored WHERE dice >= 0.8
"""

OP9_SQL = rf"""
WITH found AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, '{licences.UPPER}', '{licences.LOWER}'), '[^\x00-\x20!-/:-@\[-`{{-~\x7f]+')) AS term FROM documents),
posting AS (SELECT doc_id, term, count(*) AS tf FROM found GROUP BY ALL),
lengths AS (SELECT doc_id, sum(tf) AS len FROM posting GROUP BY doc_id),
totals AS (SELECT count(*) AS n, (SELECT sum(len) FROM lengths) / count(*) AS mean FROM documents),
frequency AS (SELECT term, ln(1 + (any_value(n) - count(*) + 0.5) / (count(*) + 0.5)) AS idf FROM posting, totals GROUP BY term),
scored AS (
  SELECT q.doc_id AS query_id, p.doc_id,
         round(sum(q.tf * idf * p.tf * 2.2 / (p.tf + 1.2 * (0.25 + 0.75 * len / mean))), 6) AS score
  FROM posting q JOIN posting p USING (term) JOIN frequency USING (term) JOIN lengths l ON l.doc_id = p.doc_id, totals
  WHERE q.doc_id % 50 = 0 GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM scored)
SELECT query_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""

OP11_SQL = rf"""
WITH low AS (SELECT doc_id, regexp_extract_all(translate(text, '{licences.UPPER}', '{licences.LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
kept AS (SELECT row_number() OVER () AS row, doc_id, w, len(w) AS n FROM low WHERE len(w) > 0),
totals AS (SELECT count(*) AS docs, sum(n)::BIGINT AS length FROM kept),
posting AS (SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(w) AS term FROM kept) GROUP BY ALL),
items AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, '{licences.UPPER}', '{licences.LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
weights AS (
  SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS weight FROM posting, totals GROUP BY term),
scored AS (
  SELECT item_id, row, sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // length))))::BIGINT AS score
  FROM items JOIN posting USING (term) JOIN weights USING (term) JOIN kept USING (row), totals GROUP BY ALL),
ranked AS (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST)::INTEGER AS rank
  FROM scored JOIN kept USING (row) WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
"""


def _field(name: str) -> str:
    return f"coalesce(strlen({name}::VARCHAR) || ':' || {name}::VARCHAR, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(text if c == "text" else _field(c) for c in merkle.FIELDS) + ")"


#: CRC-32 of a short ASCII string by its bits, since DuckDB has no such function.
_CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
  lambda crc, c: list_reduce(list_prepend(xor(crc, c), range(8)), lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)))"""

OP12_SQL = rf"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, source, {_leaf(_field("text"))} AS leaf,
         CASE WHEN {_CRC32} % 5 = 0 THEN {_leaf(_field(f"translate(text, '{licences.UPPER}', '{licences.LOWER}')"))} ELSE {_leaf(_field("text"))} END AS bent
  FROM documents),
placed AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM leaves),
-- Each level of each source as one list of nodes; the tree of the subroots follows in the same way.
level AS (
  SELECT source, 0 AS height, list(leaf ORDER BY place) AS nodes FROM placed GROUP BY source
  UNION ALL
  SELECT source, height + 1, list_transform(range(0, len(nodes), 16), lambda i: sha256(array_to_string(nodes[i + 1 : i + 16], ''))) FROM level WHERE len(nodes) > 1),
subroot AS (SELECT source, nodes[1] AS subroot, row_number() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS spot FROM level WHERE len(nodes) = 1),
above AS (
  SELECT 0 AS height, list(subroot ORDER BY spot) AS nodes FROM subroot
  UNION ALL
  SELECT height + 1, list_transform(range(0, len(nodes), 16), lambda i: sha256(array_to_string(nodes[i + 1 : i + 16], ''))) FROM above WHERE len(nodes) > 1),
root AS (SELECT nodes[1] AS root FROM above WHERE len(nodes) = 1),
inside AS (
  SELECT doc_id, source, leaf, 0 AS height, place, bent AS node, '' AS proof, place AS id FROM placed
  UNION ALL
  SELECT doc_id, i.source, leaf, i.height + 1, place // 16,
         sha256(array_to_string(nodes[place // 16 * 16 + 1 : place], '') || node || array_to_string(nodes[place + 2 : place // 16 * 16 + 16], '')),
         proof || array_to_string(nodes[place // 16 * 16 + 1 : place], '') || array_to_string(nodes[place + 2 : place // 16 * 16 + 16], ''), id
  FROM inside i JOIN level l ON l.source IS NOT DISTINCT FROM i.source AND l.height = i.height AND len(nodes) > 1),
up AS (
  SELECT doc_id, t.source, leaf, 0 AS height, spot AS place, node, proof, id, subroot
  FROM (SELECT *, row_number() OVER (PARTITION BY source, id ORDER BY height DESC) AS last FROM inside) t JOIN subroot s ON s.source IS NOT DISTINCT FROM t.source WHERE last = 1
  UNION ALL
  SELECT doc_id, source, leaf, u.height + 1, place // 16,
         sha256(array_to_string(nodes[place // 16 * 16 + 1 : place], '') || node || array_to_string(nodes[place + 2 : place // 16 * 16 + 16], '')),
         proof || array_to_string(nodes[place // 16 * 16 + 1 : place], '') || array_to_string(nodes[place + 2 : place // 16 * 16 + 16], ''), id, subroot
  FROM up u JOIN above a ON a.height = u.height AND len(nodes) > 1),
done AS (SELECT *, row_number() OVER (PARTITION BY source, id ORDER BY height DESC) AS last FROM up)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, node AS folded_root, node = root AS verified FROM done, root WHERE last = 1
"""

QUERIES = {
    f.__name__: f for f in (op1_wrapper_text, op2_mix_sources, op3_quality_votes, op4_odd_sketches, op5_curve_packing, op6_prefix_doubling, op7_best_fit_matrix, op8_licence_scan, op9_top_k_search, op10_exact_dedup, op11_aho_corasick, op12_merkle_manifest, op13_multi_index)
}
ORACLES = {"op8_licence_scan": OP8_SQL, "op9_top_k_search": OP9_SQL, "op10_exact_dedup": OP10_SQL, "op11_aho_corasick": OP11_SQL, "op12_merkle_manifest": OP12_SQL}
