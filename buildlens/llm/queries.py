"""Registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..cluster import ship_code, table
from . import chat, ivfpq, langid, lines, middle, minhash, neighbours, packing, repetition, resampling, sentencepiece, toxicity, warc
from .store import shared_folder

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_file(name: str) -> str:
    """Place of a public tokenizer's file on this machine; every worker has it at the same place."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.judge(table(spark, sf_dir, "documents"))


def op3_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ivfpq.search(table(spark, sf_dir, "embeddings"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), digest=True)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.render(table(spark, sf_dir, "conversations"))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece.digests(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.duplicates(table(spark, sf_dir, "documents"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.dedup(table(spark, sf_dir, "documents")).select("doc_id", "text", F.size("removed").cast("long").alias("n_removed"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_folder(spark)}/tables-{spark.sparkContext.applicationId}/warc-{uuid.uuid4().hex}"
    warc.write(table(spark, sf_dir, "pages"), f"{folder}/streams")
    warc.normalise(spark, f"{folder}/streams", f"{folder}/records")
    found = warc.read(spark, f"{folder}/records", payload=False)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return middle.digests(middle.transform(table(spark, sf_dir, "documents")))


def _shipped(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_code(spark)
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Query]:
    found = [
        op1_language_id, op2_quality_rules, op3_nearest_vectors, op4_packing, op5_toxicity, op6_chat_format, op7_sentencepiece,
        op8_near_duplicates, op9_line_dedup, op10_quality_classifier, op11_warc, op12_importance_resampling, op13_fill_in_middle,
    ]
    return {q.__name__: _shipped(q) for q in found}


OP6_SQL = """
WITH ordered AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
  FROM conversations),
prefixes AS (
  SELECT conv_id, place, list({'r': role, 't': text}) OVER (PARTITION BY conv_id ORDER BY place ROWS UNBOUNDED PRECEDING) AS said,
         lead(place) OVER (PARTITION BY conv_id ORDER BY place) IS NULL AS last
  FROM ordered),
hashed AS (SELECT conv_id, place, last, md5(said::VARCHAR) AS h FROM prefixes),
whole AS (SELECT min(conv_id) AS conv_id, place AS n_turns, h, count(*) AS copies FROM hashed WHERE last GROUP BY place, h),
kept AS (SELECT conv_id, n_turns, copies FROM whole w
         WHERE NOT EXISTS (SELECT 1 FROM hashed p WHERE NOT p.last AND p.place = w.n_turns AND p.h = w.h))
SELECT k.conv_id, k.n_turns, k.copies,
       string_agg('<|' || o.role || '|>' || chr(10) || o.text || chr(10) || '<|end|>' || chr(10), '' ORDER BY o.place) AS rendered
FROM kept k JOIN ordered o ON o.conv_id = k.conv_id
GROUP BY k.conv_id, k.n_turns, k.copies
"""

OP8_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, list_slice(w, i, i + 4)::VARCHAR AS s
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 4, least(len(w), 1)))) AS i FROM words)),
sizes AS (SELECT doc_id, count(*) AS n, md5(string_agg(s, chr(0) ORDER BY s)) AS h FROM shingles GROUP BY doc_id),
classes AS (SELECT min(doc_id) AS node, h, any_value(n) AS n FROM sizes GROUP BY h),
own AS (SELECT c.node, c.n, s.s FROM classes c JOIN shingles s ON s.doc_id = c.node),
links AS (
  SELECT a.node AS a, b.node AS b FROM own a JOIN own b ON a.s = b.s AND a.node < b.node AND 100 * least(a.n, b.n) >= 75 * greatest(a.n, b.n)
  GROUP BY a.node, b.node, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT node AS a, node AS b FROM classes UNION SELECT r.a, e.b FROM reach r JOIN edges e ON e.a = r.b),
component AS (SELECT a AS node, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, coalesce(c.component_id, d.doc_id) AS component_id, d.doc_id = coalesce(c.component_id, d.doc_id) AS kept
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN classes k ON k.h = s.h LEFT JOIN component c ON c.node = k.node
"""

OP9_SQL = r"""
WITH lines AS (
  SELECT doc_id, generate_subscripts(l, 1) AS line_no, unnest(l) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)),
worded AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY line_no) AS place,
         sum(n) OVER (PARTITION BY doc_id ORDER BY line_no ROWS UNBOUNDED PRECEDING) AS total
  FROM (SELECT *, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n FROM lines) WHERE n > 0),
runs AS (
  SELECT a.doc_id, a.place AS start, min(b.place) AS stop FROM worded a JOIN worded b ON b.doc_id = a.doc_id AND b.place >= a.place AND b.total - a.total + a.n >= 50
  GROUP BY a.doc_id, a.place
  UNION
  SELECT b.doc_id, max(a.place) AS start, b.place AS stop FROM worded a JOIN worded b ON b.doc_id = a.doc_id AND b.place >= a.place AND b.total - a.total + a.n >= 50
  GROUP BY b.doc_id, b.place),
named AS (
  SELECT r.doc_id, r.start, r.stop, md5(string_agg(w.line, chr(10) ORDER BY w.place)) AS h
  FROM runs r JOIN worded w ON w.doc_id = r.doc_id AND w.place BETWEEN r.start AND r.stop GROUP BY r.doc_id, r.start, r.stop),
later AS (SELECT doc_id, start, stop FROM (SELECT *, row_number() OVER (PARTITION BY h ORDER BY doc_id, start) AS k FROM named) WHERE k > 1),
gone AS (SELECT DISTINCT w.doc_id, w.line_no FROM later r JOIN worded w ON w.doc_id = r.doc_id AND w.place BETWEEN r.start AND r.stop),
kept AS (
  SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.line_no) FILTER (g.line_no IS NULL) AS text, count(g.line_no) AS n_removed
  FROM lines l LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.line_no = l.line_no GROUP BY l.doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text, coalesce(k.n_removed, 0) AS n_removed
FROM documents d LEFT JOIN kept k ON k.doc_id = d.doc_id
"""


OP11_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html) AS n, sha1(html) AS h, max(page_id) OVER (PARTITION BY html) AS newest FROM p)
SELECT page_id, n AS payload_bytes, h AS payload_digest, CASE WHEN n >= 1000 AND newest <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND newest <> page_id THEN newest END AS refers_to
FROM d
"""

OP12_SQL = r"""
WITH crc_table AS (
  SELECT list(list_reduce(list_concat([n], range(8)), lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY n) AS step FROM range(256) r(n)),
texts AS (SELECT doc_id AS id, text, false AS target FROM documents UNION ALL SELECT item_id, text, true FROM benchmark),
found AS (
  SELECT id, target, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM texts),
bytes AS (
  SELECT w, list_transform(range(strlen(w)), lambda i: ('0x' || substr(hex(encode(w)), (2 * i + 1)::INT, 2))::BIGINT) AS b FROM (SELECT DISTINCT w FROM found)),
hashed AS (
  SELECT w, xor(list_reduce(list_concat([4294967295::BIGINT], b), lambda c, x: xor(c >> 8, step[1 + (xor(c, x) & 255)])), 4294967295) % 10000 AS bucket FROM bytes, crc_table),
features AS (SELECT id, target, bucket FROM found JOIN hashed USING (w)),
counts AS (SELECT bucket, count(*) FILTER (NOT target) AS s, count(*) FILTER (target) AS t FROM features GROUP BY bucket),
totals AS (SELECT sum(s)::DOUBLE AS s_all, sum(t)::DOUBLE AS t_all FROM counts),
gains AS (SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (s_all + 10000) / ((s + 1)::DOUBLE * (t_all + 10000))))::BIGINT AS gain FROM counts, totals),
weights AS (SELECT id, count(*) AS n, sum(gain) AS weight FROM features JOIN gains USING (bucket) WHERE NOT target GROUP BY id),
scored AS (
  SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0)::BIGINT AS weight,
         coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln((('0x' || sha256('2024:' || doc_id)[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM documents LEFT JOIN weights ON id = doc_id),
ordered AS (SELECT *, CASE WHEN n_features >= 20 THEN row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) END AS k FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN k <= (SELECT 10 * count(k) // 100 FROM ordered) THEN k END AS rank FROM ordered
"""

OP13_SQL = r"""
WITH cuts AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u, sha256('7:' || doc_id) AS h FROM documents),
drawn AS (
  SELECT *, len(u) AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2, ('0x' || h[25:32])::BIGINT AS h4 FROM cuts),
parts AS (
  SELECT doc_id, text, n, least(h1 % (n + 1), h2 % (n + 1)) AS low, greatest(h1 % (n + 1), h2 % (n + 1)) AS high, u,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn),
cut AS (
  SELECT doc_id, text, n, form, array_to_string(u[:low], '') AS p, array_to_string(u[low + 1:high], '') AS m, array_to_string(u[high + 1:], '') AS s FROM parts)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM cut
"""


def oracle_sql() -> dict[str, str]:
    """Queries that SQL can express on whole tables; the others are tested against brute force."""
    return {
        "op6_chat_format": OP6_SQL, "op8_near_duplicates": OP8_SQL, "op9_line_dedup": OP9_SQL,
        "op11_warc": OP11_SQL, "op12_importance_resampling": OP12_SQL, "op13_fill_in_middle": OP13_SQL,
    }
