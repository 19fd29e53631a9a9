"""The registered queries of this subpackage: each applies one operator to its whole table, with production settings.

A query names the operator's columns as its contract asks. ``SQL`` holds the same results as DuckDB SQL where SQL can
express them; the tests compare the other queries with brute force.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import chunks, codes, decontaminate, divergence, lines, mixing, ngrams, parity, quality, simhash, templates, urls, warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.compare_edited(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op2_page_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = templates.main_texts(table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op3_url_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages")).withColumnRenamed("id", "page_id")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    found = lines.with_frequent_lines(docs, "source", "text")
    return found.select("doc_id", "source", F.col("kept").alias("text"), "n_lines", "n_dropped")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.mix_sources(table(spark, sf_dir, "documents"))
    return mix.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def op6_parity_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = parity.document_components(table(spark, sf_dir, "documents"), words=3, percent=90)
    return found.withColumnRenamed("id", "doc_id")


def op7_gear_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = chunks.repeated_passages(table(spark, sf_dir, "documents"))
    return found.withColumnsRenamed({"id": "doc_id", "first_id": "first_doc_id"})


def op8_zstd_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.withColumnRenamed("id", "doc_id")


def op9_qgram_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.withColumnRenamed("id", "doc_id")


def op10_zip_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(spark, table(spark, sf_dir, "pages"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = codes.compress(table(spark, sf_dir, "embeddings"))
    return found.drop("label").withColumnRenamed("id", "vec_id")


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op13_trie_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngrams.score_documents(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_page_templates": op2_page_templates,
    "op3_url_models": op3_url_models,
    "op4_line_dedup": op4_line_dedup,
    "op5_mixing": op5_mixing,
    "op6_parity_join": op6_parity_join,
    "op7_gear_chunks": op7_gear_chunks,
    "op8_zstd_quality": op8_zstd_quality,
    "op9_qgram_leaks": op9_qgram_leaks,
    "op10_zip_warc": op10_zip_warc,
    "op11_vector_codes": op11_vector_codes,
    "op12_source_divergence": op12_source_divergence,
    "op13_trie_scores": op13_trie_scores,
}


def _assignment(turn: int) -> str:
    """Each part's nearest entry of codebook ``turn``, the first of equals."""
    return f"""m{turn} AS (
  SELECT p.vec_id, p.part, min((list_sum(list_transform(list_zip(p.x, b.c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::HUGEINT * 64 + b.entry)) AS m
  FROM p JOIN b{turn} b ON p.part = b.part GROUP BY p.vec_id, p.part
), a{turn} AS MATERIALIZED (
  SELECT vec_id, part, (m % 64)::BIGINT AS entry, (m // 64)::BIGINT AS away FROM m{turn}
)"""


def _codebook_round(turn: int) -> str:
    """Codebook ``turn`` + 1: floors of the means, entries without parts as they were."""
    return f"""{_assignment(turn)}, s{turn} AS (
  SELECT part, entry, place, sum(value)::HUGEINT AS total, count(*) AS n
  FROM (SELECT a.part, a.entry, unnest(p.x) AS value, generate_subscripts(p.x, 1) AS place
        FROM a{turn} a JOIN p USING (vec_id, part)) GROUP BY part, entry, place
), f{turn} AS (
  SELECT part, entry, list(((total - ((total % n) + n) % n) // n)::BIGINT ORDER BY place) AS c FROM s{turn} GROUP BY part, entry
), b{turn + 1} AS MATERIALIZED (
  SELECT b.part, b.entry, coalesce(f.c, b.c) AS c FROM b{turn} b LEFT JOIN f{turn} f ON b.part = f.part AND b.entry = f.entry
)"""


SQL: dict[str, str] = {
    "op4_line_dedup": """
WITH l AS (
  SELECT DISTINCT doc_id, source, trim(line) AS line
  FROM (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line FROM documents)
), pages AS (
  SELECT source, count(*) AS pages FROM documents GROUP BY source
), often AS (
  SELECT l.source, l.line FROM l JOIN pages p ON l.source IS NOT DISTINCT FROM p.source
  WHERE l.line <> '' GROUP BY l.source, l.line, p.pages
  HAVING count(*) >= 3 AND count(*) > p.pages * 0.1::DOUBLE
), bad AS (
  SELECT source, list(line) AS bad FROM often GROUP BY source
), cut AS (
  SELECT d.doc_id, d.source, string_split(d.text, chr(10)) AS lines,
         list_filter(string_split(d.text, chr(10)), lambda x: NOT coalesce(list_contains(b.bad, trim(x)), false)) AS kept
  FROM documents d LEFT JOIN bad b ON d.source IS NOT DISTINCT FROM b.source
)
SELECT doc_id, source, array_to_string(kept, chr(10)) AS text, coalesce(len(lines), 0) AS n_lines,
       coalesce(len(lines) - len(kept), 0) AS n_dropped
FROM cut
""",
    "op5_mixing": r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), w AS (
  SELECT source, source_size, source_size * 2.0::DOUBLE AS cap,
         [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS w
  FROM s
), o AS (
  SELECT *, row_number() OVER (ORDER BY cap / w, source NULLS LAST) AS pos FROM w
), lev AS (
  SELECT a.source, a.source_size, a.cap, a.w, a.pos,
         ((SELECT sum(source_size) FROM o)::DOUBLE * 3 / 2 - coalesce(sum(b.cap), 0)) / ((SELECT sum(w) FROM o) - coalesce(sum(b.w), 0)) AS level
  FROM o a LEFT JOIN o b ON b.pos < a.pos GROUP BY a.source, a.source_size, a.cap, a.w, a.pos
), free AS (
  SELECT min(pos) AS pos FROM lev WHERE level * w < cap
), t AS (
  SELECT source, source_size,
         least(cap, coalesce((SELECT level FROM lev WHERE pos = (SELECT pos FROM free)) * w, cap)) AS target
  FROM lev
), p AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY substr(md5(concat(coalesce(d.doc_id::VARCHAR, ''), '|', d.size::VARCHAR)), 1, 16), d.doc_id
                           ROWS UNBOUNDED PRECEDING) - d.size AS running,
         CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS whole
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       (whole * size + greatest(0, least(size, floor(target) - whole * source_size - running)))::BIGINT AS taken
FROM p
""",
    "op6_parity_join": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS words FROM documents
), s AS (
  SELECT DISTINCT doc_id, shingle FROM (
    SELECT doc_id, unnest(CASE WHEN len(words) >= 3
      THEN list_transform(range(1, len(words) - 1), lambda i: array_to_string(words[i:i + 2], ' '))
      WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END) AS shingle FROM w)
), n AS (
  SELECT w.doc_id, count(s.shingle) AS n FROM w LEFT JOIN s ON w.doc_id = s.doc_id GROUP BY w.doc_id
), shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id
), link AS (
  SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 90 * (x.n + y.n - k)
), edge AS (
  SELECT a, b FROM link UNION ALL SELECT b, a FROM link
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM n
  UNION
  SELECT r.a, e.b FROM reach r JOIN edge e ON r.b = e.a
)
SELECT n.doc_id, n.n AS n_shingles, min(reach.b) AS component_id
FROM n JOIN reach ON n.doc_id = reach.a GROUP BY n.doc_id, n.n
""",
    "op10_zip_warc": """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
), d AS (
  SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS hex, max(page_id) OVER (PARTITION BY payload) AS newest
  FROM p
)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((('0x' || substr(hex, 5 * (i // 4) + 1, 5))::INT >> (15 - 5 * (i % 4))::INT) & 31)::INT, 1)), '') AS payload_digest,
  CASE WHEN page_id = newest THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> newest THEN newest END AS refers_to
FROM d
""",
    "op11_vector_codes": f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), p AS MATERIALIZED (
  SELECT vec_id, label, part, list_slice(v, part * (len(v) // 16) + 1, (part + 1) * (len(v) // 16)) AS x
  FROM (SELECT *, unnest(range(16)) AS part FROM kept)
), b0 AS MATERIALIZED (
  SELECT part, entry, x AS c
  FROM (SELECT *, row_number() OVER (PARTITION BY part ORDER BY vec_id, x) - 1 AS entry FROM p) WHERE entry < 64
), {_codebook_round(0)}, {_codebook_round(1)}, {_assignment(2)}, coded AS (
  SELECT p.vec_id, p.label, string_agg(lpad(to_hex(a2.entry), 2, '0'), '' ORDER BY p.part) AS code, sum(a2.away)::BIGINT AS error
  FROM p JOIN a2 USING (vec_id, part) GROUP BY p.vec_id, p.label
), books AS (
  SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) AS digest FROM b2
)
SELECT vec_id, lower(code) AS code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error,
       (SELECT digest FROM books) AS codebooks_sha256
FROM coded
""",
    "op12_source_divergence": r"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), t AS MATERIALIZED (
  SELECT id, lang, source, unnest(terms) AS term FROM d
), kept AS MATERIALIZED (
  SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT id) >= 30
), v AS (
  SELECT lang, count(*) AS v FROM kept GROUP BY lang
), g AS MATERIALIZED (
  SELECT lang, source, coalesce(v, 0) AS v FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN v USING (lang)
), c AS MATERIALIZED (
  SELECT lang, source, term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY lang, source, term
), every AS MATERIALIZED (
  SELECT g.lang, g.source, k.term, g.v, coalesce(c.n, 0) AS n, sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang, g.source) AS total
  FROM g JOIN kept k ON g.lang = k.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), p AS MATERIALIZED (
  SELECT *, (1 + (1000000000::HUGEINT * (n + 5)) // (total + 5 * v))::BIGINT AS p FROM every
), q AS (
  SELECT lang, term, (1 + (1000000000::HUGEINT * (n + 5)) // (sum(n) OVER (PARTITION BY lang) + 5 * v))::BIGINT AS q
  FROM (SELECT lang, term, sum(n) AS n, max(v) AS v FROM every GROUP BY lang, term)
), diff AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source
), pair AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(diff.value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN diff ON diff.lang = a.lang AND diff.source = a.source AND diff.item = b.source
), term AS (
  SELECT p.lang, p.source, 'term' AS part, p.term AS item, p.p - q.q AS value
  FROM p JOIN q ON p.lang = q.lang AND p.term = q.term WHERE p.n > 0 AND p.p > q.q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item))::INT AS rank
  FROM (SELECT * FROM pair UNION ALL SELECT * FROM term)
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 50
""",
}
