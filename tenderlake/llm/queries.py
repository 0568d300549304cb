"""The corpus operators on the driver tables, one query each, with DuckDB SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderlake.llm import (
    decontaminate, entropy_mix, fill_middle, grid_join, hash_search, html_wrappers, jaccard_join, ppm_language, reshard, toxic_segments,
    url_templates, warc, whitening,
)
from tenderlake.llm.graph import crc_remainder

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _remainder(column: str, modulus: int) -> str:
    """SQL of the remainder that splits rows into folds."""
    return f"crc32(cast(cast({column} as string) as binary)) % {modulus}"


def op1_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_wrappers.extract_main_text(_table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    classes = jaccard_join.jaccard_classes(docs)
    sizes = docs.select("doc_id", jaccard_join.count_ngrams().alias("n_shingles"))
    return sizes.join(classes, sizes["doc_id"] == classes["id"], "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")
    )


def op3_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_templates.judge_urls(_table(spark, sf_dir, "pages"))
    return judged.select("page_id", "host", "path", "rule", "verdict", "template", "purity")


def op4_toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    held_out = crc_remainder("doc_id", 4) == 2
    model = toxic_segments.fit(docs, labels.where(~held_out), fold=f"{_remainder('id', 4)} = 3")
    score = F.col("toxicity.score")
    return toxic_segments.score_toxicity(docs, model).select(
        "doc_id", held_out.alias("held_out"), score.alias("score"),
        (score >= toxic_segments.THRESHOLD).cast("int").alias("predicted"), F.size("toxicity.segments").cast("long").alias("n_segments"),
    )


def op5_entropy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    mixed = entropy_mix.plan_mix(docs).copies(docs)
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("long").alias("taken"))


def op6_vector_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid_join.vector_classes(_table(spark, sf_dir, "embeddings"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = crc_remainder("doc_id", 5) == 0
    model = ppm_language.fit(docs.where(~held_out))
    return ppm_language.predict_language(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op8_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    c = F.col("contamination")
    items: Column = F.array_sort(F.filter(c["items"], lambda i: i.isNotNull()))
    hit = decontaminate.hit_words(c)
    return found.select(
        "doc_id", c.n_words.alias("n_words"), hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"),
    )


def op9_warc_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    captures = warc.round_trip(_table(spark, sf_dir, "pages"))
    return captures.select(
        F.col("metadata.page_id").alias("page_id"), F.coalesce("response.payload_bytes", "original.payload_bytes").alias("payload_bytes"),
        F.col("response.payload_digest").alias("payload_digest"), F.col("type").alias("record_type"),
        F.col("original.page_id").alias("refers_to"),
    )


def shard_columns(sharded: DataFrame) -> DataFrame:
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).cast("long")
    return sharded.select(
        "doc_id", "size", crc.alias("text_crc32"), F.lit(reshard.LAW).alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op10_resharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_columns(reshard.reshard(_table(spark, sf_dir, "documents")))


def op11_whitened(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten_vectors(_table(spark, sf_dir, "embeddings"))


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_middle.restore(fill_middle.fill_middle(_table(spark, sf_dir, "documents")))
    f = F.col("fim")
    return made.select(
        "doc_id", f.n.alias("n"), f.form.alias("form"), f.prefix_chars.alias("prefix_chars"), f.middle_chars.alias("middle_chars"),
        F.sha2(f.output, 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"),
    )


def op13_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hash_search.nearest_vectors(_table(spark, sf_dir, "embeddings"), "vec_id % 20 = 0")


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_main_text, op2_ngram_jaccard, op3_url_templates, op4_toxic_segments, op5_entropy_mix, op6_vector_classes,
        op7_language, op8_contamination, op9_warc_captures, op10_resharding, op11_whitened, op12_fill_middle, op13_nearest,
    )
}

_FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_REACH = """
  both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
  reach(id, other) AS (
    SELECT a, b FROM both_ways UNION SELECT r.id, l.b FROM reach r JOIN both_ways l ON l.a = r.other),
  lowest AS (SELECT id, min(least(id, other)) AS low FROM reach GROUP BY id)"""

SQL = {
    "op2_ngram_jaccard": f"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all({_FOLDED}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
  grams AS (
    SELECT DISTINCT doc_id, unnest(CASE
      WHEN len(w) >= 5 THEN [array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)]
      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM words),
  sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
  shared AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM grams x JOIN grams y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL),
  links AS (
    SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * k >= 75 * (x.n + y.n - k)),{_REACH}
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, coalesce(l.low, d.doc_id) AS component_id
FROM documents d LEFT JOIN sizes s USING (doc_id) LEFT JOIN lowest l ON l.id = d.doc_id""",
    "op6_vector_classes": f"""
WITH RECURSIVE vectors AS (SELECT vec_id, label, [x::DOUBLE for x in embedding] AS e FROM embeddings),
  good AS (
    SELECT * FROM vectors WHERE label IS NOT NULL AND e IS NOT NULL
      AND len([x for x in e if x IS NULL OR NOT isfinite(x)]) = 0 AND len([x for x in e if x <> 0]) > 0),
  links AS (
    SELECT x.vec_id AS a, y.vec_id AS b FROM good x JOIN good y ON x.label = y.label AND x.vec_id < y.vec_id
    WHERE len(x.e) = len(y.e) AND list_cosine_similarity(x.e, y.e) >= 0.98),{_REACH},
  degrees AS (SELECT a AS id, count(*) AS n FROM both_ways GROUP BY a)
SELECT v.vec_id, coalesce(d.n, 0)::BIGINT AS n_links, coalesce(l.low, v.vec_id)::BIGINT AS component_id,
  v.vec_id = coalesce(l.low, v.vec_id) AS kept
FROM vectors v LEFT JOIN degrees d ON d.id = v.vec_id LEFT JOIN lowest l ON l.id = v.vec_id""",
    "op8_contamination": f"""
WITH doc_words AS (
    SELECT doc_id, regexp_extract_all({_FOLDED}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
  item_words AS (
    SELECT item_id, regexp_extract_all({_FOLDED}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
  windows AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS n,
      unnest([array_to_string(w[i:i + least(len(w), 10) - 1], ' ') for i in range(1, len(w) - least(len(w), 10) + 2)]) AS g
    FROM item_words WHERE len(w) > 0),
  places AS (
    SELECT doc_id, k.n, unnest(range(1, len(w) - k.n + 2)) AS place,
      unnest([array_to_string(w[i:i + k.n - 1], ' ') for i in range(1, len(w) - k.n + 2)]) AS g
    FROM doc_words, (SELECT DISTINCT n FROM windows) k WHERE len(w) >= k.n),
  found AS (SELECT doc_id, n, place, item_id FROM places JOIN windows USING (n, g)),
  hits AS (SELECT doc_id, count(DISTINCT word) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(place, place + n)) AS word FROM found) GROUP BY doc_id),
  items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(h.n_hit, 0)::BIGINT AS n_hit, coalesce(i.n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(i.names, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN hits h USING (doc_id) LEFT JOIN items i USING (doc_id)""",
    "op12_fill_middle": """
WITH cut AS (
    SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\n]*\\n|[^\\n]+') AS u,
      sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
  drawn AS (
    SELECT *, len(u)::BIGINT AS n, [('0x' || substr(h, 8 * k + 1, 8))::BIGINT for k in range(0, 4)] AS r FROM cut),
  ends AS (
    SELECT *, least(r[1] % (n + 1), r[2] % (n + 1)) AS a, greatest(r[1] % (n + 1), r[2] % (n + 1)) AS b,
      CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR r[3] % 100 >= 100 THEN 'plain'
        WHEN r[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
  parts AS (
    SELECT doc_id, t, n, form, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m,
      array_to_string(u[b + 1:], '') AS s FROM ends)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END)
    AS output_sha256, sha256(t) AS restored_sha256
FROM parts""",
    "op9_warc_captures": """
WITH payloads AS (
    SELECT page_id, strlen(coalesce(html, '')) AS n, upper(sha1(coalesce(html, ''))) AS hex FROM pages),
  coded AS (
    SELECT page_id, n, hex, max(page_id) OVER (PARTITION BY hex) AS owner, array_to_string([
      substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        ((('0x' || substr(hex, (i // 4) * 5 + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INTEGER + 1, 1) for i in range(0, 32)], '') AS digest
    FROM payloads)
SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest,
  CASE WHEN page_id = owner THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = owner THEN NULL ELSE owner END AS refers_to
FROM coded""",
}
