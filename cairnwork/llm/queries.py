"""The queries opN_<name> over whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnwork.llm import decontam, doubling, langid, mixing, pii, sharding, simhash, suffixes, tokencount, topk

SHARDS = 40


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_bwt_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(_docs(spark, sf_dir)).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_shared")


def op2_ecoc_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _docs(spark, sf_dir)
    model = langid.fit(docs.where(~langid.held_out()))
    judged = langid.predict(docs.select("doc_id", "text"), model)
    return judged.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score", "ambiguous")


def op3_positional_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.match(_docs(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op4_simhash_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.classes(_docs(spark, sf_dir))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op5_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    held = _docs(spark, sf_dir).select("doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64("text", "lang", "source").alias("tie"))
    out = sharding.assign_shards(held, [F.col("doc_id"), F.col("tie")], SHARDS)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op6_boosted_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.spans(_docs(spark, sf_dir))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2(pii.as_text("base"), 256).alias("base_sha256"), pii.as_text("found").alias("spans"), F.size("found").cast("long").alias("n_spans"), (F.size("found") > 0).alias("private"))


def op7_kd_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return topk.top_k(rows, F.col("vec_id") % 20 == 0)


def op8_level_doubling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doubling.remove_repeats(_docs(spark, sf_dir)).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op9_cube_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix(_docs(spark, sf_dir), ["doc_id", "source"])
    return out.select("doc_id", F.col("__size").alias("size"), F.col("__source_size").alias("source_size"), F.col("__target").alias("target"), (F.col("__size") * F.col("__times")).cast("long").alias("taken"))


def op10_separator_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.document_counts(_docs(spark, sf_dir))


OP7_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""


WORDS3 = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
OP3_SQL = f"""
WITH iw AS (SELECT item_id, {WORDS3} AS w FROM benchmark WHERE item_id IS NOT NULL),
iwin AS (SELECT DISTINCT item_id, array_to_string(w[s:s + 9], ' ') AS x, least(len(w), 10) AS n FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM iw WHERE len(w) > 0)),
dw AS (SELECT row_number() OVER () AS r, doc_id, {WORDS3} AS w FROM documents),
sizes AS (SELECT DISTINCT n FROM iwin),
dwin AS (SELECT r, n, s, array_to_string(w[s:s + n - 1], ' ') AS x FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM dw, sizes WHERE len(w) >= n)),
hits AS (SELECT r, s, dwin.n, item_id FROM dwin JOIN iwin ON dwin.x = iwin.x AND dwin.n = iwin.n),
hw AS (SELECT r, count(*) AS n_hit FROM (SELECT DISTINCT r, unnest(range(s, s + n)) AS p FROM (SELECT DISTINCT r, s, n FROM hits)) GROUP BY 1),
hi AS (SELECT r, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS items FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS i FROM hits) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN hw USING (r) LEFT JOIN hi USING (r)
"""
OP8_SQL = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
win AS (SELECT r, s, md5(array_to_string(w[s:s + 34], ' ')) AS x FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS s FROM d WHERE len(w) >= 35)),
rep AS (SELECT x FROM win GROUP BY 1 HAVING count(*) > 1),
gone AS (SELECT DISTINCT r, unnest(range(s, s + 35)) AS p FROM win JOIN rep USING (x)),
each AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY p) AS t, count(*) AS n FROM each ANTI JOIN gone USING (r, p) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (r)
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_bwt_intervals, op2_ecoc_language, op3_positional_index, op4_simhash_tiles, op5_feistel_shards, op6_boosted_candidates, op7_kd_topk, op8_level_doubling, op9_cube_mix, op10_separator_scan)}


def oracle_sql() -> dict[str, str]:
    return {"op3_positional_index": OP3_SQL, "op7_kd_topk": OP7_SQL, "op8_level_doubling": OP8_SQL}
