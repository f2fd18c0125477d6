"""More curation queries: assembly, two-pass dedup, evidence bands, clean-up, validators, sampling and serving."""

from __future__ import annotations

from pyspark.sql import functions as F

from cairnwork.functions import text as X
from cairnwork.functions import values as V
from cairnwork.operators import relational as R
from cairnwork.operators import resolution as E
from cairnwork.operators import setjoin as S
from cairnwork.plans.registry import query
from cairnwork.plans.resolution_queries import TOK, _codes, _kinds_sql, _whole_pairs
from cairnwork.plans.storage import cut


@query(f"""WITH {_kinds_sql("source", "lang")}, p AS (SELECT a, b FROM w JOIN documents x ON x.doc_id = a JOIN documents y ON y.doc_id = b WHERE exact > 0.3 AND (x.source = y.source OR x.lang = y.lang)),
tc AS (SELECT doc_id, token, count(*) AS n FROM (SELECT doc_id, unnest({TOK}) AS token FROM documents) GROUP BY 1, 2), sq AS (SELECT doc_id, CAST(sum(n * n) AS DOUBLE) AS q FROM tc GROUP BY 1),
dot AS (SELECT a, b, CAST(sum(x.n * y.n) AS DOUBLE) AS d FROM p JOIN tc x ON x.doc_id = a JOIN tc y ON y.doc_id = b AND y.token = x.token GROUP BY 1, 2),
c AS (SELECT a, b, round(d / sqrt(x.q * y.q), 6) AS cosine FROM dot JOIN sq x ON x.doc_id = a JOIN sq y ON y.doc_id = b)
SELECT a, b, cosine, CASE WHEN cosine >= 0.92 THEN 'confirmed' WHEN cosine >= 0.85 THEN 'review' ELSE 'reject' END AS verdict FROM c""")
def two_pass_dedup(t):
    """First pass: Jaccard over 0.3, over all tokens, and the same source or language. Second pass: cosine of the whole texts' term counts."""
    codes = _codes(t, "source", "lang", counted=True)
    members = cut(S.equal_codes(codes, "t", "source", "lang"), "members")
    near = S.near_codes(codes, members, 0.3, counted=True).where("both * 10 > n * 3")
    d = t("documents").select("doc_id", "source", "lang")
    p = R.jaccard_pairs(members, near).join(d.toDF("a", "sa", "la"), "a").join(d.toDF("b", "sb", "lb"), "b").where("sa = sb OR la = lb")
    p = p.select("a", "b", F.round("cosine", 6).alias("cosine"))
    return p.withColumn("verdict", F.when(F.col("cosine") >= 0.92, "confirmed").when(F.col("cosine") >= 0.85, "review").otherwise("reject"))


@query("""WITH s AS (SELECT md5(text) AS h, min(doc_id) AS id, count(*) AS n, count(DISTINCT source) AS sources, min(lang) AS lang, string_agg(DISTINCT source, ',' ORDER BY source) AS refs FROM documents GROUP BY 1)
SELECT id, n, sources, lang, refs, CASE WHEN sources >= 3 THEN 'T1' WHEN sources = 2 THEN 'T2' ELSE 'T3' END AS tier FROM s""")
def strict_assembly(t):
    s = t("documents").groupBy(F.md5("text").alias("h")).agg(F.min("doc_id").alias("id"), F.count("*").alias("n"), F.count_distinct("source").alias("sources"), F.min("lang").alias("lang"), F.array_join(F.array_sort(F.collect_set("source")), ",").alias("refs"))
    return s.drop("h").withColumn("tier", F.when(F.col("sources") >= 3, "T1").when(F.col("sources") == 2, "T2").otherwise("T3"))


@query("""WITH p AS (SELECT a.o_orderkey AS a, b.o_orderkey AS b, abs(CAST(year(a.o_orderdate) AS INTEGER) - CAST(year(b.o_orderdate) AS INTEGER)) AS gap, a.o_orderstatus = b.o_orderstatus AS firm FROM orders a JOIN orders b ON a.o_custkey = b.o_custkey AND a.o_orderkey < b.o_orderkey)
SELECT a, b, CASE WHEN gap <= 1 THEN 'positive' WHEN gap <= 5 THEN 'neutral' WHEN firm THEN 'weak' ELSE 'conflict' END AS band FROM p""")
def year_bands(t):
    o = t("orders").select("o_orderkey", "o_custkey", "o_orderstatus", F.year("o_orderdate").alias("y"))
    gap, firm = F.abs(F.col("a.y") - F.col("b.y")), F.col("a.o_orderstatus") == F.col("b.o_orderstatus")
    p = R.block_pairs(o, "o_orderkey", ["o_custkey"])
    return p.select(F.col("a.o_orderkey").alias("a"), F.col("b.o_orderkey").alias("b"), F.when(gap <= 1, "positive").when(gap <= 5, "neutral").when(firm, "weak").otherwise("conflict").alias("band"))


@query("""SELECT c_custkey, CASE WHEN c_nationkey < 5 THEN 'known' WHEN c_nationkey < 8 THEN 'ambiguous' ELSE 'unknown' END AS class, CASE WHEN c_nationkey < 5 THEN n_name END AS country FROM customer JOIN nation ON n_nationkey = c_nationkey""")
def country_classify(t):
    n = F.col("c_nationkey")
    known = F.broadcast(t("nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name"))  # 25 nations
    return t("customer").join(known, "c_nationkey").select("c_custkey", F.when(n < 5, "known").when(n < 8, "ambiguous").otherwise("unknown").alias("class"), F.when(n < 5, F.col("n_name")).alias("country"))


@query("""SELECT p_partkey, trim(regexp_replace('By ' || p_name || ' (' || p_type || ')', '^\\s*[Bb]y\\s+|\\s*\\([^()]*\\)\\s*$', '', 'g')) AS bare FROM part""")
def strip_affixes(t):
    return t("part").select("p_partkey", X.strip_affixes(F.concat(F.lit("By "), "p_name", F.lit(" ("), "p_type", F.lit(")"))).alias("bare"))


@query("""SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' AND year(o_orderdate) <= 1996 THEN 'valid' WHEN o_orderstatus = 'O' THEN 'planned' ELSE 'unclear' END AS status, CASE WHEN o_orderstatus = 'F' AND year(o_orderdate) <= 1996 THEN CAST(year(o_orderdate) AS INTEGER) END AS year FROM orders""")
def year_validity(t):
    y = F.year("o_orderdate")
    ok = (F.col("o_orderstatus") == "F") & (y <= 1996)
    return t("orders").select("o_orderkey", F.when(ok, "valid").when(F.col("o_orderstatus") == "O", "planned").otherwise("unclear").alias("status"), F.when(ok, y).alias("year"))


@query("""WITH u AS (SELECT generate_subscripts(embedding, 1) AS i, unnest(embedding) AS x, label FROM embeddings WHERE label IN (1, 2)), l AS (SELECT i, sum(CASE WHEN label = 1 THEN CAST(round(CAST(x AS DOUBLE) * 1000000) AS BIGINT) END) / CAST(count(*) FILTER (WHERE label = 1) AS DOUBLE) AS m, sum(CASE WHEN label = 2 THEN CAST(round(CAST(x AS DOUBLE) * 1000000) AS BIGINT) END) / CAST(count(*) FILTER (WHERE label = 2) AS DOUBLE) AS d FROM u GROUP BY 1)
SELECT CAST(i - 1 AS INTEGER) AS place, round((m - 0.3 * d) / 1000000, 6) AS x FROM l""")
def user_vector(t):
    m = R.mean_vectors(t("embeddings").where("label IN (1, 2)"), "label", "embedding")
    pair = m.agg(F.max(F.when(F.col("label") == 1, F.col("mean"))).alias("liked"), F.max(F.when(F.col("label") == 2, F.col("mean"))).alias("disliked"))
    return pair.select(F.posexplode(F.zip_with("liked", "disliked", lambda a, b: a - 0.3 * b)).alias("place", "x")).select("place", F.round("x", 6).alias("x"))


@query("""SELECT page_id, CASE WHEN url LIKE 'https:%' THEN 'https' WHEN url LIKE 'http:%' THEN 'http' ELSE 'other' END AS scheme, regexp_matches(lower(regexp_replace(url, '[?#].*$', '')), '\\.(jpe?g|png|webp|tiff?)$') AS raster, 'https://x.example/' || page_id || '-' || lower(regexp_extract(rtrim(regexp_replace(url, '[?#].*$', ''), '/'), '([^/]+)$', 1)) AS built FROM pages""")
def url_builders(t):
    u = F.col("url")
    built = F.format_string("https://x.example/%s-%s", F.col("page_id").cast("string"), V.slug(u))
    return t("pages").select("page_id", F.when(u.startswith("https:"), "https").when(u.startswith("http:"), "http").otherwise("other").alias("scheme"), V.is_raster(u).alias("raster"), built.alias("built"))


@query("""WITH s AS (SELECT user_id, list(DISTINCT event_type) AS a FROM events WHERE value > 50 GROUP BY 1), r AS (SELECT user_id, list(DISTINCT event_type) AS b FROM events WHERE value < 20 GROUP BY 1) SELECT user_id, array_to_string(list_sort(list_distinct(list_concat(a, b))), ',') AS merged FROM s JOIN r USING (user_id)""")
def merged_map_of_arrays(t):
    e = t("events")
    side = lambda c, n: e.where(c).groupBy("user_id").agg(F.create_map(F.lit("types"), F.collect_set("event_type")).alias(n))
    both = side("value > 50", "a").join(side("value < 20", "b"), "user_id")
    return both.select("user_id", F.array_join(F.array_sort(V.merged_maps(F.col("a"), F.col("b"))["types"]), ",").alias("merged"))


@query("""SELECT key, count(*) AS n FROM (SELECT unnest(json_keys(props)) AS key FROM events) GROUP BY 1""")
def json_keys_as_rows(t):
    return t("events").select(F.explode(F.expr("json_object_keys(props)")).alias("key")).groupBy("key").agg(F.count("*").alias("n"))


@query("""WITH c AS (SELECT lang, doc_id, sha256('cov|' || doc_id) AS h FROM documents), g AS (SELECT doc_id FROM c ORDER BY h, doc_id LIMIT 30), l AS (SELECT min_by(doc_id, h) AS doc_id FROM c GROUP BY lang) SELECT doc_id FROM g UNION SELECT doc_id FROM l""")
def coverage_sample(t):
    c = t("documents").select("lang", "doc_id", F.sha2(F.concat_ws("|", F.lit("cov"), "doc_id"), 256).alias("h"))
    best = c.orderBy("h", "doc_id").limit(30).select("doc_id")
    return best.union(c.groupBy("lang").agg(F.min_by("doc_id", "h").alias("doc_id")).select("doc_id")).distinct()


@query()
def greedy_no_reuse(t):
    """Ten pairs in hash order, no endpoint twice, or as many as there are."""
    return _picked(R.jaccard_pairs(*_whole_pairs(t, 0.5)), 10)


def _picked(pairs, most, batch=200):
    """Greedy pick in hash order. The driver sees batches of the first pairs whose endpoints are both free; each batch gives one pair at least."""
    p = cut(pairs.select("a", "b", F.sha2(F.concat_ws("|", "a", "b"), 256).alias("h")), "pool")
    used: set = set()
    rows = []
    while len(rows) < most:
        first = p.where(~F.col("a").isin(*used) & ~F.col("b").isin(*used)) if used else p
        got = first.orderBy("h").limit(batch).select("a", "b").collect()
        if not got:
            break
        for r in got:
            if len(rows) < most and not {r["a"], r["b"]} & used:
                used |= {r["a"], r["b"]}
                rows.append((len(rows) + 1, r["a"], r["b"]))
    return p.sparkSession.createDataFrame(rows, "place int, a long, b long")


@query("""SELECT lang, round(max(share), 6) AS catch_all, CAST(count(*) AS BIGINT) AS sources FROM (SELECT lang, source, count(*) / CAST(sum(count(*)) OVER (PARTITION BY lang) AS DOUBLE) AS share FROM documents GROUP BY 1, 2) GROUP BY 1""")
def catch_all_rates(t):
    n = t("documents").groupBy("lang", "source").agg(F.count("*").alias("n"))
    return n.groupBy("lang").agg(F.round(F.max("n") / F.sum("n"), 6).alias("catch_all"), F.count("*").alias("sources"))


@query("""WITH r AS (SELECT md5(text) AS ref, doc_id FROM documents), u AS (SELECT ref, count(*) AS n FROM r GROUP BY 1) SELECT 'unique_ref' AS check_name, count(*) FILTER (WHERE n > 1) AS violations, CASE WHEN count(*) FILTER (WHERE n > 1) = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM u
UNION ALL SELECT 'vector_shape', count(*) FILTER (WHERE len(embedding) <> 64), CASE WHEN count(*) FILTER (WHERE len(embedding) <> 64) = 0 THEN 'PASS' ELSE 'FAIL' END FROM embeddings
UNION ALL SELECT 'label_vocab', count(*) FILTER (WHERE quality NOT IN (0, 1)), CASE WHEN count(*) FILTER (WHERE quality NOT IN (0, 1)) = 0 THEN 'PASS' ELSE 'FAIL' END FROM labels
UNION ALL SELECT 'orphan_label', count(*), CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)""")
def strict_checks(t):
    def row(name, df, bad):
        n = F.count_if(bad)
        return df.agg(n.alias("violations")).select(F.lit(name).alias("check_name"), "violations", F.when(F.col("violations") == 0, "PASS").otherwise("FAIL").alias("status"))

    refs = t("documents").groupBy(F.md5("text").alias("ref")).agg(F.count("*").alias("n"))
    out = row("unique_ref", refs, F.col("n") > 1).union(row("vector_shape", t("embeddings"), F.size("embedding") != 64)).union(row("label_vocab", t("labels"), ~F.col("quality").isin(0, 1)))
    return out.union(row("orphan_label", t("labels").join(t("documents").select("doc_id"), "doc_id", "left_anti"), F.lit(True)))


@query("""WITH m AS (SELECT md5(text) AS h, doc_id, source, n_chars FROM documents), s AS (SELECT h, count(DISTINCT source) AS k FROM m GROUP BY 1 HAVING count(*) > 1), r AS (SELECT doc_id, row_number() OVER (PARTITION BY h ORDER BY n_chars DESC, doc_id) AS place, k FROM m JOIN s USING (h)) SELECT doc_id, CASE WHEN place = 1 THEN 'keep' ELSE 'swap' END AS fate, k AS sources FROM r""")
def cover_avoidance(t):
    m = t("documents").select(F.md5("text").alias("h"), "doc_id", "source", "n_chars")
    g = m.groupBy("h").agg(F.count_distinct("source").alias("sources"), F.count("*").alias("n"), F.min_by("doc_id", F.struct(-F.col("n_chars"), "doc_id")).alias("best")).where("n > 1")
    return m.join(g, "h").select("doc_id", F.when(F.col("doc_id") == F.col("best"), "keep").otherwise("swap").alias("fate"), "sources")


@query("""SELECT p_partkey, string_agg(w, ' ' ORDER BY k) AS kept FROM (SELECT p_partkey, w, row_number() OVER (PARTITION BY p_partkey, lower(w) ORDER BY k) AS n, k FROM (SELECT p_partkey, unnest(string_split(p_name || ' ' || p_name, ' ')) AS w, generate_subscripts(string_split(p_name || ' ' || p_name, ' '), 1) AS k FROM part)) WHERE n = 1 GROUP BY 1""")
def ordered_distinct(t):
    w = F.split("p_name", " ")
    return t("part").select("p_partkey", F.array_join(V.ordered_union(w, w), " ").alias("kept"))


@query("""WITH d AS (SELECT doc_id, lang, len(string_split(trim(text), ' ')) AS words FROM documents) SELECT lang, count(*) AS n, round(avg(words), 4) AS mean_words, count(*) FILTER (WHERE words < 20) AS vague FROM d GROUP BY 1""")
def vagueness(t):
    d = t("documents").select("lang", F.size(F.split(F.trim("text"), " ")).alias("words"))
    return d.groupBy("lang").agg(F.count("*").alias("n"), F.round(F.avg("words"), 4).alias("mean_words"), F.count_if(F.col("words") < 20).alias("vague"))


@query("""WITH RECURSIVE e AS MATERIALIZED (SELECT DISTINCT a.doc_id AS u, b.doc_id AS v FROM documents a JOIN documents b ON md5(a.text) = md5(b.text) AND a.doc_id <> b.doc_id), c AS (SELECT u AS node, u AS root FROM e UNION SELECT e.v, c.root FROM c JOIN e ON c.node = e.u), r AS (SELECT node, min(root) AS root FROM c GROUP BY 1)
SELECT doc_id, coalesce(root, doc_id) AS cluster FROM documents LEFT JOIN r ON node = doc_id""")
def clusters_with_singletons(t):
    d = t("documents").select("doc_id", F.md5("text").alias("h"))
    first = d.groupBy("h").agg(F.min("doc_id").alias("least"))
    edges = d.join(first, "h").where("doc_id <> least").select(F.col("least").alias("a"), F.col("doc_id").alias("b"))
    return E.clusters(d, "doc_id", edges, "a", "b")
