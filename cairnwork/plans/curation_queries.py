"""Curation queries: bridges, fusion, audits, splits, galleries, reviews, vocabularies and serving filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from cairnwork.functions import text as X
from cairnwork.operators import relational as R
from cairnwork.plans.registry import query
from cairnwork.sources import readers


def _text(c):
    return F.array_join(F.array_sort(F.collect_set(c.cast("string"))), ",")


@query("""SELECT source, count(*) AS n, min(id) AS least, max(name) AS last FROM (SELECT 'orders' AS source, o_orderkey AS id, o_orderpriority AS name FROM orders UNION ALL SELECT 'events', event_id, event_type FROM events UNION ALL SELECT 'documents', doc_id, lang FROM documents) GROUP BY 1""")
def source_union(t):
    c = F.col
    u = readers.uniform({"orders": (t("orders"), {"id": c("o_orderkey"), "name": c("o_orderpriority")}), "events": (t("events"), {"id": c("event_id"), "name": c("event_type")}), "documents": (t("documents"), {"id": c("doc_id"), "name": c("lang")})})
    return u.groupBy("source").agg(F.count("*").alias("n"), F.min("id").alias("least"), F.max("name").alias("last"))


@query("SELECT l_orderkey, string_agg(DISTINCT p_brand, ',' ORDER BY p_brand) AS brands FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1")
def bridge_join(t):
    native = t("lineitem").groupBy("l_orderkey").agg(F.collect_list("l_partkey").alias("ids")).select("l_orderkey", F.explode("ids").alias("p_partkey"))
    return native.join(t("part"), "p_partkey").groupBy("l_orderkey").agg(_text(F.col("p_brand")).alias("brands"))


@query("""WITH d AS (SELECT doc_id, source, md5(text) AS h FROM documents), g AS (SELECT doc_id FROM labels WHERE quality = 1)
SELECT b.doc_id, min(a.doc_id) AS match, count(*) AS links FROM d a JOIN d b ON a.h = b.h AND a.source <> b.source WHERE EXISTS (SELECT 1 FROM g WHERE g.doc_id = a.doc_id) AND NOT EXISTS (SELECT 1 FROM g WHERE g.doc_id = b.doc_id) GROUP BY 1""")
def exact_name_cross_source(t):
    """Rows that are not confirmed, with the least confirmed row of equal text from another source and the number of such. Copies meet per text and source, never as pairs."""
    d = t("documents").select("doc_id", "source", F.md5("text").alias("h"))
    good = t("labels").where("quality = 1").select("doc_id")
    per = d.join(good, "doc_id", "left_semi").groupBy("h", "source").agg(F.min("doc_id").alias("least"), F.count("*").alias("n"))
    held = per.groupBy("h").agg(F.collect_list(F.struct("source", "least", "n")).alias("s"))
    m = d.join(good, "doc_id", "left_anti").join(held, "h").withColumn("o", F.filter("s", lambda x: x["source"] != F.col("source")))
    return m.where(F.size("o") > 0).select("doc_id", F.array_min("o.least").alias("match"), F.aggregate("o.n", F.lit(0).cast("long"), lambda a, x: a + x).alias("links"))


@query("""WITH k AS (SELECT max(c_custkey) + 1 AS n FROM customer) SELECT DISTINCT least(x.c_nationkey, y.c_nationkey) AS a, greatest(x.c_nationkey, y.c_nationkey) AS b FROM k, orders o JOIN customer x ON x.c_custkey = o.o_custkey JOIN customer y ON y.c_custkey = (o.o_custkey * 3 + 1) % n WHERE x.c_nationkey <> y.c_nationkey""")
def pair_through_mapping(t):
    """The mapping reaches every customer's key."""
    n = F.broadcast(t("customer").agg((F.max("c_custkey") + 1).alias("n")))  # one row
    return _mapped_pairs(t, t("orders").join(n).select(F.col("o_custkey").alias("x"), ((F.col("o_custkey") * 3 + 1) % F.col("n")).alias("y")))


def _mapped_pairs(t, p):
    c = t("customer").select("c_custkey", "c_nationkey")
    p = p.distinct()
    p = p.join(c.toDF("x", "nx"), "x").join(c.toDF("y", "ny"), "y").where("nx <> ny")
    return p.select(F.least("nx", "ny").alias("a"), F.greatest("nx", "ny").alias("b")).distinct()


@query("""SELECT l_orderkey, max(p) AS most, count(*) AS n FROM (SELECT l_orderkey, unnest(CAST(ids AS BIGINT[])) AS p FROM (SELECT l_orderkey, to_json(list(l_partkey)) AS ids FROM lineitem GROUP BY 1)) GROUP BY 1""")
def json_array_explode(t):
    j = t("lineitem").groupBy("l_orderkey").agg(F.to_json(F.collect_list("l_partkey")).alias("ids"))
    return j.select("l_orderkey", F.explode(F.from_json("ids", "array<bigint>")).alias("p")).groupBy("l_orderkey").agg(F.max("p").alias("most"), F.count("*").alias("n"))


@query("""SELECT p_partkey, coalesce(s.brand, p_brand) AS p_brand FROM part LEFT JOIN (SELECT p_partkey AS k, CASE WHEN p_partkey % 6 = 0 THEN 'Over' END AS brand FROM part WHERE p_partkey % 3 = 0) s ON s.k = p_partkey""")
def overlay_join(t):
    p = t("part").select("p_partkey", "p_brand")
    side = p.where("p_partkey % 3 = 0").select("p_partkey", F.when(F.col("p_partkey") % 6 == 0, "Over").alias("p_brand"))
    return R.overlay(p, side, "p_partkey", ["p_brand"])


@query("""SELECT doc_id, coalesce(nullif(CASE WHEN doc_id % 3 = 0 THEN trim(source) ELSE ' ' END, ' '), CASE WHEN doc_id % 2 = 0 THEN lang END, 'none') AS shown, concat_ws(' ', source, CASE WHEN doc_id % 2 = 0 THEN lang END) AS joined FROM documents""")
def fallback_chain(t):
    even = F.when(F.col("doc_id") % 2 == 0, F.col("lang"))
    first = F.nullif(F.trim(F.when(F.col("doc_id") % 3 == 0, F.col("source")).otherwise(" ")), F.lit(""))
    return t("documents").select("doc_id", F.coalesce(first, even, F.lit("none")).alias("shown"), X.joined(F.col("source"), even, F.lit(" ")).alias("joined"))


@query("""SELECT o_orderkey, coalesce(CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END, o_orderpriority) AS value, CASE WHEN o_orderkey % 2 = 0 THEN 'first' ELSE 'second' END AS origin FROM orders""")
def fuse_with_provenance(t):
    a = F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderstatus"))
    return t("orders").select("o_orderkey", F.coalesce(a, "o_orderpriority").alias("value"), F.when(a.isNotNull(), "first").otherwise("second").alias("origin"))


@query("""WITH s AS (SELECT l_orderkey, list(DISTINCT l_returnflag) AS f FROM lineitem GROUP BY 1) SELECT l_orderkey, len(list_intersect(f, ['R', 'A'])) > 0 AS overlaps, len(list_intersect(f, ['N', 'R'])) = len(f) AS contained FROM s""")
def array_filters(t):
    s = t("lineitem").groupBy("l_orderkey").agg(F.collect_set("l_returnflag").alias("f"))
    lits = lambda *x: F.array(*map(F.lit, x))
    return s.select("l_orderkey", F.arrays_overlap("f", lits("R", "A")).alias("overlaps"), X.is_subset(F.col("f"), lits("N", "R")).alias("contained"))


@query("""SELECT l_suppkey, string_agg(p_type || '=' || n, ',' ORDER BY p_type) AS distribution FROM (SELECT l_suppkey, p_type, count(*) AS n FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2) GROUP BY 1""")
def feature_distribution(t):
    n = t("lineitem").join(t("part"), F.col("p_partkey") == F.col("l_partkey")).groupBy("l_suppkey", "p_type").agg(F.count("*").alias("n"))
    m = n.groupBy("l_suppkey").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("p_type", "n")))).alias("m"))
    return m.select("l_suppkey", F.array_join(F.transform(F.map_entries("m"), lambda e: F.concat_ws("=", e["key"], e["value"])), ",").alias("distribution"))


@query("""SELECT a.event_type AS x, b.event_type AS y, count(*) AS n FROM events a JOIN events b ON a.user_id = b.user_id AND a.event_id + 1000 = b.event_id GROUP BY 1, 2""")
def confusion_counts(t):
    e = t("events").select("user_id", "event_id", "event_type")
    b = e.select("user_id", (F.col("event_id") - 1000).alias("event_id"), F.col("event_type").alias("y"))
    return e.withColumnRenamed("event_type", "x").join(b, ["user_id", "event_id"]).groupBy("x", "y").agg(F.count("*").alias("n"))


@query("""SELECT CASE WHEN value >= 100 THEN '100' WHEN value >= 95 THEN '95-99' WHEN value >= 85 THEN '85-94' ELSE '<85' END AS bucket, count(*) AS n FROM events GROUP BY 1""")
def score_buckets(t):
    v = F.col("value")
    return t("events").groupBy(F.when(v >= 100, "100").when(v >= 95, "95-99").when(v >= 85, "85-94").otherwise("<85").alias("bucket")).agg(F.count("*").alias("n"))


@query("""SELECT doc_id, round((CAST(n_chars > 300 AS INTEGER) + CAST(lang = 'en' AS INTEGER) + CAST(quality IS NOT NULL AS INTEGER)) / 3.0, 6) AS completeness, concat_ws(',', CASE WHEN n_chars <= 300 THEN 'text' END, CASE WHEN lang <> 'en' THEN 'lang' END, CASE WHEN quality IS NULL THEN 'label' END) AS missing,
CAST(50 * CAST(n_chars > 300 AS INTEGER) + 30 * CAST(lang = 'en' AS INTEGER) + 20 * coalesce(quality, 0) AS INTEGER) AS overall FROM documents LEFT JOIN labels USING (doc_id)""")
def completeness_and_quality(t):
    parts = {"text": F.col("n_chars") > 300, "lang": F.col("lang") == "en", "label": F.col("quality").isNotNull()}
    n = {k: c.cast("int") for k, c in parts.items()}
    d = t("documents").join(t("labels"), "doc_id", "left")
    missing = F.concat_ws(",", *(F.when(~c, k) for k, c in parts.items()))
    return d.select("doc_id", F.round(sum(n.values()) / 3, 6).cast("double").alias("completeness"), missing.alias("missing"), (50 * n["text"] + 30 * n["lang"] + 20 * F.coalesce("quality", F.lit(0))).alias("overall"))


@query("""WITH c AS (SELECT l_partkey, l_linestatus, count(*) AS n FROM lineitem GROUP BY 1, 2), m AS (SELECT l_partkey, max(n) AS m FROM c GROUP BY 1), w AS (SELECT l_partkey, count(*) AS k, min(l_linestatus) AS v FROM c JOIN m USING (l_partkey) WHERE n = m GROUP BY 1) SELECT l_partkey, CASE WHEN k = 1 THEN v END AS chosen FROM w""")
def primary_or_null(t):
    return R.consensus(t("lineitem"), "l_partkey", "l_linestatus").select("l_partkey", F.col("value").alias("chosen"))


@query("""WITH r AS (SELECT source, doc_id, n_chars, lang, row_number() OVER (PARTITION BY source ORDER BY (CAST(n_chars > 1000 AS INTEGER) + CAST(lang = 'en' AS INTEGER)) DESC, n_chars DESC, doc_id) AS k FROM documents) SELECT source, doc_id, n_chars FROM r WHERE k = 1""")
def richest_record(t):
    rich = (F.col("n_chars") > 1000).cast("int") + (F.col("lang") == "en").cast("int")
    return t("documents").groupBy("source").agg(F.max_by(F.struct("doc_id", "n_chars"), F.struct(rich, "n_chars", -F.col("doc_id"))).alias("r")).select("source", "r.*")


@query("""SELECT mention, count(*) AS n FROM (SELECT unnest(string_split(p_name, ' ')) AS mention FROM part) WHERE mention NOT IN ('small', 'large') GROUP BY 1""")
def mention_split(t):
    m = F.filter(F.split("p_name", " "), lambda x: ~x.isin("small", "large"))
    return t("part").select(F.explode(m).alias("mention")).groupBy("mention").agg(F.count("*").alias("n"))


@query("""WITH g AS (SELECT p_name, count(*) AS n, count(DISTINCT p_brand) AS brands, count(DISTINCT p_size) AS sizes FROM part GROUP BY 1) SELECT p_name, n, CASE WHEN n >= 3 AND sizes >= 2 AND length(p_name) < 11 THEN 'split' WHEN brands > 1 THEN 'flag' ELSE 'keep' END AS verdict FROM g""")
def false_merge_split(t):
    g = t("part").groupBy("p_name").agg(F.count("*").alias("n"), F.count_distinct("p_brand").alias("brands"), F.count_distinct("p_size").alias("sizes"))
    return g.select("p_name", "n", F.when((F.col("n") >= 3) & (F.col("sizes") >= 2) & (F.length("p_name") < 11), "split").when(F.col("brands") > 1, "flag").otherwise("keep").alias("verdict"))


@query("""WITH n AS (SELECT c_custkey, c_nationkey, c_mktsegment, regexp_replace(c_name, '[0-9]+', '', 'g') AS bare, c_name FROM customer), g AS (SELECT c_nationkey, c_mktsegment, bare, count(DISTINCT c_name) AS names, min(c_custkey) AS root FROM n GROUP BY 1, 2, 3 HAVING count(DISTINCT c_name) > 1)
SELECT c_custkey, root, names - 1 AS links FROM n JOIN g USING (c_nationkey, c_mktsegment, bare)""")
def code_only_difference(t):
    """Rows of a block whose names differ by a code only: the least of them stands for the class, links counts the other names."""
    n = t("customer").select("c_custkey", "c_nationkey", "c_mktsegment", F.regexp_replace("c_name", "[0-9]+", "").alias("bare"), "c_name")
    block = ["c_nationkey", "c_mktsegment", "bare"]
    g = n.groupBy(*block).agg(F.count_distinct("c_name").alias("names"), F.min("c_custkey").alias("root")).where("names > 1")
    return n.join(g, block).select("c_custkey", "root", (F.col("names") - 1).alias("links"))


@query("""WITH g AS (SELECT md5(text) AS h, source, min(lang) AS lang FROM documents GROUP BY 1, 2) SELECT a.source AS s1, b.source AS s2, count(*) AS groups FROM g a JOIN g b ON a.h = b.h AND a.source < b.source AND a.lang = b.lang GROUP BY 1, 2""")
def match_recall_audit(t):
    g = t("documents").groupBy(F.md5("text").alias("h"), "source").agg(F.min("lang").alias("lang"))
    p = R.block_pairs(g, "source", ["h", "lang"])
    return p.groupBy(F.col("a.source").alias("s1"), F.col("b.source").alias("s2")).agg(F.count("*").alias("groups"))


BITS = "SELECT vec_id, label, array_to_string(list_transform(embedding, lambda x: CASE WHEN x > 0 THEN '1' ELSE '0' END), '') AS b FROM embeddings"


@query(f"""WITH h AS ({BITS}), k AS (SELECT vec_id, i, substr(b, CAST(i * 8 + 1 AS INTEGER), 8) AS band FROM h, (SELECT unnest(range(8)) AS i)) SELECT a.vec_id AS a, b.vec_id AS b, count(*) AS bands FROM k a JOIN k b ON a.i = b.i AND a.band = b.band AND a.vec_id < b.vec_id GROUP BY 1, 2 HAVING count(*) >= 2""")
def contiguous_band_pairs(t):
    b = F.array_join(F.transform("embedding", lambda x: F.when(x > 0, "1").otherwise("0")), "")
    h = t("embeddings").select("vec_id", b.alias("b"))
    return R.band_pairs(h, "vec_id", F.array(*(F.concat(F.lit(f"{i}:"), F.substring("b", i * 8 + 1, 8)) for i in range(8)))).where("bands >= 2")


@query("""SELECT source, string_agg(lang || ':' || doc_id, ',' ORDER BY lang) AS best FROM (SELECT source, lang, doc_id, row_number() OVER (PARTITION BY source, lang ORDER BY n_chars DESC, doc_id) AS k FROM documents) WHERE k = 1 GROUP BY 1""")
def best_cover_per_type(t):
    one = R.first_of(t("documents").select("source", "lang", "doc_id", "n_chars"), ["source", "lang"], F.desc("n_chars"), F.col("doc_id"))
    return one.groupBy("source").agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "lang", "doc_id"))), ",").alias("best"))


@query("""SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) AS k FROM documents) WHERE k = 1""")
def gallery_first_kept(t):
    return t("documents").groupBy(F.md5("text").alias("h")).agg(F.min("doc_id").alias("doc_id")).select("doc_id")


@query("""WITH g AS (SELECT source, md5(text) AS h, min(doc_id) AS doc_id, bool_or(lang = 'en') AS cover FROM documents GROUP BY 1, 2) SELECT source, doc_id, CAST(row_number() OVER (PARTITION BY source ORDER BY cover DESC, doc_id) - 1 AS INTEGER) AS sort_order FROM g""")
def gallery_projection(t):
    g = t("documents").groupBy("source", F.md5("text").alias("h")).agg(F.min("doc_id").alias("doc_id"), F.bool_or(F.col("lang") == "en").alias("cover"))
    return R.positions(g, ["source"], F.desc("cover"), F.col("doc_id")).select("source", "doc_id", "sort_order")


@query("""SELECT o.o_orderkey, CASE WHEN o_orderkey % 4 > 0 THEN o_orderstatus WHEN o_orderkey % 8 = 0 THEN 'recovered' END AS status FROM orders o""")
def recovery_merge(t):
    k = F.col("o_orderkey")
    base = t("orders").select("o_orderkey", F.when(k % 4 > 0, F.col("o_orderstatus")).alias("status"))
    again = t("orders").where(k % 8 == 0).select("o_orderkey", F.lit("recovered").alias("r"))
    return base.join(again, "o_orderkey", "left").select("o_orderkey", F.coalesce("status", "r").alias("status"))


@query("""WITH s AS (SELECT doc_id, CASE WHEN text LIKE '%@%' THEN 1 WHEN lang <> 'en' THEN 2 WHEN n_chars > 3000 THEN 3 END AS stratum FROM documents), r AS (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY md5('p' || doc_id), doc_id) AS k FROM s WHERE stratum IS NOT NULL) SELECT stratum, doc_id FROM r WHERE k <= 10""")
def priority_strata(t):
    s = F.when(F.col("text").contains("@"), 1).when(F.col("lang") != "en", 2).when(F.col("n_chars") > 3000, 3)
    d = t("documents").select("doc_id", s.alias("stratum")).where("stratum IS NOT NULL")
    return R.top_n(d, ["stratum"], 10, F.md5(F.concat(F.lit("p"), F.col("doc_id"))), F.col("doc_id")).select("stratum", "doc_id")


@query("""WITH a AS (SELECT doc_id FROM documents ORDER BY sha256('l|' || doc_id), doc_id LIMIT 20), b AS (SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM a) ORDER BY sha256('m|' || doc_id), doc_id LIMIT 30) SELECT 'n20' AS rung, doc_id FROM a UNION ALL SELECT 'n30', doc_id FROM b""")
def disjoint_ladder(t):
    d = t("documents").select("doc_id")
    a = R.hash_sample(d, 20, "l", "doc_id")
    b = R.hash_sample(d.join(a, "doc_id", "left_anti"), 30, "m", "doc_id")
    return a.select(F.lit("n20").alias("rung"), "doc_id").union(b.select(F.lit("n30"), "doc_id"))


@query("""WITH p AS (SELECT DISTINCT p_type AS prefix FROM part), n AS (SELECT p_partkey, p_type || '-' || p_brand AS slug FROM part) SELECT p_partkey, max_by(prefix, length(prefix)) AS prefix FROM n JOIN p ON starts_with(slug, prefix) GROUP BY 1""")
def longest_prefix_join(t):
    p = t("part").select(F.col("p_type").alias("prefix")).distinct()
    slug = F.concat_ws("-", "p_type", "p_brand")
    each = t("part").select("p_partkey", F.explode(F.transform(F.sequence(F.lit(1), F.length(slug)), lambda i: F.substr(slug, F.lit(1), i))).alias("prefix"))
    return each.join(p, "prefix").groupBy("p_partkey").agg(F.max_by("prefix", F.length("prefix")).alias("prefix"))


@query("""SELECT l_suppkey, count(DISTINCT l_partkey) AS missing FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 10) GROUP BY 1""")
def missing_reference_discovery(t):
    return t("lineitem").join(t("part").where("p_size > 10").select(F.col("p_partkey").alias("l_partkey")), "l_partkey", "left_anti").groupBy("l_suppkey").agg(F.count_distinct("l_partkey").alias("missing"))


@query("""SELECT CASE WHEN l.doc_id IS NULL THEN 'missing' WHEN (quality = 1) = (n_chars > 500) THEN CASE WHEN quality = 1 THEN 'confirmed' ELSE 'rejected' END ELSE 'split' END AS verdict, count(*) AS n FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id GROUP BY 1""")
def two_judges(t):
    d = t("documents").join(t("labels"), "doc_id", "left")
    same = (F.col("quality") == 1) == (F.col("n_chars") > 500)
    return d.groupBy(F.when(F.col("quality").isNull(), "missing").when(same & (F.col("quality") == 1), "confirmed").when(same, "rejected").otherwise("split").alias("verdict")).agg(F.count("*").alias("n"))


@query("""SELECT item_id, CAST(floor((row_number() OVER (ORDER BY item_id) - 1) / 8) AS BIGINT) AS batch, CASE WHEN item_id % 2 = 0 THEN 'A' ELSE 'B' END AS side FROM benchmark""")
def blind_batches(t):
    n = R.numbered(t("benchmark").select("item_id"), "item_id", "n")
    return n.select("item_id", F.floor((F.col("n") - 1) / 8).alias("batch"), F.when(F.col("item_id") % 2 == 0, "A").otherwise("B").alias("side"))


@query("""SELECT axis, agree, doc_id FROM (SELECT lang AS axis, quality = toxic AS agree, doc_id, row_number() OVER (PARTITION BY lang, quality = toxic ORDER BY sha256('adj|' || doc_id), doc_id) AS k FROM labels JOIN documents USING (doc_id)) WHERE k <= 5""")
def adjudication_queue(t):
    d = t("labels").join(t("documents"), "doc_id").select(F.col("lang").alias("axis"), (F.col("quality") == F.col("toxic")).alias("agree"), "doc_id")
    return R.top_n(d, ["axis", "agree"], 5, F.sha2(F.concat_ws("|", F.lit("adj"), "doc_id"), 256), F.col("doc_id")).select("axis", "agree", "doc_id")


@query("""SELECT lang, round(avg(CAST(n_chars > 500 AS INTEGER)), 6) AS before_share, round(avg(CAST(n_chars > 500 OR doc_id % 4 = 0 AS INTEGER)), 6) AS after_share FROM documents GROUP BY 1""")
def coverage_before_after(t):
    share = lambda c: F.round(F.avg(c.cast("int")), 6)
    long = F.col("n_chars") > 500
    return t("documents").groupBy("lang").agg(share(long).alias("before_share"), share(long | (F.col("doc_id") % 4 == 0)).alias("after_share"))


@query("""SELECT p_type AS tag, count(*) AS n, p_type NOT IN ('ECONOMY', 'STANDARD', 'PROMO') AS drifted FROM part GROUP BY 1""")
def vocabulary_drift(t):
    return t("part").groupBy(F.col("p_type").alias("tag")).agg(F.count("*").alias("n")).withColumn("drifted", ~F.col("tag").isin("ECONOMY", "STANDARD", "PROMO"))


@query("""SELECT (SELECT count(*) FROM orders) AS inputs, (SELECT count(*) FROM orders WHERE o_orderstatus = 'F') AS outputs, (SELECT count(*) FROM orders WHERE o_orderstatus = 'O') AS excluded, (SELECT count(*) FROM orders WHERE o_orderstatus NOT IN ('F', 'O')) AS unresolved, true AS balanced""")
def ledger_accounting(t):
    s = F.col("o_orderstatus")
    a = t("orders").agg(F.count("*").alias("inputs"), F.count_if(s == "F").alias("outputs"), F.count_if(s == "O").alias("excluded"), F.count_if(~s.isin("F", "O")).alias("unresolved"))
    return a.withColumn("balanced", F.col("inputs") == F.col("outputs") + F.col("excluded") + F.col("unresolved"))


@query("""SELECT count(*) AS clusters FROM (SELECT md5(text) AS h FROM documents GROUP BY 1 HAVING count(DISTINCT source) > 1)""")
def multi_source_clusters(t):
    return t("documents").groupBy(F.md5("text").alias("h")).agg(F.count_distinct("source").alias("s")).where("s > 1").agg(F.count("*").alias("clusters"))


@query("""SELECT o_custkey, count(DISTINCT o_orderstatus) > 1 AS status_conflict, CAST(max(year(o_orderdate)) - min(year(o_orderdate)) AS INTEGER) > 2 AS year_conflict FROM orders GROUP BY 1""")
def conflict_tests(t):
    y = F.year("o_orderdate")
    return t("orders").groupBy("o_custkey").agg((F.count_distinct("o_orderstatus") > 1).alias("status_conflict"), (F.max(y) - F.min(y) > 2).alias("year_conflict"))


@query("""WITH g AS (SELECT p_partkey % 50 AS cluster, p_partkey AS k, p_brand FROM part), f AS (SELECT cluster, p_brand, count(*) AS n, min(k) AS least FROM g GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY n DESC, least) AS place FROM f)
SELECT cluster, p_brand, n, CASE WHEN place = 1 THEN 'keep' ELSE 'new' END AS fate FROM r""")
def split_preview(t):
    f = t("part").groupBy((F.col("p_partkey") % 50).alias("cluster"), "p_brand").agg(F.count("*").alias("n"), F.min("p_partkey").alias("least"))
    return R.positions(f, ["cluster"], F.desc("n"), F.col("least"), name="place").select("cluster", "p_brand", "n", F.when(F.col("place") == 0, "keep").otherwise("new").alias("fate"))


@query("""SELECT p_partkey, p_brand FROM part WHERE list_contains(string_split(p_name, ' '), 'ring') AND p_type IN ('ECONOMY', 'PROMO')""")
def facet_search(t):
    return t("part").where(F.array_contains(F.split("p_name", " "), "ring") & F.col("p_type").isin("ECONOMY", "PROMO")).select("p_partkey", "p_brand")


@query("""WITH g AS (SELECT md5(text) AS gold, min(doc_id) AS want FROM documents GROUP BY 1), n AS (SELECT md5(text) AS gold, min(doc_id) AS got FROM documents WHERE doc_id <> 5 GROUP BY 1) SELECT want, got, want IS NOT DISTINCT FROM got AS ok FROM g LEFT JOIN n USING (gold)""")
def regression_gate(t):
    d = t("documents").select("doc_id", F.md5("text").alias("gold"))
    return _gold_check(d, d)


def _gold_check(held, d):
    gold = held.groupBy("gold").agg(F.min("doc_id").alias("want"))
    now = d.where("doc_id <> 5").groupBy("gold").agg(F.min("doc_id").alias("got"))
    return gold.join(now, "gold", "left").select("want", "got", F.col("want").eqNullSafe(F.col("got")).alias("ok"))


@query("""SELECT source, CASE WHEN count(DISTINCT lang) >= 3 THEN 'T1' WHEN count(DISTINCT lang) = 2 THEN 'T2' ELSE 'T3' END AS tier FROM documents GROUP BY 1""")
def confidence_tier(t):
    n = F.count_distinct("lang")
    return t("documents").groupBy("source").agg(F.when(n >= 3, "T1").when(n == 2, "T2").otherwise("T3").alias("tier"))


