"""Relational operators on the driver's tables: joins, aggregates, windows, sets, samples, statistics."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from cairnwork.functions import values as V
from cairnwork.operators import relational as R
from cairnwork.plans.registry import query

D = "double"


@query("""SELECT 'c_custkey' AS field, count(*) FILTER (WHERE c_custkey IS NULL) AS nulls, CAST(0 AS BIGINT) AS blanks FROM customer
UNION ALL SELECT 'c_name', count(*) FILTER (WHERE c_name IS NULL), count(*) FILTER (WHERE trim(c_name) = '') FROM customer
UNION ALL SELECT 'c_nationkey', count(*) FILTER (WHERE c_nationkey IS NULL), 0 FROM customer
UNION ALL SELECT 'c_acctbal', count(*) FILTER (WHERE c_acctbal IS NULL), 0 FROM customer
UNION ALL SELECT 'c_mktsegment', count(*) FILTER (WHERE c_mktsegment IS NULL), count(*) FILTER (WHERE trim(c_mktsegment) = '') FROM customer""")
def null_census(t):
    return R.null_census(t("customer"))


@query("SELECT event_type, count(*) AS n, count(*) FILTER (WHERE value > 50) AS large, count(*) FILTER (WHERE value <= 10) AS small, count(DISTINCT user_id) AS users FROM events GROUP BY 1")
def filtered_counts(t):
    return t("events").groupBy("event_type").agg(F.count("*").alias("n"), F.count_if(F.col("value") > 50).alias("large"), F.count_if(F.col("value") <= 10).alias("small"), F.count_distinct("user_id").alias("users"))


@query("SELECT count(*) AS groups, CAST(sum(n) AS BIGINT) AS members FROM (SELECT md5(trim(text)) AS h, count(*) AS n FROM documents GROUP BY 1 HAVING count(*) > 1)")
def duplicate_groups(t):
    g = t("documents").groupBy(F.md5(F.trim("text")).alias("h")).agg(F.count("*").alias("n")).where("n > 1")
    return g.agg(F.count("*").alias("groups"), F.sum("n").alias("members"))


@query("SELECT count(*) AS total, count(DISTINCT o_custkey) AS distinct_keys, count(*) - count(DISTINCT o_custkey) AS duplicates FROM orders")
def distinct_census(t):
    n, d = F.count("*"), F.count_distinct("o_custkey")
    return t("orders").agg(n.alias("total"), d.alias("distinct_keys"), (n - d).alias("duplicates"))


@query("""SELECT 'order_pk' AS check_name, (SELECT count(*) - count(DISTINCT o_orderkey) FROM orders) AS violations
UNION ALL SELECT 'order_customer', (SELECT count(*) FROM orders WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey))
UNION ALL SELECT 'line_order', (SELECT count(*) FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey))
UNION ALL SELECT 'idle_customer', (SELECT count(*) FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE c_custkey = o_custkey))""")
def pk_and_ref_checks(t):
    o, c, line = t("orders"), t("customer"), t("lineitem")
    row = lambda name, df: df.select(F.lit(name).alias("check_name"), "violations")
    anti = lambda a, b, k, m: a.join(b.select(F.col(m).alias(k)), k, "left_anti").agg(F.count("*").alias("violations"))
    out = row("order_pk", o.agg((F.count("*") - F.count_distinct("o_orderkey")).alias("violations")))
    for name, x in (("order_customer", anti(o, c, "o_custkey", "c_custkey")), ("line_order", anti(line, o, "l_orderkey", "o_orderkey")), ("idle_customer", anti(c, o, "c_custkey", "o_custkey"))):
        out = out.union(row(name, x))
    return out


@query("""(SELECT 'left' AS side, s_suppkey AS k FROM supplier EXCEPT SELECT 'left', l_suppkey FROM lineitem WHERE l_quantity > 45)
UNION ALL (SELECT 'right', l_suppkey FROM lineitem WHERE l_quantity > 45 EXCEPT SELECT 'right', s_suppkey FROM supplier)""")
def key_parity_except(t):
    return R.key_parity(t("supplier").select(F.col("s_suppkey").alias("k")), t("lineitem").where("l_quantity > 45").select(F.col("l_suppkey").alias("k")), "k")


@query("SELECT kind, count(*) AS n, CAST(sum(id) AS BIGINT) AS total FROM (SELECT 'order' AS kind, o_custkey AS id FROM orders UNION ALL SELECT 'customer', c_custkey FROM customer) GROUP BY 1")
def union_all_ledgers(t):
    u = t("orders").select(F.lit("order").alias("kind"), F.col("o_custkey").alias("id")).union(t("customer").select(F.lit("customer"), "c_custkey"))
    return u.groupBy("kind").agg(F.count("*").alias("n"), F.sum("id").alias("total"))


@query("SELECT o_custkey AS id FROM orders UNION SELECT s_suppkey FROM supplier")
def union_distinct_endpoints(t):
    return t("orders").select(F.col("o_custkey").alias("id")).union(t("supplier").select("s_suppkey")).distinct()


@query("""WITH e AS (SELECT user_id, event_type, ts < TIMESTAMP '2024-01-02' AS early FROM events),
g AS (SELECT user_id, event_type, bool_or(early) AS a, bool_or(NOT early) AS b FROM e GROUP BY 1, 2)
SELECT user_id, count(*) FILTER (WHERE a AND b) AS same, count(*) FILTER (WHERE b AND NOT a) AS added, count(*) FILTER (WHERE a AND NOT b) AS dropped FROM g GROUP BY 1""")
def set_diff_per_group(t):
    early = F.col("ts") < F.lit("2024-01-02").cast("timestamp_ntz")
    sets = t("events").groupBy("user_id").agg(F.collect_set(F.when(early, F.col("event_type"))).alias("a"), F.collect_set(F.when(~early, F.col("event_type"))).alias("b"))
    n = lambda c: F.size(c).cast("long")
    return sets.select("user_id", n(F.array_intersect("a", "b")).alias("same"), n(F.array_except("b", "a")).alias("added"), n(F.array_except("a", "b")).alias("dropped"))


@query("""SELECT a.o_orderkey AS a, b.o_orderkey AS b, CAST(abs(year(a.o_orderdate) - year(b.o_orderdate)) AS INTEGER) AS gap FROM orders a JOIN orders b
ON a.o_custkey = b.o_custkey AND a.o_orderpriority = b.o_orderpriority AND a.o_orderkey < b.o_orderkey AND abs(year(a.o_orderdate) - year(b.o_orderdate)) <= 2""")
def block_join_year(t):
    o = t("orders").select("o_orderkey", "o_custkey", "o_orderpriority", F.year("o_orderdate").alias("y"))
    gap = F.abs(F.col("a.y") - F.col("b.y"))
    return R.block_pairs(o, "o_orderkey", ["o_custkey", "o_orderpriority"], gap <= 2).select(F.col("a.o_orderkey").alias("a"), F.col("b.o_orderkey").alias("b"), gap.alias("gap"))


@query("""WITH o AS (SELECT o_orderkey, o_custkey, CAST(year(o_orderdate) AS INTEGER) AS y FROM orders)
SELECT a.o_orderkey AS a, b.o_orderkey AS b FROM o a JOIN o b ON a.o_custkey = b.o_custkey AND abs(a.y - b.y) <= 1 AND a.o_orderkey <> b.o_orderkey""")
def year_bucket_join(t):
    o = t("orders").select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("y"))
    return _near_years(o, o)


def _near_years(left, o):
    left = left.select(F.col("o_orderkey").alias("a"), "o_custkey", "y")
    return R.year_bucket_join(left, o.select(F.col("o_orderkey").alias("b"), "o_custkey", F.col("y").alias("y2")), ["o_custkey"], "y", "y2", 1).where("a <> b").select("a", "b")


@query("""WITH c AS (SELECT c_custkey, c_nationkey, min(CAST(year(o_orderdate) AS INTEGER)) AS lo, max(CAST(year(o_orderdate) AS INTEGER)) AS hi FROM customer JOIN orders ON c_custkey = o_custkey WHERE o_totalprice > 250000 GROUP BY 1, 2)
SELECT a.c_custkey AS a, b.c_custkey AS b, greatest(0, a.lo - b.hi, b.lo - a.hi) AS gap FROM c a JOIN c b ON a.c_nationkey = b.c_nationkey AND a.c_custkey < b.c_custkey WHERE greatest(0, a.lo - b.hi, b.lo - a.hi) > 1""")
def year_interval_gap(t):
    y = F.year("o_orderdate")
    c = t("customer").join(t("orders").where("o_totalprice > 250000"), F.col("c_custkey") == F.col("o_custkey")).groupBy("c_custkey", "c_nationkey").agg(F.min(y).alias("lo"), F.max(y).alias("hi"))
    gap = V.interval_gap(F.col("a.lo"), F.col("a.hi"), F.col("b.lo"), F.col("b.hi"))
    return R.block_pairs(c, "c_custkey", ["c_nationkey"], gap > 1).select(F.col("a.c_custkey").alias("a"), F.col("b.c_custkey").alias("b"), gap.alias("gap"))


@query("""WITH n AS (SELECT l_suppkey, p_type, count(*) AS n FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY n DESC, p_type) AS k FROM n) SELECT l_suppkey, p_type, n FROM r WHERE k = 1""")
def mode_by_group(t):
    return R.mode_by(t("lineitem").join(t("part"), F.col("p_partkey") == F.col("l_partkey")), ["l_suppkey"], "p_type")


@query("""WITH x AS (SELECT l_suppkey, p_type, p_size FROM lineitem JOIN part ON p_partkey = l_partkey), n AS (SELECT l_suppkey, p_type, count(*) AS n FROM x GROUP BY 1, 2),
m AS (SELECT l_suppkey, p_type FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY n DESC, p_type) AS k FROM n) WHERE k = 1),
s AS (SELECT l_suppkey, p_type, p_size, count(*) AS n FROM x JOIN m USING (l_suppkey, p_type) GROUP BY 1, 2, 3)
SELECT l_suppkey, p_type, p_size FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey, p_type ORDER BY n DESC, p_size) AS k FROM s) WHERE k = 1""")
def modal_pair(t):
    x = t("lineitem").join(t("part"), F.col("p_partkey") == F.col("l_partkey")).select("l_suppkey", "p_type", "p_size")
    m = R.mode_by(x, ["l_suppkey"], "p_type").select("l_suppkey", "p_type")
    return R.mode_by(x.join(m, ["l_suppkey", "p_type"]), ["l_suppkey", "p_type"], "p_size").select("l_suppkey", "p_type", "p_size")


@query("SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS k FROM events) WHERE k = 1")
def dedupe_keep_first(t):
    return R.first_of(t("events"), ["user_id", "event_type"], F.col("ts"), F.col("event_id")).select("user_id", "event_type", "event_id", "value")


@query("""SELECT lang, doc_id, CAST(rank AS INTEGER) AS rank, n FROM (SELECT lang, doc_id, row_number() OVER (PARTITION BY lang ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id) AS rank, count(*) OVER (PARTITION BY lang) AS n FROM documents) WHERE rank <= 3""")
def topn_examples_per_tag(t):
    d = t("documents").select("lang", "doc_id")
    top = R.top_n(d, ["lang"], 3, F.md5(F.col("doc_id").cast("string")), F.col("doc_id"))
    return top.join(d.groupBy("lang").agg(F.count("*").alias("n")), "lang").select("lang", "doc_id", "rank", "n")


@query("SELECT user_id, max(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS click, max(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS viewed, max(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS error FROM events GROUP BY 1")
def evidence_pivot(t):
    flag = lambda k: F.max(F.when(F.col("event_type") == k, 1).otherwise(0))
    return t("events").groupBy("user_id").agg(flag("click").alias("click"), flag("view").alias("viewed"), flag("error").alias("error"))


@query("""SELECT l_partkey AS part, l_suppkey AS supp, CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS returned, CAST(sum(CASE WHEN l_discount > 0.05 THEN 1 ELSE 0 END) AS BIGINT) AS discounted, min(l_quantity) AS least, count(*) AS n FROM lineitem GROUP BY 1, 2""")
def evidence_rollup(t):
    one = lambda c: F.sum(F.when(c, 1).otherwise(0)).cast("long")
    return t("lineitem").groupBy(F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supp")).agg(one(F.col("l_returnflag") == "R").alias("returned"), one(F.col("l_discount") > 0.05).alias("discounted"), F.min("l_quantity").alias("least"), F.count("*").alias("n"))


@query("""WITH c AS (SELECT user_id % 50 AS k, event_type AS axis, CAST(floor(value / 10) AS BIGINT) AS v, round(value / 100, 4) AS conf, user_id AS src FROM events),
b AS (SELECT k, axis, v, max(conf) AS confidence, count(*) AS claims, count(DISTINCT src) AS sources FROM c GROUP BY 1, 2, 3)
SELECT *, CASE WHEN confidence >= 0.85 THEN 'confirmed' WHEN sources >= 2 AND confidence >= 0.75 THEN 'confirmed' ELSE 'candidate' END AS status FROM b""")
def claims_to_facets(t):
    c = t("events").select((F.col("user_id") % 50).alias("k"), F.col("event_type").alias("axis"), F.floor(F.col("value") / 10).alias("v"), F.round(F.col("value") / 100, 4).alias("conf"), F.col("user_id").alias("src"))
    return R.facets(c, "k", "axis", "v", "conf", "src")


@query("""WITH c AS (SELECT l_orderkey, l_returnflag AS v, count(*) AS n FROM lineitem GROUP BY 1, 2), m AS (SELECT l_orderkey, max(n) AS most, count(*) AS kinds FROM c GROUP BY 1),
w AS (SELECT c.l_orderkey, kinds, count(*) AS ties, min(v) AS v FROM c JOIN m ON c.l_orderkey = m.l_orderkey AND c.n = m.most GROUP BY 1, 2)
SELECT l_orderkey, CASE WHEN ties = 1 THEN v END AS value, CASE WHEN kinds = 1 THEN 'unanimous' WHEN ties > 1 THEN 'conflict' ELSE 'plurality' END AS status FROM w""")
def consensus_value(t):
    return R.consensus(t("lineitem"), "l_orderkey", "l_returnflag")


@query("""WITH x AS (SELECT l_suppkey, l_partkey, l_orderkey, p_type, CAST(year(l_shipdate) AS INTEGER) AS y, l_quantity FROM lineitem JOIN part ON p_partkey = l_partkey),
t AS (SELECT l_suppkey, string_agg(p_type || ':' || n, ',' ORDER BY n DESC, p_type) AS top_types FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY n DESC, p_type) AS k FROM (SELECT l_suppkey, p_type, count(*) AS n FROM x GROUP BY 1, 2)) WHERE k <= 3 GROUP BY 1),
h AS (SELECT l_suppkey, l_partkey AS hero FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_quantity DESC, l_partkey, l_orderkey) AS k FROM x) WHERE k = 1),
a AS (SELECT l_suppkey, count(*) AS lines, count(DISTINCT l_partkey) AS parts, min(y) AS first_year, max(y) AS last_year FROM x GROUP BY 1)
SELECT * FROM a JOIN t USING (l_suppkey) JOIN h USING (l_suppkey)""")
def portfolio_rollup(t):
    x = t("lineitem").join(t("part"), F.col("p_partkey") == F.col("l_partkey")).select("l_suppkey", "l_partkey", "l_orderkey", "p_type", F.year("l_shipdate").alias("y"), "l_quantity")
    counts = x.groupBy("l_suppkey", "p_type").agg(F.count("*").alias("n"))
    ranked = F.slice(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("m"), "p_type"))), 1, 3)
    top = counts.groupBy("l_suppkey").agg(F.array_join(F.transform(ranked, lambda e: F.concat_ws(":", e["p_type"], -e["m"])), ",").alias("top_types"))
    rest = x.groupBy("l_suppkey").agg(F.count("*").alias("lines"), F.count_distinct("l_partkey").alias("parts"), F.min("y").alias("first_year"), F.max("y").alias("last_year"), F.min_by("l_partkey", F.struct(-F.col("l_quantity"), "l_partkey", "l_orderkey")).alias("hero"))
    return rest.join(top, "l_suppkey")


@query("SELECT lang, quantile_disc(n_chars, 0.5) AS median, quantile_disc(n_chars, 0.9) AS p90 FROM documents GROUP BY 1")
def percentile_disc_len(t):
    q = lambda p, n: F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY n_chars)").cast("long").alias(n)
    return t("documents").groupBy("lang").agg(q(0.5, "median"), q(0.9, "p90"))


@query("SELECT lang, round(quantile_cont(n_chars, 0.05), 4) AS p05, round(quantile_cont(n_chars, 0.5), 4) AS p50, round(quantile_cont(n_chars, 0.95), 4) AS p95, round(avg(n_chars), 4) AS mean FROM documents GROUP BY 1")
def quantiles_interp(t):
    q = lambda p, n: F.round(F.percentile("n_chars", p), 4).alias(n)
    return t("documents").groupBy("lang").agg(q(0.05, "p05"), q(0.5, "p50"), q(0.95, "p95"), F.round(F.avg("n_chars"), 4).alias("mean"))


@query("""WITH n AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1)
SELECT CASE WHEN n = 1 THEN '1' WHEN n <= 4 THEN '2-4' WHEN n <= 9 THEN '5-9' ELSE '10+' END AS bucket, count(*) AS orders FROM n GROUP BY 1""")
def histogram_buckets(t):
    n = t("lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n"))
    return n.groupBy(F.when(F.col("n") == 1, "1").when(F.col("n") <= 4, "2-4").when(F.col("n") <= 9, "5-9").otherwise("10+").alias("bucket")).agg(F.count("*").alias("orders"))


@query("""WITH s AS (SELECT source, CAST(n_chars > 500 AS INTEGER) + CAST(lang = 'en' AS INTEGER) + CAST(text LIKE '%@%' AS INTEGER) + CAST(text LIKE '%|%' AS INTEGER) AS score FROM documents)
SELECT source, round(avg(score), 6) AS mean_score, count(*) FILTER (WHERE score >= 2) AS rich FROM s GROUP BY 1""")
def info_score(t):
    one = lambda c: c.cast("int")
    score = one(F.col("n_chars") > 500) + one(F.col("lang") == "en") + one(F.col("text").contains("@")) + one(F.col("text").contains("|"))
    s = t("documents").select("source", score.alias("score"))
    return s.groupBy("source").agg(F.round(F.avg("score"), 6).alias("mean_score"), F.count_if(F.col("score") >= 2).alias("rich"))


WILSON = "(p + z*z/(2*n) {} z*sqrt(p*(1-p)/n + z*z/(4*n*n))) / (1 + z*z/n)"


@query(f"""WITH g AS (SELECT lang, CAST(count(*) AS DOUBLE) AS n, CAST(sum(quality) AS DOUBLE) / count(*) AS p, 1.959963984540054 AS z FROM labels JOIN documents USING (doc_id) GROUP BY 1)
SELECT lang, CAST(n AS BIGINT) AS n, round(p, 6) AS rate, round({WILSON.format("-")}, 6) AS low, round({WILSON.format("+")}, 6) AS high FROM g""")
def wilson_by_group(t):
    g = t("labels").join(t("documents"), "doc_id").groupBy("lang").agg(F.count("*").cast(D).alias("n"), (F.sum("quality") / F.count("*")).alias("p")).withColumn("z", F.lit(1.959963984540054))
    return g.select("lang", F.col("n").cast("long").alias("n"), F.round("p", 6).alias("rate"), F.round(F.expr(WILSON.format("-")), 6).alias("low"), F.round(F.expr(WILSON.format("+")), 6).alias("high"))


@query("""WITH s AS (SELECT quality, n_chars FROM labels JOIN documents USING (doc_id)), r AS (SELECT quality, rank() OVER (ORDER BY n_chars) + (count(*) OVER (PARTITION BY n_chars) - 1) / 2.0 AS r FROM s)
SELECT round((sum(CASE WHEN quality = 1 THEN r ELSE 0 END) - sum(quality) * (sum(quality) + 1) / 2.0) / (sum(quality) * (count(*) - sum(quality))), 6) AS auroc FROM r""")
def auroc(t):
    # ranks come from counts per score; their running total goes by ranges of scores, so no task sees them all
    s = t("labels").join(t("documents"), "doc_id").groupBy("n_chars").agg(F.count("*").alias("n"), F.sum("quality").alias("pos"))
    r = R.running_total(s, "n_chars", "n", "before").withColumn("r", (F.col("before") + (F.col("n") + 1) / 2) * F.col("pos"))
    p, n = F.sum("pos"), F.sum("n")
    return r.agg(F.round((F.sum("r") - p * (p + 1) / 2) / (p * (n - p)), 6).alias("auroc"))


@query("""WITH s AS (SELECT quality, n_chars FROM labels JOIN documents USING (doc_id)), k AS (SELECT unnest([200, 500, 1000, 2000, 5000]) AS cut)
SELECT cut, count(*) FILTER (WHERE n_chars >= cut) AS kept, round(count(*) FILTER (WHERE n_chars >= cut AND quality = 1) / CAST(count(*) FILTER (WHERE quality = 1) AS DOUBLE), 6) AS recall, round(count(*) FILTER (WHERE n_chars >= cut AND quality = 0) / CAST(count(*) FILTER (WHERE quality = 0) AS DOUBLE), 6) AS fpr FROM s, k GROUP BY 1""")
def threshold_table(t):
    s = t("labels").join(t("documents"), "doc_id").select("quality", "n_chars", F.explode(F.array(*map(F.lit, (200, 500, 1000, 2000, 5000)))).alias("cut"))
    over = F.col("n_chars") >= F.col("cut")
    share = lambda q: F.round(F.count_if(over & (F.col("quality") == q)) / F.count_if(F.col("quality") == q), 6)
    return s.groupBy("cut").agg(F.count_if(over).alias("kept"), share(1).alias("recall"), share(0).alias("fpr"))


@query("""WITH b AS (SELECT CAST(floor(n_chars / 250) AS BIGINT) AS band, count(*) AS n, CAST(sum(quality) AS BIGINT) AS good FROM labels JOIN documents USING (doc_id) GROUP BY 1)
SELECT band, CAST(sum(n) OVER w AS BIGINT) AS routed, round(CAST(sum(good) OVER w AS DOUBLE) / sum(n) OVER w, 6) AS accuracy FROM b WINDOW w AS (ORDER BY band ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)""")
def routing_curve(t):
    b = t("labels").join(t("documents"), "doc_id").groupBy(F.floor(F.col("n_chars") / 250).alias("band")).agg(F.count("*").alias("n"), F.sum("quality").alias("good"))
    w = Window.orderBy("band").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    return b.select("band", F.sum("n").over(w).alias("routed"), F.round(F.sum("good").over(w) / F.sum("n").over(w), 6).alias("accuracy"))


@query("""WITH s AS (SELECT lang, source, count(*) AS size FROM documents GROUP BY 1, 2), q AS (SELECT *, size * 100 / CAST(sum(size) OVER () AS DOUBLE) AS whole FROM s), f AS (SELECT *, CAST(floor(whole) AS BIGINT) AS fl FROM q),
r AS (SELECT *, row_number() OVER (ORDER BY round(whole - fl, 9) DESC, lang, source) AS k, 100 - sum(fl) OVER () AS rest FROM f) SELECT lang, source, size, CAST(fl + CASE WHEN k <= rest THEN 1 ELSE 0 END AS BIGINT) AS quota FROM r""")
def hamilton_quota(t):
    return R.quotas(t("documents"), ["lang", "source"], 100)


@query("SELECT doc_id, source FROM documents ORDER BY sha256('s1|' || doc_id), doc_id LIMIT 50")
def hash_sample(t):
    return R.hash_sample(t("documents").select("doc_id", "source"), 50, "s1", "doc_id")


@query("""WITH s AS (SELECT lang, count(*) AS size FROM documents GROUP BY 1), q AS (SELECT *, size * 40 / CAST(sum(size) OVER () AS DOUBLE) AS whole FROM s), f AS (SELECT *, CAST(floor(whole) AS BIGINT) AS fl FROM q),
r AS (SELECT *, row_number() OVER (ORDER BY round(whole - fl, 9) DESC, lang) AS k, 40 - sum(fl) OVER () AS rest FROM f), c AS (SELECT lang, fl + CASE WHEN k <= rest THEN 1 ELSE 0 END AS quota FROM r),
d AS (SELECT lang, doc_id, row_number() OVER (PARTITION BY lang ORDER BY sha256('s2|' || doc_id), doc_id) AS k FROM documents) SELECT lang, doc_id FROM d JOIN c USING (lang) WHERE k <= quota""")
def stratified_sample(t):
    return R.stratified(t("documents").select("lang", "doc_id"), ["lang"], 40, "s2", "doc_id")


@query("SELECT o_orderpriority, round(sum(o_totalprice), 2) AS total, count(*) AS n FROM orders WHERE o_orderstatus = ANY(['F', 'O']) AND o_orderpriority <> ALL(['1-URGENT']) GROUP BY 1")
def any_all_lists(t):
    return t("orders").where(F.col("o_orderstatus").isin("F", "O") & ~F.col("o_orderpriority").isin("1-URGENT")).groupBy("o_orderpriority").agg(F.round(F.sum("o_totalprice"), 2).alias("total"), F.count("*").alias("n"))


@query("""SELECT a.c_custkey, a.c_nationkey AS nation, CAST(CASE WHEN a.c_acctbal > 5000 THEN a.c_nationkey END AS INTEGER) AS seen FROM customer a WHERE a.c_nationkey IS DISTINCT FROM CASE WHEN a.c_acctbal > 5000 THEN a.c_nationkey END""")
def distinct_from(t):
    c = t("customer").withColumn("seen", F.when(F.col("c_acctbal") > 5000, F.col("c_nationkey")))
    return c.where(~F.col("c_nationkey").eqNullSafe(F.col("seen"))).select("c_custkey", F.col("c_nationkey").alias("nation"), "seen")


@query("SELECT c.c_custkey, coalesce(o.first_order, -1) AS first_order FROM customer c LEFT JOIN (SELECT o_custkey, min(o_orderkey) AS first_order FROM orders GROUP BY 1) o ON c.c_custkey = o.o_custkey")
def scalar_subquery_min(t):
    o = t("orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.min("o_orderkey").alias("first_order"))
    return t("customer").join(o, "c_custkey", "left").select("c_custkey", F.coalesce("first_order", F.lit(-1)).alias("first_order"))


@query("""SELECT r_name, n_name, count(*) AS orders, round(sum(o_totalprice), 2) AS total FROM region JOIN nation ON r_regionkey = n_regionkey JOIN customer ON n_nationkey = c_nationkey JOIN orders ON c_custkey = o_custkey GROUP BY 1, 2""")
def join_chain(t):
    x = t("orders").join(t("customer"), F.col("c_custkey") == F.col("o_custkey")).join(F.broadcast(t("nation")), F.col("n_nationkey") == F.col("c_nationkey")).join(F.broadcast(t("region")), F.col("r_regionkey") == F.col("n_regionkey"))
    return x.groupBy("r_name", "n_name").agg(F.count("*").alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events WHERE CAST(json_extract_string(props, '$.k') AS INTEGER) >= 90")
def json_props_extract(t):
    k = F.get_json_object("props", "$.k").cast("int")
    return t("events").select("event_id", k.alias("k")).where("k >= 90")


@query("SELECT o_custkey, string_agg(DISTINCT o_orderstatus, ',' ORDER BY o_orderstatus) AS statuses, string_agg(DISTINCT CAST(year(o_orderdate) AS VARCHAR), ',' ORDER BY CAST(year(o_orderdate) AS VARCHAR)) AS years FROM orders GROUP BY 1")
def text_aggregates(t):
    text = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    return t("orders").groupBy("o_custkey").agg(text("o_orderstatus").alias("statuses"), text(F.year("o_orderdate").cast("string")).alias("years"))


@query("SELECT c_nationkey, bool_and(c_acctbal > -1000) AS all_solvent, bool_or(c_acctbal > 9900) AS any_rich FROM customer GROUP BY 1")
def bool_reduce(t):
    return t("customer").groupBy("c_nationkey").agg(F.bool_and(F.col("c_acctbal") > -1000).alias("all_solvent"), F.bool_or(F.col("c_acctbal") > 9900).alias("any_rich"))


@query("""SELECT o_orderkey, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) - 1 AS INTEGER) AS sort_order FROM orders""")
def contiguous_order(t):
    return R.positions(t("orders"), ["o_custkey"], F.desc("o_totalprice"), F.col("o_orderkey")).select("o_orderkey", "sort_order")


@query("""WITH r AS (SELECT l_orderkey, l_extendedprice, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_linenumber) AS k FROM lineitem)
SELECT l_orderkey, max(CASE WHEN k = 1 THEN l_extendedprice END) AS best, max(CASE WHEN k = 2 THEN l_extendedprice END) AS second, round(max(CASE WHEN k = 1 THEN l_extendedprice END) - max(CASE WHEN k = 2 THEN l_extendedprice END), 2) AS margin FROM r WHERE k <= 2 GROUP BY 1""")
def best_second_margin(t):
    r = R.top_n(t("lineitem"), ["l_orderkey"], 2, F.desc("l_extendedprice"), F.col("l_linenumber"), rank="k")
    at = lambda n: F.max(F.when(F.col("k") == n, F.col("l_extendedprice")))
    return r.groupBy("l_orderkey").agg(at(1).alias("best"), at(2).alias("second"), F.round(at(1) - at(2), 2).alias("margin"))


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def order_by_limit(t):
    return t("orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(25)


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey > 500 OR (o_custkey = 500 AND o_orderkey > 10)")
def keyset_scan(t):
    return t("orders").where("o_custkey > 500 OR (o_custkey = 500 AND o_orderkey > 10)").select("o_orderkey", "o_custkey")


@query("""SELECT 'part' AS axis, p_type AS tag, count(*) AS df FROM part GROUP BY 2 UNION ALL SELECT 'brand', p_brand, count(*) FROM part GROUP BY 2
UNION ALL SELECT 'size', CASE WHEN p_size < 10 THEN 's' WHEN p_size < 30 THEN 'm' ELSE 'l' END, count(*) FROM part GROUP BY 2""")
def tag_axes_stack_docfreq(t):
    size = F.when(F.col("p_size") < 10, "s").when(F.col("p_size") < 30, "m").otherwise("l")
    return R.stack_axes(t("part"), "p_partkey", {"part": F.array("p_type"), "brand": F.array("p_brand"), "size": F.array(size)}).groupBy("axis", "tag").agg(F.count("*").alias("df"))


@query("""WITH v AS (SELECT unnest(['ECONOMY', 'STANDARD', 'PROMO', 'NEVER SEEN']) AS tag), o AS (SELECT p_type AS tag, count(*) AS df FROM part GROUP BY 1)
SELECT tag, coalesce(df, 0) AS df, round(ln((SELECT count(*) FROM part) / CAST(coalesce(df, 0) + 1 AS DOUBLE)), 6) AS idf FROM v LEFT JOIN o USING (tag)""")
def vocab_left_join_unobserved(t):
    p = t("part")
    v = p.sparkSession.createDataFrame([(x,) for x in ("ECONOMY", "STANDARD", "PROMO", "NEVER SEEN")], "tag string")
    seen = p.groupBy(F.col("p_type").alias("tag")).agg(F.count("*").alias("df"))
    total = F.broadcast(p.agg(F.count("*").alias("n")))
    df = F.coalesce("df", F.lit(0))
    return v.join(seen, "tag", "left").join(total).select("tag", df.alias("df"), F.round(F.ln(F.col("n") / (df + 1)), 6).alias("idf"))


@query("""WITH e AS (SELECT vec_id, label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings), s AS (SELECT label, i, sum(CAST(round(CAST(x AS DOUBLE) * 1000000) AS BIGINT)) AS s, count(*) AS n FROM e GROUP BY 1, 2), m AS (SELECT label, i, n, CAST(s AS DOUBLE) / n / 1000000 AS x FROM s)
SELECT label, max(n) AS df, round(ln((SELECT count(*) FROM embeddings) / CAST(max(n) + 1 AS DOUBLE)), 6) AS idf, round(sqrt(sum(x * x)), 6) AS norm, CAST(row_number() OVER (ORDER BY max(n) DESC, label) AS INTEGER) AS sort_rank FROM m GROUP BY 1""")
def tag_stats(t):
    e = t("embeddings")
    m = R.mean_vectors(e, "label", "embedding")
    total = F.broadcast(e.agg(F.count("*").alias("total")))
    rank = F.row_number().over(Window.orderBy(F.desc("n"), "label"))
    return m.join(total).select("label", F.col("n").alias("df"), F.round(F.ln(F.col("total") / (F.col("n") + 1)), 6).alias("idf"), F.round(V.norm(F.col("mean")), 6).alias("norm"), rank.alias("sort_rank"))


@query("""SELECT count(*) AS n, round(min(sqrt(list_inner_product(e, e))), 5) AS least, round(max(sqrt(list_inner_product(e, e))), 5) AS most FROM (SELECT list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings)""")
def vector_norm_census(t):
    n = t("embeddings").select(V.norm(F.col("embedding")).alias("n"))
    return n.agg(F.count("*").alias("n"), F.round(F.min(F.col("n")), 5).alias("least"), F.round(F.max(F.col("n")), 5).alias("most"))
