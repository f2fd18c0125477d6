"""Text, URL, number, page, snapshot, queue and quality queries on the driver's tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from cairnwork.functions import text as X
from cairnwork.functions import values as V
from cairnwork.operators import relational as R
from cairnwork.plans.registry import query
from cairnwork.sources import readers, sinks
from cairnwork.streaming import queues

GENERIC = ["the", "of", "and", "in", "on", "la", "le", "de", "der", "die"]
GENERIC_SQL = ", ".join(f"'{g}'" for g in GENERIC)
PLAIN = "trim(regexp_replace(lower({}), '[^a-z0-9]+', ' ', 'g'))"
TOK = f"list_filter(string_split({PLAIN.format('p_name')}, ' '), lambda t: t <> '')"


@query(f"SELECT p_partkey, {PLAIN.format('p_name')} AS plain, md5({PLAIN.format('p_name')}) AS h FROM part")
def text_normalize(t):
    return t("part").select("p_partkey", X.plain(F.col("p_name")).alias("plain"), F.md5(X.plain(F.col("p_name"))).alias("h"))


@query()
def text_fold_unicode(t):
    return t("documents").select("doc_id", X.fold_unicode(F.col("text")).alias("folded"))


@query(f"SELECT doc_id, array_to_string(list_filter({TOK.replace('p_name', 'text')}, lambda t: t NOT IN ({GENERIC_SQL})), ' ') AS core, len(list_filter({TOK.replace('p_name', 'text')}, lambda t: t NOT IN ({GENERIC_SQL}))) <= 1 AS generic FROM documents")
def core_tokens(t):
    c = F.col("text")
    return t("documents").select("doc_id", F.array_join(X.core_tokens(c, GENERIC), " ").alias("core"), X.is_generic(c, GENERIC).alias("generic"))


@query(f"SELECT item_id, array_to_string(list_sort(list_distinct(list_filter({TOK.replace('p_name', 'text')}, lambda t: len(t) >= 3 AND t NOT IN ({GENERIC_SQL})))), ',') AS keywords FROM benchmark")
def search_keywords(t):
    return t("benchmark").select("item_id", F.array_join(X.search_keywords(F.col("text"), GENERIC), ",").alias("keywords"))


@query("SELECT doc_id, trim(regexp_replace(regexp_replace(text, '[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F\\x7F]', '', 'g'), '[ \\t]+', ' ', 'g')) AS cleaned, length(text) > 2000 AS long FROM documents")
def text_cleanup(t):
    return t("documents").select("doc_id", X.clean_controls(F.col("text")).alias("cleaned"), (F.length("text") > 2000).alias("long"))


@query("SELECT page_id, lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)', 1)) AS host, regexp_replace(url, '^http://', 'https://') AS secure, lower(regexp_extract(rtrim(regexp_replace(url, '[?#].*$', ''), '/'), '([^/]+)$', 1)) AS slug, CASE WHEN lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)', 1)) LIKE '%example.com%' THEN 'com' WHEN lower(url) LIKE '%example.net%' THEN 'net' ELSE 'other' END AS label FROM pages")
def url_parts(t):
    u = F.col("url")
    return t("pages").select("page_id", V.host(u).alias("host"), V.https(u).alias("secure"), V.slug(u).alias("slug"), V.source_label(u, [("example.com", "com"), ("example.net", "net")]).alias("label"))


@query("SELECT page_id, regexp_replace(url, '^https?://(?:www|m)[.]([^/]+)', 'https://\\1') AS moved FROM pages")
def host_rewrite(t):
    return t("pages").select("page_id", V.rewrite_host(F.col("url"), "^https?://(?:www|m)[.]([^/]+)", "https://$1").alias("moved"))


@query("SELECT page_id, regexp_extract(html, '(?s)<title[^>]*>(.*?)</title>', 1) AS title, regexp_extract(html, '<html[^>]*\\slang=\"([^\"]*)\"', 1) AS lang, len(regexp_extract_all(html, '<a\\s[^>]*href=\"([^\"]*)\"', 1)) AS links FROM pages")
def html_extract_meta(t):
    h = F.col("html")
    return t("pages").select("page_id", readers.page_title(h).alias("title"), readers.page_language(h).alias("lang"), F.size(readers.page_links(h)).cast("long").alias("links"))


@query("SELECT link, count(*) AS n, count(DISTINCT page_id) AS pages FROM (SELECT page_id, unnest(regexp_extract_all(html, '<a\\s[^>]*href=\"([^\"]*)\"', 1)) AS link FROM pages) GROUP BY 1")
def html_links(t):
    each = t("pages").select("page_id", F.explode(readers.page_links(F.col("html"))).alias("link"))
    return each.groupBy("link").agg(F.count("*").alias("n"), F.count_distinct("page_id").alias("pages"))


@query(r"""SELECT page_id, trim(regexp_replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(html, '(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->', ' ', 'g'), '<[^>]*>', ' ', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', chr(39)), '&amp;', '&'), '\s+', ' ', 'g')) AS text FROM pages""")
def html_text(t):
    return t("pages").select("page_id", readers.page_text(F.col("html")).alias("text"))


@query("""WITH y AS (SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS y FROM orders) SELECT o_orderkey, CASE WHEN y < 1900 THEN 'Pre-1900' WHEN y < 1945 THEN '1900-1945' WHEN y < 1980 THEN '1945-1980' WHEN y < 2000 THEN '1980-2000' WHEN y < 2015 THEN '2000-2015' WHEN y < 9999 THEN '2015+' END AS era, CASE WHEN y > 1997 THEN 'future' ELSE 'completed' END AS kind FROM y""")
def era_year_kind(t):
    y = F.year("o_orderdate")
    return t("orders").select("o_orderkey", V.era(y).alias("era"), V.year_kind(y, 1997).alias("kind"))


@query("""SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS strict, CASE WHEN o_orderkey % 2 = 0 THEN CAST(year(o_orderdate) AS INTEGER) END AS loose FROM orders""")
def year_parsers(t):
    y = F.year("o_orderdate").cast("string")
    return t("orders").select("o_orderkey", V.year_strict(F.concat(F.lit(" "), y)).alias("strict"), V.year_anywhere(F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("built in "), y, F.lit("; 12345"))).otherwise("no year 99999")).alias("loose"))


@query("SELECT p_partkey, round(p_retailprice * 10, 2) AS n, round(p_size * 1000 * CAST(0.09290304 AS DOUBLE), 2) AS sqm, 'Lyon' AS city, 'France' AS country FROM part")
def number_and_place_tokens(t):
    p = F.col("p_retailprice") * 10
    german = F.replace(F.replace(F.replace(F.format_number(p, 2), F.lit(","), F.lit("_")), F.lit("."), F.lit(",")), F.lit("_"), F.lit("."))
    place = V.place_parts(F.lit("Lyon, Rhone , France"))
    return t("part").select("p_partkey", F.round(V.number_of(german), 2).alias("n"), V.square_metres(F.concat(F.format_number(F.col("p_size") * 1000, 0), F.lit(" sq ft"))).alias("sqm"), place["city"].alias("city"), place["country"].alias("country"))


@query("SELECT o_orderkey, sha256(o_orderstatus || chr(0) || o_orderpriority) AS parts, sha256('{\"pri\":\"' || o_orderpriority || '\",\"status\":\"' || o_orderstatus || '\"}') AS canon, sha256(CASE WHEN CAST(o_orderkey AS VARCHAR) < CAST(o_custkey AS VARCHAR) THEN o_orderkey || chr(0) || o_custkey ELSE o_custkey || chr(0) || o_orderkey END) AS edge FROM orders")
def record_hashes(t):
    return t("orders").select("o_orderkey", V.joined_hash(F.col("o_orderstatus"), F.col("o_orderpriority")).alias("parts"), V.canonical_hash(status=F.col("o_orderstatus"), pri=F.col("o_orderpriority")).alias("canon"), V.edge_id(F.col("o_custkey"), F.col("o_orderkey")).alias("edge"))


@query("SELECT p_partkey, CAST(list_sum(list_transform(string_split(p_brand, ''), lambda c: ascii(c))) % 2 AS INTEGER) AS coin FROM part")
def parity_coin(t):
    return t("part").select("p_partkey", V.parity_coin(F.col("p_brand")).alias("coin"))


@query("""SELECT doc_id, lang, CASE WHEN n_chars < 100 THEN 'DROP' WHEN text LIKE '%@%' THEN 'REVIEW' ELSE 'KEEP' END AS decision, CASE WHEN n_chars < 100 THEN 'short' WHEN text LIKE '%@%' THEN 'contact' WHEN lang = 'en' THEN 'T1' ELSE 'T2' END AS reason,
concat_ws(',', CASE WHEN n_chars < 300 THEN 'short' END, CASE WHEN lang <> 'en' THEN 'language' END, CASE WHEN text LIKE '%|%' THEN 'table' END) AS reasons FROM documents""")
def reality_filter(t):
    d = t("documents")
    short, mail = F.col("n_chars") < 100, F.col("text").contains("@")
    reasons = F.array_compact(F.array(F.when(F.col("n_chars") < 300, "short"), F.when(F.col("lang") != "en", "language"), F.when(F.col("text").contains("|"), "table")))
    return d.select("doc_id", "lang", F.when(short, "DROP").when(mail, "REVIEW").otherwise("KEEP").alias("decision"), F.when(short, "short").when(mail, "contact").when(F.col("lang") == "en", "T1").otherwise("T2").alias("reason"), F.array_join(reasons, ",").alias("reasons"))


@query("""SELECT doc_id, (CASE WHEN n_chars > 1000 THEN quality END) = 1 AS passes, ((CASE WHEN n_chars > 1000 THEN quality END) = 1) IS NOT FALSE AS check_ok FROM documents LEFT JOIN labels USING (doc_id)""")
def constraint_3vl(t):
    q = F.when(F.col("n_chars") > 1000, F.col("quality")) == 1
    return t("documents").join(t("labels"), "doc_id", "left").select("doc_id", q.alias("passes"), F.coalesce(q, F.lit(True)).alias("check_ok"))


@query("""WITH a AS (SELECT o_orderkey AS k, o_orderstatus AS s FROM orders WHERE o_orderkey % 5 > 0), b AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 11 = 0 THEN 'X' ELSE o_orderstatus END AS s FROM orders WHERE o_orderkey % 7 > 0)
SELECT coalesce(a.k, b.k) AS k, CASE WHEN a.k IS NULL THEN 'insert' WHEN b.k IS NULL THEN 'delete' WHEN a.s IS NOT DISTINCT FROM b.s THEN 'keep' ELSE 'update' END AS action FROM a FULL JOIN b ON a.k = b.k""")
def exact_set_sync_plan(t):
    a, b = _snapshots(t)
    return sinks.sync_plan(a, b, "k", ["s"])


def _snapshots(t):
    o, k = t("orders"), F.col("o_orderkey")
    a = o.where(k % 5 > 0).select(k.alias("k"), F.col("o_orderstatus").alias("s"))
    return a, o.where(k % 7 > 0).select(k.alias("k"), F.when(k % 11 == 0, "X").otherwise(F.col("o_orderstatus")).alias("s"))


@query("""WITH a AS (SELECT o_orderkey AS k, o_orderstatus AS s FROM orders WHERE o_orderkey % 5 > 0), b AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 11 = 0 THEN 'X' ELSE o_orderstatus END AS s FROM orders WHERE o_orderkey % 7 > 0)
SELECT k, s FROM b UNION ALL SELECT k, s FROM a WHERE k NOT IN (SELECT k FROM b)""")
def upsert_merge(t):
    a, b = _snapshots(t)
    return sinks.upsert(a, b, ["k"])


@query("""WITH a AS (SELECT o_orderkey AS k, o_orderstatus AS s FROM orders WHERE o_orderkey % 5 > 0), b AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 11 = 0 THEN 'X' ELSE o_orderstatus END AS s FROM orders WHERE o_orderkey % 7 > 0)
SELECT k, s FROM a UNION ALL SELECT k, s FROM b WHERE k NOT IN (SELECT k FROM a)""")
def append_if_absent(t):
    a, b = _snapshots(t)
    return sinks.append_absent(a, b, ["k"])


@query("""WITH a AS (SELECT o_orderkey AS k, o_orderstatus AS s FROM orders WHERE o_orderkey % 5 > 0), b AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 11 = 0 THEN 'X' ELSE o_orderstatus END AS s FROM orders WHERE o_orderkey % 7 > 0)
SELECT b.k, b.s FROM b LEFT JOIN a ON a.k = b.k WHERE a.k IS NULL OR a.s IS DISTINCT FROM b.s""")
def snapshot_diff(t):
    a, b = _snapshots(t)
    return queues.changed_only(a, b, "k", ["s"])


@query("""WITH a AS (SELECT o_orderkey AS k, o_orderstatus AS s FROM orders WHERE o_orderkey % 5 > 0), b AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 11 = 0 THEN 'X' ELSE o_orderstatus END AS s FROM orders WHERE o_orderkey % 7 > 0)
SELECT coalesce(a.k, b.k) AS k, CASE WHEN a.k IS NULL THEN 'missing left' WHEN b.k IS NULL THEN 'missing right' ELSE 's' END AS field FROM a FULL JOIN b ON a.k = b.k WHERE a.k IS NULL OR b.k IS NULL OR a.s IS DISTINCT FROM b.s""")
def first_difference(t):
    a, b = _snapshots(t)
    return R.first_difference(a, b, "k", ["s"])


def _queue(t):
    status = F.when(F.col("event_id") % 3 == 0, "running").when(F.col("event_id") % 3 == 1, "pending").otherwise("done")
    return t("events").select(F.col("event_id").alias("id"), status.alias("status"), (F.col("event_id") % 2).cast("int").alias("attempts"), F.col("ts").alias("claimed_at"))


QUEUE = "q AS (SELECT event_id AS id, CASE WHEN event_id % 3 = 0 THEN 'running' WHEN event_id % 3 = 1 THEN 'pending' ELSE 'done' END AS status, CAST(event_id % 2 AS INTEGER) AS attempts, ts AS claimed_at FROM events)"


@query(f"WITH {QUEUE}, p AS (SELECT id FROM q WHERE status = 'pending' ORDER BY id LIMIT 40) SELECT id, CASE WHEN id IN (SELECT id FROM p) THEN 'running' ELSE status END AS status, attempts + CASE WHEN id IN (SELECT id FROM p) THEN 1 ELSE 0 END AS attempts FROM q")
def queue_claim(t):
    return queues.claim_next(_queue(t), 40).select("id", "status", "attempts")


@query(f"WITH {QUEUE} SELECT id, CASE WHEN status = 'running' AND claimed_at < TIMESTAMP '2024-01-03' THEN 'pending' ELSE status END AS status FROM q")
def stale_reset(t):
    return queues.reset_stale(_queue(t), F.lit("2024-01-03").cast("timestamp_ntz")).select("id", "status")


@query("WITH d AS (SELECT user_id, sha256(props) AS h FROM events WHERE event_id % 2 = 0) SELECT event_id FROM events e WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.user_id = e.user_id AND d.h = sha256(e.props))")
def memo_skip(t):
    e = t("events").select("event_id", "user_id", F.sha2("props", 256).alias("h"))
    return queues.unfinished(e, e.where("event_id % 2 = 0"), ["user_id", "h"]).select("event_id")


@query("SELECT user_id, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY floor(value / 20) DESC, event_id DESC) AS k FROM events) WHERE k = 1")
def last_good_version(t):
    v = t("events").select("user_id", "event_id", "value", F.floor(F.col("value") / 20).alias("q"))
    return queues.last_good(v, "user_id", "event_id", "q").select("user_id", "event_id", "value")


@query("SELECT count(*) AS n, md5(string_agg(n_nationkey || '=' || n_name, ';' ORDER BY n_nationkey)) AS h FROM nation")
def rowset_hash(t):
    rows = F.array_sort(F.collect_list(F.struct("n_nationkey", F.concat_ws("=", "n_nationkey", "n_name").alias("x"))))
    return t("nation").agg(F.count("*").alias("n"), F.md5(F.array_join(F.transform(rows, lambda r: r["x"]), ";")).alias("h"))


@query("""WITH h AS (SELECT sha256(to_json({'p_brand': p_brand, 'p_name': p_name, 'p_partkey': p_partkey, 'p_size': p_size, 'p_type': p_type})) AS h FROM part), b AS (SELECT substr(h, 1, 2) AS b, count(*) AS n, sum(CAST(CAST('0x' || substr(h, 3, 15) AS BIGINT) AS DECIMAL(38, 0))) AS s, bit_xor(CAST('0x' || substr(h, 18, 15) AS BIGINT)) AS x FROM h GROUP BY 1)
SELECT CAST(sum(n) AS BIGINT) AS rows, sha256(string_agg(b || ':' || n || ':' || s || ':' || x, ',' ORDER BY b || ':' || n || ':' || s || ':' || x)) AS hash FROM b""")
def table_logical_hash(t):
    """Of all rows in any order: a hash a row, a summary a leading byte, one hash."""
    return sinks.table_hash(t("part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size"))


def _status(rate, floor):
    return F.when(rate >= floor, "PASS").when(rate >= floor - 0.05, "WARN").otherwise("FAIL")


@query("""WITH r AS (SELECT 'text' AS rule, avg(CAST(length(trim(text)) > 0 AS INTEGER)) AS rate, 1.0 AS least FROM documents UNION ALL SELECT 'lang', avg(CAST(lang IS NOT NULL AS INTEGER)), 0.99 FROM documents
UNION ALL SELECT 'labelled', count(l.doc_id) / CAST(count(*) AS DOUBLE), 0.5 FROM documents d LEFT JOIN labels l USING (doc_id) UNION ALL SELECT 'english', avg(CAST(lang = 'en' AS INTEGER)), 0.65 FROM documents
UNION ALL SELECT 'unique', count(DISTINCT md5(text)) / CAST(count(*) AS DOUBLE), 0.98 FROM documents)
SELECT rule, round(rate, 6) AS rate, CASE WHEN rate >= least THEN 'PASS' WHEN rate >= least - 0.05 THEN 'WARN' ELSE 'FAIL' END AS status FROM r""")
def qc_suite(t):
    d = t("documents")
    share = lambda c: F.avg(c.cast("int"))
    rules = [
        ("text", d.agg(share(F.length(F.trim("text")) > 0).alias("rate")), 1.0), ("lang", d.agg(share(F.col("lang").isNotNull()).alias("rate")), 0.99),
        ("labelled", d.select("doc_id").join(t("labels").select("doc_id", F.lit(1).alias("x")), "doc_id", "left").agg((F.count("x") / F.count("*")).alias("rate")), 0.5),
        ("english", d.agg(share(F.col("lang") == "en").alias("rate")), 0.65), ("unique", d.agg((F.count_distinct(F.md5("text")) / F.count("*")).alias("rate")), 0.98),
    ]
    return reduce(lambda a, b: a.union(b), (x.select(F.lit(n).alias("rule"), F.round("rate", 6).alias("rate"), _status(F.col("rate"), least).alias("status")) for n, x, least in rules))


@query("""SELECT lang, round(avg(CAST(quality IS NOT NULL AS INTEGER)), 6) AS coverage, CASE WHEN avg(CAST(quality IS NOT NULL AS INTEGER)) >= 0.5 THEN 'PASS' ELSE 'WARN' END AS status FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1""")
def field_coverage_thresholds(t):
    c = F.avg(F.col("quality").isNotNull().cast("int"))
    return t("documents").join(t("labels"), "doc_id", "left").groupBy("lang").agg(F.round(c, 6).alias("coverage"), F.when(c >= 0.5, "PASS").otherwise("WARN").alias("status"))


@query("""WITH s AS (SELECT l_orderkey AS k, list(l_partkey) AS parts FROM lineitem GROUP BY 1), e AS (SELECT k, unnest(parts) AS p FROM s) SELECT 'dangling' AS side, count(*) AS n FROM e WHERE p NOT IN (SELECT p_partkey FROM part) UNION ALL SELECT 'unused', count(*) FROM part WHERE p_partkey NOT IN (SELECT p FROM e)""")
def ref_integrity_both_ways(t):
    e = t("lineitem").groupBy("l_orderkey").agg(F.collect_list("l_partkey").alias("parts")).select(F.explode("parts").alias("p_partkey"))
    p = t("part").select("p_partkey")
    n = lambda name, df: df.agg(F.count("*").alias("n")).select(F.lit(name).alias("side"), "n")
    return n("dangling", e.join(p, "p_partkey", "left_anti")).union(n("unused", p.join(e, "p_partkey", "left_anti")))


@query("""SELECT conv_id, count(*) AS turns, count(*) FILTER (WHERE role = 'user') AS asked, min(turn) = 0 AND max(turn) = count(*) - 1 AS contiguous FROM conversations GROUP BY 1""")
def order_contiguity_check(t):
    n = F.count("*")
    return t("conversations").groupBy("conv_id").agg(n.alias("turns"), F.count_if(F.col("role") == "user").alias("asked"), ((F.min("turn") == 0) & (F.max("turn") == n - 1)).alias("contiguous"))


@query("""WITH a AS (SELECT column_name AS f, column_type AS k FROM (DESCRIBE orders)), b AS (SELECT column_name AS f, column_type AS k FROM (DESCRIBE SELECT * EXCLUDE (o_orderstatus) REPLACE (CAST(o_custkey AS INTEGER) AS o_custkey), 1 AS o_new FROM orders))
SELECT CASE WHEN a.f IS NULL THEN '+' WHEN b.f IS NULL THEN '-' ELSE '~' END AS change, coalesce(a.f, b.f) AS field FROM a FULL JOIN b ON a.f = b.f WHERE a.f IS NULL OR b.f IS NULL OR a.k <> b.k""")
def schema_diff(t):
    a = t("orders")
    rows = R.schema_difference(a, a.drop("o_orderstatus").withColumn("o_new", F.lit(1)).withColumn("o_custkey", F.col("o_custkey").cast("int")))
    return a.sparkSession.createDataFrame(rows, "change string, field string")
