"""Value functions, and sources and sinks as round trips: a table is written in a form, read back by its reader, and compared with itself."""

from __future__ import annotations

import gzip
import hashlib

from pyspark.sql import functions as F

from cairnwork.functions import text as X
from cairnwork.functions import values as V
from cairnwork.plans.registry import query
from cairnwork.plans.storage import scratch
from cairnwork.sources import readers, sinks
from cairnwork.streaming import queues


@query("""WITH v AS (SELECT vec_id, list_transform(embedding[1:4], lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings), e AS (SELECT vec_id, v, list_transform(v, lambda x: exp(x - list_max(v))) AS e FROM v)
SELECT vec_id, round(e[1] / list_sum(e), 6) AS p1, round(e[4] / list_sum(e), 6) AS p4, '[' || array_to_string(list_transform(v, lambda x: printf('%.6f', x)), ',') || ']' AS shown, round(list_sum(list_transform(v, lambda x: CAST(printf('%.6f', x) AS DOUBLE))), 6) AS total FROM e""")
def vector_values(t):
    """Softmax of a vector, its text form, and the sum of what is read back from the text."""
    v = F.slice("embedding", 1, 4).cast("array<double>")
    shown = V.vector_text(v)
    p = V.softmax(v)
    total = F.aggregate(V.vector_parse(shown), F.lit(0.0), lambda a, x: a + x)
    return t("embeddings").select("vec_id", F.round(F.get(p, F.lit(0)), 6).alias("p1"), F.round(F.get(p, F.lit(3)), 6).alias("p4"), shown.alias("shown"), F.round(total, 6).alias("total"))


@query("""SELECT o_orderkey, array_to_string(CASE WHEN 1890 + o_orderkey % 150 = year(o_orderdate) THEN [CAST(CAST(year(o_orderdate) AS INTEGER) AS VARCHAR)] ELSE [CAST(CAST(year(o_orderdate) AS INTEGER) AS VARCHAR), CAST(1890 + o_orderkey % 150 AS VARCHAR)] END, ',') AS years FROM orders""")
def years_in_text(t):
    y = F.year("o_orderdate").cast("string")
    text = F.concat(F.lit("built "), y, F.lit(", again "), (F.col("o_orderkey") % 150 + 1890).cast("string"), F.lit("; no 31999 "), y)
    return t("orders").select("o_orderkey", F.array_join(V.years_in(text), ",").alias("years"))


@query("""SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN round(p_size * CAST(0.09290304 AS DOUBLE), 2) WHEN 1 THEN p_size * 10000.0 WHEN 2 THEN CAST(p_size AS DOUBLE) WHEN 3 THEN p_size * 1000.5 END AS sqm FROM part""")
def areas(t):
    n, k = F.col("p_size").cast("string"), F.col("p_size") % 5
    thousand = F.concat(F.format_number(F.col("p_size") * 1000.5, 2), F.lit(" m2"))
    text = F.when(k == 0, F.concat(n, F.lit(" square feet"))).when(k == 1, F.concat(n, F.lit(" ha"))).when(k == 2, F.concat(F.lit("about "), n, F.lit(" sqm"))).when(k == 3, thousand).otherwise(F.concat(n, F.lit(" rooms")))
    return t("part").select("p_partkey", V.square_metres(text).alias("sqm"))


@query("""WITH u AS (SELECT page_id, CASE page_id % 3 WHEN 0 THEN url || '/123e4567-e89b-12d3-a456-' || lpad(CAST(page_id AS VARCHAR), 12, '0') || '/a.jpg' WHEN 1 THEN url || '/' || md5(url) || '.jpg' ELSE url END AS url FROM pages)
SELECT page_id, CASE page_id % 3 WHEN 0 THEN '123e4567-e89b-12d3-a456-' || lpad(CAST(page_id AS VARCHAR), 12, '0') WHEN 1 THEN regexp_extract(url, '([0-9a-f]{16,})', 1) ELSE nullif(regexp_extract(url, '([^/?#]+)(?:[?#].*)?$', 1), '') END AS asset FROM u""")
def asset_key(t):
    u, k = F.col("url"), F.col("page_id") % 3
    url = F.when(k == 0, F.concat(u, F.lit("/123e4567-e89b-12d3-a456-"), F.lpad(F.col("page_id").cast("string"), 12, "0"), F.lit("/a.jpg"))).when(k == 1, F.concat(u, F.lit("/"), F.md5("url"), F.lit(".jpg"))).otherwise(u)
    return t("pages").select("page_id", V.asset_key(url).alias("asset"))


@query("""SELECT page_id, lower(rtrim(regexp_replace(regexp_replace(url, '^[a-zA-Z]+://(www\\.)?', ''), '[?#].*$', ''), '/')) || '/a b' AS key, CASE WHEN url LIKE 'http:%' THEN 'https:' || url[6:] ELSE url END AS secure FROM pages""")
def url_keys(t):
    """Comparison keys of percent-encoded URLs, and the scheme made https."""
    bare = F.regexp_replace("url", "[?#].*$", "")
    coded = F.concat(F.rtrim(bare, F.lit("/")), F.lit("/a%20b/?q=1"))
    return t("pages").select("page_id", V.compare_key(coded).alias("key"), V.https(F.col("url")).alias("secure"))


LISTED = "CASE event_id % 4 WHEN 0 THEN '[\"a\",\"' || event_type || '\"]' WHEN 1 THEN event_type WHEN 2 THEN ' ' END"


@query(f"""WITH e AS (SELECT event_id, {LISTED} AS raw, event_type FROM events) SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'a,' || event_type WHEN 1 THEN event_type ELSE '' END AS items, CAST(CASE event_id % 4 WHEN 0 THEN 2 WHEN 1 THEN 0 ELSE 0 END AS INTEGER) AS length, event_id % 4 < 2 AS present FROM e""")
def tolerant_lists(t):
    """A JSON list, a lone text, a blank and a null as arrays; the length of what is no list is 0; presence."""
    k = F.col("event_id") % 4
    raw = F.when(k == 0, F.concat(F.lit('["a","'), "event_type", F.lit('"]'))).when(k == 1, F.col("event_type")).when(k == 2, " ")
    return t("events").select("event_id", F.array_join(V.array_of(raw), ",").alias("items"), V.list_length(raw).alias("length"), V.is_present(raw, "string").alias("present"))


@query("""SELECT event_id, 'a.b[0].k=' || json_extract_string(props, '$.k') || ',a.c=' || event_type || ',d=' || event_id AS leaves FROM events""")
def json_walk(t):
    """Every leaf of a nested JSON value with its path."""
    j = F.concat(F.lit('{"a":{"b":['), "props", F.lit('],"c":"'), "event_type", F.lit('"},"d":'), F.col("event_id").cast("string"), F.lit("}"))
    return t("events").select("event_id", F.array_join(X.json_leaves(j), ",").alias("leaves"))


@query("""SELECT doc_id, substr(trim(source) || ' ' || lang || ' ' || trim(regexp_replace(text, '\\s+', ' ', 'g')), 1, 300) AS joined, length(text) BETWEEN 50 AND 5000 AS fits FROM documents""")
def text_for_vectors(t):
    """Parts of a record joined for an embedding, without the missing ones and up to a length."""
    body = F.trim(F.regexp_replace("text", "\\s+", " "))
    return t("documents").select("doc_id", X.joined(F.col("source"), F.col("lang"), F.lit("  "), body, most=300).alias("joined"), F.length("text").between(50, 5000).alias("fits"))


@query()
def compat_names(t):
    return t("documents").select("doc_id", X.compat_fold(F.col("text")).alias("folded"))


@query()
def accuracy_intervals(t):
    """Exact intervals of each language's share, and the posterior of the whole; counts per language meet on the driver."""
    from cairnwork.functions import stats

    rows = t("labels").join(t("documents"), "doc_id").groupBy("lang").agg(F.sum("quality").alias("k"), F.count("*").alias("n")).orderBy("lang").collect()
    out = [(r["lang"], r["n"], *map(lambda x: round(x, 6), stats.clopper_pearson(r["k"], r["n"]))) for r in rows]
    mean, low, high = stats.beta_accuracy([(r["k"], r["n"], float(r["n"])) for r in rows])
    return t("labels").sparkSession.createDataFrame([*out, ("all", sum(r["n"] for r in rows), round(low, 6), round(high, 6))], "lang string, n long, low double, high double")


# --- sources ----------------------------------------------------------------------------------------


@query("""SELECT n_regionkey AS region, n_nationkey AS id, n_name AS name FROM nation""")
def json_documents(t):
    """Whole JSON documents, with a list or an object as root."""
    spark = t("nation").sparkSession
    at = scratch(spark, "json")
    row = F.struct(F.col("n_regionkey").alias("region"), F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))
    each = t("nation").groupBy("n_regionkey").agg(F.to_json(F.collect_list(row)).alias("j"))
    root = F.when(F.col("n_regionkey") % 2 == 0, F.col("j")).otherwise(F.concat(F.lit('{"clusters":'), "j", F.lit("}")))
    each.repartition(5, "n_regionkey").select(root.alias("value"), "n_regionkey").write.partitionBy("n_regionkey").text(at)
    return readers.json_rows(spark, f"{at}/*", "region int, id int, name string")


@query("""SELECT user_id AS k, max(event_id) AS v FROM events GROUP BY 1""")
def json_lines_last(t):
    """JSON lines keyed by id: bad lines are skipped, the last row of a key counts."""
    spark = t("events").sparkSession
    at = scratch(spark, "lines")
    line = F.to_json(F.struct(F.col("user_id").alias("k"), F.col("event_id").alias("v")))
    lines = t("events").repartition(1).sortWithinPartitions("event_id").select(F.explode(F.array(line, F.lit("{broken"))).alias("value"))  # one file, as it is the order of lines that decides
    lines.write.text(at)
    return readers.last_lines(spark, at, "k long, v long", "k")


@query("""SELECT url, CASE WHEN page_id % 2 = 0 THEN '2024-05-01' END AS lastmod FROM pages WHERE regexp_matches(url, '^[^&<]*$')""")
def sitemap_scan(t):
    spark = t("pages").sparkSession
    at = scratch(spark, "sitemap")
    p = t("pages").where(~F.col("url").rlike("[&<]"))
    entry = F.concat(F.lit("<url><loc> "), "url", F.lit(" </loc>"), F.when(F.col("page_id") % 2 == 0, "<lastmod>2024-05-01</lastmod>").otherwise(""), F.lit("</url>"))
    p.select(F.concat(F.lit("<urlset>"), entry, F.lit("</urlset>")).alias("value")).write.text(at)
    return readers.sitemap_urls(spark, at)


@query("""SELECT page_id, page_id AS id, lower(regexp_extract(url, '^[a-zA-Z]+://([^/:?#]+)', 1)) AS host FROM pages""")
def embedded_json(t):
    """The JSON object that a page's script holds: of several candidates the one with most of the wanted keys, then the longest."""
    h = F.concat("html", F.lit('<script>var state = {"x": 1};</script><script>var state = {"id": '), F.col("page_id").cast("string"), F.lit(', "host": "'), V.host(F.col("url")), F.lit('"};</script>'))
    found = readers.embedded_json(h, "state", ["id", "host"])
    return t("pages").select("page_id", F.get_json_object(found, "$.id").cast("long").alias("id"), F.get_json_object(found, "$.host").alias("host"))


@query("""SELECT p.page_id, regexp_extract(html, '(?s)<h1[^>]*>(.*?)</h1>', 1) AS heading, len(regexp_extract_all(html, '<p[^a-z]')) AS paragraphs, len(regexp_extract_all(html, '<li>')) AS items, regexp_extract(html, '(?s)<article>(.*?)</article>', 1) <> '' AS has_article FROM pages p""")
def page_records(t):
    """A page as a row: heading, paragraphs, list items, whether it has an article."""
    r = readers.page_record(F.col("html"))
    return t("pages").select("page_id", r.alias("r")).select("page_id", "r.heading", "r.paragraphs", "r.items", "r.has_article")


@query("""SELECT name, name <> 'b' AS ok FROM (VALUES ('a'), ('b'), ('c')) v(name)""")
def pinned_files(t):
    """Files against their pinned hashes: a changed one and a missing one fail (here b was changed)."""
    spark = t("nation").sparkSession
    at = scratch(spark, "pins")
    body = {"a": b"first", "b": b"other", "c": b"third"}
    for name, data in body.items():
        sinks.write_bytes(spark, f"{at}/{name}", data)
    want = {n: hashlib.sha256(b"second" if n == "b" else d).hexdigest() for n, d in body.items()}
    return readers.checked_files(spark, at, want).select("name", "ok")


@query("""SELECT page_id, sha256(html) AS sha256, strlen(html) AS size, true AS ok FROM pages WHERE page_id < 0 UNION ALL SELECT n_nationkey, sha256(repeat(n_name, 50)), strlen(repeat(n_name, 50)), n_nationkey % 7 <> 3 FROM nation""")
def gzip_snapshots(t):
    """Compressed snapshots are unpacked and checked against the hash in their manifest."""
    spark = t("nation").sparkSession
    at, manifest = scratch(spark, "gzip"), []
    for r in t("nation").select("n_nationkey", "n_name").collect():  # 25 nations
        data = (r["n_name"] * 50).encode()
        sinks.write_bytes(spark, f"{at}/{r['n_nationkey']}.gz", gzip.compress(data, mtime=0))
        manifest.append((f"{r['n_nationkey']}.gz", "0" if r["n_nationkey"] % 7 == 3 else hashlib.sha256(data).hexdigest()))
    got = readers.gzip_snapshots(spark, at, spark.createDataFrame(manifest, "name string, want string"))
    return got.select(F.regexp_extract("name", "^([0-9]+)", 1).cast("long").alias("page_id"), "sha256", F.length("body").cast("long").alias("size"), "ok")


# --- sinks -------------------------------------------------------------------------------------------


def _orders(t, where):
    return t("orders").where(where).select("o_orderkey", "o_orderstatus", "o_totalprice")


@query("SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 2 = 0")
def published_once(t):
    """Written beside its path and renamed; a second publication without `replace` is refused and leaves the first."""
    spark = t("orders").sparkSession
    at = scratch(spark, "published")
    sinks.publish(_orders(t, "o_orderkey % 2 = 0"), at)
    try:
        sinks.publish(_orders(t, "o_orderkey % 2 = 1"), at)
    except FileExistsError:
        return spark.read.parquet(at)
    raise AssertionError("an existing table was overwritten")


@query("SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 3 = 0")
def published_if_clean(t):
    """A refresh that breaks a check leaves the last good table."""
    spark = t("orders").sparkSession
    at = scratch(spark, "clean")
    check = lambda df: df.agg(F.count_if(F.col("o_orderkey") % 3 != 0).alias("n")).select(F.when(F.col("n") == 0, "PASS").otherwise("FAIL").alias("status"))
    for where in ("o_orderkey % 3 = 0", "o_orderkey % 3 < 2"):
        rows = _orders(t, where)
        sinks.publish_if_clean(rows, check(rows), at)
    return spark.read.parquet(at)


@query("SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def append_unseen(t):
    """JSON lines grow by what is not there: an interrupted run that starts again adds no row twice."""
    spark = t("orders").sparkSession
    at = scratch(spark, "appended")
    schema = "o_orderkey long, o_orderstatus string, o_totalprice double"
    for where in ("o_orderkey % 2 = 0", "o_orderkey % 3 < 2", "true"):
        sinks.append_unseen(_orders(t, where), at, schema, "o_orderkey")
    return spark.read.schema(schema).json(at)


@query("SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 5 > 0")
def csv_bulk(t):
    spark = t("orders").sparkSession
    at = scratch(spark, "csv")
    rows = _orders(t, "o_orderkey % 5 > 0")
    sinks.bulk_csv(rows, at)
    return readers.csv_rows(spark, at, rows.schema)


@query("SELECT count(*) AS kept, true AS refused FROM orders WHERE o_orderkey % 2 = 0")
def write_once(t):
    """A snapshot's path can be written once; later writes are refused, and its hash shows that nothing changed."""
    spark = t("orders").sparkSession
    at = scratch(spark, "immutable")
    first = _orders(t, "o_orderkey % 2 = 0")
    before = sinks.seal(first, at)
    try:
        sinks.seal(_orders(t, "true"), at)
        refused = False
    except FileExistsError:
        refused = sinks.sealed(spark, at) == before
    return spark.read.parquet(f"{at}/data").agg(F.count("*").alias("kept")).withColumn("refused", F.lit(refused))


BATCHES = "a AS (SELECT o_orderkey AS k, o_orderstatus AS s FROM orders WHERE o_orderkey % 5 > 0), b AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 11 = 0 THEN 'X' ELSE o_orderstatus END AS s FROM orders WHERE o_orderkey % 7 > 0)"


def _batches(t):
    k = F.col("o_orderkey")
    a = t("orders").where(k % 5 > 0).select(k.alias("k"), F.col("o_orderstatus").alias("s"))
    return a, t("orders").where(k % 7 > 0).select(k.alias("k"), F.when(k % 11 == 0, "X").otherwise(F.col("o_orderstatus")).alias("s"))


@query(f"WITH {BATCHES} SELECT k, s FROM b UNION ALL SELECT k, s FROM a WHERE k NOT IN (SELECT k FROM b) AND k % 3 > 0")
def delete_then_upsert(t):
    """Removed ids go first, then the batch is merged."""
    a, b = _batches(t)
    return sinks.delete_then_upsert(a, a.where("k % 3 = 0").select("k"), b, ["k"])


@query(f"WITH {BATCHES} SELECT coalesce(a.k, b.k) AS k, coalesce(b.s, a.s) AS s, array_to_string(CASE WHEN b.k % 2 = 0 THEN ['new'] WHEN a.k IS NOT NULL THEN ['old', 'kept'] ELSE [] END, ',') AS tags FROM a FULL JOIN b ON a.k = b.k")
def merge_keep(t):
    """An upsert in which an empty array does not wipe out what was known."""
    a, b = _batches(t)
    a = a.withColumn("tags", F.array(F.lit("old"), F.lit("kept")))
    b = b.withColumn("tags", F.when(F.col("k") % 2 == 0, F.array(F.lit("new"))).otherwise(F.array().cast("array<string>")))
    return sinks.merge_keep(a, b, "k", ["tags"]).withColumn("tags", F.coalesce(F.array_join("tags", ","), F.lit("")))


@query("SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_orderkey % 4 = 0 THEN 'new' ELSE 'old' END AS v FROM lineitem WHERE l_orderkey % 4 > 0 OR l_linenumber < 3")
def replace_children(t):
    """All lines of some orders give way to their new lines."""
    lines = t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    fresh = lines.where("l_orderkey % 4 = 0 AND l_linenumber < 3").withColumn("v", F.lit("new"))
    parents = lines.where("l_orderkey % 4 = 0").select("l_orderkey")
    return sinks.replace_children(lines.withColumn("v", F.lit("old")), fresh, "l_orderkey", parents)


@query("SELECT n_nationkey, n_name, n_regionkey, CAST(NULL AS INTEGER) AS added FROM nation")
def added_columns(t):
    return sinks.add_missing_columns(t("nation"), {"n_name": "string", "added": "int"})


@query("SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1")
def resumed_stage(t):
    """A stage that was finished on the same inputs is read, not computed again."""
    spark = t("orders").sparkSession
    at = scratch(spark, "stages")
    want = t("orders").groupBy("o_orderstatus").agg(F.count("*").alias("n"))
    sinks.resumable(want, at, "counts", "inputs1")
    return sinks.resumable(want.where("false"), at, "counts", "inputs1")


# --- queues and streams --------------------------------------------------------------------------------


@query("""SELECT event_id FROM events WHERE event_id % 3 = 0 AND event_id % 9 <> 0""")
def recovery_selection(t):
    """Failed tasks that no recovery run has settled."""
    e = t("events").select("event_id", F.when(F.col("event_id") % 3 == 0, "failed").otherwise("success").alias("status"))
    return queues.to_recover(e, e.where("event_id % 9 = 0"), "event_id").select("event_id")


@query("""SELECT doc_id, sha256(text) AS hash FROM documents""")
def hash_cache_stream(t):
    """A stream over the table hashes what has arrived, once; it ends when all is read."""
    d = t("documents").select("doc_id", "text")
    spark = d.sparkSession
    at = scratch(spark, "hashes")
    stored = f"{at}/in"
    d.write.parquet(stored)
    stream = spark.readStream.schema(d.schema).parquet(stored)
    for _ in range(2):  # the second run finds nothing new
        queues.hash_stream(stream, "doc_id", "text", f"{at}/out", f"{at}/checkpoint").awaitTermination()
    return spark.read.schema("doc_id long, hash string").parquet(f"{at}/out")


@query("""SELECT event_type, time_bucket(INTERVAL '1 hour', ts) AS hour, count(*) AS n FROM events GROUP BY 1, 2""")
def windowed_stream(t):
    """Events per kind and hour by a stream with a watermark, all of it in one run."""
    e = t("events").select("event_type", F.col("ts").cast("timestamp").alias("ts"))
    spark = e.sparkSession
    at = scratch(spark, "windows")
    e.write.parquet(f"{at}/in")
    stream = queues.windowed_counts(spark.readStream.schema(e.schema).parquet(f"{at}/in"), "ts", "event_type", "1 hour", "1 day")
    stored = f"{at}/out"

    def keep(batch, number):
        batch.select("event_type", F.col("window.start").alias("hour"), "n").write.mode("overwrite").parquet(stored)

    stream.writeStream.outputMode("complete").foreachBatch(keep).option("checkpointLocation", f"{at}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(stored).withColumn("hour", F.col("hour").cast("timestamp_ntz"))
