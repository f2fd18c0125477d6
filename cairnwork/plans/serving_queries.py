"""Serving projection, publish reasons, validators, vocabularies and review queues on records made from the driver's tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cairnwork.functions import values as V
from cairnwork.operators import records as P
from cairnwork.operators import relational as R
from cairnwork.plans.registry import query
from cairnwork.plans.storage import cut

# What the words of a part's name stand for in a record.
STUFF = {"ring": "Courtyard", "plate": "walls", "rod": "Steel", "gear": "Glass", "gizmo": "stairs", "anvil": "Concrete", "widget": "light", "bolt": "Timber"}


def sql_map(table: dict) -> str:
    return "MAP {" + ", ".join(f"'{k}': {'NULL' if v is None else repr(v)}" for k, v in table.items()) + "}"


def sql_list(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


RECORDS = f"""ln AS (SELECT l_orderkey AS id, min_by(p_name, CAST(l_linenumber AS BIGINT) * 1000000000 + l_partkey) AS name, list_sort(list(DISTINCT {sql_map(STUFF)}[split_part(p_name, ' ', 2)])) AS material, list_sort(list(DISTINCT 'https://img.example/' || l_partkey || '.jpg')) AS images,
list_sort(list(DISTINCT 'F' || l_suppkey)) AS firms, count(DISTINCT l_returnflag) AS n_sources FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1),
rec AS (SELECT o_orderkey AS id, name, CASE WHEN o_custkey % 19 > 0 THEN c_mktsegment END AS city, CASE WHEN o_custkey % 13 > 0 THEN n_name END AS country, CASE WHEN o_orderkey % 17 > 0 THEN CAST(year(o_orderdate) AS INTEGER) END AS year, material,
CASE WHEN o_orderkey % 5 = 0 THEN ['Stair', 'Courtyard'] ELSE CAST([] AS VARCHAR[]) END AS elements, images, images[1] AS cover, firms, coalesce(n_sources, 0) AS n_sources,
CASE WHEN n_sources >= 3 THEN 'T1' WHEN n_sources = 2 THEN 'T2' ELSE 'T3' END AS tier, name IS NOT NULL AND o_orderstatus <> 'P' AS publishable FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey LEFT JOIN ln ON id = o_orderkey)"""


def _orders(t) -> DataFrame:
    nation = F.broadcast(t("nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name"))  # 25 nations
    customer = t("customer").join(nation, "c_nationkey").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment", "n_name")
    o = t("orders").join(customer, "o_custkey").withColumnRenamed("o_orderkey", "id")
    return o.withColumns({"city": F.when(F.col("o_custkey") % 19 > 0, F.col("c_mktsegment")), "country": F.when(F.col("o_custkey") % 13 > 0, F.col("n_name")), "year": F.when(F.col("id") % 17 > 0, F.year("o_orderdate"))})


def record_keys(t) -> DataFrame:
    """(id, name, country, city, year, parts, suppliers) of the records, stored: what matching reads of them. Parts and suppliers are the keys of images and firms, one to one.

    Lines travel as numbers and are gathered where they arrive, so no half-made set is shuffled.
    """
    part = t("part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    lines = t("lineitem").join(part, "l_partkey").select(F.col("l_orderkey").alias("id"), "l_linenumber", "l_partkey", "l_suppkey", "p_name").repartition("id")
    sets = lines.groupBy("id").agg(F.min(F.when(F.col("p_name").isNotNull(), F.struct("l_linenumber", "l_partkey", "p_name")))["p_name"].alias("name"), F.collect_set("l_partkey").alias("parts"), F.collect_set("l_suppkey").alias("suppliers"))
    return cut(_orders(t).select("id", "city", "country", "year").join(sets, "id", "left").select("id", "name", "country", "city", "year", "parts", "suppliers"), "records", release=True)


def records(t) -> DataFrame:
    """Orders as records: the first part's name, place of the customer, materials, images and firms of the lines."""
    part = t("part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    sorted_set = lambda c: F.array_sort(F.collect_set(c))
    lines = t("lineitem").join(part, "l_partkey").groupBy(F.col("l_orderkey").alias("id")).agg(
        F.min_by("p_name", F.struct("l_linenumber", "l_partkey")).alias("name"), sorted_set(F.element_at(P.lookup(STUFF), F.element_at(F.split("p_name", " "), 2))).alias("material"),
        sorted_set(F.concat(F.lit("https://img.example/"), "l_partkey", F.lit(".jpg"))).alias("images"), sorted_set(F.concat(F.lit("F"), "l_suppkey")).alias("firms"), F.count_distinct("l_returnflag").alias("n_sources"),
    )
    o = _orders(t).join(lines, "id", "left")
    n = F.col("n_sources")
    return o.select(
        "id", "name", "city", "country", "year",
        "material", F.when(F.col("id") % 5 == 0, P.lits(["Stair", "Courtyard"])).otherwise(F.array().cast("array<string>")).alias("elements"), "images", F.get("images", F.lit(0)).alias("cover"), "firms",
        F.coalesce(n, F.lit(0)).alias("n_sources"), F.when(n >= 3, "T1").when(n == 2, "T2").otherwise("T3").alias("tier"), (F.col("name").isNotNull() & (F.col("o_orderstatus") != "P")).alias("publishable"),
    )


REASONS = """list_filter([CASE WHEN coalesce(trim(name), '') = '' THEN 'missing_name' END, CASE WHEN coalesce(len(firms), 0) = 0 THEN 'missing_source_refs' END, CASE WHEN coalesce(len(images), 0) = 0 THEN 'missing_source_urls' END,
CASE WHEN coalesce(len(images), 0) = 0 THEN 'missing_all_images' END, CASE WHEN coalesce(trim(cover), '') = '' THEN 'missing_display_cover_url' END], lambda r: r IS NOT NULL)"""
NOISE, ELEMENTS = sql_list(P.MATERIAL_NOISE), sql_map(P.ELEMENT_OF)
SERVING = f"""{RECORDS}, rs AS (SELECT *, {REASONS} AS reasons, list_filter(material, lambda m: lower(trim(m)) NOT IN {NOISE}) AS mats, list_filter(list_distinct(list_filter(list_transform(material, lambda m: {ELEMENTS}[lower(trim(m))]), lambda e: e IS NOT NULL)), lambda e: NOT list_contains(elements, e)) AS gained FROM rec),
hl AS (SELECT *, coalesce(len(material), 0) > 0 AND len(mats) = 0 AND len(gained) = 0 AS hollow FROM rs),
srv AS (SELECT id, name, city, country, year, coalesce(mats, CAST([] AS VARCHAR[])) AS material, list_concat(elements, list_sort(coalesce(gained, CAST([] AS VARCHAR[])))) AS elements, coalesce(images, CAST([] AS VARCHAR[])) AS images, cover, tier, n_sources, publishable AND NOT hollow AS publishable,
CASE WHEN hollow THEN list_append(reasons, '{P.NOISE_ONLY}') ELSE reasons END AS reasons, CASE WHEN year < 1900 THEN 'Pre-1900' WHEN year < 1945 THEN '1900-1945' WHEN year < 1980 THEN '1945-1980' WHEN year < 2000 THEN '1980-2000' WHEN year < 2015 THEN '2000-2015' WHEN year < 9999 THEN '2015+' END AS era FROM hl)"""


def _served(t) -> DataFrame:
    r = records(t)
    c = F.col
    return P.serving_rows(r.withColumn("reasons", P.publish_reasons(c("name"), c("firms"), c("images"), c("images"), c("cover"))))


@query(f"""WITH {SERVING} SELECT id, name, city, country, year, array_to_string(material, ',') AS material, array_to_string(list_sort(elements), ',') AS elements, len(images) AS images, cover, tier, n_sources, publishable, array_to_string(reasons, ',') AS reasons, era FROM srv""")
def map_row(t):
    return _served(t).withColumns({"material": F.array_join("material", ","), "elements": F.array_join(F.array_sort("elements"), ","), "images": F.size("images").cast("long"), "reasons": F.array_join("reasons", ",")})


@query(f"""WITH {RECORDS} SELECT id, array_to_string({REASONS}, ',') AS reasons, len({REASONS}) = 0 AS may_show FROM rec""")
def publish_reasons(t):
    c = F.col
    r = P.publish_reasons(c("name"), c("firms"), c("images"), c("images"), c("cover"))
    return records(t).select("id", F.array_join(r, ",").alias("reasons"), (F.size(r) == 0).alias("may_show"))


@query(f"""WITH {SERVING} SELECT id, array_to_string(coalesce(mats, CAST([] AS VARCHAR[])), ',') AS material, array_to_string(list_sort(coalesce(gained, CAST([] AS VARCHAR[]))), ',') AS gained FROM hl""")
def material_reclassify(t):
    r = P.reclassified(F.col("material"), F.col("elements"))
    return records(t).select("id", F.array_join(r["material"], ",").alias("material"), F.array_join(F.array_sort(r["gained"]), ",").alias("gained"))


@query(f"""WITH {RECORDS} SELECT id, name, country, city, year, tier, array_to_string(coalesce(images, CAST([] AS VARCHAR[])), ' ') AS image_urls FROM rec WHERE coalesce(trim(name), '') <> '' AND coalesce(len(images), 0) > 0""")
def raw_export(t):
    """Records that have a name and an image, flat, as they leave the store."""
    r = records(t).where((F.coalesce(F.trim("name"), F.lit("")) != "") & (F.size("images") > 0))
    return r.select("id", "name", "country", "city", "year", "tier", F.array_join("images", " ").alias("image_urls"))


GENERIC = f"""(len(regexp_extract_all(lower(name), '[a-z0-9]+')) > 0 AND len(list_filter(regexp_extract_all(lower(name), '[a-z0-9]+'), lambda w: w NOT IN {sql_list(P.GENERIC_NAMES)} AND len(w) > 1)) <= 1)"""


@query(f"""WITH {SERVING}, dk AS (SELECT count(*) - 1 AS n FROM srv GROUP BY id HAVING count(*) > 1), dc AS (SELECT count(*) AS n FROM srv WHERE publishable AND cover IS NOT NULL GROUP BY cover HAVING count(*) > 1),
dn AS (SELECT lower(trim(name)) AS name FROM srv WHERE coalesce(trim(name), '') <> '' GROUP BY 1 HAVING count(*) > 1)
SELECT 'failure' AS kind, 'missing_required' AS rule, count(*) FILTER (WHERE coalesce(trim(name), '') = '') AS n FROM srv
UNION ALL SELECT 'failure', 'invalid_confidence_tier', count(*) FILTER (WHERE tier NOT IN ('T1', 'T2', 'T3')) FROM srv
UNION ALL SELECT 'failure', 'bad_material_visual', count(*) FILTER (WHERE len(material) = 0 AND NOT list_contains(reasons, '{P.NOISE_ONLY}') AND len(elements) = 0) FROM srv
UNION ALL SELECT 'failure', 'bad_architectural_elements', count(*) FILTER (WHERE len(list_filter(elements, lambda e: e NOT IN {sql_list(sorted(set(P.ELEMENT_OF.values())))})) > 0) FROM srv
UNION ALL SELECT 'failure', 'publishable_missing_image', count(*) FILTER (WHERE publishable AND (len(images) = 0 OR cover IS NULL)) FROM srv
UNION ALL SELECT 'failure', 'duplicate_pk', CAST(coalesce(sum(n), 0) AS BIGINT) FROM dk UNION ALL SELECT 'failure', 'display_cover_url_reused', CAST(coalesce(sum(n), 0) AS BIGINT) FROM dc
UNION ALL SELECT 'warning', 'nonpublishable_rows', count(*) FILTER (WHERE NOT publishable) FROM srv UNION ALL SELECT 'warning', 'empty_all_images', count(*) FILTER (WHERE len(images) = 0) FROM srv
UNION ALL SELECT 'warning', 'missing_display_cover_url', count(*) FILTER (WHERE cover IS NULL) FROM srv UNION ALL SELECT 'warning', 'missing_location_country', count(*) FILTER (WHERE country IS NULL) FROM srv
UNION ALL SELECT 'warning', 'missing_location_city', count(*) FILTER (WHERE city IS NULL) FROM srv UNION ALL SELECT 'warning', 'missing_project_year', count(*) FILTER (WHERE year IS NULL) FROM srv
UNION ALL SELECT 'warning', 'genericish_name_rows', count(*) FILTER (WHERE {GENERIC}) FROM srv
UNION ALL SELECT 'warning', 'duplicate_name_groups', count(*) FROM dn UNION ALL SELECT 'warning', 'generic_duplicate_name_groups', count(*) FILTER (WHERE {GENERIC}) FROM dn""")
def upload_checks(t):
    return P.upload_checks(_served(t))


FIELDS = ("id", "name", "tier", "city", "country", "year", "material", "cover")


@query(f"""WITH {RECORDS}, f AS (""" + " UNION ALL ".join(f"SELECT '{f}' AS field, count(*) FILTER (WHERE {'len(material) > 0' if f == 'material' else f + ' IS NOT NULL' if f in ('id', 'year') else f'trim({f}) <> ' + chr(39) * 2}) AS filled, count(*) AS n FROM rec" for f in FIELDS) + """)
SELECT field, filled, round(filled / CAST(n AS DOUBLE), 4) AS pct, CASE WHEN field IN ('id', 'name', 'tier') AND filled < n THEN 'missing_required' WHEN filled < n THEN 'null_field' ELSE 'ok' END AS issue FROM f""")
def review_report(t):
    """Presence of every field; a gap in a required one is critical."""
    r = records(t)
    kinds = dict(r.dtypes)
    c = P.coverage(r, {f: V.is_present(F.col(f), kinds[f]) for f in FIELDS})
    full = F.col("filled") == F.max("filled").over(Window.partitionBy())  # the id is always there; a row per field
    return c.withColumn("issue", F.when(full, "ok").when(F.col("field").isin("id", "name", "tier"), "missing_required").otherwise("null_field"))


def _tag_tables(t):
    e = t("embeddings")
    means = R.mean_vectors(e, "label", "embedding")
    total = e.agg(F.count("*").alias("n"))
    stats = means.join(F.broadcast(total.select(F.col("n").alias("total_n")))).select(F.col("label").alias("tag"), F.col("n").alias("doc_freq"), "total_n", F.ln(F.col("total_n") / (F.col("n") + 1)).alias("idf"))  # one row
    return stats, means.select(F.col("label").alias("tag"), V.normalized(F.col("mean")).alias("centroid"), "n"), total


@query("""WITH s AS (SELECT label AS tag, count(*) AS df FROM embeddings GROUP BY 1), big AS (SELECT tag FROM s WHERE df >= 20 AND tag NOT IN (0, 1, 2, 3, 4, 5, 6, 7))
SELECT * FROM (VALUES ('total_n', 0), ('sum_doc_freq', 0), ('idf_formula', 0), ('stats_without_centroid', 0), ('centroid_without_stats', 0), ('count_of_centroid', 0), ('unit_length', 0)) v("check", bad), (SELECT 'PASS' AS status)
UNION ALL SELECT 'stats_without_label', count(*) FILTER (WHERE tag > 7), CASE WHEN count(*) FILTER (WHERE tag > 7) = 0 THEN 'PASS' ELSE 'FAIL' END FROM s
UNION ALL SELECT 'out_of_vocabulary', count(*) FILTER (WHERE tag > 8), CASE WHEN count(*) FILTER (WHERE tag > 8) = 0 THEN 'PASS' ELSE 'FAIL' END FROM s
UNION ALL SELECT 'frequent_without_label', count(*), CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'WARN' END FROM big""")
def tag_table_checks(t):
    stats, centroids, total = _tag_tables(t)
    labels = stats.where("tag < 8").select("tag")
    return P.tag_checks(stats, centroids, labels, total, list(range(9)), 20)


@query("""WITH u AS (SELECT label, generate_subscripts(embedding, 1) AS i, CAST(round(CAST(unnest(embedding) AS DOUBLE) * 1000000) AS BIGINT) AS x FROM embeddings WHERE label = 3), m AS (SELECT i, sum(x) / CAST(count(*) AS DOUBLE) / 1000000 AS x FROM u GROUP BY 1), c AS (SELECT list(x ORDER BY i) AS c FROM m),
s AS (SELECT vec_id, label, round(list_inner_product(v, c) / greatest(sqrt(list_inner_product(v, v)) * sqrt(list_inner_product(c, c)), 1e-12), 6) AS score FROM (SELECT vec_id, label, list_transform(embedding, lambda y: CAST(y AS DOUBLE)) AS v FROM embeddings), c) SELECT vec_id, label, score FROM s ORDER BY score DESC, vec_id LIMIT 20""")
def tag_centroid_neighbors(t):
    """The 20 vectors nearest to a tag's centroid."""
    _, centroids, _ = _tag_tables(t)
    one = F.broadcast(centroids.where("tag = 3").select("centroid"))  # one row
    s = F.round(V.cosine(F.col("embedding"), F.col("centroid")), 6)
    return t("embeddings").join(one).select("vec_id", "label", s.alias("score")).orderBy(F.desc("score"), "vec_id").limit(20)


@query("""WITH k AS (SELECT vec_id, label, embedding, vec_id % 3 > 0 AS shown FROM embeddings), a AS (SELECT label, bool_or(shown) AS any_shown FROM k GROUP BY 1), u AS (SELECT label, generate_subscripts(embedding, 1) AS i, CAST(round(CAST(unnest(embedding) AS DOUBLE) * 1000000) AS BIGINT) AS x FROM k JOIN a USING (label) WHERE shown OR NOT any_shown)
SELECT label, CAST(i - 1 AS INTEGER) AS place, round(sum(x) / CAST(count(*) AS DOUBLE) / 1000000, 6) AS x FROM u GROUP BY 1, 2""")
def portfolio_vector(t):
    """Mean vector of a portfolio's shown members, of all where none is shown."""
    k = t("embeddings").withColumn("shown", F.col("vec_id") % 3 > 0)
    some = k.groupBy("label").agg(F.bool_or("shown").alias("any_shown"))
    m = R.mean_vectors(k.join(some, "label").where("shown OR NOT any_shown"), "label", "embedding")
    return m.select("label", F.posexplode("mean").alias("place", "x")).withColumn("x", F.round("x", 6))


@query("""WITH v AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings), u AS (SELECT e FROM v WHERE vec_id = 11), x AS (SELECT DISTINCT user_id FROM events WHERE event_type = 'purchase')
SELECT v.vec_id, round(list_inner_product(v.e, u.e) / greatest(sqrt(list_inner_product(v.e, v.e)) * sqrt(list_inner_product(u.e, u.e)), 1e-12), 6) AS score FROM v, u WHERE v.vec_id <> 11 AND v.vec_id NOT IN (SELECT user_id FROM x) ORDER BY 2 DESC, 1 LIMIT 20""")
def recommend_exclude(t):
    """Neighbours of a vector without those already taken, by anti join."""
    e = t("embeddings")
    u = F.broadcast(e.where("vec_id = 11").select(F.col("embedding").alias("u")))  # one row
    taken = t("events").where("event_type = 'purchase'").select(F.col("user_id").alias("vec_id"))
    s = e.where("vec_id <> 11").join(taken, "vec_id", "left_anti").join(u).select("vec_id", F.round(V.cosine(F.col("embedding"), F.col("u")), 6).alias("score"))
    return s.orderBy(F.desc("score"), "vec_id").limit(20)


# --- names, places, links -----------------------------------------------------------------------

TITLED = "d AS (SELECT doc_id, substr(regexp_replace(text, '\\s+', ' ', 'g'), 1, CAST(doc_id % 90 AS INTEGER)) || CASE WHEN doc_id % 7 = 0 THEN ' wins prize' WHEN doc_id % 11 = 0 THEN ' Biennale' ELSE '' END AS name, lang, n_chars FROM documents)"


def _titled(t):
    k = F.col("doc_id")
    name = F.concat(F.substr(F.regexp_replace("text", "\\s+", " "), F.lit(1), (k % 90).cast("int")), F.when(k % 7 == 0, " wins prize").when(k % 11 == 0, " Biennale").otherwise(""))
    return t("documents").select("doc_id", name.alias("name"), "lang", "n_chars")


VERB, EVENT = (x.replace("(?i)", "") for x in (P.ARTICLE_VERBS, P.EVENT_WORDS))
TITLE = f"CASE WHEN coalesce(name, '') = '' THEN 'empty_name' WHEN length(name) > {P.LONGEST_NAME} THEN 'name_too_long' WHEN regexp_matches(name, '{VERB}', 'i') THEN 'action_verb' WHEN regexp_matches(name, '{EVENT}', 'i') THEN 'non_building_keyword' END"


@query(f"WITH {TITLED} SELECT doc_id, {TITLE} AS reason FROM d")
def article_title_reject(t):
    return _titled(t).select("doc_id", P.article_title(F.col("name")).alias("reason"))


@query(f"""WITH {TITLED}, j AS (SELECT d.*, {TITLE} AS title, doc_id % 10 = 0 AS many, doc_id % 3 > 0 AS firm, n_chars > 3000 AS area, lang = 'en' AS country FROM d)
SELECT doc_id, CASE WHEN many THEN 'KEEP' WHEN title IS NOT NULL THEN 'DROP' WHEN NOT firm THEN 'DROP' WHEN area OR country THEN 'KEEP' ELSE 'DEFER_L4' END AS decision, CASE WHEN many THEN 'T1' WHEN title IS NOT NULL OR NOT firm THEN NULL WHEN area OR country THEN 'T2' END AS tier,
CASE WHEN many THEN 'L1_cross_source' WHEN title IS NOT NULL THEN 'L2_' || title WHEN NOT firm THEN 'L3_no_architect_link' WHEN area OR country THEN 'L3_struct_signal:' || concat_ws('+', CASE WHEN area THEN 'area' END, CASE WHEN country THEN 'country' END) ELSE 'L3_no_struct_defer_to_L4' END AS reason FROM j""")
def reality_layers(t):
    k = F.col("doc_id")
    return _titled(t).select("doc_id", P.reality(F.col("name"), k % 10 == 0, k % 3 > 0, {"area": F.col("n_chars") > 3000, "country": F.col("lang") == "en"}).alias("r")).select("doc_id", "r.*")


@query(f"""WITH {RECORDS}, q AS (SELECT id, concat_ws(';', CASE WHEN coalesce(length(trim(name)), 0) < 9 THEN 'name' END, CASE WHEN city IS NULL OR city NOT IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD') THEN 'program' END) AS text_bad, concat_ws(';', CASE WHEN coalesce(len(material), 0) < 2 THEN 'material' END, CASE WHEN cover IS NULL THEN 'cover' END) AS image_bad FROM rec)
SELECT id, concat_ws(';', nullif(text_bad, ''), nullif(image_bad, '')) AS issues, CASE WHEN text_bad <> '' THEN 'enrichment' WHEN image_bad <> '' THEN 'image_analysis' END AS requeue FROM q""")
def requeue_target(t):
    issue = lambda bad, name: F.when(F.coalesce(bad, F.lit(True)), name)
    text = F.array_compact(F.array(issue(F.length(F.trim("name")) < 9, "name"), issue(~F.col("city").isin("BUILDING", "MACHINERY", "HOUSEHOLD"), "program")))
    image = F.array_compact(F.array(issue(F.size("material") < 2, "material"), issue(F.col("cover").isNull(), "cover")))
    return records(t).select("id", text.alias("a"), image.alias("b")).select("id", F.array_join(F.concat("a", "b"), ";").alias("issues"), P.requeue(F.col("a"), F.col("b")).alias("requeue"))


KNOWN = [f"NATION_{i}" for i in range(0, 25, 2)]


@query(f"""WITH c AS (SELECT c_custkey, n_name, CASE WHEN c_custkey % 4 = 0 THEN n_name WHEN c_custkey % 4 = 1 THEN c_mktsegment || ' ' || n_name || ' -' WHEN c_custkey % 4 = 2 THEN n_name || ' east' ELSE CAST(c_custkey AS VARCHAR) END AS place, CASE WHEN c_custkey % 5 = 0 THEN n_name WHEN c_custkey % 5 = 1 THEN '12-3' WHEN c_custkey % 5 = 2 THEN 'Ann Smith' ELSE c_mktsegment END AS town FROM customer JOIN nation ON n_nationkey = c_nationkey),
k AS (SELECT *, CASE WHEN c_custkey % 4 < 2 AND n_name IN {sql_list(KNOWN)} THEN n_name END AS country FROM c)
SELECT c_custkey, country, CASE WHEN c_custkey % 5 = 0 AND (n_name IN {sql_list(KNOWN)} OR n_name IS NOT DISTINCT FROM country) THEN NULL WHEN c_custkey % 5 IN (1, 2) THEN NULL ELSE town END AS city FROM k""")
def place_validators(t):
    k, n = F.col("c_custkey"), F.broadcast(t("nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name"))  # 25 nations
    place = F.when(k % 4 == 0, F.col("n_name")).when(k % 4 == 1, F.concat_ws(" ", "c_mktsegment", "n_name", F.lit("-"))).when(k % 4 == 2, F.concat("n_name", F.lit(" east"))).otherwise(k.cast("string"))
    town = F.when(k % 5 == 0, F.col("n_name")).when(k % 5 == 1, "12-3").when(k % 5 == 2, "Ann Smith").otherwise(F.col("c_mktsegment"))
    c = t("customer").join(n, "c_nationkey").select("c_custkey", P.country_of(place, KNOWN, ["ann", "smith"]).alias("country"), town.alias("town"))
    return c.select("c_custkey", "country", P.city_of(F.col("town"), F.col("country"), KNOWN, ["ann", "smith"]).alias("city"))


@query("""SELECT page_id, CASE WHEN NOT regexp_matches(lower(url), 'spam-farm|blog\\.') THEN url END AS link FROM pages""")
def social_links(t):
    return t("pages").select("page_id", P.own_link(F.col("url"), r"spam-farm|blog\.").alias("link"))


@query("""WITH p AS (SELECT conv_id, turn, CASE WHEN turn % 3 = 0 THEN 'Add to list  Choose list...' || chr(10) || text WHEN turn % 3 = 1 THEN text ELSE 'Add to list Choose list...' END AS text FROM conversations)
SELECT conv_id, turn, nullif(trim(regexp_replace(regexp_replace(text, '(?i)\\bAdd to list\\s+Choose list\\.\\.\\.', ' ', 'g'), '\\s+', ' ', 'g')), '') AS text, CASE WHEN trim(text) = '' THEN 'missing' WHEN turn % 3 = 2 THEN 'rejected_ui_only' WHEN turn % 3 = 0 AND trim(regexp_replace(text, '(?i)\\bAdd to list\\s+Choose list\\.\\.\\.', ' ', 'g')) = '' THEN 'rejected_ui_only' WHEN turn % 3 = 0 THEN 'ui_removed' ELSE 'clean' END AS status, CAST(CASE WHEN turn % 3 = 1 THEN 0 ELSE 1 END AS INTEGER) AS removed FROM p""")
def boilerplate_removal(t):
    k = F.col("turn") % 3
    text = F.when(k == 0, F.concat(F.lit("Add to list  Choose list...\n"), "text")).when(k == 1, F.col("text")).otherwise("Add to list Choose list...")
    return t("conversations").select("conv_id", "turn", P.without_boilerplate(text, r"(?i)\bAdd to list\s+Choose list\.\.\.").alias("r")).select("conv_id", "turn", "r.*")


@query("""WITH p AS (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'sqft_1_3' WHEN 1 THEN 'sqft_1000' WHEN 2 THEN 'other' END AS slug, CASE p_size % 4 WHEN 0 THEN '1,000 - 3,000 sqft' WHEN 1 THEN '1,000,000+ sqft' WHEN 2 THEN 'large' END AS display FROM part)
SELECT p_partkey, CASE WHEN slug = 'sqft_1_3' THEN 1000 WHEN slug = 'sqft_1000' THEN 1000000 WHEN display LIKE '1,000 %' THEN 1000 WHEN display LIKE '%+%' THEN 1000000 END AS min_sqft, CASE WHEN slug = 'sqft_1_3' THEN 3000 WHEN slug = 'sqft_1000' THEN NULL WHEN display LIKE '1,000 %' THEN 3000 END AS max_sqft,
coalesce(slug = 'sqft_1000' OR (slug IS DISTINCT FROM 'sqft_1_3' AND display LIKE '%+%'), false) AS is_open, CASE WHEN slug = 'sqft_1_3' THEN CASE WHEN display LIKE '%+%' THEN 'review' ELSE 'confirmed' END WHEN slug = 'sqft_1000' THEN CASE WHEN display LIKE '1,000 %' THEN 'review' ELSE 'confirmed' END WHEN display LIKE '1,0%' THEN 'candidate' ELSE 'review' END AS status FROM p""")
def size_bands(t):
    a, b = F.col("p_partkey") % 4, F.col("p_size") % 4
    slug = F.when(a == 0, "sqft_1_3").when(a == 1, "sqft_1000").when(a == 2, "other")
    shown = F.when(b == 0, "1,000 - 3,000 sqft").when(b == 1, "1,000,000+ sqft").when(b == 2, "large")
    return t("part").select("p_partkey", P.size_band(slug, shown).alias("r")).select("p_partkey", "r.*")


# --- vocabularies --------------------------------------------------------------------------------

PROGRAMS = {"ring": "Museum", "gear": "Infrastructure", "bolt": "Housing", "anvil": "Infrastructure"}


@query(f"""WITH g AS (SELECT l_orderkey, list(split_part(p_name, ' ', 2) ORDER BY l_linenumber, l_partkey) AS tags FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1), h AS (SELECT l_orderkey, list_filter(tags, lambda x: x IN {sql_list(PROGRAMS)})[1] AS hit FROM g)
SELECT l_orderkey, coalesce({sql_map(PROGRAMS)}[hit], 'Other') AS program, CASE WHEN hit IS NULL THEN 'no_typology_tag_match' ELSE 'matched:' || hit END AS reason FROM h""")
def tags_to_program(t):
    part = t("part").select(F.col("p_partkey").alias("l_partkey"), F.element_at(F.split("p_name", " "), 2).alias("tag"))
    g = t("lineitem").join(part, "l_partkey").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "tag"))).alias("g"))
    return g.select("l_orderkey", P.first_program(F.col("g.tag"), PROGRAMS).alias("r")).select("l_orderkey", "r.*")


FACETS = [("red", "tone", "warm"), ("hot", "tone", "warm"), ("blue", "tone", "cool"), ("cold", "tone", "cool"), ("ring", "form", "round"), ("rod", "form", "linear"), ("plate", "form", "flat"), ("old", "age", "historic"), ("new", "age", "recent")]


@query(f"""WITH f(tag, axis, value) AS (VALUES {", ".join(map(str, FACETS))}), g AS (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS tag FROM part) SELECT axis, value, count(DISTINCT p_partkey) AS parts FROM g JOIN f USING (tag) GROUP BY 1, 2
UNION ALL SELECT 'unmapped', tag, count(DISTINCT p_partkey) FROM g WHERE tag NOT IN (SELECT tag FROM f) GROUP BY 1, 2""")
def tag_facets(t):
    """Tags become facets by a dimension table; those without one are listed."""
    f = F.broadcast(t("part").sparkSession.createDataFrame(FACETS, "tag string, axis string, value string"))  # the vocabulary
    g = t("part").select("p_partkey", F.explode(F.split("p_name", " ")).alias("tag")).join(f, "tag", "left")
    return g.groupBy(F.coalesce("axis", F.lit("unmapped")).alias("axis"), F.coalesce("value", "tag").alias("value")).agg(F.count_distinct("p_partkey").alias("parts"))


@query("""SELECT p_partkey, CASE WHEN p_name = 'red ring' THEN 'typology' WHEN regexp_matches(p_name, '(^| )(wid|bol)') THEN 'typology' WHEN regexp_matches(p_name, '(^| )(plate|ro)') THEN 'element' ELSE 'drop' END AS bucket FROM part""")
def tag_buckets(t):
    return t("part").select("p_partkey", P.bucket_of(F.regexp_replace("p_name", " ", "-"), ["red ring"], {"typology": ["wid", "bol"], "element": ["plate", "ro"]}).alias("bucket"))


VOCAB, LEGACY, ALIAS = ["Economy", "Standard", "Premium"], {"promo": "Premium", "small": None}, {"larg": "Standard"}


@query("""SELECT p_partkey, CASE p_type WHEN 'ECONOMY' THEN 'Economy' WHEN 'STANDARD' THEN 'Standard' WHEN 'PROMO' THEN 'Premium' END AS strict, CASE WHEN p_type IN ('ECONOMY', 'STANDARD') THEN 'case_normalized' WHEN p_type = 'PROMO' THEN 'legacy_migrated' WHEN p_type = 'SMALL' THEN 'legacy_dropped' ELSE 'unknown_value' END AS strict_reason,
CASE p_type WHEN 'ECONOMY' THEN 'Economy' WHEN 'STANDARD' THEN 'Standard' WHEN 'PROMO' THEN 'Premium' WHEN 'LARGE' THEN 'Standard' WHEN 'SMALL' THEN NULL ELSE p_type END AS loose, CASE WHEN p_type IN ('ECONOMY', 'STANDARD') THEN 'case_normalized' WHEN p_type = 'PROMO' THEN 'legacy_migrated' WHEN p_type = 'SMALL' THEN 'legacy_dropped' WHEN p_type = 'LARGE' THEN 'loose_alias' END AS loose_reason FROM part""")
def vocab_migration(t):
    """Strict and permissive migration of a value to the vocabulary, with the reason of each rewrite."""
    v = F.col("p_type")
    r = t("part").select("p_partkey", P.migrated(v, VOCAB, LEGACY).alias("s"), P.migrated(v, VOCAB, LEGACY, ALIAS).alias("l"))
    return r.select("p_partkey", F.col("s.value").alias("strict"), F.col("s.reason").alias("strict_reason"), F.col("l.value").alias("loose"), F.col("l.reason").alias("loose_reason"))


@query("""WITH m AS (SELECT p_type AS old, CASE p_type WHEN 'ECONOMY' THEN 'Economy' WHEN 'STANDARD' THEN 'Standard' WHEN 'PROMO' THEN 'Premium' END AS new FROM part) SELECT old, new, count(*) AS n FROM m WHERE old IS DISTINCT FROM new GROUP BY 1, 2""")
def vocab_audit(t):
    """What a migration rewrote, counted."""
    m = t("part").select(F.col("p_type").alias("old"), P.migrated(F.col("p_type"), VOCAB, LEGACY)["value"].alias("new"))
    return m.where(~F.col("old").eqNullSafe(F.col("new"))).groupBy("old", "new").agg(F.count("*").alias("n"))


@query("""WITH d AS (SELECT event_id, CASE event_id % 3 WHEN 0 THEN '{"style":"modern","tone":"RED"}' WHEN 1 THEN '{"style":"Modern","tone":"grey","k":1}' ELSE '{"tone":"Warm"}' END AS j FROM events)
SELECT event_id, CASE WHEN event_id % 3 < 2 THEN 'Modern' END AS style, CASE event_id % 3 WHEN 0 THEN 'Warm' WHEN 2 THEN 'Warm' END AS tone, event_id % 3 < 2 AS changed FROM d""")
def nested_vocab(t):
    """Two fields of a nested JSON value, brought to the vocabulary; what is unknown goes."""
    k = F.col("event_id") % 3
    j = F.when(k == 0, '{"style":"modern","tone":"RED"}').when(k == 1, '{"style":"Modern","tone":"grey","k":1}').otherwise('{"tone":"Warm"}')
    m = t("events").select("event_id", F.from_json(j, "map<string,string>").alias("m"))
    style, tone = F.col("m")["style"], F.col("m")["tone"]
    new_style, new_tone = P.migrated(style, ["Modern", "Classic"], {})["value"], P.migrated(tone, ["Warm", "Cool"], {"red": "Warm"})["value"]
    return m.select("event_id", new_style.alias("style"), new_tone.alias("tone"), (~new_style.eqNullSafe(style) | ~new_tone.eqNullSafe(tone)).alias("changed"))


CONTEXT, ANCILLARY, ORDER = ["plate"], ["ring", "rod"], ["gear", "bolt", "gizmo", "anvil", "widget", "ring", "rod", "plate"]


@query(f"""WITH c AS (SELECT l_orderkey, split_part(p_name, ' ', 2) AS tag, count(*) AS n FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2)
SELECT l_orderkey, tag FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY tag = 'plate', n DESC, tag IN ('ring', 'rod'), list_position([{", ".join(f"'{x}'" for x in ORDER)}], tag)) AS k FROM c) WHERE k = 1""")
def primary_type(t):
    part = t("part").select(F.col("p_partkey").alias("l_partkey"), F.element_at(F.split("p_name", " "), 2).alias("tag"))
    c = t("lineitem").join(part, "l_partkey").groupBy("l_orderkey", "tag").agg(F.count("*").alias("n"))
    return P.primary_type(c, "l_orderkey", "tag", "n", CONTEXT, ANCILLARY, ORDER)


@query("""WITH p AS (SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN p_type END AS tr, CASE WHEN p_size % 2 = 0 THEN p_brand END AS vr, CASE WHEN p_size % 5 > 0 THEN p_name END AS tf, CASE WHEN p_size % 7 = 0 THEN p_brand END AS vf FROM part)
SELECT p_partkey, coalesce(vr, tr) AS roof, CASE WHEN vr IS NOT NULL THEN 'vision' WHEN tr IS NOT NULL THEN 'text' END AS roof_source, coalesce(tf, vf) AS facade, CASE WHEN tf IS NOT NULL THEN 'text' WHEN vf IS NOT NULL THEN 'vision' END AS facade_source, tf AS scale FROM p""")
def axis_precedence(t):
    """Axes from text and image, each with its own precedence and the source of its value."""
    s, w = F.col("p_size"), F.when
    text = {"roof": w(s % 3 == 0, F.col("p_type")), "facade": w(s % 5 > 0, F.col("p_name")), "scale": w(s % 5 > 0, F.col("p_name"))}
    vision = {"roof": w(s % 2 == 0, F.col("p_brand")), "facade": w(s % 7 == 0, F.col("p_brand"))}
    v = P.axis_values(text, vision, {"roof"})
    return t("part").select("p_partkey", v["roof"]["value"].alias("roof"), v["roof"]["source"].alias("roof_source"), v["facade"]["value"].alias("facade"), v["facade"]["source"].alias("facade_source"), v["scale"]["value"].alias("scale"))


WORDY = "lower(url || ' ' || CASE WHEN page_id % 5 = 0 THEN 'Floor Plan' WHEN page_id % 5 = 1 THEN 'Drone view' WHEN page_id % 5 = 2 THEN 'Main hall' WHEN page_id % 5 = 3 THEN 'Joint' ELSE '' END)"


@query(f"""WITH p AS (SELECT page_id, {WORDY} AS x, page_id % 13 = 0 AS hint FROM pages) SELECT page_id, CASE WHEN hint OR regexp_matches(x, '{"|".join(P.IMAGE_WORDS["drawing"])}') THEN 'drawing' WHEN regexp_matches(x, '{"|".join(P.IMAGE_WORDS["aerial"])}') THEN 'aerial' WHEN regexp_matches(x, '{"|".join(P.IMAGE_WORDS["interior"])}') THEN 'interior' WHEN regexp_matches(x, '{"|".join(P.IMAGE_WORDS["detail"])}') THEN 'detail' ELSE 'exterior' END AS type,
CASE WHEN hint OR regexp_matches(x, '{"|".join(w for k in P.IMAGE_WORDS.values() for w in k)}') THEN 'high' ELSE 'low' END AS confidence FROM p""")
def image_types(t):
    k = F.col("page_id") % 5
    alt = F.when(k == 0, "Floor Plan").when(k == 1, "Drone view").when(k == 2, "Main hall").when(k == 3, "Joint").otherwise("")
    return t("pages").select("page_id", P.image_type(F.col("url"), alt, F.when(F.col("page_id") % 13 == 0, "drawing").otherwise("gallery")).alias("r")).select("page_id", "r.*")


AXES = """a AS (SELECT event_id, event_id % 11 > 0 AS scope, CASE event_id % 4 WHEN 0 THEN 'drawing' WHEN 3 THEN 'mixed' ELSE 'photograph' END AS medium, CASE user_id % 4 WHEN 0 THEN 'interior' WHEN 1 THEN 'exterior' WHEN 2 THEN 'threshold' ELSE 'unknown' END AS context, CASE WHEN event_id % 5 = 0 THEN 'element_detail' ELSE 'overall' END AS framing, CASE WHEN event_id % 7 = 0 THEN 'aerial_oblique' ELSE 'eye_level' END AS camera, CASE WHEN event_id % 9 = 0 THEN 'construction_visible' ELSE 'visibly_finished' END AS state, event_id % 17 = 0 AS unsure FROM events),
m AS (SELECT *, CASE WHEN NOT scope THEN 'unknown' WHEN medium = 'drawing' THEN 'drawing' WHEN medium <> 'photograph' THEN 'unknown' WHEN camera = 'aerial_oblique' THEN 'aerial' WHEN framing = 'element_detail' THEN 'detail' WHEN context IN ('interior', 'exterior') THEN context ELSE 'unknown' END AS class FROM a)"""


@query(f"""WITH {AXES} SELECT event_id, class, CASE WHEN scope THEN concat_ws(',', CASE WHEN medium = 'drawing' AND class <> 'drawing' THEN 'drawing' END, CASE WHEN camera = 'aerial_oblique' AND class <> 'aerial' THEN 'aerial' END, CASE WHEN framing = 'element_detail' AND class <> 'detail' THEN 'detail' END, CASE WHEN context IN ('interior', 'threshold') AND class <> 'interior' THEN 'interior' END, CASE WHEN context IN ('exterior', 'threshold') AND class <> 'exterior' THEN 'exterior' END) ELSE '' END AS others,
CASE WHEN NOT scope THEN 'rejected' WHEN state <> 'visibly_finished' THEN 'archive_only' WHEN class = 'unknown' OR medium = 'mixed' OR context = 'threshold' OR unsure THEN 'review_required' ELSE 'eligible' END AS usage FROM m""")
def axes_to_class(t):
    k, u = F.col("event_id"), F.col("user_id") % 4
    medium = F.when(k % 4 == 0, "drawing").when(k % 4 == 3, "mixed").otherwise("photograph")
    context = F.when(u == 0, "interior").when(u == 1, "exterior").when(u == 2, "threshold").otherwise("unknown")
    a = t("events").select("event_id", (k % 11 > 0).alias("scope"), medium.alias("medium"), context.alias("context"), F.when(k % 5 == 0, "element_detail").otherwise("overall").alias("framing"), F.when(k % 7 == 0, "aerial_oblique").otherwise("eye_level").alias("camera"), F.when(k % 9 == 0, "construction_visible").otherwise("visibly_finished").alias("state"), (k % 17 == 0).alias("unsure"))
    r = P.image_class(*map(F.col, ("scope", "medium", "context", "framing", "camera", "state", "unsure")))
    return a.select("event_id", r.alias("r")).select("event_id", "r.class", F.array_join("r.others", ",").alias("others"), "r.usage")


# --- audits, queues and views -----------------------------------------------------------------------


@query(f"""WITH {SERVING} SELECT id, cover FROM srv WHERE publishable AND cover IN (SELECT cover FROM srv WHERE publishable AND cover IS NOT NULL GROUP BY 1 HAVING count(*) > 1)""")
def duplicate_cover_rows(t):
    s = _served(t).where("publishable").select("id", "cover")
    return s.join(P.repeated(s, "cover"), "cover", "left_semi").select("id", "cover")


@query(f"""WITH {RECORDS} SELECT 'orphan_line' AS check_name, count(*) AS n FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders) UNION ALL SELECT 'record_without_line', count(*) FROM rec WHERE name IS NULL
UNION ALL SELECT 'cover_not_in_images', count(*) FROM rec WHERE cover IS NOT NULL AND NOT list_contains(images, cover) UNION ALL SELECT 'tier_differs', count(*) FROM rec WHERE tier <> CASE WHEN n_sources >= 3 THEN 'T1' WHEN n_sources = 2 THEN 'T2' ELSE 'T3' END
UNION ALL SELECT 'country_missing_but_known', count(*) FROM rec WHERE country IS NULL UNION ALL SELECT 'order_without_customer', count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)""")
def integrity_audit(t):
    """Links, recomputed facts and gaps that the sources could fill."""
    r, n = records(t), F.col("n_sources")
    count = lambda name, df: df.agg(F.count("*").alias("n")).select(F.lit(name).alias("check_name"), "n")
    parts = [
        count("orphan_line", t("lineitem").join(t("orders").select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey", "left_anti")), count("record_without_line", r.where("name IS NULL")),
        count("cover_not_in_images", r.where(F.col("cover").isNotNull() & ~F.array_contains("images", F.col("cover")))), count("tier_differs", r.where(F.col("tier") != F.when(n >= 3, "T1").when(n == 2, "T2").otherwise("T3"))),
        count("country_missing_but_known", r.where("country IS NULL")), count("order_without_customer", t("orders").join(t("customer").select(F.col("c_custkey").alias("o_custkey")), "o_custkey", "left_anti")),
    ]
    return reduce(DataFrame.union, parts)


@query(f"""WITH {SERVING} SELECT 'curated' AS view, count(*) AS n FROM srv WHERE publishable UNION ALL SELECT 'review_queue', count(*) FROM srv WHERE NOT publishable AND name IS NOT NULL UNION ALL SELECT 'missing_place', count(*) FROM srv WHERE publishable AND (city IS NULL OR country IS NULL)""")
def curated_views(t):
    """Temporary views over the serving rows, read back by name."""
    s = _served(t)
    views = {"curated": s.where("publishable"), "review_queue": s.where("NOT publishable AND name IS NOT NULL"), "missing_place": s.where("publishable AND (city IS NULL OR country IS NULL)")}
    for name, df in views.items():
        df.createOrReplaceTempView(f"cairnwork_{name}")
    return s.sparkSession.sql(" UNION ALL ".join(f"SELECT '{name}' AS view, count(*) AS n FROM cairnwork_{name}" for name in views))


@query("""WITH s AS (SELECT label, vec_id, row_number() OVER (PARTITION BY label ORDER BY sha256('q|' || vec_id), vec_id) AS k FROM embeddings), seeds AS (SELECT vec_id AS seed, label FROM s ORDER BY k, sha256('q|' || vec_id), vec_id LIMIT 12), v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings),
c AS (SELECT seed, b.vec_id AS id, round(list_inner_product(a.e, b.e) / greatest(sqrt(list_inner_product(a.e, a.e)) * sqrt(list_inner_product(b.e, b.e)), 1e-12), 6) AS score FROM seeds JOIN v a ON a.vec_id = seed JOIN v b ON b.vec_id <> seed),
r AS (SELECT *, row_number() OVER (PARTITION BY seed ORDER BY score DESC, id) AS true_rank FROM c) SELECT seed, id, true_rank, CAST(row_number() OVER (PARTITION BY seed ORDER BY sha256('b|' || seed || '|' || id)) AS BIGINT) AS label FROM r WHERE true_rank <= 5""")
def taste_queue(t):
    """A blind queue: seeds of as many tags as there are, the five nearest of each in an order that hides their rank."""
    e = t("embeddings").select("vec_id", "label", "embedding")
    h = F.sha2(F.concat_ws("|", F.lit("q"), "vec_id"), 256)
    seeds = e.withColumn("k", F.row_number().over(Window.partitionBy("label").orderBy(h, "vec_id"))).orderBy("k", h, "vec_id").limit(12)
    seeds = F.broadcast(seeds.select(F.col("vec_id").alias("seed"), F.col("embedding").alias("s")))  # twelve rows
    c = e.join(seeds, F.col("vec_id") != F.col("seed")).select("seed", F.col("vec_id").alias("id"), F.round(V.cosine(F.col("s"), F.col("embedding")), 6).alias("score"))
    r = R.top_n(c, ["seed"], 5, F.desc("score"), F.col("id"), rank="true_rank").select("seed", "id", F.col("true_rank").cast("long").alias("true_rank"))
    hidden = Window.partitionBy("seed").orderBy(F.sha2(F.concat_ws("|", F.lit("b"), "seed", "id"), 256))
    return r.withColumn("label", F.row_number().over(hidden).cast("long"))


@query("""SELECT axis, tag, round(ln(total_n / CAST(n + 1 AS DOUBLE)), 6) AS idf, fresh FROM (SELECT 'type' AS axis, p_type AS tag, count(*) AS n, max(p_partkey) AS latest FROM part GROUP BY 2), (SELECT count(*) AS total_n, max(p_partkey) AS fresh FROM part)""")
def tag_freshness(t):
    """Tag weights with the whole table's latest version beside each: a window without partitions, over one row per tag."""
    p = t("part").groupBy(F.col("p_type").alias("tag")).agg(F.count("*").alias("n"), F.max("p_partkey").alias("latest"))
    every = Window.partitionBy()
    return p.select(F.lit("type").alias("axis"), "tag", F.round(F.ln(F.sum("n").over(every) / (F.col("n") + 1)), 6).alias("idf"), F.max("latest").over(every).alias("fresh"))
