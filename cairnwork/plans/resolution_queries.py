"""Entity resolution, fusion, near-duplicate and vector queries on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from cairnwork.functions import text as X
from cairnwork.functions import values as V
from cairnwork.operators import relational as R
from cairnwork.operators import resolution as E
from cairnwork.operators import setjoin as S
from cairnwork.operators.graph import components
from cairnwork.operators.namescore import name_scores
from cairnwork.plans.registry import query
from cairnwork.plans.storage import cut

# DuckDB's view of the tokens that functions.text.tokens gives
TOK = "list_filter(string_split(trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g')), ' '), lambda t: t <> '')"
SETS = f"ts AS (SELECT doc_id, list_distinct({TOK}) AS s FROM documents)"


def _codes(t, *facts, counted=False):
    """Documents as token sets, with a hash of the text and the facts."""
    return S.coded(t("documents"), "doc_id", F.col("text"), F.md5("text").alias("t"), *facts, counted=counted)


# Jaccard pairs over all tokens: no cap on a token's frequency
PAIRS = """tk AS (SELECT doc_id, unnest(s) AS token FROM ts), bo AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM tk x JOIN tk y ON x.token = y.token AND x.doc_id < y.doc_id GROUP BY 1, 2),
w AS (SELECT a, b, n / CAST(len(x.s) + len(y.s) - n AS DOUBLE) AS exact FROM bo JOIN ts x ON x.doc_id = a JOIN ts y ON y.doc_id = b)"""
WHOLE = f"{SETS}, {PAIRS}"


def _kinds_sql(*facts):
    """The same over one document of each text and facts."""
    return f"ks AS (SELECT * FROM documents WHERE doc_id IN (SELECT min(doc_id) FROM documents GROUP BY {', '.join(('md5(text)', *facts))})), {SETS.replace('FROM documents', 'FROM ks')}, {PAIRS}"


def _whole_pairs(t, least, *facts):
    """(sets with their roots, pairs of roots) of documents with Jaccard of at least `least`. One document, the least, stands for those that agree in text and facts."""
    codes = _codes(t, *facts)
    members = cut(S.equal_codes(codes, "t", *facts), "members")
    return members, S.near_codes(codes, members, least)


@query(f"WITH {_kinds_sql()} SELECT a, b, round(exact, 6) AS score FROM w WHERE exact >= 0.5")
def jaccard_pairs(t):
    """Pairs of texts, each by its least document."""
    return R.jaccard_pairs(*_whole_pairs(t, 0.5)).select("a", "b", F.round(F.col("both") / F.col("n"), 6).alias("score"))


@query(f"""WITH RECURSIVE {WHOLE}, e AS MATERIALIZED (SELECT a AS u, b AS v FROM w WHERE exact >= 0.5 UNION SELECT b, a FROM w WHERE exact >= 0.5),
c AS (SELECT DISTINCT u AS node, u AS root FROM e UNION SELECT e.v, c.root FROM c JOIN e ON c.node = e.u)
SELECT node, min(root) AS root FROM c GROUP BY 1""")
def near_dup_clusters(t):
    """Equal sets hang on their root by an edge each, so their pairs are never made; a task returns a spanning forest of the others."""
    codes = _codes(t)
    members = cut(S.equal_codes(codes), "members")
    near = S.near_codes(codes, members, 0.5, forest=True)
    copies = members.where("id <> root").select(F.col("root").alias("a"), F.col("id").alias("b"))
    return components(near.select("a", "b").union(copies), "a", "b")


def _whole_verdict_pairs(t):
    """Pairs from 78 on, below which both passes reject, with both documents' facts."""
    d = t("documents").select("doc_id", "source", "lang", "n_chars")
    p = R.jaccard_pairs(*_whole_pairs(t, 0.78, "source", "lang", "n_chars"))
    p = p.select("a", "b", "both", (100 * F.round(F.col("both") / F.col("n"), 6)).alias("score"))
    return p.join(d.toDF("a", "source_a", "lang_a", "n_chars_a"), "a").join(d.toDF("b", "source_b", "lang_b", "n_chars_b"), "b")


@query(f"""WITH {_kinds_sql("source", "lang", "n_chars")}, p AS (SELECT a, b, round(exact, 6) AS score, x.source = y.source AS same_source, x.lang = y.lang AS same_lang, abs(x.n_chars - y.n_chars) AS gap FROM w JOIN documents x ON x.doc_id = a JOIN documents y ON y.doc_id = b WHERE exact >= 0.78)
SELECT a, b, CASE WHEN same_lang AND ((gap = 0 AND score >= 0.9) OR score >= 0.95) THEN 'auto' WHEN score >= 0.78 AND (same_lang OR same_source) THEN 'tiebreak' ELSE 'reject' END AS verdict FROM p""")
def match_verdicts_pass1(t):
    same = F.col("lang_a") == F.col("lang_b")
    v = E.record_verdict(F.col("score"), F.col("score"), same, F.col("n_chars_a") == F.col("n_chars_b"), F.col("source_a") == F.col("source_b"), F.lit(True))
    return _whole_verdict_pairs(t).select("a", "b", v.alias("verdict"))


@query(f"""WITH {_kinds_sql("source", "lang", "n_chars")}, p AS (SELECT a, b, round(exact, 6) AS score, n, x.source = y.source AS same_source, abs(x.n_chars - y.n_chars) AS gap FROM w JOIN bo USING (a, b) JOIN documents x ON x.doc_id = a JOIN documents y ON y.doc_id = b WHERE exact >= 0.78)
SELECT a, b, CASE WHEN same_source AND gap <= 1 AND n >= 2 AND score >= 0.9 THEN 'auto' ELSE 'reject' END AS verdict FROM p""")
def match_verdicts_pass2(t):
    v = E.rescue_verdict(F.col("score"), F.col("both"), F.abs(F.col("n_chars_a") - F.col("n_chars_b")), F.col("source_a") == F.col("source_b"))
    return _whole_verdict_pairs(t).select("a", "b", v.alias("verdict"))


@query("""WITH s AS (SELECT l_suppkey AS k, list_distinct(list(l_partkey)) AS parts FROM lineitem GROUP BY 1), p AS (SELECT a.k AS a, b.k AS b, len(a.parts) AS na, len(b.parts) AS nb, len(list_intersect(a.parts, b.parts)) AS shared, (a.k * 7 + b.k) % 100 AS score, abs(a.k - b.k) % 4 AS gap
FROM s a JOIN s b ON a.k < b.k AND a.k % 10 = b.k % 10)
SELECT a, b, CASE WHEN shared = 0 AND na >= 3 AND nb >= 3 THEN 'BLOCK' WHEN shared = 0 AND na >= 2 AND nb >= 2 AND score < 90 AND gap > 1 THEN 'BLOCK' WHEN shared = 0 AND na >= 2 AND nb >= 2 THEN 'TIEBREAKER_PASS' ELSE 'PASS' END AS gate FROM p""")
def match_gate(t):
    return _gates(t("lineitem"))


def _gates(items):
    s = items.groupBy(F.col("l_suppkey").alias("k")).agg(F.collect_set("l_partkey").alias("parts")).withColumn("m", F.col("k") % 10)
    p = R.block_pairs(s, "k", ["m"])
    a, b = F.col("a.parts"), F.col("b.parts")
    gate = E.image_gate(F.size(a), F.size(b), X.overlap(a, b), (F.col("a.k") * 7 + F.col("b.k")) % 100, F.abs(F.col("a.k") - F.col("b.k")) % 4)
    return p.select(F.col("a.k").alias("a"), F.col("b.k").alias("b"), gate.alias("gate"))


@query("""WITH o AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, CAST(year(o_orderdate) AS INTEGER) AS y FROM orders), p AS (SELECT a.o_orderkey AS a, b.o_orderkey AS b, a.o_orderstatus = b.o_orderstatus AS firm, a.o_orderpriority = b.o_orderpriority AS city, abs(a.y - b.y) AS gap, (a.o_orderkey + b.o_orderkey) % 101 AS score FROM o a JOIN o b ON a.o_custkey = b.o_custkey AND a.o_orderkey < b.o_orderkey)
SELECT a, b, CASE WHEN gap >= 5 THEN 'DIFFERENT' WHEN (firm AND gap = 0 AND city AND score >= 80) OR (firm AND gap = 0 AND city AND score >= 70) OR (firm AND score >= 95) OR (firm AND city AND gap <= 1 AND score >= 75) THEN 'SAME' WHEN (firm AND NOT city AND score < 80) OR (NOT firm AND NOT city AND score < 85) THEN 'DIFFERENT' ELSE 'UNDECIDED' END AS verdict,
round(0.4 * score / 100 + 0.25 * CAST(firm AS INTEGER) + 0.1 + 0.1 * CAST(city AS INTEGER) + 0.15 * CAST(gap = 0 AS INTEGER), 6) AS dup_score FROM p""")
def tiebreak_and_duplicate_score(t):
    o = t("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", F.year("o_orderdate").alias("y"))
    p = R.block_pairs(o, "o_orderkey", ["o_custkey"])
    firm, city = (F.col(f"a.{c}") == F.col(f"b.{c}") for c in ("o_orderstatus", "o_orderpriority"))
    gap, score, yes = F.abs(F.col("a.y") - F.col("b.y")), (F.col("a.o_orderkey") + F.col("b.o_orderkey")) % 101, F.lit(True)
    return p.select(F.col("a.o_orderkey").alias("a"), F.col("b.o_orderkey").alias("b"), E.tiebreak(firm, yes, city, city, gap, score).alias("verdict"), F.round(E.duplicate_score(score / 100, firm, yes, city, gap == 0), 6).alias("dup_score"))


@query()
def component_safety(t):
    """Edges and bad pairs of all orders."""
    o = t("orders").select(F.col("o_orderkey").alias("u"), "o_custkey")
    e = o.select("u", (F.col("u") + F.col("o_custkey") % 3 + 1).alias("v"))
    return E.safe_components(e, "u", "v", o.select("u", (F.col("u") + 1).alias("v")))


@query("""WITH e AS (SELECT DISTINCT l_suppkey % 40 AS a, 40 + l_partkey % 40 AS b FROM lineitem WHERE l_quantity = 50), b AS (SELECT a AS u, b AS v FROM e UNION SELECT b, a FROM e), h AS (SELECT u AS hub, count(*) AS degree FROM b GROUP BY 1 HAVING count(*) > 2),
n AS (SELECT hub, v AS x FROM h JOIN b ON u = hub), l AS (SELECT n.hub, count(*) AS linked FROM n JOIN n m ON n.hub = m.hub AND n.x < m.x JOIN b ON b.u = n.x AND b.v = m.x GROUP BY 1)
SELECT hub, degree, coalesce(linked, 0) AS linked, coalesce(linked, 0) = degree * (degree - 1) / 2 AS clique FROM h LEFT JOIN l USING (hub)""")
def fanout_guard(t):
    e = t("lineitem").where("l_quantity = 50").select((F.col("l_suppkey") % 40).alias("a"), (40 + F.col("l_partkey") % 40).alias("b"))
    return E.fan_out(e, "a", "b", 2)


@query("""WITH l AS (SELECT DISTINCT o_custkey % 300 AS old, o_orderkey % 310 AS new FROM orders WHERE o_totalprice > 400000), a AS (SELECT old, count(*) AS na FROM l GROUP BY 1), b AS (SELECT new, count(*) AS nb FROM l GROUP BY 1)
SELECT old, new, CASE WHEN na = 1 AND nb = 1 THEN '1:1' WHEN nb = 1 THEN '1:n' WHEN na = 1 THEN 'n:1' ELSE 'n:m' END AS kind FROM l JOIN a USING (old) JOIN b USING (new)""")
def crosswalk_cardinality(t):
    links = t("orders").where("o_totalprice > 400000").select((F.col("o_custkey") % 300).alias("old"), (F.col("o_orderkey") % 310).alias("new"))
    return E.crosswalk(links, "old", "new")


@query("""WITH k AS (SELECT c_name AS key, c_custkey + 1 AS id FROM customer WHERE c_custkey % 3 = 0), n AS (SELECT c_name AS key FROM customer WHERE c_custkey % 2 = 0), f AS (SELECT key FROM n WHERE key NOT IN (SELECT key FROM k))
SELECT key, id, false AS created FROM k WHERE key IN (SELECT key FROM n) UNION ALL SELECT key, (SELECT max(id) FROM k) + row_number() OVER (ORDER BY key), true FROM f""")
def registry_match_or_create(t):
    c = t("customer")
    known = c.where("c_custkey % 3 = 0").select(F.col("c_name").alias("key"), (F.col("c_custkey") + 1).alias("id"))
    return E.match_or_create(known, c.where("c_custkey % 2 = 0").select(F.col("c_name").alias("key")), "key", "id")


@query("""WITH RECURSIVE l AS (SELECT p_partkey AS src, CAST(floor(p_partkey / 3) AS BIGINT) AS dst FROM part WHERE p_partkey > 20), c AS (SELECT src, dst FROM l UNION ALL SELECT c.src, l.dst FROM c JOIN l ON c.dst = l.src)
SELECT src, min(dst) AS dst FROM c GROUP BY 1""")
def redirect_closure(t):
    links = t("part").where("p_partkey > 20").select(F.col("p_partkey").alias("src"), F.floor(F.col("p_partkey") / 3).alias("dst"))
    return E.follow_redirects(links, "src", "dst")


@query("""WITH m AS (SELECT p_partkey % 100 AS cluster, p_partkey AS key, CASE WHEN p_size > 20 THEN p_type END AS kind, p_brand FROM part)
SELECT cluster, min(key) AS key, count(*) AS members, min_by(kind, CASE WHEN kind IS NOT NULL THEN key END) AS kind, string_agg(DISTINCT p_brand, ',' ORDER BY p_brand) AS brands FROM m GROUP BY 1""")
def merge_absorb(t):
    m = t("part").select((F.col("p_partkey") % 100).alias("cluster"), F.col("p_partkey").alias("key"), F.when(F.col("p_size") > 20, F.col("p_type")).alias("kind"), F.array("p_brand").alias("brands"))
    return E.absorb(m, "cluster", "key", ["kind"], ["brands"]).withColumn("brands", F.array_join("brands", ","))


@query("""WITH s AS (SELECT l_partkey, l_linenumber AS rank, CASE WHEN l_discount > 0.04 THEN l_returnflag END AS flag, CASE WHEN l_tax > 0.04 THEN l_linestatus END AS stat FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey, l_linenumber ORDER BY l_orderkey) AS k FROM lineitem) WHERE k = 1)
SELECT l_partkey, min_by(flag, CASE WHEN flag IS NOT NULL THEN rank END) AS flag, min(CASE WHEN flag IS NOT NULL THEN rank END) AS flag_from, min_by(stat, CASE WHEN stat IS NOT NULL THEN rank END) AS stat, min(CASE WHEN stat IS NOT NULL THEN rank END) AS stat_from FROM s GROUP BY 1""")
def priority_field_pick(t):
    s = R.first_of(t("lineitem"), ["l_partkey", "l_linenumber"], F.col("l_orderkey"))
    s = s.select("l_partkey", F.col("l_linenumber").alias("rank"), F.when(F.col("l_discount") > 0.04, F.col("l_returnflag")).alias("flag"), F.when(F.col("l_tax") > 0.04, F.col("l_linestatus")).alias("stat"))
    return E.pick_by_priority(s, "l_partkey", "rank", ["flag", "stat"])


@query("""WITH b AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 3 > 0 THEN o_orderstatus END AS old, CASE WHEN o_orderkey % 5 > 0 THEN CASE WHEN o_orderkey % 7 = 0 THEN 'X' ELSE o_orderstatus END END AS new FROM orders)
SELECT k, coalesce(new, old) AS value, CASE WHEN old IS NULL AND new IS NULL THEN 'missing' WHEN new IS NULL THEN 'kept' WHEN old IS NULL THEN 'filled' WHEN old = new THEN 'same' ELSE 'replaced' END AS status,
CASE WHEN old IS NULL AND new IS NULL THEN 'missing' WHEN old IS NULL OR new IS NULL THEN 'single' WHEN old = new THEN 'confirmed' ELSE 'conflict' END AS two FROM b""")
def field_reconcile(t):
    k = F.col("o_orderkey")
    b = t("orders").select(k.alias("k"), F.when(k % 3 > 0, F.col("o_orderstatus")).alias("old"), F.when(k % 5 > 0, F.when(k % 7 == 0, "X").otherwise(F.col("o_orderstatus"))).alias("new"))
    return b.select("k", E.reconcile(F.col("old"), F.col("new")).alias("r"), E.two_source(F.col("old"), F.col("new")).alias("two")).select("k", "r.value", "r.status", "two")


@query("""WITH f AS (SELECT user_id AS k, CASE WHEN value > 60 THEN 1 WHEN value < 5 THEN -1 ELSE 0 END AS a, CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS b, event_id, CAST(event_id % 13 AS INTEGER) AS gap FROM events)
SELECT event_id, CASE WHEN pos >= 2 AND neg = 0 THEN 'merge' WHEN neg > 0 AND pos < 2 THEN 'reject' WHEN pos = 1 AND neg = 0 THEN 'related' ELSE 'defer' END AS proposal
FROM (SELECT event_id, CAST(a = 1 AS INTEGER) + b + CAST(gap <= 1 AS INTEGER) AS pos, CAST(a = -1 AS INTEGER) + CAST(gap > 10 AS INTEGER) AS neg FROM f)""")
def evidence_proposal(t):
    zero = F.lit(0)
    fam = {"name": F.when(F.col("value") > 60, 1).when(F.col("value") < 5, -1).otherwise(0), "firm": F.when(F.col("event_type") == "click", 1).otherwise(0), "place": zero, "year": E.year_family(F.col("event_id") % 13), "image": zero, "external": zero}
    return t("events").select("event_id", E.proposal(fam).alias("proposal"))


# --- hashes and vectors ------------------------------------------------------------------------

LIMBS = """h AS (SELECT vec_id, label, list_transform(embedding, lambda x: CASE WHEN x > 0 THEN '1' ELSE '0' END) AS b FROM embeddings)"""


def _bits(t):
    return t("embeddings").select("vec_id", "label", F.array_join(F.transform("embedding", lambda x: F.when(x > 0, "1").otherwise("0")), "").alias("bits"))


def _hashes(t, *columns):
    """The columns and h: all 64 sign bits as a signed integer."""
    return _bits(t).select(*columns, "vec_id", "label", F.conv("bits", 2, -10).cast("long").alias("h"))


@query(f"""WITH {LIMBS}, p AS (SELECT x.vec_id AS a, y.vec_id AS b, CAST(len(list_filter(list_zip(x.b, y.b), lambda z: z[1] <> z[2])) AS INTEGER) AS d FROM h x JOIN h y ON x.vec_id < y.vec_id)
SELECT a, b, d FROM p WHERE d <= 18""")
def hamming_pairs(t):
    """Sign hashes up to 18 of 64 bits apart. At such a radius a band has three or four bits and most pairs meet in one; hash_node_pairs has the
    selective form, 8 of 256 bits."""
    return R.banded_pairs(_hashes(t), "vec_id", ["h"], 19, 18)


@query(f"""WITH {LIMBS}, g AS (SELECT list_aggregate(b, 'string_agg', '') AS bits, count(*) AS n, min(vec_id) AS node FROM h GROUP BY 1) SELECT node, n FROM g""")
def exact_clusters(t):
    return _bits(t).groupBy("bits").agg(F.min("vec_id").alias("node"), F.count("*").alias("n")).select("node", "n")


@query("""WITH g AS (SELECT md5(text) AS h, count(*) AS n, count(DISTINCT source) AS sources, count(DISTINCT lang) AS langs, min(doc_id) AS node FROM documents GROUP BY 1 HAVING count(*) > 1)
SELECT node, n, sources, CASE WHEN n > 20 THEN 'mass' WHEN langs = 1 AND sources > 1 THEN 'split' ELSE 'review' END AS class FROM g""")
def cross_source_dup_audit(t):
    g = t("documents").groupBy(F.md5("text").alias("h")).agg(F.min("doc_id").alias("node"), F.count("*").alias("n"), F.count_distinct("source").alias("sources"), F.count_distinct("lang").alias("langs")).where("n > 1")
    return g.select("node", "n", "sources", F.when(F.col("n") > 20, "mass").when((F.col("langs") == 1) & (F.col("sources") > 1), "split").otherwise("review").alias("class"))


@query("""WITH r AS (SELECT source, doc_id, n_chars, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS p0, bool_or(n_chars >= 300) OVER (PARTITION BY source) AS any_ok FROM documents),
q AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n_chars, doc_id) AS k FROM r WHERE n_chars >= 300 OR NOT any_ok)
SELECT source, doc_id, CAST(k AS INTEGER) AS place FROM q WHERE k <= 3""")
def shortlist_p1(t):
    ok = F.col("n_chars") >= 300
    d = t("documents").join(t("documents").groupBy("source").agg(F.bool_or(ok).alias("any_ok")), "source")
    return R.top_n(d.where(ok | ~F.col("any_ok")), ["source"], 3, F.col("n_chars"), F.col("doc_id"), rank="place").select("source", "doc_id", "place")


@query()
def shortlist_p2(t):
    return E.greedy_shortlist(_hashes(t), "label", "vec_id", "vec_id", "h", 24, 3)


@query()
def source_disjoint_clusters(t):
    return E.source_disjoint_clusters(_hashes(t, (F.col("vec_id") % 25).alias("grp")), "grp", "vec_id", "label", "h", 12)


@query("""WITH v AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings), u AS (SELECT e FROM v WHERE vec_id = 3),
s AS (SELECT v.vec_id, label, round(list_inner_product(v.e, u.e) / greatest(sqrt(list_inner_product(v.e, v.e)) * sqrt(list_inner_product(u.e, u.e)), 1e-12) + CASE WHEN label = 1 THEN 0.05 ELSE 0 END, 6) AS score FROM v, u WHERE v.vec_id NOT IN (3, 5, 7))
SELECT vec_id, label, score FROM s ORDER BY score DESC, vec_id LIMIT 20""")
def recommend_user(t):
    e = t("embeddings")
    u = F.broadcast(e.where("vec_id = 3").select(F.col("embedding").alias("u")))  # one row
    score = V.cosine(F.col("embedding"), F.col("u")) + F.when(F.col("label") == 1, 0.05).otherwise(0.0)
    return e.where(~F.col("vec_id").isin(3, 5, 7)).join(u).select("vec_id", "label", F.round(score, 6).alias("score")).orderBy(F.desc("score"), "vec_id").limit(20)


@query("""SELECT s_suppkey, n, total FROM (SELECT l_suppkey AS s_suppkey, count(DISTINCT l_partkey) AS n, round(sum(l_extendedprice), 2) AS total FROM lineitem GROUP BY 1) WHERE n > 1 ORDER BY n DESC, total DESC, s_suppkey LIMIT 20""")
def recommend_cold(t):
    g = t("lineitem").groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(F.count_distinct("l_partkey").alias("n"), F.round(F.sum("l_extendedprice"), 2).alias("total"))
    return g.where("n > 1").orderBy(F.desc("n"), F.desc("total"), "s_suppkey").limit(20)


@query()
def recommend_mmr(t):
    """Greedy rerank of the top 30 by score less the likeness to what is taken; 30 rows meet on the driver, by definition."""
    e = t("embeddings")
    u = F.broadcast(e.where("vec_id = 3").select(F.col("embedding").alias("u")))
    top = e.where("vec_id <> 3").join(u).select("vec_id", "embedding", V.cosine(F.col("embedding"), F.col("u")).alias("score")).orderBy(F.desc("score"), "vec_id").limit(30)
    rows = [(r["vec_id"], r["embedding"], r["score"]) for r in top.collect()]
    like = lambda a, b: sum(x * y for x, y in zip(a, b)) / ((sum(x * x for x in a) * sum(y * y for y in b)) ** 0.5 or 1)
    taken: list = []
    while rows and len(taken) < 10:
        best = max(rows, key=lambda r: (0.7 * r[2] - 0.3 * max((like(r[1], k[1]) for k in taken), default=0.0), -r[0]))
        rows.remove(best)
        taken.append(best)
    return e.sparkSession.createDataFrame([(i + 1, r[0], round(r[2], 6)) for i, r in enumerate(taken)], "place int, vec_id long, score double")


@query()
def name_similarity_scores(t):
    """Strict and loose score of the whole texts of every pair with a Jaccard of 0.3 or more."""
    return name_scores(t("documents"), "doc_id", F.col("text"), cut(R.jaccard_pairs(*_whole_pairs(t, 0.3)), "pairs"))
