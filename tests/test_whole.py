"""Queries that do the whole job, against brute force on small tables with what a cut would lose."""

import hashlib
import random
from collections import Counter
from datetime import date
from itertools import combinations

from cairnwork.functions import text as X
from cairnwork.plans.catalogue import QUERIES
from cairnwork.plans.review_queries import _picked

WORDS = [f"w{i}" for i in range(40)]


def crowd():
    """20 exact copies, 15 near copies of another text, a pair of ordinary words only, empty and null texts."""
    out = [(i, " ".join(WORDS[:10])) for i in range(20)]
    out += [(20 + i, " ".join([*WORDS[10:18], f"own{i % 5}"])) for i in range(15)]
    return [*out, (40, "w0 w1 w2 w10"), (41, "w0 w1 w2 w11"), (42, ""), (43, None), (44, "...")]


def jaccards(rows, least):
    sets = {i: frozenset((t or "").replace(".", "").split()) for i, t in rows}
    pairs = ((a, b, len(sets[a] & sets[b]), len(sets[a] | sets[b])) for a, b in combinations(sorted(sets), 2))
    return {(a, b, round(n / m, 6)) for a, b, n, m in pairs if m and n >= least * m}


def test_groups_larger_than_any_cap(spark, tmp_path):
    spark.createDataFrame(crowd(), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    first = {}
    for i, text in crowd():
        first.setdefault(text, i)
    want = {(a, b, s) for a, b, s in jaccards(crowd(), 0.5) if {a, b} <= set(first.values())}  # a text stands for its copies
    got = [(r.a, r.b, r.score) for r in QUERIES["jaccard_pairs"](spark, str(tmp_path)).collect()]
    assert len(got) == len(want) and set(got) == want
    assert {(20, 24, 0.8), (40, 41, 0.6)} <= want
    roots = {r.node: r.root for r in QUERIES["near_dup_clusters"](spark, str(tmp_path)).collect()}
    assert roots == {**dict.fromkeys(range(20), 0), **dict.fromkeys(range(20, 35), 20), 40: 40, 41: 40}


def test_name_scores_of_whole_texts(spark, tmp_path):
    head = " ".join(WORDS[:30])  # over 80 characters
    texts = {1: head + " x y z", 2: head + " p q", 3: f"z y x {head}", 4: "w1 w2 w3", 5: None}
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {(r.a, r.b): (r.strict, r.loose) for r in QUERIES["name_similarity_scores"](spark, str(tmp_path)).collect()}
    assert set(got) == {(a, b) for a, b, _ in jaccards(list(texts.items()), 0.3)} == {(1, 2), (1, 3), (2, 3)}
    for (a, b), (strict, loose) in got.items():
        both = X.sort_ratio(texts[a], texts[b]), X.set_ratio(texts[a], texts[b])
        assert (strict, loose) == (min(both), max(both))
    assert got[1, 2][0] < got[1, 3][0] == 100


def test_rows_outside_the_fixed_subsets(spark, tmp_path):
    sf = str(tmp_path)
    spark.createDataFrame([(61, 1), (61, 2), (61, 3), (71, 4), (71, 5), (71, 6), (5, 1), (65, 1)], "l_suppkey long, l_partkey long").write.parquet(f"{sf}/lineitem.parquet")
    custs = [(k, k % 3) for k in range(400)]
    spark.createDataFrame(custs, "c_custkey long, c_nationkey int").write.parquet(f"{sf}/customer.parquet")
    orders = [(k, c, date(1990 + k % 4, 5, 1)) for k, c in [(1, 301), (2, 301), (3, 301), (10, 3), (20, 1), (21, 6)]]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderdate date").write.parquet(f"{sf}/orders.parquet")
    spark.createDataFrame([(1, "a"), (5, "b"), (150, "c"), (151, "c")], "doc_id long, text string").write.parquet(f"{sf}/documents.parquet")
    got = {n: sorted(map(tuple, QUERIES[n](spark, sf).collect()), key=str) for n in ("match_gate", "year_bucket_join", "component_safety", "regression_gate", "pair_through_mapping")}
    assert got["match_gate"] == [(5, 65, "PASS"), (61, 71, "BLOCK")]
    assert got["year_bucket_join"] == sorted(((k, m) for k, c, y in orders for m, d, z in orders if k != m and c == d and abs(y.year - z.year) <= 1), key=str)
    links = [(k, k + c % 3 + 1) for k, c, _ in orders]
    root = {n: n for e in links for n in e}
    for _ in root:
        for u, v in links:
            root[u] = root[v] = min(root[u], root[v])
    bad = {root[k] for k, *_ in orders if root.get(k + 1) == root[k]}
    size = {r: sum(x == r for x in root.values()) for r in root.values()}
    assert got["component_safety"] == sorted(((n, r, size[r], size[r] <= 4 and r not in bad) for n, r in root.items()), key=str)
    assert got["regression_gate"] == sorted([(1, 1, True), (5, None, False), (150, 150, True)], key=str)
    nation, ends = dict(custs), [(c, (3 * c + 1) % 400) for _, c, _ in orders]
    assert got["pair_through_mapping"] == sorted({tuple(sorted((nation[x], nation[y]))) for x, y in ends if nation[x] != nation[y]}, key=str)


def test_all_64_sign_bits_count(spark, tmp_path):
    r = random.Random(3)
    base = [[r.choice((-1.0, 1.0)) for _ in range(64)] for _ in range(3)]
    flipped = lambda v, at: [-x if i in at else x for i, x in enumerate(v)]
    # changes in the first bit, in the second half only, and of random places
    vecs = [flipped(base[i % 3], {0, 63} if i % 4 == 0 else set(range(40, 54)) if i % 4 == 1 else set(r.sample(range(64), r.randint(0, 30)))) for i in range(150)]
    rows = [(25 * i + i % 2, i % 5, v) for i, v in enumerate(vecs)]
    spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    far = lambda a, b: sum((x > 0) != (y > 0) for x, y in zip(a, b))
    label_of, cluster = {k: x for k, x, _ in rows}, {k: {k} for k, *_ in rows}
    for (k, x, v), (m, y, w) in combinations(sorted(rows), 2):
        if k % 25 == m % 25 and x != y and far(v, w) <= 12 and cluster[k] is not cluster[m] and {label_of[i] for i in cluster[k]}.isdisjoint(label_of[i] for i in cluster[m]):
            cluster[k] |= cluster[m]
            for i in cluster[m]:
                cluster[i] = cluster[k]
    want = [(k % 25, k, min(cluster[k])) for k, *_ in rows]
    assert sum(k != c for _, k, c in want) > 20
    assert sorted(map(tuple, QUERIES["source_disjoint_clusters"](spark, str(tmp_path)).collect())) == sorted(want)
    taken, short = {}, []
    for k, label, v in sorted(rows):
        own = taken.setdefault(label, [])
        if len(own) < 3 and all(far(v, x) > 24 for x in own):
            own.append(v)
            short.append((label, k, len(own)))
    assert sorted(map(tuple, QUERIES["shortlist_p2"](spark, str(tmp_path)).collect())) == sorted(short)


def test_second_pass_confirms_by_term_counts(spark, tmp_path):
    often = " ".join(["common words"] * 40)
    texts = {1: f"{often} a b", 2: f"{often} a d", 3: "x y z u", 4: "x y z v", 5: "x y q r", 6: "a b c " * 9 + "d d d d d"}
    rows = [(i, t, "en", f"s{i}") for i, t in texts.items()] + [(7, "x y z u", "de", "s7"), (8, "x y z u", "fr", "s3"), (9, None, "en", "s9")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {(r.a, r.b): (r.cosine, r.verdict) for r in QUERIES["two_pass_dedup"](spark, str(tmp_path)).collect()}
    facts = {i: (t, lang, source) for i, t, lang, source in rows}
    cand = {(a, b) for a, b, s in jaccards([r[:2] for r in rows], 0.3) if s > 0.3 and (facts[a][1] == facts[b][1] or facts[a][2] == facts[b][2])}
    counts = {i: Counter((t or "").split()) for i, (t, *_) in facts.items()}
    size = {i: sum(n * n for n in c.values()) for i, c in counts.items()}
    want = {(a, b): round(sum(n * counts[b][k] for k, n in counts[a].items()) / (size[a] * size[b]) ** 0.5, 6) for a, b in cand}
    assert {k: c for k, (c, _) in got.items()} == want
    assert all(v == ("confirmed" if c >= 0.92 else "review" if c >= 0.85 else "reject") for c, v in got.values())
    assert got[1, 2][1] == "confirmed"  # a Jaccard of 0.6
    assert got[3, 8] == (1.0, "confirmed") and got[3, 4] == (0.75, "reject") and (3, 7) not in got


def test_pick_goes_on_past_a_hub(spark):
    pairs = [(0, i) for i in range(1, 60)] + [(100 + 2 * i, 101 + 2 * i) for i in range(6)]
    order = sorted(pairs, key=lambda p: hashlib.sha256(f"{p[0]}|{p[1]}".encode()).hexdigest())
    want, used = [], set()
    for a, b in order:
        if not {a, b} & used:
            used |= {a, b}
            want.append((len(want) + 1, a, b))
    d = spark.createDataFrame(pairs, "a long, b long")
    for most in (3, 10):
        assert list(map(tuple, _picked(d, most, batch=2).orderBy("place").collect())) == want[:most]


def test_fuzzy_names_of_one_firm(spark):
    from difflib import SequenceMatcher

    from pyspark.sql import functions as F

    from cairnwork.operators import resolution as E

    r = random.Random(5)
    rows = [(i, f"{r.choice(['villa nordica', 'haus am see', 'torre alta norte'])} {r.randint(1, 12)}{'' if i % 3 else ' b'}", r.choice(["fr", "de", None]), r.choice(["x", None]), r.choice([1990, 1991, 1999, None]), r.sample(["f", "g", "h"], r.randint(0, 2))) for i in range(70)]
    d = spark.createDataFrame(rows, "id long, name string, country string, city string, year int, firms array<string>")
    got = {(x.a, x.b): (x.likeness, x.score) for x in E.fuzzy_block_pairs(d, "id", "name", "country", "city", "year", "firms", F.lit(False)).collect()}
    want = {}
    for (a, x, c, t, y, f), (b, z, e, u, w, g) in combinations(rows, 2):
        like = SequenceMatcher(None, x, z).ratio()
        if c and c == e and set(f) & set(g) and x != z and (t is None or u is None or t == u) and (y is None or w is None or abs(y - w) <= 2) and like >= 0.9:
            want[a, b] = (round(like, 4), round(0.55 + 0.35 * like + (0.05 if t and t == u else 0), 4))
    assert want and got.keys() == want.keys()
    assert all(abs(got[k][0] - want[k][0]) < 1e-9 and abs(got[k][1] - want[k][1]) < 2e-4 for k in want)


def test_greedy_rerank(spark, tmp_path):
    r = random.Random(9)
    rows = [(i, i % 4, [r.gauss(0, 1) for _ in range(6)]) for i in range(60)]
    spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").write.parquet(f"{tmp_path}/embeddings.parquet")
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    cos = lambda a, b: dot(a, b) / (dot(a, a) * dot(b, b)) ** 0.5
    vec, user = {i: v for i, _, v in rows}, rows[3][2]
    left = sorted((i for i in vec if i != 3), key=lambda i: (-cos(vec[i], user), i))[:30]
    taken = []
    while len(taken) < 10:
        best = max(left, key=lambda i: 0.7 * cos(vec[i], user) - 0.3 * max((cos(vec[i], vec[k]) for k in taken), default=0))
        left.remove(best)
        taken.append(best)
    assert [x.vec_id for x in QUERIES["recommend_mmr"](spark, str(tmp_path)).orderBy("place").collect()] == taken


def test_numbers_over_ranges(spark):
    from cairnwork.operators import relational as R

    r = random.Random(2)
    keys = r.sample(range(10**6), 500)
    d = spark.createDataFrame([(k,) for k in keys], "k long")
    assert {x.k: x.n for x in R.numbered(d, "k", "n").collect()} == {k: i + 1 for i, k in enumerate(sorted(keys))}
    assert R.numbered(d.limit(0), "k", "n").count() == 0


def test_rules_and_values(spark):
    from pyspark.sql import functions as F

    from cairnwork.functions import stats
    from cairnwork.functions import values as V
    from cairnwork.operators import resolution as E

    facts = [(True, True, False, False, 0, 79, "DIFFERENT"), (True, True, False, False, 0, 80, "UNDECIDED"), (False, True, False, True, 1, 84, "DIFFERENT"), (False, True, False, True, 1, 85, "UNDECIDED"), (None, True, False, None, None, 10, "DIFFERENT"),
             (True, True, True, False, 0, 80, "SAME"), (True, False, True, True, 0, 99, "DIFFERENT"), (True, None, None, None, None, 95, "SAME"), (True, True, None, True, 0, 70, "SAME"), (False, True, True, True, 5, 99, "DIFFERENT"), (True, True, True, None, 1, 75, "SAME"), (False, True, None, None, 1, 10, "UNDECIDED")]
    d = spark.createDataFrame(facts, "firm boolean, country boolean, city boolean, kind boolean, gap int, score int, want string")
    assert all(x.got == x.want for x in d.select(E.tiebreak(*map(F.col, ("firm", "country", "city", "kind", "gap", "score"))).alias("got"), "want").collect())
    years = spark.createDataFrame([(1899, "Pre-1900"), (1900, "1900-1945"), (1944, "1900-1945"), (1945, "1945-1980"), (1980, "1980-2000"), (2000, "2000-2015"), (2015, "2015+"), (9999, None), (None, None)], "y int, want string")
    assert all(x.got == x.want for x in years.select(V.era(F.col("y")).alias("got"), "want").collect())
    assert abs(stats.beta_accuracy([(9, 10, 1.0), (0, 0, 5.0)])[0] - 9.5 / 11) < 0.02 and all(map(lambda x: x != x, stats.beta_accuracy([(0, 0, 1.0)])))
