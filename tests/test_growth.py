"""Large groups of like records: the rows are DuckDB's, and no step makes or sends many more rows than the tables or the result have."""

import os
import random
from datetime import datetime

import duckdb
import pytest

from cairnwork.plans.catalogue import QUERIES, SQL


def made(df, metric):
    """Rows of df, and the largest value of a metric among its plan's nodes: numOutputRows of joins, or shuffleRecordsWritten."""
    rows, found = df.collect(), [0]

    def walk(p):
        if p.nodeName() == "AdaptiveSparkPlan":
            return walk(p.executedPlan())
        if "QueryStage" in p.nodeName():
            return walk(p.plan())
        if (x := p.metrics().get(metric)).isDefined() and (metric != "numOutputRows" or "Join" in p.nodeName()):
            found.append(x.get().value())
        for i in range(p.children().size()):
            walk(p.children().apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return rows, max(found)


def by_sql(sf, name):
    c = duckdb.connect()
    for f in os.listdir(sf):
        c.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{sf}/{f}/*.parquet'")
    out = c.execute(SQL[name])
    return [d[0] for d in out.description], out.fetchall()


def same(rows, sf, name):
    names, want = by_sql(sf, name)
    assert sorted((tuple(r[c] for c in names) for r in rows), key=str) == sorted(want, key=str)
    return want


@pytest.fixture(scope="module")
def crowd(spark, tmp_path_factory):
    """600 orders of one place and one name, most with a firm and an image of their own; some share firms or images, lack a year, a place, lines or a name."""
    sf, r = str(tmp_path_factory.mktemp("crowd")), random.Random(1)
    put = lambda name, rows, schema: spark.createDataFrame(rows, schema).write.parquet(f"{sf}/{name}.parquet")
    put("nation", [(0, "A"), (1, "B")], "n_nationkey int, n_name string")
    put("customer", [(k, k % 2, "S") for k in (1, 3, 13, 19)], "c_custkey long, c_nationkey int, c_mktsegment string")
    put("part", [(k, "large ring" if k < 1000 else "old ring" if k < 1010 else None) for k in range(1020)] + [(2000 + k, "cold rod") for k in range(600)], "p_partkey long, p_name string")
    orders = [(k, 1 if k % 50 else r.choice((3, 13, 19)), "F", datetime(1990 + r.choice((0, 0, 0, 1, 3)), 5, 1)) for k in range(600)]
    put("orders", orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp")
    lines = [(k, part, firm, i, "N") for k in range(600) if k % 97 for own in [k if k % 7 else 2000 + k] for i, (part, firm) in enumerate([(own, k), (r.choice((own, r.randrange(5), r.randrange(1000, 1020))), k if r.random() < 0.6 else 5000 + r.randrange(20))])]
    put("lineitem", lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_returnflag string")
    return sf


def test_anchored_merges_make_no_pairs_of_names(spark, crowd):
    rows, most = made(QUERIES["anchor_policy"](spark, crowd), "numOutputRows")
    want = same(rows, crowd, "anchor_policy")
    assert {s for *_, s in want} == {"merge", "anchor_missing", "fanout_review"}
    assert most < 10_000  # a name's records have 89,700 pairs


def test_pairs_of_a_name_are_not_shuffled(spark, crowd):
    rows, most = made(QUERIES["candidate_universe"](spark, crowd), "shuffleRecordsWritten")
    want = same(rows, crowd, "candidate_universe")
    assert len({o for *_, o in want}) > 7
    assert most < 5_000 < len(want)


def test_embedding_pairs_are_met_once(spark, tmp_path):
    r, sf = random.Random(2), str(tmp_path)
    words = [f"w{i}" for i in range(90)]  # more than a mask has bits
    names = ["w1 w2", "w2 w1", "w1 w2 w3", "w1", "", None, "w1 w1 w2", *["w1 w2 w3 w4", "w1 w2 w3 w4 w5"] * 10, " ".join(words), " ".join(words[:80])] + [" ".join(r.sample(words[:12], r.randint(1, 8))) for _ in range(40)]
    part = [(k, r.choice(names), r.choice(("B1", "B1", "B2", None)), r.choice(("x", "y", None)), r.choice((1, 2, 2, 2, 3, 5, 9, None))) for k in range(300)]
    base = [[r.gauss(0, 1) for _ in range(4)] for _ in range(3)]
    spark.createDataFrame(part, "p_partkey long, p_name string, p_brand string, p_type string, p_size int").write.parquet(f"{sf}/part.parquet")
    spark.createDataFrame([(k, [x + r.gauss(0, 0.3) for x in base[k % 3]]) for k in range(0, 300, 2)], "vec_id long, embedding array<float>").write.parquet(f"{sf}/embeddings.parquet")
    rows, most = made(QUERIES["embedding_matcher"](spark, sf), "numOutputRows")
    want = same(rows, sf, "embedding_matcher")
    assert {v for *_, v in want} == {"accept_high", "accept_medium", "needs_review", "reject"}
    assert most <= len(want)
