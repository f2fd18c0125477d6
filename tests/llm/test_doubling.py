import hashlib
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from cairnwork.llm import doubling, packed, queries
from tests.llm.fixtures import docs, rows, saved

SF = "/root/testdata/sf0.001"


def brute(documents, n=35):
    places = defaultdict(list)
    split = [(t or "").encode().split() for _, t in documents]
    for d, w in enumerate(split):
        for s in range(len(w) - n + 1):
            places[tuple(w[s : s + n])].append((d, s))
    gone = [set() for _ in split]
    for p in places.values():
        if len(p) > 1:
            for d, s in p:
                gone[d] |= set(range(s, s + n))
    return sorted((i, len(w), len(g), hashlib.sha256(b" ".join(x for k, x in enumerate(w) if k not in g)).hexdigest()) for (i, _), w, g in zip(documents, split, gone))


def test_op8_against_brute_force(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(packed, "BUCKET_BYTES", 2000)
    out = queries.op8_level_doubling(spark, saved(spark, tmp_path, ["n_words", "block"])).collect()
    assert sorted(map(tuple, out)) == brute([(i, t) for i, t, *_ in rows()])


def test_op8_on_driver_rows(spark):
    d = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert sorted(map(tuple, queries.op8_level_doubling(spark, SF).collect())) == brute(d)


def test_op8_within_one_document_and_empty(spark):
    d = spark.createDataFrame([(1, " ".join(["a"] * 40)), (2, " ".join(map(str, range(50)))), (None, "x")], "doc_id long, text string")
    out = {r.doc_id: (r.n_words, r.n_removed) for r in doubling.remove_repeats(d).collect()}
    assert out == {1: (40, 40), 2: (50, 0), None: (1, 0)}
    assert doubling.remove_repeats(docs(spark).limit(0)).count() == 0


def test_answers_travel_not_blocks(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    table = packed.block_table(docs(spark), "doc_id", "text", 2000)
    got = table.select("block", F.lit(0).alias("bucket"), F.lit(b"x").alias("got"))
    both = packed.joined(table, got)
    assert both.where("size(answers) = 1").count() == table.count() > 5
    plan = both._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert not any("body" in line for line in plan.splitlines() if "Exchange" in line) and "Bucketed: true" in plan
    ids = [r.block for r in table.select("block").collect()]
    want = [r.h for r in spark.createDataFrame([(i,) for i in ids], "b long").select(F.hash("b").alias("h")).collect()]
    assert packed._hash(np.array(ids)).tolist() == want
