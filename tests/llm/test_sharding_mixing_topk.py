import zlib
from collections import defaultdict

import numpy as np
import pytest

from cairnwork.llm import mixing, queries, sharding, topk
from tests.llm.fixtures import docs, rows, saved


@pytest.mark.parametrize("n", [1, 2, 3, 40, 97, 1000, 4096])
def test_permutation_is_a_bijection_with_inverse(n):
    p = sharding.permute(np.arange(n), n, 7)
    assert sorted(p) == list(range(n))
    assert (sharding.permute(p, n, 7, back=True) == np.arange(n)).all()


def test_op5_whole_table(spark, tmp_path):
    out = queries.op5_feistel_shards(spark, saved(spark, tmp_path, ["shard", "slot", "size"])).collect()
    want = sorted((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, *_ in rows())
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in out) == want
    slots = defaultdict(list)
    for r in out:
        slots[r.shard].append(r.slot)
        assert r.law == "rows" and r.grown_shard is None
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1 and set(slots) == set(range(40))
    again = queries.op5_feistel_shards(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, again), key=str) == sorted(map(tuple, out), key=str)


def test_locate_agrees_with_the_table(spark):
    from pyspark.sql import functions as F

    out = sharding.assign_shards(spark.range(100).withColumnRenamed("id", "k"), [F.col("k")], 7, seed=3).collect()
    assert all(sharding.locate(r.k, 100, 7, 3) == (r.shard, r.slot) for r in out)


def test_op5_and_op9_empty(spark, tmp_path):
    docs(spark).limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert queries.op5_feistel_shards(spark, str(tmp_path)).count() == 0
    assert queries.op9_cube_mix(spark, str(tmp_path)).count() == 0


def test_targets_by_hand():
    assert mixing.targets([("a", 100), ("b", 100), ("c", 100)]) == {"a": 50.0, "b": 100.0, "c": 150.0}
    got = mixing.targets([("a", 100), ("b", 10), (None, 90)])
    assert got["b"] == 30.0 and got[None] == pytest.approx(170 * 3 / 4) and sum(got.values()) == pytest.approx(200)


def test_flight_keeps_both_totals():
    r = np.random.default_rng(1)
    size, p = r.integers(1, 900, 500), np.full(500, 0.37)
    out = mixing.flight(p, size, r)
    assert ((out > 0) & (out < 1)).sum() <= 2
    assert out.sum() == pytest.approx(p.sum()) and out @ size == pytest.approx(p @ size)


def test_op9_whole_table(spark, tmp_path):
    out = queries.op9_cube_mix(spark, saved(spark, tmp_path, ["size", "taken"])).collect()
    want = sorted((i, len((t or "").encode().split())) for i, t, *_ in rows())
    assert sorted((r.doc_id, r["size"]) for r in out) == want
    source = {i: s for i, _, _, s, _ in rows()}
    taken, size, goal, most = defaultdict(int), defaultdict(int), {}, defaultdict(int)
    for r in out:
        s = source[r.doc_id]
        taken[s] += r.taken
        size[s] += r["size"]
        most[s] = max(most[s], r["size"])
        goal[s] = r.target
        assert r.taken <= 3 * r["size"] and (r["size"] == 0 or r.taken % r["size"] == 0)
    assert goal == pytest.approx(mixing.targets(list(size.items())))
    assert all(abs(taken[s] - goal[s]) <= most[s] for s in goal)
    again = queries.op9_cube_mix(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, out))


def test_mix_in_many_blocks(spark):
    from pyspark.sql import functions as F

    d = spark.range(3000).select(F.col("id").alias("doc_id"), F.expr("repeat('w ', cast(1 + id % 50 as int))").alias("text"), F.when(F.col("id") % 3 > 0, "hot").otherwise(F.lit("cold")).alias("source"))
    out = mixing.mix(d, block_rows=20).groupBy("source").agg(F.sum(F.col("__size") * F.col("__times")).alias("t"), F.first("__target").alias("g"), F.count("*").alias("n")).collect()
    assert sum(r.n for r in out) == 3000 and all(abs(r.t - r.g) <= 50 for r in out)


def brute(vectors, k):
    ok = [(i, tuple(np.floor(64 * np.array(v, float)))) for i, v in vectors if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for n, (q, x) in enumerate(ok):
        if q % 20 == 0:
            best = sorted((-int(np.dot(x, y)), c) for m, (c, y) in enumerate(ok) if m != n and len(x) == len(y))[:k]
            out += [(q, r + 1, c, -s) for r, (s, c) in enumerate(best)]
    return sorted(out)


def small_shards(monkeypatch):
    for name, value in {"SHARD_ROWS": 64, "QUERY_ROWS": 4, "LEAF_ROWS": 8, "PAGE_BOXES": 2}.items():
        monkeypatch.setattr(topk, name, value)


def test_topk_against_brute_force(spark, tmp_path, monkeypatch):
    small_shards(monkeypatch)
    r = np.random.default_rng(5)
    vectors = [(i, [float(np.float32(x)) for x in r.normal(0, 0.1 if i % 7 else 2, 8).round(1)]) for i in range(300)]  # rounded: ties
    vectors += [(320, None), (340, [None] * 8), (360, [float("nan")] * 8), (380, [float("inf")] + [0.0] * 7), (400, [0.0] * 8), (None, [1.0] * 8), (420, [])]
    vectors += [(20, vectors[20][1]), (20, [1.0] * 8), (21, vectors[21][1]), (500, [0.5, 1.0]), (501, [1.0, 1.0])]  # repeated ids and rows, another length
    vectors += [(1000 + i, [0.3] * 8) for i in range(200)]  # equal vectors, many more than a shard's rows
    spark.createDataFrame([(*v, "x", 1) for v in vectors], "vec_id long, embedding array<float>, shard string, row int").write.parquet(f"{tmp_path}/embeddings.parquet")
    out = queries.op7_kd_topk(spark, str(tmp_path)).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in out) == brute(vectors, 20)


def test_boxes_prune_shards(spark, monkeypatch):
    from pyspark.sql import functions as F

    small_shards(monkeypatch)
    r = np.random.default_rng(1)
    centre = np.array([[2.0 if i >> j & 1 else -2.0 for j in range(4)] for i in range(16)])  # medians part these
    vectors = [(i, [float(np.float32(x)) for x in centre[i // 7 % 16] + r.normal(0, 0.02, 4)]) for i in range(1600)]
    sent = []
    plain = topk._searched
    monkeypatch.setattr(topk, "_searched", lambda shards, asks, k, tasks: (sent.append((asks, shards)), plain(shards, asks, k, tasks))[1])
    d = spark.createDataFrame(vectors, "vec_id long, embedding array<float>")
    out = topk.top_k(d, F.col("vec_id") % 20 == 0, k=5).collect()
    assert sorted(map(tuple, out)) == brute(vectors, 5)
    queries_sent = sum(len(x.q_ids) // 8 for x in sent[1][0].select("q_ids").collect())
    assert sent[0][1].count() > 16 and queries_sent < 80 * (sent[0][1].count() - 1) / 3  # far fewer than every query to every other shard


def test_topk_few_and_none(spark, tmp_path):
    spark.createDataFrame([(0, [1.0, 2.0]), (20, [0.5, 0.0])], "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    assert sorted(map(tuple, queries.op7_kd_topk(spark, str(tmp_path)).collect())) == [(0, 1, 20, 2048), (20, 1, 0, 2048)]
    spark.createDataFrame([], "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/e/embeddings.parquet")
    assert queries.op7_kd_topk(spark, f"{tmp_path}/e").count() == 0
