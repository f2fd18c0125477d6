from collections import Counter, defaultdict

import corpus_pipeline as cp
from cairnwork.llm import mixing
from tests.llm.fixtures import docs, rows, saved, words
from tests.llm.test_langid_decontam_simhash import ITEMS, brute_classes, brute_decontam


def test_stages_against_brute_force(spark, tmp_path):
    sf = saved(spark, tmp_path, ["shard", "lang_pred", "size"])
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    d = spark.read.parquet(f"{sf}/documents.parquet")
    names = d.columns
    stages = dict(cp.STAGES)
    assert list(stages) == ["language ID", "SimHash near-dedup", "benchmark decontamination", "mixing sources", "sharding"]

    d = stages["language ID"](spark, d, sf)
    kept = [(i, t) for i, t, *_ in rows() if any(map(str.isalpha, t or ""))]
    assert d.columns == names and sorted((r.doc_id, r.text) for r in d.collect()) == sorted(kept)
    d = stages["SimHash near-dedup"](spark, d, sf)
    least = {i for i, _, c in brute_classes(kept) if i == c}
    kept = sorted({i: t for i, t in kept if i in least}.items())
    assert d.columns == names and sorted((r.doc_id, r.text) for r in d.collect()) == kept
    d = stages["benchmark decontamination"](spark, d, sf)
    bad = {r[0] for r in brute_decontam(kept, ITEMS) if r[5]}
    kept = [k for k in kept if k[0] not in bad]
    assert d.columns == names and sorted((r.doc_id, r.text) for r in d.collect()) == kept
    before = {r.doc_id: (r.source, len((r.text or "").split())) for r in d.collect()}
    d = stages["mixing sources"](spark, d, sf)
    times = Counter(r.doc_id for r in d.collect())
    size, taken, most = defaultdict(int), defaultdict(int), defaultdict(int)
    for i, (s, n) in before.items():
        size[s] += n
        taken[s] += n * times[i]
        most[s] = max(most[s], n)
    goal = mixing.targets(list(size.items()))
    assert d.columns == names and max(times.values()) <= 3 and all(abs(taken[s] - goal[s]) <= most[s] for s in goal)
    n = sum(times.values())
    out = stages["sharding"](spark, d, sf)
    assert Counter(r.doc_id for r in out.collect()) == times and {"shard", "slot"} <= set(out.columns)
    sizes = Counter(r.shard for r in out.collect())
    assert max(sizes.values()) - min(sizes[s] for s in range(40)) <= 1 and sum(sizes.values()) == n


def test_run_empty(spark, tmp_path):
    docs(spark).limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert cp.run(spark, str(tmp_path)).count() == 0


def test_rows_without_id(spark, tmp_path):
    d = docs(spark)
    lost = spark.createDataFrame([(None, "only here and nowhere else", "en", "a", 1)] * 2 + [(None, rows()[13][1], "en", "a", 1), (None, ITEMS[0][1], "en", "a", 1)], d.schema)
    spark.createDataFrame(ITEMS[:1], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    stages = dict(cp.STAGES)
    both = stages["SimHash near-dedup"](spark, d.union(lost), str(tmp_path)).where("doc_id IS NULL")
    assert sorted(r.text for r in both.collect()) == sorted(["only here and nowhere else", ITEMS[0][1]])
    assert [r.text for r in stages["benchmark decontamination"](spark, both, str(tmp_path)).collect()] == ["only here and nowhere else"]


def test_rows_that_share_an_id_are_judged_apart(spark, tmp_path):
    d = docs(spark)
    own, other, copied = (" ".join(words(150, seed)) for seed in (91, 92, 93))
    held = [(5, copied, "en", "a", 1), (9, copied, "en", "a", 1), (9, own, "en", "a", 1), (9, other, "de", "b", 1), (None, other, "en", "a", 1), (9, own, "en", "b", 1), (3, ITEMS[0][1], "en", "a", 1), (3, own[::-1], "en", "a", 1)]
    spark.createDataFrame(ITEMS[:1], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    stages = dict(cp.STAGES)
    for order in (held, held[::-1]):
        kept = stages["SimHash near-dedup"](spark, spark.createDataFrame(order, d.schema), str(tmp_path))
        assert sorted((r.doc_id, r.text) for r in kept.collect()) == sorted([(5, copied), (9, own), (9, other), (3, ITEMS[0][1]), (3, own[::-1])])
        clean = stages["benchmark decontamination"](spark, kept, str(tmp_path)).where("doc_id = 3")
        assert [r.text for r in clean.collect()] == [own[::-1]]


def test_positions_and_numbers(spark, tmp_path, monkeypatch):
    from pyspark.sql import functions as F

    from cairnwork.llm import positions

    d = docs(spark).repartition(3)
    d.write.parquet(f"{tmp_path}/d")
    stored = spark.read.parquet(f"{tmp_path}/d").where("doc_id <> 3")
    twice = stored.withColumn("k", F.explode(F.array(F.lit(1), F.lit(2))))
    assert positions._scan(stored) and not positions._scan(d) and not positions._scan(twice)
    monkeypatch.setattr(positions, "CHUNK_BITS", 3)
    for table in (d, stored, twice):
        rows_ = positions.positioned(table)
        held = [tuple(r) for r in rows_.select("__f", "__r").collect()]
        assert len(set(held)) == len(held) == table.count()
        facts = rows_.where("n_chars % 2 = 0").select("__f", "__r", (F.col("n_chars") % 200).alias("value"))
        for limit in (1 << 20, 0):  # broadcast, and joined by position
            monkeypatch.setattr(positions, "BROADCAST_BYTES", limit)
            for width in (1, 8):
                got = positions.attach(rows_, facts, "v", width).select("n_chars", "v").collect()
                assert len(got) == len(held) and all(r.v == (None if r.n_chars % 2 else r.n_chars % 200) for r in got)


def test_a_task_has_one_python_process(spark, tmp_path, monkeypatch):
    """Python processes stay with their executor: so no operator reads another's rows in one stage, and there are no Python RDDs, whose processes are others."""
    from pyspark import SparkContext

    from cairnwork.llm import decontam
    from cairnwork.plans.storage import cut

    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    d = cut(docs(spark), "docs")
    plan = decontam.match(d, spark.read.parquet(f"{tmp_path}/benchmark.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1

    def refused(*args, **kwargs):
        raise AssertionError("a Python RDD")

    monkeypatch.setattr(SparkContext, "parallelize", refused)
    for _, stage in cp.STAGES:
        d = cut(stage(spark, d, str(tmp_path)), "stage")
    assert d.count() > 0
