"""Operators on small tables, against values worked out by hand or by plain code."""

import json

import pytest
from pyspark.sql import functions as F

from cairnwork.functions import text as X
from cairnwork.functions import values as V
from cairnwork.operators import relational as R
from cairnwork.operators import resolution as E
from cairnwork.operators.graph import components
from cairnwork.sources import readers, sinks
from cairnwork.streaming import queues


def one(spark, c):
    return spark.range(1).select(c.alias("x")).first().x


def test_similarity_by_hand():
    assert X.lcs_length("kitten", "sitting") == 4
    assert X.indel_ratio("ab", "ab") == 100 and X.indel_ratio("ab", "cd") == 0
    assert X.sort_ratio("villa savoye", "savoye villa") == 100
    assert X.set_ratio("villa savoye", "villa savoye poissy") == 100
    assert X.set_ratio("a b", "c d") == X.indel_ratio("a b", "c d") and X.set_ratio("", "a") == 0


def test_scores_and_folding(spark):
    d = spark.createDataFrame([("Łódź Øre—Haus", "x"), (None, "ＡＢ ①!")], "a string, b string")
    out = d.select(X.fold_unicode("a").alias("a"), X.compat_fold("b").alias("b"), X.name_scores("a", "b").alias("s")).collect()
    assert out[0].a == "lodz ore haus" and out[1].a is None and out[1].b == "ab 1"
    assert all(r.s.strict <= r.s.loose for r in out)


def test_numbers(spark):
    for text, want in (("1.234,5", 1234.5), ("1,234.5", 1234.5), ("1234", 1234.0), ("x", None)):
        assert one(spark, V.number_of(F.lit(text))) == want
    assert one(spark, V.square_metres(F.lit("100 m2"))) == 100 and one(spark, V.square_metres(F.lit("2 ha"))) == 20000 and one(spark, V.square_metres(F.lit("5 rooms"))) is None
    assert one(spark, V.year_strict(F.lit("1999"))) == 1999 and one(spark, V.year_strict(F.lit("c. 1999"))) is None and one(spark, V.year_anywhere(F.lit("c. 1999!"))) == 1999
    assert one(spark, V.interval_gap(F.lit(1990), F.lit(1992), F.lit(1995), F.lit(1996))) == 3


def test_urls_and_arrays(spark):
    assert one(spark, V.compare_key(F.lit("https://www.a.com/x%20y/?q=1"))) == "a.com/x y"
    assert one(spark, V.asset_key(F.lit("http://h/123e4567-e89b-12d3-a456-426614174000/a.jpg"))).startswith("123e4567")
    assert one(spark, V.array_of(F.lit('["a","b"]'))) == ["a", "b"] and one(spark, V.array_of(F.lit("a"))) == ["a"] and one(spark, V.array_of(F.lit(" "))) == []
    assert one(spark, V.hex_distance(F.lit("0" * 64), F.lit("f" + "0" * 62 + "1"))) == 5
    assert one(spark, V.cosine(F.array(F.lit(1.0), F.lit(0.0)), F.array(F.lit(0.0), F.lit(2.0)))) == 0
    assert sum(one(spark, V.softmax(F.array(F.lit(1.0), F.lit(3.0))))) == pytest.approx(1)
    assert one(spark, V.vector_parse(V.vector_text(F.array(F.lit(0.5), F.lit(-1.0))))) == [0.5, -1.0]


def test_bands_keep_every_near_pair(spark):
    bits = "".join(str(i * 7 % 2) for i in range(64))
    far = "".join("1" if c == "0" and i in (0, 9, 30) else c for i, c in enumerate(bits))
    d = spark.createDataFrame([(1, bits), (2, far), (3, bits[::-1].translate(str.maketrans("01", "10")))], "id int, b string")
    assert (1, 2) in {(r.a, r.b) for r in R.band_pairs(d, "id", V.interleaved_bands(F.col("b"), 64, 9)).collect()}


def test_components_and_safety(spark):
    e = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7), (None, 3)], "a long, b long")
    assert {r.node: r.root for r in components(e, "a", "b").collect()} == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100}
    bad = spark.createDataFrame([(100, 101)], "a long, b long")
    assert {r.root: r.safe for r in E.safe_components(e, "a", "b", bad).collect()} == {0: False, 100: False}


def test_greedy(spark):
    d = spark.createDataFrame([("g", 1, "a", 0), ("g", 2, "a", 1), ("g", 3, "b", 1), ("g", 4, "b", 255)], "grp string, item int, src string, h long")
    assert {r.item: r.cluster for r in E.source_disjoint_clusters(d, "grp", "item", "src", "h", 2).collect()} == {1: 1, 2: 2, 3: 1, 4: 4}
    assert [r.item for r in E.greedy_shortlist(d, "grp", "item", "item", "h", 2, 3).orderBy("place").collect()] == [1, 4]


def test_redirect_cycle_is_an_error(spark):
    d = spark.createDataFrame([(1, 2), (2, 1)], "s int, d int")
    with pytest.raises(RuntimeError):
        E.follow_redirects(d, "s", "d", rounds=3)


def test_sinks(spark, tmp_path):
    a = spark.createDataFrame([(1, ["x"], "p"), (2, ["y"], "q")], "k int, arr array<string>, s string")
    b = spark.createDataFrame([(2, [], "z"), (3, ["n"], None)], "k int, arr array<string>, s string")
    assert {(r.k, tuple(r.arr), r.s) for r in sinks.merge_keep(a, b, "k", ["arr"]).collect()} == {(1, ("x",), "p"), (2, ("y",), "z"), (3, ("n",), None)}
    assert sinks.table_hash(a).first() == sinks.table_hash(a.orderBy(F.desc("k"))).first() != sinks.table_hash(b).first()
    path = f"file://{tmp_path}/t"
    sinks.publish(a, path)
    with pytest.raises(FileExistsError):
        sinks.publish(b, path)
    checks = spark.createDataFrame([("c", "FAIL")], "c string, status string")
    assert not sinks.publish_if_clean(b, checks, path) and spark.read.parquet(path).count() == 2
    assert sinks.publish_if_clean(b.limit(1), checks.where("false"), path) and spark.read.parquet(path).count() == 1
    assert sinks.replace_children(a, b, "k").count() == 3 and "new" in sinks.add_missing_columns(a, {"new": "int", "k": "int"}).columns
    first = sinks.resumable(a, f"file://{tmp_path}/r", "stage", "h1")
    assert sinks.resumable(b, f"file://{tmp_path}/r", "stage", "h1").count() == first.count() == 2


def test_sources(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"clusters": [{"id": 1}, {"id": 2}]}))
    (tmp_path / "b.json").write_text(json.dumps([{"id": 3}]))
    assert sorted(r.id for r in readers.json_rows(spark, f"{tmp_path}/*.json", "id int").collect()) == [1, 2, 3]
    (tmp_path / "l.jsonl").write_text('{"k": 1, "v": "a"}\nbad\n{"k": 1, "v": "b"}\n{"k": 2, "v": "c"}\n')
    assert {r.k: r.v for r in readers.last_lines(spark, f"{tmp_path}/l.jsonl", "k int, v string", "k").collect()} == {1: "b", 2: "c"}
    (tmp_path / "s.xml").write_text("<urlset><url><loc> http://a </loc><lastmod>2024</lastmod></url><url><loc>http://b</loc></url></urlset>")
    assert {(r.url, r.lastmod) for r in readers.sitemap_urls(spark, f"{tmp_path}/s.xml").collect()} == {("http://a", "2024"), ("http://b", None)}
    assert one(spark, readers.page_text(F.lit("<p>a &lt;b&gt;</p><script>x</script><!-- c -->d"))) == "a <b> d"
    assert one(spark, readers.embedded_json(F.lit('<script>var t = {"a": 1};</script>'), "t")) == '{"a": 1}'
    pinned = readers.checked_files(spark, f"{tmp_path}/b.json", {"b.json": "0", "none": "1"}).collect()
    assert [r.ok for r in pinned] == [False, False]


def test_streams(spark, tmp_path):
    d = spark.createDataFrame([(1, "a"), (2, "b")], "id long, text string")
    d.write.parquet(f"{tmp_path}/in")
    for want in (2, 3):
        stream = spark.readStream.schema(d.schema).parquet(f"{tmp_path}/in")
        queues.hash_stream(stream, "id", "text", f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()
        assert spark.read.parquet(f"{tmp_path}/out").count() == want
        spark.createDataFrame([(3, "c")], "id long, text string").write.mode("append").parquet(f"{tmp_path}/in") if want == 2 else None
    ev = spark.createDataFrame([(0, "a"), (30, "a"), (70, "b")], "s long, kind string").select(F.timestamp_seconds("s").alias("ts"), "kind")
    assert {(r.kind, r.n) for r in queues.windowed_counts(ev, "ts", "kind", "1 minute", "1 minute").collect()} == {("a", 2), ("b", 1)}


def test_quotas_and_samples(spark):
    d = spark.createDataFrame([("a", i) for i in range(7)] + [("b", i) for i in range(7, 10)], "c string, k long")
    assert {r.c: r.quota for r in R.quotas(d, ["c"], 5).collect()} == {"a": 4, "b": 1} or {r.c: r.quota for r in R.quotas(d, ["c"], 5).collect()} == {"a": 3, "b": 2}
    assert R.stratified(d, ["c"], 5, "s", "k").count() == 5 == R.hash_sample(d, 5, "s", "k").count()
    assert R.schema_difference(d, d.drop("k").withColumn("z", F.lit(1))) == [("+", "z"), ("-", "k")]


def test_entry_points(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).count() > 0


def test_intervals():
    from cairnwork.functions import stats

    assert stats.wilson(0, 0) == (0.0, 1.0) and stats.wilson(8, 10)[0] == pytest.approx(0.4902, abs=1e-4)
    assert stats.clopper_pearson(8, 10) == (pytest.approx(0.4439, abs=1e-4), pytest.approx(0.9748, abs=1e-4))
    mean, low, high = stats.beta_accuracy([(90, 100, 1.0)])
    assert low < mean < high and mean == pytest.approx(90.5 / 101, abs=0.01)


def test_command_line(spark, tmp_path, capsys):
    from cairnwork.__main__ import main

    sf = "/root/testdata/sf0.001"
    assert main(["list", "tag_"]) == 0 and "tag_stats" in capsys.readouterr().out
    assert main(["sql", "no_such"]) == 2 and main(["sql", "tag_stats"]) == 0
    assert main(["run", "null_census", sf, "--out", f"{tmp_path}/out"]) == 0 and spark.read.parquet(f"{tmp_path}/out").count() > 0
    assert main(["count", sf, "null_census"]) == 0 and main(["checks", sf]) in (0, 1)


def test_sealed_table_that_changes_is_found(spark, tmp_path):
    at = f"file://{tmp_path}/s"
    first = sinks.seal(spark.range(5), at)
    assert sinks.sealed(spark, at) == first
    spark.range(6).write.mode("overwrite").parquet(f"{at}/data")
    with pytest.raises(ValueError):
        sinks.sealed(spark, at)


def test_no_shared_folder_is_an_error_on_a_cluster():
    from types import SimpleNamespace

    from cairnwork.plans import storage

    remote = SimpleNamespace(conf=SimpleNamespace(get=lambda k, d: None), sparkContext=SimpleNamespace(master="spark://host:7077"))
    with pytest.raises(RuntimeError):
        storage.shared_dir(remote)
