"""Scores of pairs of whole texts, against one pair at a time; no text is sent once for each of its pairs."""

import random

import numpy as np
import pandas as pd
import pyarrow as pa
import pyspark.sql.functions as F
import pytest

from cairnwork.functions import text as X
from cairnwork.operators import namescore as N
from cairnwork.plans.catalogue import QUERIES
from cairnwork.plans.storage import apart
from tests.test_growth import made


@pytest.mark.parametrize("together", [None, True, False])
def test_lengths_of_common_subsequences(monkeypatch, together):
    if together is not None:
        batches = N._batches
        monkeypatch.setattr(N, "_batches", lambda *a: ((same, together) for same, _ in batches(*a)))
    r = random.Random(1)
    some = lambda: "".join(r.choices(r.choice(("ab c", "abcdefgh 123")), k=r.choice((0, 1, 62, 63, 64, 126, 127, 300, 700))))
    texts = [(x, some() if r.random() < 0.5 else "".join(c for c in x if r.random() < 0.8)) for x in (some() for _ in range(400))]
    guess = np.array([r.random() * 1.2 * min(map(len, p)) for p in texts])  # often too much
    assert N.lcs_lengths([(x.encode(), y.encode()) for x, y in texts], guess).tolist() == [X.lcs_length(*p) for p in texts]


def test_ratios_of_one_pair_and_of_many():
    r = random.Random(2)
    words = ["villa", "savoye", "a", "poissy", "x1", "house", "of", "1931"]
    texts = [(" ".join(r.choices(words, k=r.randint(0, 30))), " ".join(r.choices(words, k=r.randint(0, 30)))) for _ in range(300)] + [("", ""), ("a", ""), ("a b", "c d"), ("a a b", "b a")]
    rows = []
    for x, y in texts:
        p, q = set(x.encode().split()), set(y.encode().split())
        rows.append((b" ".join(sorted(x.encode().split())), b" ".join(sorted(y.encode().split())), p - q, q - p, len(b" ".join(p & q))))
    got = list(zip(*(x.tolist() for x in N.ratios(rows))))
    assert got == [(X.sort_ratio(*p), X.set_ratio(*p)) for p in texts]


def test_a_text_is_not_sent_for_each_of_its_pairs(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(N, "FEWEST", 2)
    texts = {i: " ".join([*(f"w{k}" for k in range(20)), f"own{i}", *["w3"] * (i % 3)]) for i in range(90)}
    spark.createDataFrame([*texts.items(), (90, None), (91, "alone")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    df = QUERIES["name_similarity_scores"](spark, str(tmp_path))
    _, most = made(df, "numOutputRows")  # of joins with texts; scoring takes rows by groups
    rows = {(r.a, r.b): (r.strict, r.loose) for r in df.collect()}
    assert len(rows) == 90 * 89 // 2
    for (a, b), got in list(rows.items())[::37]:
        both = X.sort_ratio(texts[a], texts[b]), X.set_ratio(texts[a], texts[b])
        assert got == (min(both), max(both))
    assert most <= 90 * 3


def test_pairs_met_together_have_like_lengths(monkeypatch):
    met, band = [], N._in_band
    monkeypatch.setattr(N, "_in_band", lambda a, b, *width: met.append((max(map(len, a)) * len(a), sum(map(len, a)))) or band(a, b, *width))
    r = random.Random(3)
    some = lambda n: bytes(r.choices(b"abcdefgh 123", k=n))
    # as far from each other: two long texts, and a short one and a long one
    pairs = [(some(3000), some(3000)) for _ in range(30)] + [(some(100), some(3100)) for _ in range(90)]
    got = N.lcs_lengths(pairs, np.array([1500] * 30 + [80] * 90))
    assert got.tolist() == [X.lcs_length(x.decode(), y.decode()) for x, y in pairs]
    made, own = map(sum, zip(*met))
    assert made <= 1.5 * own


@pytest.mark.parametrize(("partners", "chars"), [(256, 1 << 24), (3, 1 << 24), (7, 300)])
def test_scores_of_a_task(monkeypatch, partners, chars):
    monkeypatch.setattr(N, "PARTNERS", partners)
    monkeypatch.setattr(N, "KEPT_CHARS", chars)
    r = random.Random(4)
    texts = {k: " ".join(sorted(r.choices([*"abcde", f"own{k}", f"w{k % 7}", "house"], k=r.choice((0, 1, 5, 40))))) for k in range(40)}
    packed = pd.DataFrame([(k, len(x), pa.compress(x.encode(), codec="zstd", asbytes=True)) for k, x in texts.items()], columns=["id", "size", "packed"])
    pairs = [(a, b) for a in range(39, -1, -1) for b in range(40) if a < b]
    got = pd.concat(N._score(packed, pd.DataFrame(pairs, columns=["a", "b"])))
    want = {(a, b): (X.sort_ratio(texts[a], texts[b]), X.set_ratio(texts[a], texts[b])) for a, b in pairs}
    assert {(a, b): (x, y) for a, b, x, y in got.itertuples(index=False)} == {k: (min(v), max(v)) for k, v in want.items()}


@pytest.mark.parametrize("n", [1, 21, 45])
def test_each_task_has_its_own_partition(spark, n):
    keys = apart(spark, n)
    dealt = spark.createDataFrame([(k,) for k in keys], "task int").repartition(n, "task").select("task", F.spark_partition_id().alias("p"))
    assert sorted(r.p for r in dealt.collect()) == list(range(n))
    assert [k for k, _ in sorted(map(tuple, dealt.collect()), key=lambda r: r[1])] == keys


def test_tasks_of_scores_are_dealt_apart(spark, monkeypatch):
    monkeypatch.setattr(N, "FEWEST", 6)
    docs = spark.createDataFrame([(k, f"villa w{k % 5} x{k}") for k in range(60)], "doc_id long, text string")
    pairs = spark.createDataFrame([(a, b) for a in range(60) for b in range(a + 1, 60)], "a long, b long")
    scores = N.name_scores(docs, "doc_id", F.col("text"), pairs).withColumn("p", F.spark_partition_id()).collect()
    assert len(scores) == 60 * 59 // 2 and len({r.p for r in scores}) == 21
