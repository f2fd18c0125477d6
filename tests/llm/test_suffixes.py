import hashlib
from collections import Counter

import numpy as np
import pytest

from cairnwork.llm import packed, queries, suffixes
from tests.llm.fixtures import docs, rows, saved

SF = "/root/testdata/sf0.001"


def brute(documents, n=400):
    held = Counter()
    texts = [(t or "").encode() for _, t in documents]
    for t in texts:
        held.update(t[s : s + n] for s in range(len(t) - n + 1))
    out = []
    for (i, _), t in zip(documents, texts):
        edge = np.zeros(len(t) + 1, int)
        for s in range(len(t) - n + 1):
            if held[t[s : s + n]] > 1:
                edge[s] += 1
                edge[s + n] -= 1
        gone = np.cumsum(edge)[:-1] > 0
        kept = bytes(np.frombuffer(t, np.uint8)[~gone])
        out.append((i, len(t), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def test_bounded_repeats_against_brute_force():
    r = np.random.default_rng(3)
    for depth in (1, 2, 3, 5, 9, 16):
        for letters in (1, 2, 4):
            text = r.integers(0, letters, 300)
            text[r.random(300) < 0.04] = -1
            text[-1] = -1
            at = [s for s in range(301 - depth) if (text[s : s + depth] >= 0).all()]
            held = Counter(tuple(text[s : s + depth]) for s in at)
            want = np.zeros(300, bool)
            want[[s for s in at if held[tuple(text[s : s + depth])] > 1]] = True
            assert (suffixes.bounded_repeats(text, depth) == want).all(), (depth, letters)


@pytest.mark.parametrize("hot", [2000, 1])
def test_op1_against_brute_force(spark, tmp_path, monkeypatch, hot):
    monkeypatch.setattr(suffixes, "HOT", hot)
    monkeypatch.setattr(suffixes, "BLOCK_BYTES", 3000)
    monkeypatch.setattr(packed, "BUCKET_BYTES", 1000)
    out = queries.op1_bwt_intervals(spark, saved(spark, tmp_path, ["n_bytes", "block"])).collect()
    assert sorted(tuple(r)[:5] for r in out) == brute([(i, t) for i, t, *_ in rows()])


def test_op1_on_driver_rows(spark):
    d = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    out = queries.op1_bwt_intervals(spark, SF).collect()
    assert sorted(tuple(r)[:5] for r in out) == brute(d)
    sharing = {i for i, _, removed, *_ in brute(d, suffixes.REPORT) if removed}
    barely = {i for i, _, removed, *_ in brute(d, suffixes.gram_length(suffixes.REPORT)) if removed}
    found = {r.doc_id for r in out if r.n_shared}
    assert sharing <= found <= barely and len(found) < len(d)


def test_op1_within_one_document_and_empty(spark):
    d = spark.createDataFrame([(1, "a" * 401), (2, "a" * 400 + "b"), (3, "b" * 400), (None, "x" * 399)], "doc_id long, text string")
    out = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans) for r in suffixes.remove_repeats(d).collect()}
    assert out == {1: (401, 401, 1), 2: (401, 400, 1), 3: (400, 0, 0), None: (399, 0, 0)}
    assert suffixes.remove_repeats(docs(spark).limit(0)).count() == 0
