import numpy as np
import pytest

from cairnwork.llm import queries, tokencount
from tests.llm.fixtures import docs, rows, saved


def encoder():
    with open(tokencount.RANKS, "rb") as f:
        return tokencount.tokenizer(f.read())


@pytest.mark.parametrize("block", [7, 1 << 18])
def test_op10_against_plain_encoding(spark, tmp_path, monkeypatch, block):
    monkeypatch.setattr(tokencount, "GROUP", 3)
    monkeypatch.setattr(tokencount.write_flat, "__defaults__", ("doc_id", "text", tokencount.RANKS, tokencount.END, block))
    e = encoder()
    want = sorted((i, len(e.encode_ordinary(t or ""))) for i, t, *_ in rows())
    assert sorted(map(tuple, queries.op10_separator_scan(spark, saved(spark, tmp_path, ["file", "ordinal"])).collect())) == want


def test_streams_of_any_shape(spark, tmp_path):
    r = np.random.default_rng(2)
    want = {}
    for f in range(6):
        ids = r.integers(0, 3, 200 * f).astype("<u2")
        if f == 3:
            ids[:] = 1
        ids.tofile(tmp_path / f"{f}.bin")
        ends = np.flatnonzero(ids == 2)
        counts = np.diff(np.concatenate([[-1], ends, [len(ids)]])) - 1
        want[f] = [int(c) for c in (counts[:-1] if not counts[-1] else counts)]
    for block in (1, 13, 5000):
        flat = tokencount.read_flat(spark, str(tmp_path), 2, block)
        got = {}
        for x in tokencount.count_tokens(flat, end=2).collect():
            got.setdefault(x.file, []).append((x.ordinal, x.n_tokens))
        assert all([o for o, _ in sorted(v)] == list(range(len(v))) for v in got.values())
        assert sorted([n for _, n in sorted(v)] for v in got.values()) == sorted(v for v in want.values() if v)


def test_op10_empty(spark, tmp_path):
    docs(spark).limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert queries.op10_separator_scan(spark, str(tmp_path)).count() == 0
