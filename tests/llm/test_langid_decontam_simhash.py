import hashlib
import re
import zlib
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from cairnwork.llm import decontam, langid, queries, simhash
from tests.llm.fixtures import docs, rows, saved, words

SF = "/root/testdata/sf0.001"


def test_codewords_are_distinct():
    for n in (1, 2, 3, 4, 5, 6, 20):
        code = langid.codewords(n)
        assert len({tuple(c) for c in code}) == n


def test_op2_edges(spark, tmp_path):
    out = {r.doc_id: r for r in queries.op2_ecoc_language(spark, saved(spark, tmp_path, ["score", "lang_pred"])).collect()}
    text = {i: t for i, t, *_ in rows()}
    learned = {r[2] for r in rows() if r[2] and zlib.crc32(str(r[0]).encode()) % 4 != 2}
    for i, r in out.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert (r.lang_pred == "und") == (not any(map(str.isalpha, text[i] or "")))
        assert r.lang_pred == "und" or r.lang_pred in learned
        assert 0 <= r.score <= 1
    assert len(out) == len(text)


def test_op2_without_labels(spark, tmp_path):
    docs(spark).withColumn("lang", F.lit(None).cast("string")).write.parquet(f"{tmp_path}/documents.parquet")
    assert {r.lang_pred for r in queries.op2_ecoc_language(spark, str(tmp_path)).collect()} == {"und"}
    docs(spark).limit(0).write.parquet(f"{tmp_path}/e/documents.parquet")
    assert queries.op2_ecoc_language(spark, f"{tmp_path}/e").count() == 0


def test_op2_held_out_accuracy(spark):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    out = [r for r in queries.op2_ecoc_language(spark, SF).collect() if r.held_out and lang[r.doc_id] and r.lang_pred != "und"]
    assert sum(r.lang_pred == lang[r.doc_id] for r in out) >= 0.9 * len(out)


WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lowered(t):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute_decontam(documents, items):
    windows = {}
    for i, t in items:
        w = lowered(t)
        for at in range(max(1, len(w) - 9)) if w else ():
            windows.setdefault(tuple(w[at : at + 10]), set()).add(i)
    out = []
    for i, t in documents:
        w, hit, found = lowered(t), set(), set()
        for n in {len(x) for x in windows}:
            for at in range(len(w) - n + 1):
                if (x := windows.get(tuple(w[at : at + n]))) is not None:
                    hit |= set(range(at, at + n))
                    found |= x
        ids = ",".join(sorted(map(str, found)))
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), len(hit) > 0))
    return sorted(out)


ITEMS = [(1, " ".join(words(400, 1)[100:130]).upper()), (22, "x, y!"), (3, None), (4, "..."), (5, " ".join(words(60, 2)[:12])), (6, " ".join(words(60, 2)[:12])), (7, "é"), (8, "no such words here at all")]


def test_op3_against_brute_force(spark, tmp_path):
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    want = brute_decontam([(i, t) for i, t, *_ in rows()], ITEMS)
    out = queries.op3_positional_index(spark, saved(spark, tmp_path, ["n_words", "item_id"])).collect()
    assert sorted(map(tuple, out)) == want


def test_op3_in_several_passes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(decontam, "MAX_WINDOWS", 40)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    distinct = [(i, t) for i, t, *_ in rows() if i != 14]
    out = decontam.match(docs(spark).where("doc_id <> 14"), items).collect()
    assert sorted(map(tuple, out)) == brute_decontam(distinct, ITEMS)


def test_op3_in_several_passes_keeps_rows_that_share_an_id(spark, monkeypatch):
    monkeypatch.setattr(decontam, "MAX_WINDOWS", 40)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    held = [(i if i % 3 else None if i % 2 else 7, t) for i, (_, t, *_) in enumerate(rows())] + [(None, "x y"), (7, "x y")] * 6
    got = sorted((tuple(r) for r in decontam.match(spark.createDataFrame(held, "doc_id long, text string").repartition(6), items).collect()), key=repr)
    want = sorted((w for i, t in held for w in [(i, *brute_decontam([(0, t)], ITEMS)[0][1:])]), key=repr)
    assert len(got) == len(held) and got == want


def test_one_stored_index_answers_many(spark):
    index = decontam.build_index(docs(spark)).cache()
    everything = [(i, t) for i, t, *_ in rows()]
    for items in (ITEMS, ITEMS[:1], [(9, "x y")], []):
        got = decontam.match_index(index, spark.createDataFrame(items, "item_id long, text string")).collect()
        assert sorted(map(tuple, got)) == brute_decontam(everything, items)
    assert decontam.proximity_index(index, "x y", 1).count() >= 1
    stored = index.select(F.sum(F.octet_length("postings")) / 4).first()[0]
    assert stored == sum(len(lowered(t)) for _, t in everything)  # every token is posted
    index.unpersist()


def test_op3_on_driver_rows(spark):
    d = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    b = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert sorted(map(tuple, queries.op3_positional_index(spark, SF).collect())) == brute_decontam(d, b)


def test_proximity(spark):
    d = spark.createDataFrame([(1, "red fox near the blue lake"), (2, "red one two three four five blue"), (3, "blue"), (4, None)], "doc_id long, text string")
    assert [(r.doc_id, r.position) for r in decontam.proximity(d, "red blue", 4).collect()] == [(1, 0)]
    assert {r.doc_id for r in decontam.proximity(d, "red blue", 6).collect()} == {1, 2}


def brute_print(t):
    w = re.sub("[A-Z]", lambda m: m[0].lower(), t or "").encode().split()
    if not w:
        return 0
    s = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
    h = [xxhash.xxh64(x, seed=42).intdigest() for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_classes(documents):
    prints = [(i, brute_print(t)) for i, t in documents]
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(range(len(prints)), 2):
        if (prints[a][1] ^ prints[b][1]).bit_count() <= 3:
            root[max(find(a), find(b))] = min(find(a), find(b))
    least = {}
    for k, (i, _) in enumerate(prints):
        least[find(k)] = min(i, least.get(find(k), i))
    return sorted((i, f"{f:016x}", least[find(k)]) for k, (i, f) in enumerate(prints))


@pytest.mark.parametrize("tile", [2048, 8])
def test_op4_against_brute_force(spark, tmp_path, monkeypatch, tile):
    monkeypatch.setattr(simhash, "TILE_ROWS", tile)
    out = queries.op4_simhash_tiles(spark, saved(spark, tmp_path, ["fp", "component_id"])).collect()
    assert sorted(map(tuple, out)) == brute_classes([(i, t) for i, t, *_ in rows()])


def test_op4_on_driver_rows(spark):
    d = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert sorted(map(tuple, queries.op4_simhash_tiles(spark, SF).collect())) == brute_classes(d)


def test_op4_in_groups_and_lots(spark, monkeypatch):
    """Many near prints in few cells: links across tiles, groups and lots of a cell and of its neighbours."""
    for name, value in {"TILE_ROWS": 4, "GROUP_ROWS": 12, "LOT_ROWS": 40}.items():
        monkeypatch.setattr(simhash, name, value)
    from cairnwork.operators.graph import components

    r = np.random.default_rng(8)
    base = [int(x) for x in r.integers(0, 2**63, 12)]
    fps = list({b ^ sum(1 << int(k) for k in r.choice(63, r.integers(0, 7), replace=False)) for b in base for _ in range(60)})
    edges = simhash.links(spark.createDataFrame([(f,) for f in fps], "fp long"))
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(fps, 2):
        if (a ^ b).bit_count() <= 3:
            root[max(find(a), find(b))] = min(find(a), find(b))
    got = {x.node: x.root for x in components(edges, "a", "b").collect()}
    assert {f: got.get(f, f) for f in fps} == {f: find(f) for f in fps} and len(set(got.values())) > 5
    assert all((x.a ^ x.b).bit_count() <= 3 for x in edges.collect())


def test_op4_chain_and_empty(spark, tmp_path):
    fps = [0, 7, 63, 511, 31 << 40]  # a chain at 3 bits each, and one apart
    edges = simhash.links(spark.createDataFrame([(f,) for f in fps], "fp long"))
    from cairnwork.operators.graph import components

    assert {(r.node, r.root) for r in components(edges, "a", "b").collect()} == {(f, 0) for f in fps[:4]}
    docs(spark).limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert queries.op4_simhash_tiles(spark, str(tmp_path)).count() == 0


def test_fit_copies_what_it_gathers_little(spark):
    """The driver holds the gathered vectors (16 KB a row), and beside them one copy in double precision."""
    import tracemalloc

    labelled = spark.createDataFrame([(i, " ".join(words(20, i)) + " der und" * (i % 2), ("en", "de")[i % 2]) for i in range(800)], "doc_id long, text string, lang string")
    langid.fit(labelled)  # so that only what a fit takes is counted
    tracemalloc.start()
    try:
        langid.fit(labelled)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert most < 4 * 800 * 4 * langid.BUCKETS
