import duckdb
import pytest

from cairnwork.llm import queries
from tests.llm.fixtures import rows
from tests.llm.test_doubling import brute as brute_doubling
from tests.llm.test_langid_decontam_simhash import ITEMS, brute_decontam
from tests.llm.test_sharding_mixing_topk import brute as brute_topk


@pytest.fixture
def duck():
    c = duckdb.connect()
    c.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    c.executemany("INSERT INTO documents VALUES (?, ?)", [r[:2] for r in rows()])
    c.execute("CREATE TABLE benchmark (item_id BIGINT, text VARCHAR)")
    c.executemany("INSERT INTO benchmark VALUES (?, ?)", ITEMS)
    return c


def test_sql_of_op3_and_op8(duck):
    d = [r[:2] for r in rows()]
    sql = queries.oracle_sql()
    assert sorted(duck.execute(sql["op3_positional_index"]).fetchall()) == brute_decontam(d, ITEMS)
    assert sorted(duck.execute(sql["op8_level_doubling"]).fetchall()) == brute_doubling(d)


def test_sql_of_op7():
    c = duckdb.connect()
    vectors = [(i, [0.1 * i, -0.3, 1.5]) for i in range(60)] + [(100, None)]
    c.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding FLOAT[])")
    c.executemany("INSERT INTO embeddings VALUES (?, ?)", vectors)
    held = c.execute("SELECT * FROM embeddings").fetchall()
    assert sorted(c.execute(f"SELECT query_id, rank, vec_id, score FROM ({queries.oracle_sql()['op7_kd_topk']})").fetchall()) == brute_topk(held, 20)
