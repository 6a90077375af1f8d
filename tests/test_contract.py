import os

import duckdb
import pytest

import __spark_entry__ as E
from opinara.operators import evaluate as EV

FOLDER = "/root/testdata/sf0.001"


def test_entry_and_oracles_name_the_same_queries():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) > 80


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")
@pytest.mark.parametrize("name", ["product_statistics", "user_history", "keyword_search_any", "graph_similar_users", "user_cf", "similar_products_metadata"])
def test_small_scale_oracle(spark, name):
    con = duckdb.connect()
    for t in "part orders lineitem customer documents embeddings".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    want = con.execute(E.oracle_sql()[name])
    cols = [d[0] for d in want.description]
    text = lambda v: repr(round(v, 6)) if isinstance(v, float) else str(v)
    got = E.queries()[name](spark, FOLDER).select(*cols)
    assert sorted(tuple(map(text, r)) for r in got.collect()) == sorted(tuple(map(text, r)) for r in want.fetchall())


def test_precision_recall_by_hand(spark):
    recs = spark.createDataFrame([(1, 10, 1), (1, 11, 2), (2, 10, 1), (3, 10, 1)], "user_id long, item_id long, rank int")
    truth = spark.createDataFrame([(1, 10), (1, 10), (1, 12), (1, 13), (1, 14), (2, 10), (2, 11), (9, 1)], "user_id long, item_id long")
    users = spark.createDataFrame([(1,), (2,), (3,)], "user_id long")
    r = EV.evaluate(recs, truth, users, 10, "m").first()
    assert r["n_users_evaluated"] == 2
    assert r["precision_at_k"] == pytest.approx(0.75) and r["recall_at_k"] == pytest.approx(0.375)
    assert r["f1_at_k"] == pytest.approx(2 * 0.75 * 0.375 / 1.125)
    empty = EV.evaluate(recs.limit(0), truth, users).first()
    assert (empty["n_users_evaluated"], empty["f1_at_k"]) == (0, 0.0)


def test_hold_out_halves(spark):
    df = spark.createDataFrame([(1, i, 5, i) for i in range(5)], "user_id long, item_id long, rating int, ts long")
    train, test = EV.hold_out(df, ["ts"])
    assert sorted(r["item_id"] for r in train.collect()) == [0, 1] and test.count() == 3
    assert EV.activity(df, 5).count() == 1 and EV.activity(df, 6).count() == 0
