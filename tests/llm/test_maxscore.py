import math

import numpy as np
import pytest
from compare import connect, spark_rows, sql_rows
from pyspark.sql import functions as F

from tickspan.llm import maxscore
from tickspan.llm.queries import SQL, op6_top_k


def test_query_equals_sql(spark, data):
    found = spark_rows(op6_top_k(spark, data))
    assert found == sql_rows(connect(data), SQL["op6_top_k"])
    assert found[1]


@pytest.mark.parametrize("spread", [3, 200, 1 << 28])  # the last one beyond exact doubles
def test_shard_against_all_products(spread):
    rng = np.random.default_rng(spread)
    vectors = rng.integers(-spread, spread, (3000, 10))
    vectors[500:900] = vectors[0]  # many ties
    vectors[:, 4] = 7
    ids = rng.permutation(9000)[:3000]
    queries = np.concatenate([vectors[:20], np.zeros((1, 10), np.int64), -vectors[30:40]])
    asked = np.concatenate([ids[:20], [-1], np.arange(-12, -2)])
    for k in (1, 5, 4000):
        got = maxscore.top_of_shard(ids, vectors, asked, queries, k)
        for own, q, (found, scores) in zip(asked, queries, got):
            score = vectors @ q
            order = np.lexsort((ids, -score))
            order = order[ids[order] != own][:k]
            assert found.tolist() == ids[order].tolist()
            assert scores.tolist() == score[order].tolist()


def test_shards_are_merged(spark, data, monkeypatch):
    monkeypatch.setattr(maxscore, "SHARD", 60)
    monkeypatch.setattr(maxscore, "QUERIES", 4)
    assert spark_rows(op6_top_k(spark, data)) == sql_rows(connect(data), SQL["op6_top_k"])


def test_awkward_rows(spark):
    rows = [
        (0, [0.5, -0.25]), (1, [1.0, 1.0]), (2, [1.0, 1.0]), (2, [1.0, 1.0]), (3, None),
        (4, [math.nan, 1.0]), (5, [math.inf, 1.0]), (6, [None, 1.0]), (None, [9.0, 9.0]),
        (7, []), (8, [1.0]), (100, [0.0, -1.0]),
    ]
    schema = "vec_id long, embedding array<double>, label int, id string, v string, q string, g int"
    vectors = spark.createDataFrame([(*r, 0, "x", "x", "x", 1) for r in rows], schema)
    got = maxscore.top_k(vectors, F.col("vec_id") % 50 == 0, k=4).collect()
    by_query = {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        by_query.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    own = {0: (128, -64), 1: (256, 256), 2: (256, 256), 7: (0, 0), 8: (256, 0), 100: (0, -256)}
    for query, found in by_query.items():
        all_ = [(-sum(a * b for a, b in zip(own[query], own[i])), i) for i in (0, 1, 2, 2, 7, 8, 100) if i != query]
        assert found == [(i, -s) for s, i in sorted(all_)[:4]]
    assert set(by_query) == {0, 100}
    assert maxscore.top_k(vectors.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    assert maxscore.top_k(vectors, F.lit(False)).count() == 0
    assert len(maxscore.top_k(vectors, F.col("vec_id") == 8, k=50).collect()) == 6
