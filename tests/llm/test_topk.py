import duckdb
import numpy as np
import pytest

from grantlens.llm import sql, topk

SCHEMA = "vec_id long, embedding array<float>, label int"


def test_tree_finds_all_points_above_the_bar():
    draw = np.random.default_rng(1)
    points = draw.integers(-50, 50, (500, 6))
    points[100:200] = points[0]
    tree = topk.Tree(points, leaf=8)
    for query in draw.integers(-50, 50, (20, 6)):
        scores = points @ query
        rows, found = tree.search(query, 10, -1e18)
        bar = np.sort(scores)[-10]
        assert sorted(rows.tolist()) == np.flatnonzero(scores >= bar).tolist()
        assert (scores[rows] == found).all()
        rows, _ = tree.search(query, 10, float(bar + 1))
        assert sorted(rows.tolist()) == np.flatnonzero(scores > bar).tolist()


@pytest.fixture(scope="module")
def vectors(spark):
    draw = np.random.default_rng(2)
    rows = [(k, draw.normal(size=4).round(1).tolist(), 0) for k in range(700)]
    rows += [(1000 + k, [0.5, 0.5, 0.5, 0.5], 0) for k in range(300)]  # a third of the rows is one vector
    rows += [(2000, None, 0), (2100, [1.0, None, 1.0, 1.0], 0), (2200, [float("nan")] * 4, 0), (2300, [float("inf"), 0.0, 0.0, 0.0], 0),
             (None, [1.0] * 4, 0), (2400, [0.0] * 4, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


def test_top_k_equals_its_sql(vectors):
    embeddings = vectors.toPandas()  # noqa: F841  DuckDB reads it by name
    want = duckdb.sql(sql.TOP_K).fetchall()
    own = topk.integer_vectors(vectors)
    for size in (64, 8192):
        got = topk.top_k(own, own.where("vec_id % 100 = 0"), shard_points=size, query_block=4)
        assert sorted(map(tuple, got.collect())) == sorted(want)


def test_repeated_rows_count_each(spark):
    rows = [(1, [1.0, 0.0], 0), (2, [1.0, 0.0], 0), (2, [1.0, 0.0], 0), (100, [1.0, 1.0], 0), (100, [1.0, 1.0], 0)]
    own = topk.integer_vectors(spark.createDataFrame(rows, SCHEMA))
    got = topk.top_k(own, own.where("vec_id = 100"), k=3).orderBy("rank").collect()
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in got] == [(100, 1, 1), (100, 2, 2), (100, 3, 2)]


def test_fewer_than_k_and_none(spark):
    one = topk.integer_vectors(spark.createDataFrame([(100, [1.0], 0), (5, [2.0], 0), (7, [1.0, 2.0], 0)], SCHEMA))
    assert [tuple(r) for r in topk.top_k(one, one.where("vec_id = 100")).collect()] == [(100, 1, 5, 2 * 1024 * 1024)]
    none = topk.integer_vectors(spark.createDataFrame([], SCHEMA))
    assert topk.top_k(none, none).count() == 0
