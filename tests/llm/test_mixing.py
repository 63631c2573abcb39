from collections import defaultdict

import duckdb
import pytest

from grantlens.llm import mixing, sql


def expected_targets(sizes, weights=(5, 2, 1), share=1.5, cap=2.0):
    """Resharing, step by step, until no target exceeds its cap."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    left, target, open_ = share * sum(sizes.values()), {}, set(names)
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total >= cap * sizes[s]}
        if not over:
            return target | {s: left * weight[s] / total for s in open_}
        for s in over:
            target[s] = cap * sizes[s]
        left -= sum(cap * sizes[s] for s in over)
        open_ -= over
    return target


def test_targets_and_taken(spark, edge_docs):
    rows = [(k, "w " * (1 + k % 50), "en", ["a", "b", "c", "d", None][k * k % 5], 0) for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    source_of = {r[0]: r[3] for r in rows}
    found = mixing.mix(docs).collect()
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for r in found:
        sizes[source_of[r["doc_id"]]] += r["size"]
        taken[source_of[r["doc_id"]]] += r["taken"]
        target[source_of[r["doc_id"]]] = r["target"]
        assert 0 <= r["taken"] <= 2 * r["size"] and r["taken"] >= r["epochs"] * r["size"]
    want = expected_targets(sizes)
    assert {s: pytest.approx(t) for s, t in want.items()} == target
    assert all(abs(taken[s] - target[s]) < 1 for s in sizes)
    assert sorted(map(tuple, mixing.mix(docs.repartition(7)).collect())) == sorted(map(tuple, found))


def test_mix_equals_its_sql(spark, edge_docs):
    documents = edge_docs.select("doc_id", "text", "source").toPandas()  # noqa: F841  DuckDB reads it by name
    want = duckdb.sql(sql.MIXING).df()
    got = mixing.mix(edge_docs).select("doc_id", "size", "source_size", "target", "taken").toPandas()
    order = ["doc_id", "size", "taken", "target"]
    assert got.sort_values(order, ignore_index=True).astype(float).equals(
        want[got.columns].sort_values(order, ignore_index=True).astype(float))


def test_documents_are_repeated_whole(spark, edge_docs):
    copies = mixing.mixed_documents(edge_docs)
    assert copies.columns == edge_docs.columns
    assert {r["mix_size"] for r in copies.collect()} == {"extra"}
    assert max(r["count"] for r in copies.groupBy("doc_id", "text").count().collect()) <= 4  # a row given twice


def test_empty(empty_docs):
    assert mixing.mix(empty_docs).count() == 0
    assert mixing.mixed_documents(empty_docs).count() == 0
