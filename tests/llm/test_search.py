"""Exact search by inner product against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from accesslens.llm import max_score, queries

SCHEMA = "vec_id bigint, embedding array<double>, row bigint, least string"


def brute(rows, every, k):
    """(query_id, [(vec_id, score)]) of each query, the plain way in Python's integers."""
    sound = []
    for row in rows:
        vector = row[1]
        if vector is None or any(x is None or not np.isfinite(x) for x in vector):
            continue
        most = 2**62
        sound.append((row[0], [int(np.floor(max(-most, min(most, 256 * x)))) for x in vector]))
    found = []
    for i, query in sound:
        if i is None or i % every:
            continue
        scores = [
            (max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(query, other)))), j)
            for j, other in sound
            if j != i
        ]
        scores.sort(key=lambda s: (-s[0], s[1] is None, s[1] or 0))
        found.append((i, tuple((j, s) for s, j in scores[:k])))
    return sorted(found, key=str)


def searched(spark, rows, every=5, k=5):
    table = spark.createDataFrame([(*row, 1, "x") for row in rows], SCHEMA)
    vectors = max_score.integer_terms(table)
    best = max_score.search(vectors, vectors.where(F.col("id") % every == 0), k)
    found = {}
    for row in best.collect():
        found.setdefault(row.query_id, []).append((row["rank"], row.vec_id, row.score))
    return {i: sorted(r) for i, r in found.items()}


def expected(rows, every=5, k=5):
    return {
        i: [(n, j, s) for n, (j, s) in enumerate(best, 1)]
        for i, best in brute(rows, every, k)
        if best
    }


@pytest.mark.parametrize("case", ["dense", "ragged", "ties", "odd", "huge", "few"])
def test_search_against_brute_force(spark, case, monkeypatch):
    monkeypatch.setattr(max_score, "SMALL_SHARD", 500)
    monkeypatch.setattr(max_score, "SLAB_DOCUMENTS", 16)
    monkeypatch.setattr(max_score, "FIRST_DOCUMENTS", 20)
    random = np.random.default_rng(7)
    n = {"few": 4}.get(case, 150)
    rows = []
    for i in range(n):
        size = int(random.integers(0, 40)) if case == "ragged" else 24
        vector = (random.normal(size=size) * (1e17 if case == "huge" else 0.2)).tolist()
        if case == "ties":
            vector = [float(x) for x in random.integers(-1, 2, 6)]
        rows.append((i, vector))
    if case == "ties":  # a third of all rows are equal
        rows[50:100] = [(i, rows[0][1]) for i in range(50, 100)]
    if case == "odd":
        rows[3:9] = [
            (3, None), (None, rows[4][1]), (5, [None, 1.0]), (6, [float("nan")] * 24),
            (7, [float("inf")] * 24), (8, []),
        ]
        rows.append((11, rows[11][1]))
    assert searched(spark, rows) == expected(rows)


def test_no_vectors(spark):
    assert searched(spark, []) == {}
    assert searched(spark, [(0, [1.0])]) == {}
    assert searched(spark, [(1, [1.0]), (2, [1.0])]) == {}


def test_repeated_queries_have_ranks_of_their_own(spark):
    rows = [(5, [1.0]), (5, [1.0]), (6, [2.0]), (7, [3.0])]
    table = spark.createDataFrame([(*row, 1, "x") for row in rows], SCHEMA)
    vectors = max_score.integer_terms(table)
    best = max_score.search(vectors, vectors.where("id = 5"), 2).collect()
    found = sorted((r.query_id, r["rank"], r.vec_id) for r in best)
    assert found == [(5, 1, 7), (5, 1, 7), (5, 2, 6), (5, 2, 6)]


def test_bounds_spare_most_documents():
    """A query with one large weight looks at the other terms of few documents."""
    random = np.random.default_rng(3)
    vectors = [random.integers(0, 5, 30) for _ in range(1000)]
    for vector in vectors[::100]:
        vector[0] = 200
    (slab,) = max_score.slabs(list(range(1000)), vectors)
    query = np.array([100] + [1] * 29)
    best = max_score.Best(5, -np.inf)
    max_score.search_slab(slab, None, query, best)
    assert best.least > sum(slab.high[1:])  # all but one term are non-essential now
    top = sorted(((-int(v @ query), i) for i, v in enumerate(vectors)))[:5]
    assert [(s, i) for s, _, i in best.rows] == top


def test_query_equals_sql(spark, sf_dir, duck):
    from accesslens.llm.oracle import ORACLE

    rows = queries.op11_max_score(spark, sf_dir).collect()
    found = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in rows)
    assert found == sorted(duck.sql(ORACLE["op11_max_score"]).fetchall())
