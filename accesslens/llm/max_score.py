"""Exact top-k search by inner product with MaxScore.

A vector is a document, its components are terms with whole-numbered, signed weights. The
documents are dealt out to shards of a bounded number of components, and a shard's
postings are laid out by term, in slabs of documents with about equally many terms: a
term's list in a slab has the weights of all of the slab's documents, 0 where it is absent.

The most that a term can add to the score of a document of a slab is the query's weight
times the slab's largest weight of the same sign. In the order of these bounds, the terms
that together stay below the query's k-th best score so far are non-essential: a document
that has only those can't be among the best. The lists of the essential terms are
traversed; then the non-essential ones are probed from the largest bound on, only for documents
whose score with all bounds that are left still reaches the k-th best. Equal scores
reach it, so ties go to the smaller id whatever the order. A slab whose bounds stay below
it altogether is skipped.

The k-th best score starts with that among a few documents that every task gets, and rises
from slab to slab. Each shard returns at most k documents a query, which Spark merges. Queries
stream through the shards, so no task holds them all, and each is sent to each shard: that
is the work of comparing a stated set of queries with all rows, less what bounds save.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SCALE = 256
#: Components of a shard's documents, and of the shards of small tables, which are
#: searched by as many tasks as there are cores.
SHARD, SMALL_SHARD = 8_000_000, 200_000
#: Documents and components of a slab.
SLAB_DOCUMENTS, SLAB = 2_048, 1 << 18
#: Documents and components that every task gets to start with.
FIRST_DOCUMENTS, FIRST = 1_024, 1 << 18
#: Components of larger size count as this. Sums below 2^53 are exact as doubles.
MOST, EXACT = 2.0**62, 2.0**53
LONGS = (-(2**63), 2**63 - 1)


def integer_terms(
    vectors: DataFrame, id_column: str = "vec_id", vector: str = "embedding", scale: int = SCALE
) -> DataFrame:
    """(id, terms): each component x as floor(scale * x), with x as double.

    Vectors that are null or have a null or non-finite component are left out.
    """
    terms = F.transform(vector, lambda x: x.cast("double"))
    whole = vectors.select(F.col(id_column).cast("bigint").alias("id"), terms.alias("terms"))
    largest = float("inf")
    sound = F.forall(
        "terms", lambda x: x.isNotNull() & ~F.isnan(x) & (x < largest) & (x > -largest)
    )
    whole = whole.where(F.col("terms").isNotNull() & sound)

    def floor(x):
        return F.floor(F.greatest(F.least(x * scale, F.lit(MOST)), F.lit(-MOST)))

    return whole.select("id", F.transform("terms", floor).cast("array<bigint>").alias("terms"))


class Slab:
    """Postings of some documents: a row of ``weights`` for each term."""

    def __init__(self, ids: list[int | None], vectors: list[np.ndarray]):
        self.known = np.array([i is not None for i in ids], bool)
        self.ids = np.array([0 if i is None else i for i in ids], np.int64)
        n_terms = max(map(len, vectors))
        rows = np.zeros((len(vectors), n_terms), np.int64)
        for row, vector in zip(rows, vectors, strict=True):
            row[: len(vector)] = vector
        self.size = float(np.abs(rows.astype(np.float64)).max(initial=0))
        kind = np.float64 if self.size < EXACT else object
        self.weights = np.ascontiguousarray(rows.T).astype(kind)
        self.high = np.maximum(rows.max(axis=0, initial=0), 0).astype(kind)
        self.low = np.minimum(rows.min(axis=0, initial=0), 0).astype(kind)


def slabs(ids: list[int | None], vectors: list[np.ndarray]) -> Iterator[Slab]:
    """Documents in slabs of bounded size, those with equally many terms together."""
    order = sorted(range(len(vectors)), key=lambda i: len(vectors[i]))
    start = 0
    for end in range(1, len(order) + 1):
        width = len(vectors[order[end]]) if end < len(order) else math.inf
        if end - start >= SLAB_DOCUMENTS or (end - start + 1) * width > SLAB:
            part = order[start:end]
            yield Slab([ids[i] for i in part], [vectors[i] for i in part])
            start = end


class Best:
    """The k best documents of a query so far; ``least`` is the score to reach."""

    def __init__(self, k: int, least: float):
        self.k, self.least = k, least
        self.rows: list[tuple[int, bool, int]] = []

    def add(self, scores: np.ndarray, known: np.ndarray, ids: np.ndarray) -> None:
        if scores.dtype == object:
            scores = np.clip(scores, *LONGS)
        if len(scores) > self.k:
            at = len(scores) - self.k
            enough = np.partition(scores, at)[at] if scores.dtype != object else sorted(scores)[at]
            few = scores >= enough
            scores, known, ids = scores[few], known[few], ids[few]
        rows = zip(scores.tolist(), known.tolist(), ids.tolist(), strict=True)
        self.rows += [(-int(score), not named, i) for score, named, i in rows]
        self.rows = sorted(self.rows)[: self.k]
        if len(self.rows) == self.k:
            self.least = max(self.least, -self.rows[-1][0])


def search_slab(slab: Slab, own: int | None, query: np.ndarray, best: Best) -> None:
    """Adds to ``best`` the documents of a slab that are among the k best.

    A document with the query's own id is none of its candidates.
    """
    query = query[: len(slab.weights)]
    exact = np.abs(query.astype(np.float64)).sum() * max(slab.size, 1.0) < EXACT
    kind = np.float64 if exact and slab.weights.dtype != object else object
    query = query.astype(kind)
    weights = slab.weights if slab.weights.dtype == kind else slab.weights.astype(kind)
    bounds = np.maximum(query * slab.high[: len(query)], query * slab.low[: len(query)])
    order = np.argsort(bounds, kind="stable")
    sums = np.cumsum(bounds[order])
    # non-essential: those whose bounds together stay below the least score
    n_free = int(np.searchsorted(sums, best.least, side="left")) if len(order) else 0
    if n_free == len(order) and best.least > (sums[-1] if len(order) else 0):
        return
    n_free = min(n_free, max(len(order) - 1, 0))
    essential = np.sort(order[n_free:])
    scores = query[essential] @ weights[essential] if len(essential) else np.zeros(slab.ids.shape)
    rest = sums[n_free - 1] if n_free else 0
    alive = np.flatnonzero((scores + rest >= best.least) & ~(slab.known & (slab.ids == own)))
    scores = scores[alive]
    for at in range(n_free - 1, -1, -1):
        if not len(alive):
            return
        term = order[at]
        rest = sums[at - 1] if at else 0
        scores = scores + query[term] * weights[term][alive]
        reach = scores + rest >= best.least
        alive, scores = alive[reach], scores[reach]
    best.add(scores, slab.known[alive], slab.ids[alive])


def _vectors(column: pa.ListArray) -> list[np.ndarray]:
    values = column.flatten().to_numpy(zero_copy_only=False)
    ends = np.cumsum(np.asarray(column.value_lengths()))
    return np.split(values, ends[:-1]) if len(ends) else []


def _with_first_scores(queries: DataFrame, first: list[Slab], k: int) -> DataFrame:
    """Queries with ``least``, their k-th best score among a few documents, if so many."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            least = []
            for own, query in zip(batch.column(0).to_pylist(), _vectors(batch.column(2)), strict=True):
                best = Best(k, -math.inf)
                for slab in first:
                    search_slab(slab, own, query, best)
                least.append(float(best.least))
            columns = [*batch.columns, pa.array(least, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "least"])

    return queries.mapInArrow(over, "id bigint, row bigint, terms array<bigint>, least double")


def _search_shards(rows: DataFrame, k: int) -> DataFrame:
    """The best of each query in each shard; a shard's documents come before the queries."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int | None] = []
        vectors: list[np.ndarray] = []
        index: list[Slab] | None = None
        for batch in batches:
            found: list[tuple] = []
            columns = zip(
                *[batch.column(i).to_pylist() for i in range(4)],
                _vectors(batch.column(4)),
                strict=True,
            )
            for is_query, own, row, least, vector in columns:
                if not is_query:
                    ids.append(own)
                    vectors.append(vector.astype(np.int64))
                    continue
                if index is None:
                    index = list(slabs(ids, vectors))
                    ids, vectors = [], []
                # a double of a whole number above 2^53 may be rounded up
                best = Best(k, least - abs(least) * 1e-15 if abs(least) >= EXACT else least)
                for slab in index:
                    search_slab(slab, own, vector, best)
                found += [
                    (own, row, None if unnamed else i, -score)
                    for score, unnamed, i in best.rows
                ]
            table = list(zip(*found, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, pa.int64()) for column in table],
                names=["query_id", "row", "vec_id", "score"],
            )

    columns = rows.select("is_query", "id", "row", "least", "terms")
    return columns.mapInArrow(over, "query_id bigint, row bigint, vec_id bigint, score bigint")


def search(documents: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest inner products of each query.

    Both tables have ``id`` and ``terms``, an array of whole numbers; other columns are not read.
    All documents are candidates but those with the query's own id; fewer than k give fewer
    rows, and ties go to the smaller id, null last. A null id is an id like others for a
    document, and no query's own. Vectors of different lengths are compared as if the shorter had
    zeros, empty ones score 0. A null or a null component takes no part. Repeated rows are
    documents of their own, and queries of their own with the same query_id. Scores beyond
    64 bits are the largest or smallest of those. An empty table gives no rows.
    """
    spark = documents.sparkSession
    sound = "terms IS NOT NULL AND NOT exists(terms, x -> x IS NULL)"
    whole = F.col("terms").cast("array<bigint>").alias("terms")
    documents = documents.where(sound).select(F.col("id").cast("bigint"), whole)
    queries = queries.where(sound).select(
        F.col("id").cast("bigint"), F.monotonically_increasing_id().alias("row"), whole
    )
    sizes = F.size("terms")
    total, longest = documents.agg(F.sum(sizes), F.max(sizes)).first()
    few = min(FIRST_DOCUMENTS, FIRST // max(longest or 1, 1))
    chosen = documents.limit(few).collect() if total and few > k else []
    vectors = [np.array(row.terms, np.int64) for row in chosen]
    queries = _with_first_scores(queries, list(slabs([r.id for r in chosen], vectors)), k)
    n_shards = max(
        1,
        math.ceil((total or 0) / SHARD),
        min(spark.sparkContext.defaultParallelism, math.ceil((total or 0) / SMALL_SHARD)),
    )
    # dealt out by number, not by a key of which there may be many
    shard = F.pmod(F.monotonically_increasing_id(), F.lit(n_shards)).cast("int")
    nothing = F.lit(None)
    held = documents.select(
        shard.alias("shard"), F.lit(False).alias("is_query"), "id",
        nothing.cast("bigint").alias("row"), nothing.cast("double").alias("least"), "terms",
    )
    every_shard = F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1))).alias("shard")
    asked = queries.select(every_shard, F.lit(True).alias("is_query"), "id", "row", "least", "terms")
    rows = held.unionByName(asked).repartitionById(n_shards, F.col("shard"))
    best = _search_shards(rows.sortWithinPartitions("is_query"), k)
    order = Window.partitionBy("query_id", "row").orderBy(
        F.desc("score"), F.asc_nulls_last("vec_id")
    )
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
