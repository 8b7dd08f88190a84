"""Approximate nearest neighbours by an inverted multi-index.

Vectors are cut in two halves; each half has its own codebook (k-means, fitted on a bounded sample: the SAMPLE vectors of a
hash share). A pair of centroids is a cell; every vector is filed under its cell. A query walks the pairs in the order of
summed distance with a heap (both halves' centroids sorted, a pair is pushed once its neighbours towards the origin are
popped) until the cells passed hold SHARE of all vectors and at least MIN_CANDIDATES. What they hold is reranked by the exact
Euclidean distance in double precision; ties go to the smaller id.

Lists are laid out by the first centroid and split into blocks of bounded size, so that a cell with a third of all
vectors is many tasks; queries come in blocks, too, each with the cells that it probes. A block returns its best
``k`` per query, and these meet in a window. Only the cell counts (at most CENTROIDS squared) reach the driver.

Null vectors, zero vectors, vectors holding null or non-finite components, rows with null id and vectors (queries too) of another
length than the most frequent one among the vectors (ties: the longer) take no part. Repeated rows count as rows, but a repeated query is asked once. A query finds all candidates if they are
fewer than k. Extra columns are left alone; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from llm.common import read_table, staged

CENTROIDS = 64
SAMPLE = 20_000
SHARE = 0.45
MIN_CANDIDATES = 2_000
BLOCK = 4096
NEIGHBOURS = 10


def _far(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return (x * x).sum(axis=1)[:, None] + (c * c).sum(axis=1) - 2 * x @ c.T


def kmeans(x: np.ndarray, k: int, rounds: int = 12, seed: int = 1) -> np.ndarray:
    """Lloyd's rounds from distinct random points; an empty centroid stays where it was."""
    x = np.unique(x, axis=0)
    c = x[np.random.default_rng(seed).permutation(len(x))[:k]].copy()
    for _ in range(rounds if len(x) > k else 0):
        near = _far(x, c).argmin(axis=1)
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        n = np.bincount(near, minlength=len(c))
        c[n > 0] = sums[n > 0] / n[n > 0, None]
    return c


def usable(vectors: DataFrame, length: int | None = None) -> DataFrame:
    """(vec_id, vec array<double>) of the rows that take part; ``length`` is the most frequent one unless it is given."""
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vec"))
    ok = (F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vec", lambda x: x != 0))
    v = v.where(F.col("vec_id").isNotNull() & F.col("vec").isNotNull()).where(ok)
    if length is not None:
        return v.where(F.size("vec") == length)
    top = v.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return v.where(F.size("vec") == (top["n"] if top else 0))


def _matrix(col) -> np.ndarray:
    flat = np.asarray(col.flatten())
    return flat.reshape(len(col), -1) if len(col) else flat.reshape(0, 0)


def fit(vectors: DataFrame, total: int, centroids: int = CENTROIDS) -> tuple[np.ndarray, np.ndarray] | None:
    h = F.xxhash64("vec_id")
    share = min(1.0, 2 * SAMPLE / max(1, total))
    rows = vectors.where(h / F.lit(2.0 ** 64) + 0.5 <= share).orderBy(h, "vec_id").limit(SAMPLE).select("vec").toArrow()
    x = _matrix(rows.column("vec").combine_chunks())
    half = x.shape[1] // 2 if len(x) else 0
    return (kmeans(x[:, :half], centroids), kmeans(x[:, half:], centroids)) if len(x) else None


def _file_maker(books):
    def run(batches):
        one, two = books.value
        half = one.shape[1]
        for b in batches:
            if b.num_rows:
                x = _matrix(b.column("vec"))
                yield pa.RecordBatch.from_arrays([
                    b.column("vec_id"), b.column("vec"), pa.array(_far(x[:, :half], one).argmin(axis=1).astype(np.int32)),
                    pa.array(_far(x[:, half:], two).argmin(axis=1).astype(np.int32))], names=["vec_id", "vec", "c1", "c2"])
    return run


def walk(d1: np.ndarray, d2: np.ndarray, counts: np.ndarray, wanted: int) -> list[tuple[int, int]]:
    """Centroid pairs by summed distance until their cells hold ``wanted`` vectors (or all); empty cells are passed over."""
    o1, o2 = np.argsort(d1, kind="stable"), np.argsort(d2, kind="stable")
    s1, s2 = d1[o1].tolist(), d2[o2].tolist()
    heap, reach, out, held = [(s1[0] + s2[0], 0, 0)], [0] * len(s1), [], 0
    total = int(counts.sum())
    while heap and held < min(wanted, total):
        _, i, j = heapq.heappop(heap)
        reach[i] = j + 1
        n = int(counts[o1[i], o2[j]])
        if n:
            out.append((int(o1[i]), int(o2[j])))
            held += n
        # (i + 1, j) once (i + 1, j - 1) is out; (i, j + 1) once (i - 1, j + 1) is out.
        if i + 1 < len(s1) and reach[i + 1] == j:
            heapq.heappush(heap, (s1[i + 1] + s2[j], i + 1, j))
        if j + 1 < len(s2) and (i == 0 or reach[i - 1] > j + 1):
            heapq.heappush(heap, (s1[i] + s2[j + 1], i, j + 1))
    return out


def _probe_maker(books, counts, wanted):
    def run(batches):
        (one, two), n = books.value, counts.value
        half = one.shape[1]
        for b in batches:
            if not b.num_rows:
                continue
            x = _matrix(b.column("vec"))
            d1, d2 = _far(x[:, :half], one), _far(x[:, half:], two)
            rows: dict[str, list] = {"row": [], "c1": [], "cells": []}
            for k in range(len(x)):
                cells: dict[int, list[int]] = {}
                for a, c in walk(d1[k], d2[k], n, wanted):
                    cells.setdefault(a, []).append(c)
                for a, cs in cells.items():
                    rows["row"].append(k)
                    rows["c1"].append(a)
                    rows["cells"].append(cs)
            pick = pa.array(rows["row"], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("vec_id").take(pick), b.column("vec").take(pick), pa.array(rows["c1"], pa.int32()),
                                              pa.array(rows["cells"], pa.list_(pa.int32()))], names=["query_id", "vec", "c1", "cells"])
    return run


def _best(q: np.ndarray, qid: int, x: np.ndarray, ids: np.ndarray, rough: np.ndarray, k: int) -> list[tuple[int, int, float]]:
    """The k nearest of one query among x by exact distance; ``rough`` squared distances only preselect, with a margin."""
    ok = np.flatnonzero(ids != qid)
    if len(ok) > k:
        r = rough[ok]
        cut = np.partition(r, k - 1)[k - 1]
        ok = ok[r <= cut + 1e-9 * (1 + abs(cut)) + 1e-12 * float(q @ q)]
    diff = np.ascontiguousarray(x[ok] - q)
    dist = np.sqrt((diff * diff).sum(axis=1))
    order = np.lexsort((ids[ok], dist))[:k]
    return [(qid, int(ids[ok[t]]), float(dist[t])) for t in order]


def _rerank_maker(k: int):
    def run(queries: pa.Table, lists: pa.Table) -> pa.Table:
        out = []
        if queries.num_rows and lists.num_rows:
            x, ids = _matrix(lists.column("vec").combine_chunks()), lists.column("vec_id").to_numpy()
            c2 = lists.column("c2").to_numpy()
            q, qids = _matrix(queries.column("vec").combine_chunks()), queries.column("query_id").to_numpy()
            cells = queries.column("cells").to_pylist()
            for at in range(0, len(q), 256):
                rough = _far(q[at:at + 256], x)
                for t in range(at, min(at + 256, len(q))):
                    hit = np.flatnonzero(np.isin(c2, cells[t]))
                    out += _best(q[t], int(qids[t]), x[hit], ids[hit], rough[t - at][hit], k)
        return pa.table({"query_id": pa.array([r[0] for r in out], pa.int64()), "vec_id": pa.array([r[1] for r in out], pa.int64()),
                         "score": pa.array([r[2] for r in out], pa.float64())})
    return run


def search(vectors: DataFrame, queries: DataFrame, k: int = NEIGHBOURS, share: float = SHARE, centroids: int = CENTROIDS) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``queries`` its k nearest rows of ``vectors`` with another vec_id."""
    spark = vectors.sparkSession
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    base = usable(vectors)
    total = base.count()
    codes = fit(base, total, centroids)
    if codes is None:
        return empty
    books = spark.sparkContext.broadcast(codes)
    index = staged(base.mapInArrow(_file_maker(books), "vec_id long, vec array<double>, c1 int, c2 int"), "index")
    counts = np.zeros((len(codes[0]), len(codes[1])), np.int64)
    for r in index.groupBy("c1", "c2").agg(F.count("*").alias("n")).collect():
        counts[r["c1"], r["c2"]] = r["n"]
    wanted = max(MIN_CANDIDATES, int(share * total))
    asked = usable(queries, codes[0].shape[1] + codes[1].shape[1]).distinct()
    n_blocks = max(1, -(-asked.count() // BLOCK))
    chunks = F.element_at(F.array(*(F.lit(max(1, -(-int(n) // BLOCK))) for n in counts.sum(axis=1))), F.col("c1") + 1)
    probes = asked.mapInArrow(_probe_maker(books, spark.sparkContext.broadcast(counts), wanted),
                              "query_id long, vec array<double>, c1 int, cells array<int>")
    probes = (probes.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(n_blocks)).cast("int"))
              .withColumn("chunk", F.explode(F.sequence(F.lit(0), chunks - 1))))
    lists = (index.withColumn("chunk", F.pmod(F.xxhash64("vec_id"), chunks).cast("int"))
             .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))))
    keys = ["c1", "chunk", "block"]
    some = probes.groupBy(*keys).cogroup(lists.groupBy(*keys)).applyInArrow(_rerank_maker(k), "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return some.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op8_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest vectors found for each vector whose id is divisible by 100."""
    vectors = read_table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return search(vectors, vectors.where("vec_id % 100 = 0"))
