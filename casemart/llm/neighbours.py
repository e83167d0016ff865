"""Approximate nearest neighbours made exact: a block matrix join on int8 tiles.

Vectors are stored in blocks of up to `block_rows`, quantised to int8 with one scale per vector.
Every block of queries meets every block of vectors in a tile; the product of the int8 matrices
gives each inner product with an error bound from the two quantisation errors, so only pairs that
can still be among a query's k best survive. Those are computed again from the original vectors in
double precision, and each tile's k best per query are merged by a heap.

Defined cases: null, empty or all-zero vectors, and vectors with a null or non-finite component,
take no part; vectors meet only vectors of equal length; a query never finds rows of its own id;
equal rows count once; ties go to the smaller id; a null id takes no part; an empty table gives an
empty result; columns of other names are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casemart.llm.common import bucket_of, written

BLOCK = "dim int, block long, n int, ids binary, vectors binary"
FOUND = "query_id long, vec_id long, score double"


def usable(vectors: DataFrame) -> DataFrame:
    """(id, vector as array of double, dim) of the rows that take part, each once."""
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("id"), F.col("embedding").cast("array<double>").alias("v")
    )
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.filter(
        F.col("id").isNotNull() & finite & F.exists("v", lambda x: x != 0)
    ).distinct().withColumn("dim", F.size("v"))


def blocks_of(rows: DataFrame, block_rows: int) -> DataFrame:
    """Rows packed into blocks: ids and vectors as bytes, one row per block."""
    n = rows.count()
    many = max(1, -(-n // block_rows))

    def pack(part: pa.Table) -> pa.Table:
        ids = part["id"].to_numpy()
        order = np.argsort(ids, kind="stable")
        dim = part["dim"][0].as_py()
        flat = part["v"].combine_chunks().flatten().to_numpy().reshape(len(ids), dim)
        return pa.table(
            {
                "dim": pa.array([dim], pa.int32()),
                "block": [part["block"][0].as_py()],
                "n": pa.array([len(ids)], pa.int32()),
                "ids": [ids[order].tobytes()],
                "vectors": [flat[order].tobytes()],
            }
        )

    return (
        rows.withColumn("block", bucket_of(F.col("id"), many))
        .groupBy("dim", "block")
        .applyInArrow(pack, BLOCK)
    )


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 values (as float32, so that products are exact), scales, norms of x^ and of x - x^."""
    peak = np.abs(x).max(axis=1)
    scale = np.where(peak > 0, peak, 1.0) / 127
    q = np.rint(x / scale[:, None])
    near = q * scale[:, None]
    return (
        q.astype(np.float32),
        scale,
        np.sqrt((near**2).sum(axis=1)),
        np.sqrt(((x - near) ** 2).sum(axis=1)),
    )


def tile_best(
    query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, id, score) of each query's k best in this tile, exact."""
    a, a_scale, a_norm, a_error = quantise(queries)
    b, b_scale, b_norm, b_error = quantise(vectors)
    dim = max(1, queries.shape[1])
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for start in range(0, len(a), 64):  # 64 queries at a time bound the size of the product
        rows = slice(start, start + 64)
        exact = dim <= 1024  # 1024 * 127 * 127 < 2**24: float32 sums of int8 products are exact
        product = (a[rows] @ b.T).astype(np.float64) if exact else (
            a[rows].astype(np.float64) @ b.T.astype(np.float64)
        )
        guess = product * a_scale[rows, None] * b_scale
        bound = (
            a_error[rows, None] * (b_norm + b_error) + a_norm[rows, None] * b_error
        ) * (1 + 1e-9) + 1e-9 * np.abs(guess)
        own = query_ids[rows, None] == ids
        low = np.where(own, -np.inf, guess - bound)
        high = np.where(own, -np.inf, guess + bound)
        if len(ids) > k:
            floor = np.partition(low, len(ids) - k, axis=1)[:, len(ids) - k]
        else:
            floor = np.full(len(low), -np.inf)
        for i in range(len(low)):
            keep = np.flatnonzero((high[i] >= floor[i]) & ~own[i])
            score = (vectors[keep] * queries[start + i]).sum(axis=1)
            best = np.lexsort((ids[keep], -score))[:k]
            out.append(
                (np.full(len(best), query_ids[start + i]), ids[keep][best], score[best])
            )
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    return tuple(np.concatenate(x) for x in zip(*out))


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = 20, query_rows: int = 512,
    block_rows: int = 8192,
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k largest inner products, nearest first."""
    base = written(blocks_of(usable(vectors), block_rows), "ann-blocks")
    asked = blocks_of(usable(queries), query_rows).select(
        "dim", F.col("block").alias("q_block"), F.col("ids").alias("q_ids"),
        F.col("vectors").alias("q_vectors"),
    )
    # Each block of queries is sent to each block of vectors of its length: a join by block number.
    places = base.groupBy("dim").agg(F.collect_list("block").alias("places"))
    tiles = (
        asked.join(places, "dim")
        .withColumn("block", F.explode("places"))
        .drop("places")
        .repartition("dim", "block", "q_block")
        .join(base.select("dim", "block", "ids", "vectors"), ["dim", "block"])
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                q, v, s = tile_best(
                    np.frombuffer(row["q_ids"], dtype=np.int64),
                    np.frombuffer(row["q_vectors"]).reshape(-1, row["dim"]),
                    np.frombuffer(row["ids"], dtype=np.int64),
                    np.frombuffer(row["vectors"]).reshape(-1, row["dim"]),
                    k,
                )
                yield pa.record_batch([q, v, s], names=["query_id", "vec_id", "score"])

    found = tiles.select("dim", "q_ids", "q_vectors", "ids", "vectors").mapInArrow(run, FOUND)
    # At most k rows per query and task leave before the shuffle, then one heap per query.
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    few = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

    def merge(part: pd.DataFrame) -> pd.DataFrame:
        rows = set(zip((-part["score"]).tolist(), part["vec_id"].tolist()))
        best = heapq.nsmallest(k, rows)
        return pd.DataFrame(
            {
                "query_id": part["query_id"].iloc[0],
                "rank": np.arange(1, len(best) + 1, dtype=np.int32),
                "vec_id": [v for _, v in best],
                "score": [-s for s, _ in best],
            }
        )

    return few.drop("rank").groupBy("query_id").applyInPandas(
        merge, "query_id long, rank int, vec_id long, score double"
    )


def digest(embeddings: DataFrame, k: int = 20) -> DataFrame:
    """The k nearest of every vector whose id is divisible by 20, among all others."""
    return nearest(embeddings, embeddings.filter("vec_id % 20 = 0"), k)
