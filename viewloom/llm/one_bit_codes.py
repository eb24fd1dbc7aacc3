"""Nearest neighbours with randomly rotated one-bit codes.

A vector is taken relative to the mean, scaled to unit length and rotated at random; its code is the signs, packed. Two
numbers go with it: the length before scaling, and the inner product of the rotated vector with the one its code stands for.
From code and numbers the inner product with a query is estimated without bias, with an error bound that holds with high
probability. Vectors whose bound doesn't rule them out are reranked by their true distance.

Rows are dealt out in blocks by a hash of their id, queries likewise, and every block of queries meets every block of rows:
the stated set of queries is searched against all rows. Each meeting gives the `k` best of each of its queries.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from viewloom.llm.common import query, scratch, stored, table

#: Rows of a block, and queries of a block.
ROWS, QUERIES_PER_BLOCK = 4096, 4096
#: Width of the error bound in standard deviations, as published for codes of this kind.
WIDTH = 1.9
SEED = 11
#: Queries whose estimates are held at once.
AT_ONCE = 128


def usable(vector: Column) -> Column:
    """Whether a vector takes part: there, with components that are all finite, and not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def rotation(size: int) -> np.ndarray:
    """A random orthogonal matrix, the same on every machine up to rounding."""
    q, r = np.linalg.qr(np.random.default_rng(SEED).standard_normal((size, size)))
    return q * np.sign(np.diag(r))


def matrix(column: pa.ChunkedArray | pa.Array, size: int) -> np.ndarray:
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return array.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)


def encode(vectors: np.ndarray, mean: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed signs, lengths, and inner products of the rotated unit vectors with their codes' unit vectors."""
    apart = vectors - mean
    length = np.sqrt((apart**2).sum(axis=1))
    unit = (apart / np.where(length > 0, length, 1)[:, None]) @ turn
    own = np.abs(unit).sum(axis=1) / np.sqrt(unit.shape[1])
    return np.packbits(unit > 0, axis=1), length, np.where(length > 0, own, 1.0)


def mean_of(rows: DataFrame, size: int) -> np.ndarray:
    """Mean of all vectors; every partition sends one row of sums for each component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(size), 0
        for batch in batches:
            total += matrix(batch.column("vector"), size).sum(axis=0)
            n += batch.num_rows
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[np.arange(size), -1]), pa.array(np.r_[total, n])], ["at", "sum"])

    sums = {r["at"]: r["sum"] for r in rows.select("vector").mapInArrow(run, "at bigint, sum double").groupBy("at").agg(F.sum("sum").alias("sum")).collect()}
    return np.array([sums[i] for i in range(size)]) / max(sums[-1], 1)


def index(rows: DataFrame, mean: np.ndarray, size: int) -> DataFrame:
    """`rows` (vec_id, vector) with `code`, `length` and `own`."""
    kind = rows.schema["vector"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = rotation(size)
        for batch in batches:
            code, length, own = encode(matrix(batch.column("vector"), size), mean, turn)
            arrays = [batch.column("vec_id"), batch.column("vector"), pa.array([c.tobytes() for c in code], pa.binary()), pa.array(length), pa.array(own)]
            yield pa.RecordBatch.from_arrays(arrays, ["vec_id", "vector", "code", "length", "own"])

    return rows.select("vec_id", "vector").mapInArrow(run, f"vec_id bigint, vector {kind}, code binary, length double, own double")


def search(queries: pa.Table, rows: pa.Table, mean: np.ndarray, size: int, k: int) -> pa.Table:
    """The k best of `rows` for each of `queries`: (query_id, vec_id, score)."""
    out = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
    if not len(queries) or not len(rows):
        return out.empty_table()
    ids, vectors = rows.column("vec_id").to_numpy(), matrix(rows.column("vector"), size)
    # Repeated rows count once.
    first = np.unique(np.c_[ids.view(np.float64), vectors].view(np.dtype((np.void, 8 * (size + 1)))).ravel(), return_index=True)[1]
    ids, vectors = ids[first], vectors[first]
    length, own = (rows.column(c).to_numpy()[first] for c in ("length", "own"))
    packed = np.frombuffer(b"".join(rows.column("code").to_pylist()), dtype=np.uint8).reshape(len(rows), -1)[first]
    signs = np.unpackbits(packed, axis=1, count=size).astype(np.float32) * 2 - 1
    asked, wanted = queries.column("vec_id").to_numpy(), matrix(queries.column("vector"), size)
    turn = rotation(size)
    apart = wanted - mean
    reach = np.sqrt((apart**2).sum(axis=1))
    unit = ((apart / np.where(reach > 0, reach, 1)[:, None]) @ turn).astype(np.float32)
    slack = WIDTH * np.sqrt(np.maximum(1 - own**2, 0) / own**2 / max(size - 1, 1))
    got: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for at in range(0, len(asked), AT_ONCE):
        inner = (unit[at : at + AT_ONCE] @ signs.T) / np.sqrt(size) / own.astype(np.float32)
        for j in range(len(inner)):
            q = at + j
            other = np.flatnonzero(ids != asked[q])
            if not len(other):
                continue
            scale = 2 * length[other] * reach[q]
            estimate = length[other] ** 2 + reach[q] ** 2 - scale * inner[j, other]
            least = estimate - scale * slack[other]
            # The true distances of the most promising give the bar that the others' bounds must pass.
            n = min(4 * k, len(other))
            lead = np.argpartition(estimate, n - 1)[:n]
            true = np.sqrt(((vectors[other[lead]] - wanted[q]) ** 2).sum(axis=1))
            bar = np.partition(true, min(k, n) - 1)[min(k, n) - 1] if n >= k else np.inf
            chosen = np.union1d(lead, np.flatnonzero(least <= bar**2 * (1 + 1e-9)))
            true = np.sqrt(((vectors[other[chosen]] - wanted[q]) ** 2).sum(axis=1))
            best = np.lexsort((ids[other[chosen]], true))[:k]
            got.append((np.full(len(best), asked[q]), ids[other[chosen[best]]], true[best]))
    if not got:
        return out.empty_table()
    return pa.table([pa.array(np.concatenate(x)) for x in zip(*got, strict=True)], schema=out)


def nearest(vectors: DataFrame, queries: Column, k: int = 10) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest other rows found for each row of `vectors` (vec_id, embedding) where
    `queries` holds, by Euclidean distance, nearest first, ties to the smaller vec_id.

    Vectors that are null, zero, or hold null or non-finite components take no part, nor do those without vec_id or of
    another length than most (ties: the longer). Repeated rows count once; a query's own id is never its neighbour. With
    fewer than k other rows all are returned. An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    folder = scratch(spark)
    rows = vectors.where(F.col("vec_id").isNotNull() & usable(F.col("embedding"))).select("vec_id", F.col("embedding").alias("vector"), queries.alias("asks"))
    sizes = rows.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    if sizes is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    size, count = sizes["size"], sizes["count"]
    rows = rows.where(F.size("vector") == size)
    mean = mean_of(rows, size)
    coded = stored(index(rows, mean, size), f"{folder}/index")
    asking = rows.where("asks").select("vec_id", "vector").distinct()
    asking = stored(asking, f"{folder}/queries")
    row_blocks, query_blocks = -(-count // ROWS), max(1, -(-asking.count() // QUERIES_PER_BLOCK))
    numbered = lambda n: F.sequence(F.lit(0), F.lit(n - 1))
    own = lambda n: F.pmod(F.xxhash64(F.lit("block"), "vec_id"), F.lit(n)).cast("int")
    data = coded.withColumn("rows", own(row_blocks)).withColumn("asked", F.explode(numbered(query_blocks)))
    ask = asking.withColumn("asked", own(query_blocks)).withColumn("rows", F.explode(numbered(row_blocks)))
    found = (
        ask.groupBy("rows", "asked").cogroup(data.groupBy("rows", "asked"))
        .applyInArrow(lambda q, d: search(q, d, mean, size, k), "query_id bigint, vec_id bigint, score double")
    )
    ranked = found.distinct().withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


@query("op2_one_bit_codes")
def op2_one_bit_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)
