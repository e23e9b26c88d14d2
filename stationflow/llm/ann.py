"""Nearest neighbours by randomly rotated one-bit codes.

Every vector, less the mean of all, is scaled to length 1, padded to ``BITS`` components, rotated at random and kept as
one bit per component, with two numbers: its distance from the mean and the inner product of the rotated vector with
its own code. From the bits of a vector and the rotated query their inner product is estimated, and with it the
distance; the error of the estimate is bounded by ``EPSILON`` standard deviations. A vector is compared exactly if its
lower bound does not exceed the k-th smallest upper bound that the query has seen in the block.

Vectors are dealt into blocks by a hash of their id and queries into groups; a task compares one group with one block
and returns the k best per query, with exact distances. The k best of all blocks are the result. So no pair leaves a task other than
these k per query and block. The mean is exact, and the rotation follows from a seed: nothing is fitted on a sample.

Equal vectors: of one value only the k + 1 smallest ids can be among the k nearest of any query, so only those are kept
(found by a limit per value that is applied before rows move). Equal queries are searched once. Ties go to the smaller
id. Vectors that are null, zero or hold null or non-finite components take no part, nor do vectors of another dimension
than the most frequent one (the smaller one, if several are). Null ids take no part. Repeated rows of one id count once.
Fewer than k others: all of them. Extra columns are dropped.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import ship, staged

BITS = 256
K = 10
EPSILON = 2.2
SEED = 7
BLOCK_ROWS = 20_000
GROUP_QUERIES = 5_000


@lru_cache(maxsize=4)
def rotation(dim: int, bits: int, seed: int) -> np.ndarray:
    """``dim`` orthonormal rows of length ``bits``: a random rotation of vectors padded with zeros."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((bits, dim)))
    return np.ascontiguousarray((q * np.sign(np.diag(r))).T, dtype=np.float32)


def bits_for(dim: int, least: int = BITS) -> int:
    return max(least, -(-dim // 64) * 64)


def encode(vectors: np.ndarray, mean: np.ndarray, bits: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed signs, distance from the mean, and inner product with the code (1 / sqrt(bits) per component)."""
    centred = vectors.astype(np.float64) - mean
    norms = np.linalg.norm(centred, axis=1)
    unit = centred / np.where(norms > 0, norms, 1)[:, None]
    turned = unit.astype(np.float32) @ rotation(len(mean), bits, seed)
    own = np.abs(turned).sum(1) / np.sqrt(bits)
    return np.packbits(turned > 0, axis=1), norms, np.where(norms > 0, own, 1.0)


def _search_block(ids, vectors, codes, norms, own, queries, mean, k, seed, epsilon):
    """Per query: positions and exact distances of the k nearest in the block."""
    bits = codes.shape[1] * 8
    signs = np.unpackbits(codes, axis=1).astype(np.float32)
    turn = rotation(len(mean), bits, seed)
    wide = vectors.astype(np.float64)
    error = epsilon * np.sqrt(np.maximum(1 / own**2 - 1, 0) / (bits - 1))
    for q in queries.astype(np.float64):
        centred = q - mean
        length = float(np.linalg.norm(centred))
        turned = (centred / (length or 1)).astype(np.float32) @ turn
        product = (2 * (signs @ turned) - turned.sum()) / np.sqrt(bits) / own
        middle, spread = norms**2 + length**2 - 2 * norms * length * product, 2 * norms * length * error
        few = min(k, len(ids))
        limit = np.partition(middle + spread, few - 1)[few - 1]
        near = np.flatnonzero(middle - spread <= limit)
        exact = np.sqrt(((wide[near] - q) ** 2).sum(1))
        best = np.lexsort((ids[near], exact))[:k]
        yield near[best], exact[best]


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and vector of the rows that take part, one per id."""
    v = F.col("vector")
    fine = (
        F.col("vec_id").isNotNull()
        & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists(v, lambda x: x != 0)
    )
    clean = vectors.filter(fine)
    sizes = clean.groupBy(F.size("vector").alias("dim")).agg(F.count("*").alias("n"))
    most = sizes.orderBy(F.desc("n"), "dim").limit(1).collect()
    dim = most[0]["dim"] if most else 0
    return clean.filter(F.size("vector") == dim)


def nearest(
    vectors: DataFrame,
    is_query,
    k: int = K,
    bits: int = BITS,
    epsilon: float = EPSILON,
    seed: int = SEED,
    block_rows: int = BLOCK_ROWS,
    group_queries: int = GROUP_QUERIES,
) -> DataFrame:
    """query_id, rank, vec_id and score (Euclidean distance) of the k nearest others of each query.

    ``vectors``: vec_id (long) and vector (array of float or double); ``is_query``: which rows are queries.
    """
    spark = vectors.sparkSession
    ship(spark)
    kind = "array<double>"
    rows = staged(usable(vectors.select("vec_id", F.col("vector").cast(kind).alias("vector"))), "vectors")
    # -0.0 and 0.0 are one value.
    value = F.xxhash64(F.transform("vector", lambda x: x + F.lit(0.0)))
    per_id = Window.partitionBy("vec_id").orderBy("value")
    per_value = Window.partitionBy("value").orderBy("vec_id")
    one_each = rows.withColumn("value", value).withColumn("copy", F.row_number().over(per_id)).filter("copy = 1")
    base = one_each.withColumn("copy", F.row_number().over(per_value)).filter(F.col("copy") <= k + 1).drop("copy")
    base = staged(base, "base")
    asked = one_each.filter(is_query).select("vec_id", "value", "vector")

    n = base.count()
    if not n:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    means = base.select(F.posexplode("vector").alias("at", "x")).groupBy("at").agg(F.avg("x").alias("x"))
    mean = np.array([r["x"] for r in sorted(means.collect(), key=lambda r: r["at"])])  # one row per dimension
    width = bits_for(len(mean), bits)
    blocks = max(1, -(-n // block_rows))

    def coded(batches):
        import pyarrow as pa

        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.asarray(batch.column(1).flatten()).reshape(batch.num_rows, -1)
            codes, norms, own = encode(x, mean, width, seed)
            made = [pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(norms), pa.array(own)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *made], ["vec_id", "vector", "code", "norm", "own"])

    index = staged(
        base.select("vec_id", "vector").mapInArrow(coded, f"vec_id bigint, vector {kind}, code binary, norm double, own double"),
        "codes",
    ).withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))

    first = Window.partitionBy("value").orderBy("vec_id")
    distinct = asked.withColumn("copy", F.row_number().over(first)).filter("copy = 1").select("value", "vector")
    groups = max(1, -(-distinct.count() // group_queries))
    every_group, every_block = F.sequence(F.lit(0), F.lit(groups - 1)), F.sequence(F.lit(0), F.lit(blocks - 1))
    index = index.withColumn("part", F.explode(every_group))
    distinct = distinct.withColumn("part", F.pmod("value", F.lit(groups)).cast("int")).withColumn("block", F.explode(every_block))

    def search(key, left, right):
        import pyarrow as pa

        schema = pa.schema([("value", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()

        def matrix(table):
            flat = table.column("vector").combine_chunks().flatten()
            return np.asarray(flat).reshape(table.num_rows, -1)

        ids, x = np.asarray(left.column("vec_id")), matrix(left)
        codes = np.frombuffer(b"".join(left.column("code").to_pylist()), np.uint8).reshape(len(ids), -1)
        norms, own = np.asarray(left.column("norm")), np.asarray(left.column("own"))
        values, q = np.asarray(right.column("value")), matrix(right)
        out = [[], [], []]
        for value, (at, exact) in zip(values, _search_block(ids, x, codes, norms, own, q, mean, k + 1, seed, epsilon), strict=True):
            out[0].append(np.full(len(at), value))
            out[1].append(ids[at])
            out[2].append(exact)
        return pa.Table.from_arrays([pa.array(np.concatenate(o)) for o in out], schema=schema)

    found = (
        index.groupBy("block", "part")
        .cogroup(distinct.groupBy("block", "part"))
        .applyInArrow(search, "value bigint, vec_id bigint, score double")
    )
    order = Window.partitionBy("value").orderBy("score", "vec_id")
    best = found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k + 1)
    lists = best.groupBy("value").agg(F.array_sort(F.collect_list(F.struct("score", "vec_id"))).alias("near"))
    others = F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    return (
        asked.select(F.col("vec_id").alias("query_id"), "value")
        .join(lists, "value")
        .select("query_id", F.posexplode(others).alias("at", "x"))
        .select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score"))
    )


def query(embeddings: DataFrame) -> DataFrame:
    rows = embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").alias("vector"))
    return nearest(rows, F.col("vec_id") % 100 == 0)
