"""Nearest neighbours by multi-index hashing of learned binary codes.

Codes are the signs of centred vectors after a projection on their main directions and a rotation
learned to lose little by taking signs (iterative quantization). A code is cut into substrings of
eight bits, and each substring has an index of its own. If two codes differ in at most ``r`` bits,
some substring differs in at most its share of ``r``; probing all values within that share of every
substring therefore retrieves every code within the radius. What is retrieved and lies within the
radius is ranked by the exact distance of the original vectors.

The radius is chosen per query: a first search with a growing radius bounds the distance of the
k-th neighbour; signs of two vectors at that angle differ in a binomial number of bits, and the
second search takes the radius that covers that number with a margin. Where the bound says
nothing, the radius covers all codes, which is exact.

Index vectors are spread over shards by a hash of their id, queries form blocks; a task searches a
block in a shard, and the best of all shards are merged. Of equal vectors only the smallest ids that
can be among the neighbours are indexed.

Vectors that are null, zero, hold null or non-finite components or have another length than most of
the fitting sample take no part. Rows that repeat an id and vector count once; no row is a candidate of a
query with its own id. With fewer candidates than asked for, all are returned; an empty table gives none.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tamiz.llm.bpe import spread
from tamiz.session import materialize

SAMPLE = 20_000  # vectors that the projection and rotation are fitted on at most
BITS = 64
SHARD, BLOCK = 16_384, 4_096
MARGIN = 1.0  # standard deviations that the radius allows for
MASKS = [np.array([v for v in range(256) if v.bit_count() <= s], np.uint8) for s in range(9)]
COUNT = np.array([v.bit_count() for v in range(256)], np.uint8)


@dataclass(frozen=True)
class Codes:
    """Centre and rotated projection; ``dim`` is the length of the vectors."""

    dim: int
    centre: np.ndarray
    rotation: np.ndarray

    def encode(self, vectors: np.ndarray) -> np.ndarray:
        """Eight bits per byte, one row per vector."""
        return np.packbits((vectors - self.centre) @ self.rotation > 0, axis=1)


def fit_codes(sample: np.ndarray, bits: int = BITS, rounds: int = 30, seed: int = 0) -> Codes:
    """Learn the codes from a sample: principal directions, then rotation and signs in turn."""
    centre = sample.mean(axis=0)
    _, directions = np.linalg.eigh(np.cov((sample - centre).T).reshape(sample.shape[1], -1))
    projection = directions[:, ::-1][:, : min(bits, sample.shape[1])]
    points = (sample - centre) @ projection
    rotation = np.linalg.qr(np.random.default_rng(seed).normal(size=(points.shape[1],) * 2))[0]
    for _ in range(rounds):
        signs = np.where(points @ rotation > 0, 1.0, -1.0)
        u, _, vt = np.linalg.svd(points.T @ signs)
        rotation = u @ vt
    return Codes(sample.shape[1], centre, projection @ rotation)


class MultiIndex:
    """One table per substring: the places of all codes by the substring's value."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.order = [np.argsort(codes[:, i], kind="stable") for i in range(codes.shape[1])]
        self.counts = [np.bincount(codes[:, i], minlength=256) for i in range(codes.shape[1])]
        self.starts = [np.cumsum(c) - c for c in self.counts]

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Places of all codes that differ from ``code`` in at most ``radius`` bits."""
        parts = len(self.order)
        share, over = divmod(min(radius, 8 * parts), parts)
        seen = np.zeros(len(self.codes), bool)
        for i in range(parts):
            # The first substrings have the larger share; if all exceed their share, the sum exceeds the radius.
            reach = share if i <= over else share - 1
            if reach >= 0:
                values = MASKS[min(8, reach)] ^ code[i]
                seen[self.order[i][spread(self.starts[i][values], self.counts[i][values])]] = True
        found = np.flatnonzero(seen)
        return found[COUNT[self.codes[found] ^ code].sum(axis=1) <= radius]


def _usable(vector: Column) -> Column:
    sound = ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & sound & F.exists(vector, lambda x: x != 0)


def _radius(distance: float, norm: float, bits: int) -> int:
    """Bits in which a vector at ``distance`` differs from one of length ``norm``, with the margin."""
    if not norm > 0 or not distance < 2 * norm:
        return bits
    p = 2 * math.asin(distance / (2 * norm)) / math.pi
    return min(bits, math.ceil(bits * p + MARGIN * math.sqrt(bits * p * (1 - p))))


def nearest(
    queries: DataFrame, vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", k: int = 10,
    sample: int = SAMPLE, shard: int = SHARD, block: int = BLOCK,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest rows of ``vectors`` to each row of ``queries``.

    ``score`` is the Euclidean distance of the original vectors in double precision; ties go to the
    smaller id. A row is no candidate of a query with its own id. Rows without id take no part.
    """
    spark = vectors.sparkSession
    plain = [
        df.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
        .filter(F.col("id").isNotNull() & _usable(F.col("v")))
        for df in (queries, vectors)
    ]
    fitting = plain[1].orderBy(F.xxhash64("id"), "id").limit(sample).select("v").collect()
    schema = "query_id long, rank int, vec_id long, score double"
    if not fitting:
        return spark.createDataFrame([], schema)
    lengths = [len(r.v) for r in fitting]
    dim = max(set(lengths), key=lambda n: (lengths.count(n), n))
    codes = fit_codes(np.array([r.v for r in fitting if len(r.v) == dim]))
    asked, held = (df.filter(F.size("v") == dim) for df in plain)
    held = held.distinct()  # else repeated rows would take the places of other ids
    # k + 1 rows of equal vectors are enough: one may be the query's own.
    equal = Window.partitionBy("v").orderBy("id")
    held = held.withColumn("place", F.row_number().over(equal)).filter(F.col("place") <= k + 1).drop("place")
    held, asked = materialize(held, "index"), materialize(asked, "index-queries")
    shards = max(1, -(-held.count() // shard))
    blocks = max(1, -(-asked.count() // block))
    spread_out = held.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int")).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    )
    everywhere = F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
    in_blocks = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(blocks)).cast("int")

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        ids, out = left["id"].to_numpy(), []
        if len(left) and len(right):
            data = np.array(left["v"].tolist())
            index = MultiIndex(codes.encode(data))
            points = np.array(right["v"].tolist())
            bits = codes.rotation.shape[1]
            for name, point, code, radius in zip(right["id"], points, codes.encode(points), right["radius"]):
                found = index.within(code, int(radius) if radius >= 0 else 4)
                grown = 4
                while radius < 0 and grown < bits and (ids[found] != name).sum() < k:
                    grown += 4
                    found = index.within(code, grown)
                found = found[ids[found] != name]
                score = np.sqrt(((data[found] - point) ** 2).sum(axis=1))
                first = np.lexsort((ids[found], score))[:k]
                out.append(pd.DataFrame({"query_id": name, "vec_id": ids[found][first], "score": score[first]}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})

    def merged(with_radius: DataFrame) -> DataFrame:
        asks = with_radius.withColumn("block", in_blocks).withColumn("shard", everywhere)
        found = spread_out.groupBy("shard", "block").cogroup(asks.groupBy("shard", "block")).applyInPandas(
            search, "query_id long, vec_id long, score double"
        )
        best = Window.partitionBy("query_id").orderBy("score", "vec_id")
        return found.distinct().withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)

    first = merged(asked.withColumn("radius", F.lit(-1))).groupBy("query_id").agg(
        F.max("score").alias("far"), F.count("*").alias("n")
    )
    first = materialize(first, "bounds")
    bits = codes.rotation.shape[1]
    centre = codes.centre

    def radii(batches):
        for pdf in batches:
            norms = np.linalg.norm(np.array(pdf["v"].tolist()).reshape(-1, dim) - centre, axis=1)
            far = pdf["far"].where(pdf["n"] >= k, np.inf).fillna(np.inf)
            pdf["radius"] = [_radius(d, n, bits) for d, n in zip(far, norms)]
            yield pdf[["id", "v", "radius"]]

    bounded = asked.join(first, F.col("id") == F.col("query_id"), "left").select("id", "v", "far", "n")
    with_radius = materialize(bounded.mapInPandas(radii, T.StructType([
        T.StructField("id", T.LongType()), T.StructField("v", T.ArrayType(T.DoubleType())),
        T.StructField("radius", T.IntegerType()),
    ])), "radii")
    return merged(with_radius).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
