"""Nearest neighbours by inner product with multi-index hashing.

Vectors become binary codes: a rotation learned on a bounded sample brings them near the corners of
a cube, the signs are the code (several rotations make a longer code). A coordinate that fills all
vectors up to the same norm makes the order of angles that of inner products. Each code is cut into
m substrings and each substring has an index. With R = m r + a, two codes that differ in no more
than R bits differ in no more than r on one of the first a + 1 substrings, or in less than r on one
of the others; so probing all buckets that near finds every code within R, and these are ranked by
the exact product. R is the radius within which the sample's true neighbours lie.

All rows are indexed, in shards of a fixed number of rows, and queries come in blocks of a fixed
number: a task searches one shard for one block, and the best of all shards are ranked at the end.
Each row is sent once to every block and each query once to every shard, so for a given memory of a
task least is moved when a block is as large as a shard.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from starfold.llm.common import sampled, written

#: Bits of a substring.
_BITS = 8
_NEAR = np.bitwise_count(np.arange(256)[:, None] ^ np.arange(256)[None, :]).astype(np.uint8)


class Codes:
    """Learned rotations. ``fit`` on rows of equal norm; ``encode`` gives ``bits // 8`` bytes a row."""

    def __init__(self, sample: np.ndarray, bits: int = 256, rounds: int = 20, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.mean = sample.mean(axis=0)
        centred = sample - self.mean
        spread, axes = np.linalg.eigh(centred.T @ centred / max(len(sample), 1))
        keep = min(bits, int((spread > 1e-9 * max(spread.max(), 1e-30)).sum())) or 1
        axes = axes[:, ::-1][:, :keep]
        reduced = centred @ axes
        turned = []
        for _ in range(-(-bits // keep)):
            rotation = np.linalg.qr(rng.normal(size=(keep, keep)))[0]
            for _ in range(rounds):
                corners = np.where(reduced @ rotation >= 0, 1.0, -1.0)
                left, _, right = np.linalg.svd(corners.T @ reduced)
                rotation = (left @ right).T
            turned.append(axes @ rotation)
        self.planes = np.hstack(turned)[:, :bits]

    def encode(self, rows: np.ndarray) -> np.ndarray:
        return np.packbits((rows - self.mean) @ self.planes >= 0, axis=1)


def filled(rows: np.ndarray, norm: float) -> np.ndarray:
    """Rows with one more coordinate that brings their norm to ``norm``."""
    rest = np.sqrt(np.maximum(norm**2 - (rows**2).sum(axis=1), 0.0))
    return np.hstack([rows, rest[:, None]])


def asked(rows: np.ndarray, norm: float) -> np.ndarray:
    """Queries at the same norm, with nothing in the filling coordinate."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)  # so that no square is too large or small
    length = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.hstack([rows * (norm / length), np.zeros((len(rows), 1))])


def products(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products in double precision, each summed alike wherever its row stands."""
    return (rows * query).sum(axis=1)


class Index:
    """Substring indexes of a shard: for each substring, the rows in order of its value."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.words = np.ascontiguousarray(codes).view(np.uint64)
        self.order = [np.argsort(part, kind="stable") for part in codes.T]
        self.sizes = [np.bincount(part, minlength=256) for part in codes.T]

    def within(self, code: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows whose codes differ from ``code`` in at most ``radius`` bits, and the distances: the
        buckets near enough of each substring, then a look at the whole codes."""
        reach, more = divmod(radius, len(code))
        seen = np.zeros(len(self.codes), bool)
        for i, value in enumerate(code):
            probed = _NEAR[value] <= (reach if i <= more else reach - 1)
            seen[self.order[i][np.repeat(probed, self.sizes[i])]] = True
        rows = np.flatnonzero(seen)
        apart = np.bitwise_count(self.words[rows] ^ code.view(np.uint64)).sum(axis=1)
        near = apart <= radius
        return rows[near], apart[near]

    def nearest(self, code: np.ndarray, radius: int, least: int) -> np.ndarray:
        """Rows within ``radius``, or within the smallest larger one (by steps) that has ``least``."""
        least = min(least, len(self.codes))
        while True:
            rows, _ = self.within(code, radius)
            if len(rows) >= least:
                return rows
            radius += len(code)


def calibrate(codes: Codes, sample: np.ndarray, norm: float, k: int, share: float, queries: int) -> int:
    """The radius within which ``share`` of the true ``k`` nearest rows of the sample lie, for a
    bounded number of queries from the sample."""
    own = sample[: min(queries, len(sample))]
    if len(sample) < 2:
        return 0
    index = np.ascontiguousarray(codes.encode(filled(sample, norm))).view(np.uint64)
    probes = np.ascontiguousarray(codes.encode(asked(own, norm))).view(np.uint64)
    apart = []
    for i, (query, probe) in enumerate(zip(own, probes, strict=True)):
        score = sample @ query
        score[i] = -np.inf
        best = np.argpartition(-score, min(k, len(score) - 1) - 1)[:k]
        apart.append(np.bitwise_count(index[best] ^ probe).sum(axis=1))
    return int(np.ceil(np.quantile(np.concatenate(apart), share)))


def usable(vector: Column) -> Column:
    """True for vectors that are not null or zero and hold neither null nor non-finite numbers."""
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _rows(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), dtype=np.float64)


def search(
    vectors: DataFrame, is_query: Column, k: int = 20, bits: int = 256, sample: int = 20_000,
    share: float = 0.97, shard_rows: int = 16_384, block_rows: int = 16_384,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row of ``vectors`` (``vec_id``, ``embedding``)
    that ``is_query`` holds for, the ``k`` nearest other rows found, nearest first, ties to the
    smaller vec_id.

    The codes and the radius are fitted on about ``sample`` rows at most, chosen by a hash; all rows are
    indexed. Vectors that are null, zero or not finite take no part, nor do rows without
    vec_id, nor vectors of another length than most. Rows with the query's vec_id are its own row.
    A repeated candidate row counts once for each row, a query_id once, with the smallest of its
    vectors. Fewer than k other rows: all of them. The result does not depend on how rows are stored.
    """
    spark = vectors.sparkSession
    kind = vectors.schema["embedding"].dataType
    if not isinstance(kind, ArrayType):
        raise TypeError("embedding must be an array")
    vector = F.col("embedding").cast("array<double>")
    own = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), vector.alias("v"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    ).where(F.col("vec_id").isNotNull() & usable(F.col("v")))
    lengths = own.groupBy(F.size("v").alias("length")).agg(
        F.count("*").alias("rows"), F.max(F.array_max(F.transform("v", F.abs))).alias("peak"),
    )
    most = lengths.orderBy(F.desc("rows"), "length").first()
    if most is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    own = own.where(F.size("v") == most["length"])
    # codes are those of the vectors in units of the largest number, whose squares cannot overflow
    peak = float(most["peak"])
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + (x / F.lit(peak)) * (x / F.lit(peak)))
    sums = own.agg(F.count("*").alias("rows"), F.max(square).alias("square")).first()
    total, norm = sums["rows"], float(np.sqrt(sums["square"]))
    by = F.xxhash64("vec_id", "v")
    base = _rows(sampled(own, by, sample, total).orderBy("vec_id", "v").select("v").toPandas()["v"]) / peak
    codes = Codes(filled(base, norm), bits)
    radius = calibrate(codes, base, norm, k, share, 400)
    model = spark.sparkContext.broadcast(codes)

    shards = -(-total // shard_rows)
    queries = own.where("asks").select(F.col("vec_id").alias("query_id"), F.col("v").alias("q"))
    queries = queries.groupBy("query_id").agg(F.min("q").alias("q"))
    blocks = -(-max(queries.count(), 1) // block_rows)
    shard = F.pmod(by, F.lit(shards)).cast("int")
    block = F.pmod(F.xxhash64("query_id", F.lit("block")), F.lit(blocks)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    indexed = own.select("vec_id", "v", shard.alias("shard")).select("*", every(blocks).alias("block"))
    probing = queries.select("query_id", "q", block.alias("block"), every(shards).alias("shard"))

    def find(rows: pd.DataFrame, probes: pd.DataFrame) -> pd.DataFrame:
        if not len(rows) or not len(probes):
            return pd.DataFrame({"query_id": np.empty(0, int), "vec_id": np.empty(0, int), "score": np.empty(0)})
        rows = rows.sort_values("vec_id", kind="stable")
        ids, x, q = rows["vec_id"].to_numpy(), _rows(rows["v"]), _rows(probes["q"])
        index = Index(model.value.encode(filled(x / peak, norm)))
        out = []
        for query_id, query, code in zip(probes["query_id"], q, model.value.encode(asked(q, norm)), strict=True):
            # one more than k, as the query's own row may be among them
            own_rows = int(np.searchsorted(ids, query_id, "right") - np.searchsorted(ids, query_id))
            near = index.nearest(code, radius, k + own_rows)
            near = near[ids[near] != query_id]
            score = products(x[near], query)
            best = np.lexsort((ids[near], -score))[:k]
            out.append((np.full(len(best), query_id), ids[near][best], score[best]))
        query_ids, vec_ids, scores = map(np.concatenate, zip(*out, strict=True))
        return pd.DataFrame({"query_id": query_ids, "vec_id": vec_ids, "score": scores})

    found = (
        indexed.groupBy("shard", "block")
        .cogroup(probing.groupBy("shard", "block"))
        .applyInPandas(find, "query_id long, vec_id long, score double")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = written(found, "ann_found").withColumn("rank", F.row_number().over(order).cast("int"))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
