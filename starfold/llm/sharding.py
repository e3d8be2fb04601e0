"""Shards of near equal size by longest-processing-time scheduling.

Rows that must stay together form a group. Groups, sorted by size, go to the least-loaded shard,
which a heap names. A group of more than a ``grain``-th of a shard's fair share is scheduled on its
own; there can be no more than ``shards * grain`` of these. The smaller ones are dealt by a hash into
``shards * grain`` bundles, which are scheduled like groups. So the heap never sees more than
``2 * shards * grain`` items, however many rows there are, and a bundle holds about a ``grain``-th of
a share.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starfold.llm.common import free, written


def schedule(items: list[tuple], shards: int) -> list[tuple]:
    """``(*key, shard)`` for items ``(*key, size)``: largest first, ties by key, each to the
    least-loaded shard, ties to the smaller shard."""
    heap = [(0, shard) for shard in range(shards)]
    out = []
    for *key, size in sorted(items, key=lambda item: (-item[-1], item[:-1])):
        load, shard = heapq.heappop(heap)
        out.append((*key, shard))
        heapq.heappush(heap, (load + size, shard))
    return out


def assign(sized: DataFrame, shards: int = 16, grain: int = 1024) -> DataFrame:
    """``sized`` (with ``group`` string, ``size`` long) with ``shard``, from 0. Rows of a group share
    a shard; a null group is a group. No rows give no rows."""
    total = sized.agg(F.sum("size")).first()[0] or 0
    bundle = F.pmod(F.xxhash64("group"), F.lit(shards * grain)).cast("int")
    large = F.col("size") * (shards * grain) > total
    groups = sized.groupBy("group").agg(F.sum("size").alias("size"))
    # at most shards * grain large groups and as many bundles
    items = (
        groups.select(
            F.when(large, F.coalesce("group", F.lit(""))).alias("one"),
            F.when(~large, bundle).alias("bundle"), F.col("group").isNull().alias("none"), "size",
        )
        .groupBy("one", "bundle", F.when(F.col("one").isNotNull(), F.col("none")).alias("none"))
        .agg(F.sum("size").alias("size"))
    )
    found = schedule(
        [(r.bundle is None, r.one or "", bool(r.none), r.bundle or 0, r.size) for r in items.collect()],
        shards,
    )
    spark = sized.sparkSession
    alone = spark.createDataFrame(
        [(one, none, shard) for is_one, one, none, _, shard in found if is_one],
        "one string, none boolean, own_shard int",
    )
    bundled = spark.createDataFrame(
        [(b, shard) for is_one, _, _, b, shard in found if not is_one], "bundle int, bundle_shard int"
    )
    keyed = sized.withColumns(
        {"one": F.coalesce("group", F.lit("")), "none": F.col("group").isNull(), "bundle": bundle}
    )
    placed = keyed.join(F.broadcast(alone), ["one", "none"], "left").join(
        F.broadcast(bundled), "bundle", "left"
    )
    return placed.select(*sized.columns, F.coalesce("own_shard", "bundle_shard").alias("shard"))


def numbered(placed: DataFrame, total: int, rows: int = 100_000) -> DataFrame:
    """``placed``, of ``total`` rows, with ``slot``, gapless from 0 in each shard, in the order of a hash
    of the row's values, then of the values. Ranges of the hash of about ``rows`` rows each are numbered
    apart and lined up by their counts, so no task numbers a whole shard and ``rows`` does not change
    the slots. Equal rows are counted before and numbered in a run; they are told apart by slot only."""
    high, count, start, run = free(placed, "_hash", "_rows", "_start", "_run")
    bucket, first, step = free(placed, "_bucket", "_first", "_step")
    values = [c for c in placed.columns if c != "shard"]
    distinct = placed.groupBy(*placed.columns).agg(F.count("*").alias(count))
    top = F.shiftrightunsigned(F.xxhash64(*values), 33)
    distinct = distinct.withColumn(high, top)
    distinct = distinct.withColumn(bucket, F.shiftright(F.col(high) * F.lit(total // rows + 1), 31))
    distinct = written(distinct, "shards")
    sums = distinct.groupBy("shard", bucket).agg(F.sum(count).alias(step))
    upto = Window.partitionBy("shard").orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("shard", bucket, F.coalesce(F.sum(step).over(upto), F.lit(0)).alias(start))
    within = Window.partitionBy("shard", bucket).orderBy(high, *values)
    before = F.sum(count).over(within.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col(count)
    ranked = distinct.withColumn(first, before).join(starts, ["shard", bucket])
    # runs of a thousand, so that a row that is there very often never stands in one array
    at = F.col(start) + F.col(first)
    runs = ranked.select(
        *placed.columns, (at + F.col(count)).alias(count),
        F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(count) - 1) / 1000))).alias(run), at.alias(start),
    )
    low = F.col(start) + F.col(run) * 1000
    slots = F.sequence(low, F.least(low + 999, F.col(count) - 1))
    return runs.select(*placed.columns, F.explode(slots).alias("slot"))


def shard_documents(docs: DataFrame, shards: int = 16, grain: int = 1024) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` for every row: its size is the UTF-8 bytes of the
    text plus 1, rows of equal text stay together, shards are of near equal size.

    Null and empty texts have size 1 and are one group. Repeated rows are rows of their own, with
    slots of their own; a null doc_id is a value like any other. Shards and slots follow from the rows
    alone, however they are stored, at any number of rows; no rows give none. Other columns are not read.
    """
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    sized = docs.select(
        "doc_id", (F.octet_length(raw) + 1).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"), F.sha2(raw, 256).alias("group"),
    )
    sized = written(sized, "shard_sizes")
    placed = assign(sized, shards, grain).drop("group")
    return numbered(placed, sized.count())
