"""SimHash near-duplicates, found with vantage-point trees.

A fingerprint has a bit for each of the 64 majorities over the hashes of a text's shingles. Two
fingerprints within ``max_distance`` bits are within ``max_distance // blocks`` bits on at least one
of ``blocks`` groups of bits, since the distances of the groups add up. So there is one tree for
each group of bits, whose metric is the Hamming distance on that group: small radii prune, whereas
64 nearly independent bits put almost every pair at the same distance and nothing could be pruned.

Each tree is built twice over. A top tree, from a bounded sample of fingerprints, deals all
fingerprints out to shards; inside a shard the same rule goes on until few are left, and these are
compared on all 64 bits. A node holds a vantage point v and a radius m. Fingerprints with
d(v, p) <= m go inside, the others outside; by the triangle inequality a pair that is cut has its
inner end in the ring m - r < d(v, p) <= m, so exactly these are put on both sides. No pair is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starfold.llm.common import ascii_lower, free, sampled, written

#: Hashes whose bits are counted at once; keeps memory flat on very long texts.
_BLOCK = 1 << 16
#: Below this many fingerprints all pairs are compared.
_LEAF = 128


def fingerprint(text: str | None, words_per_shingle: int = 4) -> int:
    """Fingerprint as a signed 64-bit number. Fewer words than a shingle: their whole sequence is
    the one shingle; no words (null, empty or blank text): zero."""
    words = ascii_lower(text).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    k = min(words_per_shingle, len(words))
    stops = ends[k - 1 :].tolist()
    starts = [0, *(ends[: len(words) - k] + 1).tolist()]
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(stops), _BLOCK):
        spans = zip(starts[at : at + _BLOCK], stops[at : at + _BLOCK], strict=True)
        hashes = np.array([digest(joined[a:b], 42) for a, b in spans], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    packed = np.packbits(2 * ones > len(stops), bitorder="little")
    return int(packed.view("<i8")[0])


def _masks(blocks: int) -> list[np.uint64]:
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    return [
        np.uint64(sum(1 << b for b in range(lo, hi)))
        for lo, hi in zip(edges, edges[1:], strict=False)
    ]


def _split(values: np.ndarray, mask: np.uint64, radius: int, seed: int):
    """The best of a few vantage points: (vantage point, m, inside, outside) with the ring on both
    sides, or None where every split would leave one side about as large as the whole."""
    rng = np.random.default_rng(seed)
    best = None
    for v in values[rng.integers(0, len(values), 6)]:
        d = np.bitwise_count((values ^ v) & mask).astype(np.int64)
        upto = np.cumsum(np.bincount(d, minlength=radius + 1))
        for m in np.unique(np.searchsorted(upto, [len(d) * 2 // 5, len(d) // 2])):
            inside = upto[m]
            ring = inside - (upto[m - radius] if m >= radius else 0)
            cost = max(inside, len(d) - inside + ring)
            if best is None or cost < best[0]:
                best = (cost, v, int(m), d)
    cost, v, m, d = best
    return None if cost > 0.9 * len(values) else (v, m, d <= m, d > m - radius)


def build_tree(values: np.ndarray, mask: np.uint64, radius: int, leaf: int) -> list[tuple]:
    """Nodes ``(v, m, inside, outside)``, or ``(shard,)`` for a leaf; the root is node 0."""
    nodes: list[tuple] = [()]
    todo, shards = [(0, values)], 0
    while todo:
        at, own = todo.pop()
        found = _split(own, mask, radius, at) if len(own) > leaf else None
        if found is None:
            nodes[at], shards = (shards,), shards + 1
            continue
        v, m, inside, outside = found
        nodes[at] = (v, m, len(nodes), len(nodes) + 1)
        todo += [(len(nodes), own[inside]), (len(nodes) + 1, own[outside])]
        nodes += [(), ()]
    return nodes


def route(nodes: list[tuple], values: np.ndarray, mask: np.uint64, radius: int) -> tuple:
    """``(shard, position in values)`` for each shard that a fingerprint belongs to."""
    shards, places = [], []
    todo = [(0, np.arange(len(values)))]
    while todo:
        at, own = todo.pop()
        if not len(own):
            continue
        if len(nodes[at]) == 1:
            shards.append(np.full(len(own), nodes[at][0]))
            places.append(own)
            continue
        v, m, inside, outside = nodes[at]
        d = np.bitwise_count((values[own] ^ v) & mask).astype(np.int64)
        todo += [(inside, own[d <= m]), (outside, own[d > m - radius])]
    return np.concatenate(shards or [[]]), np.concatenate(places or [[]]).astype(np.int64)


def _spanning(values: np.ndarray, distance: int) -> tuple[list, list]:
    """Links that join what is connected, by search from each fingerprint not yet reached: a dense
    cluster gives one link for each member and not one for each pair."""
    a, b = [], []
    left = np.arange(len(values))
    while len(left):
        frontier, left = [left[0]], left[1:]
        while frontier and len(left):
            at = frontier.pop()
            near = np.bitwise_count(values[left] ^ values[at]) <= distance
            new, left = left[near], left[~near]
            a.append(np.full(len(new), at))
            b.append(new)
            frontier.extend(new)
    return a, b


def _among(values: np.ndarray, distance: int) -> tuple[list, list]:
    if len(values) <= 2 * _LEAF:
        a, b = np.nonzero(np.triu(np.bitwise_count(values[:, None] ^ values) <= distance, 1))
        if len(a) <= 2 * len(values):
            return [a], [b]
    return _spanning(values, distance)


def near_pairs(values: np.ndarray, mask: np.uint64, radius: int, distance: int) -> np.ndarray:
    """Links among distinct fingerprints that are within ``radius`` on ``mask`` and ``distance``
    overall, enough to connect all that such links connect. Two columns of fingerprints."""
    found = []
    todo = [(0, values)]
    while todo:
        seed, own = todo.pop()
        parts = _split(own, mask, radius, seed) if len(own) > _LEAF else None
        if parts is not None:
            todo += [(seed + 1, own[parts[2]]), (seed + 2, own[parts[3]])]
            continue
        a, b = _among(own, distance)
        found += [np.stack([own[x], own[y]], axis=1) for x, y in zip(a, b, strict=True) if len(x)]
    return np.unique(np.concatenate(found), axis=0) if found else np.empty((0, 2), np.uint64)


def links(
    prints: DataFrame, max_distance: int = 4, blocks: int = 3, sample: int = 1 << 16,
    shard_rows: int = 1 << 15,
) -> DataFrame:
    """``a, b``: links between the distinct values of ``fp`` (long) that connect exactly what
    distances up to ``max_distance`` connect.

    The top trees are fitted on about ``sample`` values at most, every value is dealt out and compared.
    A shard that outgrows ``shard_rows``, as its values cannot be told apart by any vantage point,
    is cut into pieces; each pair of pieces is a task of its own, so no task grows with the group.
    """
    spark = prints.sparkSession
    radius, masks = max_distance // blocks, _masks(blocks)
    total = prints.count()
    chosen = sampled(prints, F.xxhash64("fp"), sample, total).collect()
    values = np.array([r.fp for r in chosen], np.int64).view(np.uint64)
    leaf = max(16, len(values) * shard_rows // max(total, 1))
    trees = spark.sparkContext.broadcast([build_tree(values, m, radius, leaf) for m in masks])

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            fps = batch["fp"].to_numpy(np.int64)
            for i, mask in enumerate(masks):
                shard, place = route(trees.value[i], fps.view(np.uint64), mask, radius)
                yield pd.DataFrame({"tree": i, "shard": shard.astype(np.int64), "fp": fps[place]})

    dealt = written(prints.mapInPandas(deal, "tree int, shard long, fp long"), "simhash_shards")
    # one row for each shard, and shards are at most about twice the sample
    sizes = dealt.groupBy("tree", "shard").agg(
        F.ceil(F.count("*") / shard_rows).cast("int").alias("pieces")
    )
    own = F.pmod(F.xxhash64("fp"), F.col("pieces")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))
    tiles = (
        dealt.join(F.broadcast(sizes), ["tree", "shard"])
        .select("tree", "shard", "fp", own.alias("own"), other.alias("other"))
        .select(
            "tree", "shard", "fp",
            F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
        )
    )

    def compare(batch: pd.DataFrame) -> pd.DataFrame:
        fps = np.unique(batch["fp"].to_numpy(np.int64)).view(np.uint64)
        pairs = near_pairs(fps, masks[int(batch["tree"].iloc[0])], radius, max_distance)
        return pd.DataFrame(pairs.view(np.int64), columns=["a", "b"])

    found = tiles.groupBy("tree", "shard", "i", "j").applyInPandas(compare, "a long, b long")
    return found.distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, root``: the smallest node connected with each node that has an edge ``a, b``.

    Large-star and small-star steps in turn: each round hangs the neighbours of a node on the
    smallest of them, until every edge leads to a root. Each round is written, so its lineage is
    short; so are the smallest neighbours, so that Spark can split the edges of a hot node when both
    are joined. Only counts reach the driver.
    """
    down = F.when(F.col("a") < F.col("b"), F.struct(F.col("b").alias("u"), F.col("a").alias("v")))
    down = down.otherwise(F.struct(F.col("a").alias("u"), F.col("b").alias("v")))
    edges = written(edges.where("a <> b").select(down.alias("e")).select("e.*").distinct(), "edges")
    mark = _mark(edges)
    while mark[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = written(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low")), "lowest")
        stars = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))
        stars = written(stars.where("u <> v").distinct(), "stars")
        low = written(stars.groupBy("u").agg(F.min("v").alias("low")), "lowest")
        hung = stars.join(low, "u").where("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v"))
        hung = hung.unionByName(low.select("u", F.col("low").alias("v")))
        edges = written(hung.distinct(), "edges")
        before, mark = mark, _mark(edges)
        if before == mark:
            break
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def _mark(edges: DataFrame) -> tuple:
    hashed = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(edges.agg(F.count("*"), F.sum(hashed), F.sum(hashed % 1000003 * F.col("u"))).first())


def near_duplicates(
    docs: DataFrame, words_per_shingle: int = 4, max_distance: int = 4, **tree
) -> DataFrame:
    """``doc_id, fp, component_id`` for every row of ``docs``: its fingerprint and the smallest
    doc_id that links reach, its own included.

    Null, empty and blank texts have fingerprint zero and link like any other. Repeated rows stay
    repeated. A null doc_id takes part but is never the smallest, unless a component has no other;
    then component_id is null. Other columns, of any name, are not read.
    """
    hashed = F.udf(lambda text: fingerprint(text, words_per_shingle), "long", useArrow=False)
    own = written(docs.select("doc_id", hashed("text").alias("fp")), "simhash")
    prints = written(own.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash_distinct")
    roots = components(links(prints.select("fp"), max_distance, **tree))
    linked = roots.join(prints, roots.node == prints.fp).select("node", "root", "least")
    least = linked.groupBy("root").agg(F.min("least").alias("component"))
    reached = linked.join(least, "root").select(F.col("node").alias("fp"), "component")
    named = prints.join(reached, "fp", "left").select(
        "fp", F.coalesce("component", "least").alias("component_id")
    )
    # both sides of this join are plain files, so that Spark can split the rows of a hot fingerprint
    named = written(named, "simhash_components")
    return own.join(named, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, words_per_shingle: int = 4, max_distance: int = 4) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates, that with the smallest doc_id, nulls
    last; of several such rows that with the smallest hash of all columns, of equal ones any. Rows
    that share a doc_id but are no near-duplicates all stay. Rows with neither doc_id nor text have
    nothing to be compared or named by and stay as they are. Columns keep their values, whatever their
    names; an empty table stays empty."""
    hashed = F.udf(lambda text: fingerprint(text, words_per_shingle), "long", useArrow=False)
    fp, row = free(docs, "_fp", "_row")
    empty = F.col("doc_id").isNull() & F.col("text").isNull()
    # written, so that a row's number is the same in all that follows
    numbered = docs.where(~empty).withColumns({fp: hashed("text"), row: F.monotonically_increasing_id()})
    rows = written(numbered, "simhash_rows")
    order = F.struct(
        F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"),
        F.xxhash64(*docs.columns).alias("hash"), F.col(row).alias("row"),
    )
    first = rows.groupBy(F.col(fp).alias("fp")).agg(F.min(order).alias("first"))
    first = written(first, "simhash_distinct")
    roots = components(links(first.select("fp"), max_distance))
    group = F.coalesce("root", "fp")
    stay = first.join(roots, roots.node == first.fp, "left").groupBy(group).agg(F.min("first").alias("first"))
    stay = stay.select(F.col("first.row").alias(row))
    return rows.join(stay, row, "left_semi").select(docs.columns).unionByName(docs.where(empty))
