"""Packing by non-negative least squares.

Documents are token sequences; a piece lies in one sequence of the packed corpus, and a document
longer than the window is cut into windows first. Lengths are counted in steps of ``grain`` tokens.
All combinations of at most three steps that fill a window are enumerated, and non-negative least
squares finds how often each is to be used so that together they use up the histogram of lengths.
The counts are rounded down, the places are dealt to the pieces by their rank within their length,
and the pieces that are left over are packed greedily: end to end, cut where a window is full. The
last window, which they do not fill, is cut into powers of two, which need no padding.

Only the histogram, of ``window / grain`` numbers, reaches the driver, and the chosen combinations,
as many at most, go back. Ranks and running totals are counted within parts and lined up by the
parts' totals.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starfold.llm.common import written
from starfold.llm.word_bpe import word_codec

#: Pieces whose running total one task counts.
_STRETCH = 65_536


def combinations(steps: int, there: np.ndarray) -> np.ndarray:
    """Rows of three steps, largest first, 0 for none, that sum to ``steps``; only steps that
    ``there`` holds for."""
    first, second = np.meshgrid(np.arange(1, steps + 1), np.arange(0, steps + 1), indexing="ij")
    third = steps - first - second
    kept = (third >= 0) & (second <= first) & (third <= second)
    rows = np.stack([first[kept], second[kept], third[kept]], axis=1)
    usable = np.concatenate([[True], there])
    return rows[usable[rows].all(axis=1)]


def nonnegative_least_squares(rows: np.ndarray, target: np.ndarray, rounds: int = 3_000) -> np.ndarray:
    """``x >= 0`` that brings the sum of ``x`` times the columns nearest to ``target``; column j has a
    one for each step in ``rows[j]``. Active sets: the column that helps most comes in, the least
    squares solution of those that are in is taken as far as all stay positive."""
    scale = max(float(target.sum()), 1.0)
    want = np.concatenate([[0.0], target / scale])
    design = np.zeros((len(want), len(rows)))
    for place in rows.T:
        np.add.at(design, (place, np.arange(len(rows))), 1.0)
    design[0] = 0.0
    x = np.zeros(len(rows))
    inside = np.zeros(len(rows), bool)
    for _ in range(rounds):
        rest = want - design[:, inside] @ x[inside]
        rest[0] = 0.0
        gain = np.where(inside, -np.inf, rest[rows].sum(axis=1))
        if not len(gain) or gain.max() <= 1e-12:
            break
        inside[int(np.argmax(gain))] = True
        while True:
            solved = np.zeros(len(rows))
            solved[inside] = np.linalg.lstsq(design[:, inside], want, rcond=None)[0]
            low = inside & (solved <= 1e-15)
            if not low.any():
                x = solved
                break
            moved = np.maximum(x[low] - solved[low], 1e-300)
            share = float(np.min(x[low] / moved))
            x = x + share * (solved - x)
            out = inside & (x <= 1e-15)
            inside &= ~out
            x[out] = 0.0
            if not out.any():  # rounding: nothing has reached zero exactly
                inside &= ~low
                x[low] = 0.0
    return x * scale


def plan(histogram: np.ndarray) -> list[tuple[int, int, int, int]]:
    """``(step, first rank, number, first sequence, place)`` from the numbers of pieces by step: the
    pieces of that step from that rank on go to the sequences from the first one on, each at that
    place. Combinations are used in falling order of their share, never beyond what there is."""
    left = histogram.astype(np.int64).copy()
    used = np.zeros(len(left), np.int64)
    rows = combinations(len(left), histogram > 0)
    share = nonnegative_least_squares(rows, histogram.astype(float))
    out, sequence = [], 0
    for j in np.argsort(-share, kind="stable"):
        steps = [int(s) for s in rows[j] if s]
        most = min(int(left[s - 1]) // steps.count(s) for s in steps)
        number = min(int(np.floor(share[j] + 1e-6)), most)
        if number <= 0:
            continue
        for place, step in enumerate(steps):
            out.append((step, int(used[step - 1]), number, sequence, place))
            used[step - 1] += number
            left[step - 1] -= number
        sequence += number
    return out


def tokenized(docs: DataFrame, model: str, end_id: int, window: int = 4096) -> DataFrame:
    """``key, doc_id, doc_tokens, start, ids, length, ids_crc32``: each document's ids followed by
    ``end_id``, in rows of ``window`` ids at most (little-endian, 4 bytes each), written. Null and
    empty texts are the end id alone. ``key`` tells all rows apart, also repeated ones."""
    end = end_id.to_bytes(4, "little")

    def windows(text: str | None) -> list[bytes]:
        ids = word_codec(model).encode(text) + end
        return [ids[at : at + 4 * window] for at in range(0, len(ids), 4 * window)]

    cut = F.udf(windows, "array<binary>", useArrow=False)
    whole = docs.select("doc_id", cut("text").alias("ids"))
    tokens = F.aggregate("ids", F.lit(0).cast("long"), lambda n, ids: n + F.shiftright(F.octet_length(ids), 2))
    # no array is empty; the plain generator would have the texts encoded once more to find that out
    rows = whole.select("doc_id", tokens.alias("doc_tokens"), F.posexplode_outer("ids").alias("at", "ids"))
    return written(
        rows.select(
            F.monotonically_increasing_id().alias("key"), "doc_id", "doc_tokens",
            (F.col("at") * F.lit(window).cast("long")).alias("start"), "ids",
            F.shiftright(F.octet_length("ids"), 2).cast("long").alias("length"), F.crc32("ids").alias("ids_crc32"),
        ),
        "packing_tokens",
    )


def _ranked(rows: DataFrame) -> DataFrame:
    """``rows`` with ``rank``, from 0 within each step, in the order of ``key``."""
    part = F.shiftright("key", 33)
    rows = rows.withColumn("part", part)
    within = Window.partitionBy("part", "step").orderBy("key")
    before = Window.partitionBy("step").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy("part", "step").agg(F.count("*").alias("rows"))
    firsts = counts.select("part", "step", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("first"))
    placed = rows.withColumn("own", F.row_number().over(within) - 1).join(firsts, ["part", "step"])
    return placed.withColumn("rank", F.col("first") + F.col("own")).drop("part", "own", "first")


def _end_to_end(rows: DataFrame) -> DataFrame:
    """``rows`` with ``position``: the lengths of all rows before, by step from the largest, rank."""
    rows = rows.withColumn("stretch", F.floor(F.col("rank") / _STRETCH))
    sums = rows.groupBy("step", "stretch").agg(F.sum("length").alias("total"))
    # one row for each stretch of 65,536 pieces of a step
    before = Window.orderBy(F.desc("step"), "stretch").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sums.select("step", "stretch", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("step", "stretch").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    own = F.coalesce(F.sum("length").over(within), F.lit(0))
    placed = rows.withColumn("own", own).join(firsts, ["step", "stretch"])
    return placed.withColumn("position", F.col("base") + F.col("own")).drop("stretch", "own", "base")


def pack(tokens: DataFrame, window: int = 4096, grain: int = 16) -> DataFrame:
    """``key, doc_id, doc_tokens, row_start, row_length, start, length, sequence_id, offset``: the
    pieces of :func:`tokenized` rows, each from ``start`` in its document, and where they go. Every id
    is in exactly one piece, sequences are filled from 0 without gaps and are numbered without gaps.
    A sequence holds fewer than ``window`` ids only by what the steps of ``grain`` hide, less than
    ``grain`` for each of its three pieces, or if its size is a power of two. Documents up to a window
    are cut only if they are left over. No rows give no rows.
    """
    spark = tokens.sparkSession
    rows = tokens.select(
        "key", "doc_id", "doc_tokens", F.col("start").alias("row_start"), F.col("length").alias("row_length"),
        "length", F.ceil(F.col("length") / grain).cast("int").alias("step"),
    )
    histogram = np.zeros(-(-window // grain), np.int64)
    for r in rows.groupBy("step").count().collect():
        histogram[r["step"] - 1] = r["count"]
    chosen = plan(histogram)
    combined = max((first + number for _, _, number, first, _ in chosen), default=0)
    deals = spark.createDataFrame(
        chosen, "deal_step int, first_rank long, number long, first_sequence long, place int"
    )
    ranked = _ranked(rows)
    # at most three rows for each combination chosen, of which there are no more than steps
    dealt = ranked.join(
        F.broadcast(deals),
        (F.col("step") == F.col("deal_step")) & (F.col("rank") >= F.col("first_rank"))
        & (F.col("rank") < F.col("first_rank") + F.col("number")),
        "left",
    )
    sequence = F.col("first_sequence") + F.col("rank") - F.col("first_rank")
    dealt = written(
        dealt.select(*ranked.columns, sequence.alias("sequence_id"), "place"), "packing_places"
    )
    columns = ["key", "doc_id", "doc_tokens", "row_start", "row_length", "start", "length", "sequence_id", "offset"]
    ahead = Window.partitionBy("sequence_id").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    whole = dealt.where("sequence_id is not null").withColumns(
        {"offset": F.coalesce(F.sum("length").over(ahead), F.lit(0)), "start": F.col("row_start")}
    )

    rest = dealt.where("sequence_id is null").drop("sequence_id", "place")
    total = rest.agg(F.sum("length")).first()[0] or 0
    full = total // window
    cuts, at = [full * window], full * window  # where the sequences of the last window begin
    for size in (1 << bit for bit in range((total - at).bit_length() - 1, -1, -1)):
        if (total - at) & size and cuts[-1] + size < total:
            cuts.append(cuts[-1] + size)
    last = F.array(*[F.lit(c).cast("long") for c in cuts])
    placed = _end_to_end(rest).withColumn("until", F.col("position") + F.col("length"))
    inner = F.sequence(F.floor(F.col("position") / window) + 1, F.floor((F.col("until") - 1) / window))
    inner = F.when(
        F.floor((F.col("until") - 1) / window) > F.floor(F.col("position") / window),
        F.transform(inner, lambda w: w * window),
    ).otherwise(F.array().cast("array<bigint>"))
    inside = F.filter(last, lambda c: (c > F.col("position")) & (c < F.col("until")))
    begins = F.array_sort(F.array_distinct(F.concat(F.array("position"), inner, inside)))
    ends = F.concat(F.slice(begins, 2, F.size(begins)), F.array("until"))
    pieces = placed.select("*", F.explode(F.arrays_zip(begins.alias("b"), ends.alias("e"))).alias("piece"))
    begin = F.col("piece.b")
    # the sequence among the last window's, and where it begins
    which = F.size(F.filter(last, lambda c: c <= begin)) - 1
    is_last = begin >= full * window
    cut = pieces.withColumns(
        {
            "sequence_id": combined + F.when(is_last, full + which).otherwise(F.floor(begin / window)),
            "offset": F.when(is_last, begin - F.get(last, which)).otherwise(begin % window),
            "start": F.col("row_start") + begin - F.col("position"),
            "length": F.col("piece.e") - begin,
        }
    )
    return whole.select(columns).unionByName(cut.select(columns))


def with_ids(pieces: DataFrame, tokens: DataFrame) -> DataFrame:
    """``pieces`` with ``ids``, those of the piece."""
    ids = tokens.select("key", F.col("ids").alias("row_ids"))
    own = "substring(row_ids, int(4 * (start - row_start) + 1), int(4 * length))"
    return pieces.join(ids, "key").withColumn("ids", F.expr(own)).drop("row_ids")


def sequences(pieces: DataFrame, tokens: DataFrame) -> DataFrame:
    """``sequence_id, length, ids, pieces``: the packed sequences with their ids and, in order, what
    they consist of (``doc_id, start, length``). A sequence holds a window of ids at most."""
    parts = with_ids(pieces, tokens).groupBy("sequence_id").agg(
        F.array_sort(F.collect_list(F.struct("offset", "ids", "doc_id", "start", "length"))).alias("parts")
    )
    ids = F.aggregate("parts", F.lit(b""), lambda all, part: F.concat(all, part["ids"]))
    described = F.transform("parts", lambda p: F.struct(p["doc_id"], p["start"], p["length"]))
    return parts.select(
        "sequence_id", F.aggregate("parts", F.lit(0).cast("long"), lambda n, p: n + p["length"]).alias("length"),
        ids.alias("ids"), described.alias("pieces"),
    )


def digests(pieces: DataFrame, tokens: DataFrame) -> DataFrame:
    """``pieces`` with ``ids_crc32`` of their ids. Rows that were not cut have theirs already, so only
    the ids of the others are moved."""
    sums = tokens.select("key", "ids_crc32")
    uncut = pieces.where("length = row_length").join(sums, "key")
    cut = with_ids(pieces.where("length < row_length"), tokens)
    return uncut.unionByName(cut.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))
