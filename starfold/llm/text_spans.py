"""Places of regular expressions in texts, with Spark's own functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SPANS = "array<struct<start: bigint, end: bigint, value: string>>"
_STATE = f"struct<at: bigint, spans: {SPANS}>"
#: Matches that are placed in one go, which spares copying a long list for each match.
_BLOCK = 256


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` mentions it."""
    return F.transform(F.array(value), use)[0]


def find_all(
    text: Column, pattern: str, only_if: Column | None = None, ahead: str | None = None
) -> Column:
    """Leftmost matches that do not overlap: array of ``start, end, value``, in code points, end
    exclusive. Each match is taken with the gap before it, and the lengths are added up. ``\\G`` in
    ``pattern`` is the end of the match before. ``only_if``: a cheaper condition that every match
    implies. ``ahead``: what has to follow a match is part of its value, yet not of the match, so
    that the next one may begin in it; ``pattern`` has no groups then. A null text has none."""
    if ahead is not None:
        seen = rf"(?=({ahead}))"
        gapped, there = F.lit(rf"(?s)\G(.*?)({pattern}){seen}"), F.regexp_like(text, F.lit(pattern + seen))
    else:
        gapped, there = F.lit(rf"(?s)\G(.*?)({pattern})"), F.regexp_like(text, F.lit(pattern))
    none = F.array().cast(SPANS)
    pairs = F.zip_with(
        F.regexp_extract_all(text, gapped, F.lit(1)), F.regexp_extract_all(text, gapped, F.lit(2)),
        lambda gap, value: F.struct(F.length(gap).alias("gap"), value.alias("value")),
    )
    if ahead is not None:
        pairs = F.zip_with(
            pairs, F.regexp_extract_all(text, gapped, F.lit(3)),
            lambda pair, rest: pair.withField("rest", rest),
        )

    def state(at: Column, spans: Column) -> Column:
        return F.struct(at.cast("bigint").alias("at"), spans.alias("spans")).cast(_STATE)

    def place(so_far: Column, pair: Column) -> Column:
        start = so_far["at"] + pair["gap"]
        end = start + F.length(pair["value"])
        value = pair["value"] if ahead is None else F.concat(pair["value"], pair["rest"])
        span = F.struct(start.alias("start"), end.alias("end"), value.alias("value"))
        return state(end, F.concat(so_far["spans"], F.array(span)))

    def placed(pairs: Column) -> Column:
        def block(so_far: Column, first: Column) -> Column:
            own = state(F.element_at(so_far, -1)["at"], none)
            return F.concat(so_far, F.array(F.aggregate(F.slice(pairs, first, _BLOCK), own, place)))

        firsts = F.sequence(F.lit(1), F.greatest(F.size(pairs), F.lit(1)), F.lit(_BLOCK))
        blocks = F.aggregate(firsts, F.array(state(F.lit(0), none)), block)
        return F.flatten(F.transform(blocks, lambda b: b["spans"]))

    there = there if only_if is None else only_if & there
    return F.when(there, bound(pairs, placed)).otherwise(none)


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def digest(spans: Column) -> Column:
    return F.sha2(listed(spans).cast("binary"), 256)


def of_kind(spans: Column, kind: str, rank: int) -> Column:
    """Spans with their kind and its rank, for sorting."""
    return F.transform(
        spans,
        lambda s: F.struct(
            s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"),
            F.lit(kind).alias("kind"), s["value"].alias("value"),
        ),
    )


def replaced(text: Column, spans: Column, mark: Callable[[Column], Column]) -> Column:
    """``text`` with each of ``spans`` (sorted by start; an overlap is replaced once) replaced by
    ``mark`` of it."""

    def put(so_far: Column, span: Column) -> Column:
        kept = F.substring(text, so_far["at"] + 1, F.greatest(span["start"] - so_far["at"], F.lit(0)).cast("int"))
        more = F.when(span["start"] >= so_far["at"], F.concat(kept, mark(span))).otherwise("")
        return F.struct(
            F.greatest(so_far["at"], span["end"]).cast("int").alias("at"),
            F.concat(so_far["out"], F.array(more)).alias("out"),
        )

    first = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    done = F.aggregate(
        spans, first, put,
        lambda end: F.concat(F.array_join(end["out"], ""), F.substring(text, end["at"] + 1, F.length(text))),
    )
    return F.when(F.size(spans) > 0, done).otherwise(text)
