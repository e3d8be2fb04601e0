"""Alignment of two tokenizations of the same bytes by interval coalescing.

Tokens of both sides are byte intervals. All of them are sorted by where they start, the running
maximum of their ends is kept, and a group ends where the next start reaches that maximum: there
tokens of both sides end. Within a group every pair of tokens whose bytes overlap is a link. How
often a pair of ids is linked in the whole corpus says which ids stand for each other.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starfold.llm.common import written

#: Link codes that a task sums up at once.
_CODES = 2_000_000
_DOCUMENT = (
    "struct<n_a: bigint, n_b: bigint, n_groups: bigint, n_links: bigint, groups_sha256: string, "
    "codes: binary, times: binary>"
)


def coalesce(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group of each token of A and of B, from 0. ``ends`` are the byte offsets where the tokens
    of a side end, rising; both sides cover the same bytes."""
    starts = np.concatenate([[0], ends_a[:-1], [0], ends_b[:-1]])
    ends = np.concatenate([ends_a, ends_b])
    order = np.lexsort((ends, starts))
    reach = np.maximum.accumulate(ends[order])
    breaks = np.concatenate([[False], starts[order][1:] >= reach[:-1]])
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(breaks)
    return group[: len(ends_a)], group[len(ends_a) :]


def links(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs (place in A, place in B) of tokens whose bytes overlap."""
    starts = np.concatenate([[0], ends_a[:-1]])
    first = np.searchsorted(ends_b, starts, "right")  # the first that ends beyond the start
    last = np.searchsorted(ends_b, ends_a, "left")  # the one that holds the last byte
    sizes = last - first + 1
    a = np.repeat(np.arange(len(ends_a)), sizes)
    return a, np.arange(len(a)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + first[a]


class Pair:
    """Tokenizer A, ranks of a byte-level BPE with its splitting pattern, and B, a sentencepiece
    model that puts a space before the text. Special tokens in a text are plain text to both."""

    def __init__(self, ranks: str, pattern: str, pieces: str):
        with open(ranks, "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self._a = tiktoken.Encoding("aligned", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self._b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        self._bytes_a = [b""] * (max(table.values()) + 1)
        for token, i in table.items():
            self._bytes_a[i] = token
        self._bytes_b = [self._raw(i) for i in range(self._b.get_piece_size())]
        self._size_a = np.fromiter(map(len, self._bytes_a), np.int64, len(self._bytes_a))
        self._size_b = np.fromiter(map(len, self._bytes_b), np.int64, len(self._bytes_b))
        # how a token reads in the list of groups, after each of the marks that can precede it
        self.width = len(self._bytes_b)
        self._words = [f"{mark}{i}" for mark in ("", ",", ";") for i in range(len(self._bytes_a))]
        self._words += [f"{mark}{i}" for mark in (",", "|") for i in range(self.width)]

    def _raw(self, i: int) -> bytes:
        piece = self._b.id_to_piece(i)
        if self._b.is_byte(i):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("▁", " ").encode()

    def encode(self, text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of both sides, or None: null and empty texts, and those whose tokens do not give back
        a space and the text."""
        if not text:
            return None
        want = b" " + text.encode()
        a = np.array(self._a.encode_ordinary(" " + text), np.int64)
        b = self._b.encode(text)
        # the tokens of A are stretches of the text in order, so that their length tells; B may change it
        if self._size_a[a].sum() != len(want) or b"".join(map(self._bytes_b.__getitem__, b)) != want:
            return None
        return a, np.array(b, np.int64)

    def groups(self, a: np.ndarray, b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray) -> str:
        """``a1,a2|b1;a3|b2,b3``: ids of A and of B in each group, in order."""
        new_a = np.diff(group_a, prepend=-1) > 0
        new_b = np.diff(group_b, prepend=-1) > 0
        mark = np.where(new_a, 2, 1)
        mark[0] = 0
        # a token comes after those of its own side and those of the other side in the groups before,
        # one of B also after those of A in its own group
        place = np.empty(len(a) + len(b), np.int64)
        place[np.arange(len(a)) + np.searchsorted(group_b, group_a)] = a + mark * len(self._bytes_a)
        place[np.arange(len(b)) + np.searchsorted(group_a, group_b, "right")] = (
            b + (new_b - 2) * self.width + len(self._words)
        )
        return "".join(map(self._words.__getitem__, place.tolist()))

    def document(self, text: str | None) -> tuple:
        """Numbers of tokens, groups and links, the digest of the groups, and the distinct codes
        ``a * width + b`` of the links with how often each occurs."""
        found = self.encode(text)
        if found is None:
            return 0, 0, 0, 0, "", b"", b""
        a, b = found
        ends_a, ends_b = np.cumsum(self._size_a[a]), np.cumsum(self._size_b[b])
        group_a, group_b = coalesce(ends_a, ends_b)
        at_a, at_b = links(ends_a, ends_b)
        codes, times = np.unique(a[at_a] * self.width + b[at_b], return_counts=True)
        listed = hashlib.sha256(self.groups(a, b, group_a, group_b).encode()).hexdigest()
        return (
            len(a), len(b), int(group_a[-1]) + 1, len(at_a), listed,
            codes.astype(np.int64).tobytes(), times.astype(np.int32).tobytes(),
        )


@lru_cache(maxsize=2)
def pair(ranks: str, pattern: str, pieces: str) -> Pair:
    return Pair(ranks, pattern, pieces)


def aligned(docs: DataFrame, ranks: str, pattern: str, pieces: str) -> DataFrame:
    """One row for each row of ``docs``: ``key`` (tells rows apart), ``doc_id``, the numbers, the digest
    and the links of :meth:`Pair.document`; written."""
    run = F.udf(lambda text: pair(ranks, pattern, pieces).document(text), _DOCUMENT, useArrow=False)
    marked = docs.select(F.monotonically_increasing_id().alias("key"), "doc_id", run("text").alias("d"))
    return written(marked.select("key", "doc_id", "d.*"), "alignment")


def _codes(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, code and number of all links of a batch."""
    codes = [np.frombuffer(c.as_buffer(), np.int64) for c in batch.column("codes")]
    times = [np.frombuffer(t.as_buffer(), np.int32) for t in batch.column("times")]
    none = np.empty(0, np.int64)
    row = np.repeat(np.arange(len(codes)), list(map(len, codes)))
    return row, np.concatenate([none, *codes]), np.concatenate([none, *times])


def pair_counts(documents: DataFrame) -> DataFrame:
    """``code, links``: how many links of the corpus each pair of ids has. Tasks sum up what they read,
    some millions of codes at once, before anything is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def sums() -> tuple[np.ndarray, np.ndarray]:
            codes, place = np.unique(np.concatenate([c for c, _ in held]), return_inverse=True)
            links = np.zeros(len(codes), np.int64)
            np.add.at(links, place, np.concatenate([t for _, t in held]))
            return codes, links

        for batch in batches:
            _, codes, times = _codes(batch)
            held.append((codes, times))
            size += len(codes)
            if size >= _CODES:
                held = [sums()]
                size = len(held[0][0])
                if size >= _CODES // 2:
                    yield pa.RecordBatch.from_arrays(list(map(pa.array, held[0])), ["code", "links"])
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays(list(map(pa.array, sums())), ["code", "links"])

    parts = documents.select("codes", "times").mapInArrow(run, "code long, links long")
    return parts.groupBy("code").agg(F.sum("links").alias("links"))


def align(
    docs: DataFrame, ranks: str, pattern: str, pieces: str, part_pairs: int = 2_000_000
) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` for every row of
    ``docs``: ``n_best`` counts the links whose pair is linked as often in the corpus as any with the
    same id of B, ``count_sum`` adds up over the links how often their pairs are.

    Null and empty texts and texts that a side does not give back have no tokens: zeros, and an empty
    digest. Repeated rows stay repeated and count. No rows give no rows. Other columns, of any name,
    are not read. The counts go to the documents in parts of about ``part_pairs`` pairs, 18 bytes
    each; each part takes a pass over the links.
    """
    spark = docs.sparkSession
    width = pair(ranks, pattern, pieces).width
    documents = aligned(docs, ranks, pattern, pieces)
    counts = written(pair_counts(documents), "alignment_counts")
    best = counts.groupBy((F.col("code") % width).alias("b")).agg(F.max("links").alias("most"))
    counts = counts.join(best, F.col("code") % width == F.col("b"))
    total = counts.count()
    parts = max(-(-total // part_pairs), 1)
    part = F.pmod(F.xxhash64("code"), F.lit(parts)).cast("int")
    counts = written(
        counts.select("code", "links", (F.col("links") == F.col("most")).alias("best"), part.alias("part")),
        "alignment_best",
    )

    def looked_up(own: DataFrame) -> DataFrame:
        rows = own.toPandas().sort_values("code")
        table = spark.sparkContext.broadcast(
            (rows["code"].to_numpy(np.int64), rows["links"].to_numpy(np.int64), rows["best"].to_numpy(bool))
        )

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known, links, is_best = table.value
            for batch in batches:
                row, codes, times = _codes(batch)
                at = np.minimum(np.searchsorted(known, codes), max(len(known) - 1, 0))
                there = known[at] == codes if len(known) else np.zeros(len(codes), bool)
                row, at, times = row[there], at[there], times[there]
                sums = [np.zeros(batch.num_rows, np.int64) for _ in range(2)]
                np.add.at(sums[0], row, times * is_best[at])
                np.add.at(sums[1], row, times * links[at])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key"), *map(pa.array, sums)], ["key", "n_best", "count_sum"]
                )

        read = documents.select("key", "codes", "times")
        return read.mapInArrow(run, "key long, n_best long, count_sum long")

    found = looked_up(counts.where("part = 0"))
    for number in range(1, parts):
        found = found.unionByName(looked_up(counts.where(F.col("part") == number)))
    found = found.groupBy("key").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return documents.drop("codes", "times").join(found, "key").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )


def token_map(docs: DataFrame, ranks: str, pattern: str, pieces: str) -> DataFrame:
    """``b, a, links``: for each id of B the ids of A it is most often linked with, ties included."""
    width = pair(ranks, pattern, pieces).width
    counts = written(pair_counts(aligned(docs, ranks, pattern, pieces)), "alignment_counts")
    counts = counts.select((F.col("code") % width).alias("b"), F.floor(F.col("code") / width).alias("a"), "links")
    order = Window.partitionBy("b").orderBy(F.desc("links"))
    return counts.withColumn("rank", F.rank().over(order)).where("rank = 1").drop("rank")
