"""Ranked lexical search, exact, over posting lists in geometric blocks.

Documents are read where they lie and become vectors over the terms of the queries. A task gathers
them into segments of a bounded number of postings. In a segment every term's posting list is
clustered by the similarity of its documents, which is taken from random projections of their
vectors, into blocks; a block keeps the coordinatewise maximum of its documents' impacts. The maxima
weighted by a query bound the score of every document of a block. Blocks are opened from the highest
bound down, and a block is skipped only when its bound is less than the score that the last of the k
best has so far. So nothing is lost, whatever the clusters are like.

A document's impact for a term is ``(10^9 tf) div (1000 tf + 12 m)``, where ``m`` grows with its
length, and a term's weight is ``floor(1000 ln((2N + 2) / (2df + 1)))``; all integers.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starfold.llm.common import written
from starfold.llm.decontaminate import words_of

#: Documents a block has on average, and the length of a document's projection.
_BLOCK = 64
_DIMENSIONS = 24
_NO_ID = np.iinfo(np.int64).max


def _ranges(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """All numbers from each start to before its end, one after the other."""
    sizes = ends - starts
    before = np.cumsum(sizes) - sizes
    return np.arange(int(sizes.sum())) + np.repeat(starts - before, sizes)


class Queries:
    """A block of queries: ``texts``, and after :meth:`weigh` the weights of their terms."""

    def __init__(self, texts: list[str | None]):
        self.vocabulary: dict[bytes, int] = {}
        self.terms, self.repeats = [], []
        for text in texts:
            counts = Counter(self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words_of(text))
            own = sorted(counts)
            self.terms.append(np.array(own, np.int64))
            self.repeats.append(np.array([counts[t] for t in own], np.int64))
        # for each term the terms of all queries that have it: the coordinates a summary needs
        asked: list[set[int]] = [set() for _ in self.vocabulary]
        for own in self.terms:
            for term in own.tolist():
                asked[term].update(own.tolist())
        self.beside = [np.array(sorted(a), np.int64) for a in asked]

    def vector(self, text: str | None) -> tuple[int, list[int], list[int]]:
        """All terms of a text with repeats, and its terms that any query has, with their numbers."""
        words = words_of(text)
        counts = Counter(words)
        own = sorted((self.vocabulary[w], counts[w]) for w in self.vocabulary.keys() & counts.keys())
        return len(words), [t for t, _ in own], [n for _, n in own]

    def weigh(self, documents: int, length: int, holders: dict[int, int]) -> None:
        self.documents, self.length = documents, length
        self.weights = np.array(
            [
                math.floor(1000 * math.log((2 * documents + 2) / (2 * holders.get(t, 0) + 1)))
                for t in range(len(self.vocabulary))
            ],
            np.int64,
        )


class Segment:
    """Blocked posting lists of documents ``ids`` of ``lengths`` terms; the postings of document i lie
    in ``terms`` and ``counts`` from ``starts[i]`` to ``starts[i + 1]``, by term."""

    def __init__(self, queries: Queries, ids, lengths, starts, terms, counts):
        self.queries, self.ids, self.starts, self.terms = queries, ids, starts, terms
        m = 75 + 25 * lengths * queries.documents // max(queries.length, 1)
        self.owners = np.repeat(np.arange(len(ids)), np.diff(starts))
        self.impacts = 1_000_000_000 * counts // (1000 * counts + 12 * m[self.owners])
        self._cluster()
        self._summarise()

    def _projections(self) -> np.ndarray:
        size = len(self.queries.vocabulary)
        signs = np.random.default_rng(17).choice([-1.0, 1.0], size=(size, _DIMENSIONS))
        signs *= self.queries.weights[:, None]
        out = np.zeros((len(self.ids), _DIMENSIONS))
        some = np.flatnonzero(np.diff(self.starts))
        if len(some):
            out[some] = np.add.reduceat(signs[self.terms] * self.impacts[:, None], self.starts[some], axis=0)
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-300)

    def _cluster(self) -> None:
        """``block_docs`` lists the documents of all blocks of all posting lists, block after block;
        ``block_starts`` says where each block begins, ``first_block`` where the blocks of each list
        do."""
        order = np.argsort(self.terms, kind="stable")
        lists = np.searchsorted(self.terms[order], np.arange(len(self.queries.vocabulary) + 1))
        docs = self.owners[order]
        near = self._projections()
        first, block_starts = [], []
        for term in range(len(lists) - 1):
            a, b = int(lists[term]), int(lists[term + 1])
            first.append(len(block_starts))
            if b - a <= _BLOCK:
                block_starts += [a] if b > a else []
                continue
            own = docs[a:b]
            centres = near[own[:: _BLOCK]]
            cluster = np.argmax(near[own] @ centres.T, axis=1)
            by = np.argsort(cluster, kind="stable")
            docs[a:b] = own[by]
            block_starts += (a + np.flatnonzero(np.diff(cluster[by], prepend=-1))).tolist()
        self.block_docs = docs
        self.first_block = np.array([*first, len(block_starts)])
        self.block_starts = np.array([*block_starts, len(docs)])

    def _summarise(self) -> None:
        """For each list and each term that some query has beside it: the blocks where that term
        occurs and its largest impact there, by ``list * size + term``."""
        size = len(self.queries.vocabulary)
        row = np.full(size, -1, np.int32)
        keys, blocks, most = [], [], []
        for term in np.flatnonzero(np.diff(self.first_block)).tolist():
            beside = self.queries.beside[term]
            row[beside] = np.arange(len(beside))
            low, high = self.first_block[term], self.first_block[term + 1]
            docs = self.block_docs[self.block_starts[low] : self.block_starts[high]]
            at = _ranges(self.starts[docs], self.starts[docs + 1])
            block = np.repeat(np.arange(high - low), np.diff(self.block_starts[low : high + 1]))
            block = np.repeat(block, self.starts[docs + 1] - self.starts[docs])
            coordinate = row[self.terms[at]]
            kept = coordinate >= 0
            largest = np.zeros(len(beside) * (high - low), np.int64)
            np.maximum.at(largest, coordinate[kept] * (high - low) + block[kept], self.impacts[at[kept]])
            row[beside] = -1
            some = np.flatnonzero(largest)
            keys.append(term * size + beside[some // (high - low)])
            blocks.append(low + some % (high - low))
            most.append(largest[some])
        none = np.empty(0, np.int64)
        self.keys, self.key_starts = np.unique(np.concatenate(keys or [none]), return_index=True)
        self.summary_blocks = np.concatenate(blocks or [none])
        self.summary_most = np.concatenate(most or [none])
        self.key_starts = np.append(self.key_starts, len(self.summary_blocks))

    def _bounds(self, query: int, gains: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Blocks of the query's lists, from the highest bound down, and the bounds."""
        own = self.queries.terms[query]
        size = len(self.queries.vocabulary)
        pairs = (own[:, None] * size + own[None, :]).ravel()
        at = np.searchsorted(self.keys, pairs)
        there = at < len(self.keys)
        there[there] = self.keys[at[there]] == pairs[there]
        at, coordinate = at[there], (pairs % size)[there]
        entries = _ranges(self.key_starts[at], self.key_starts[at + 1])
        weight = np.repeat(gains[coordinate], self.key_starts[at + 1] - self.key_starts[at])
        blocks, place = np.unique(self.summary_blocks[entries], return_inverse=True)
        # sums of doubles may fall short by a few units in the last place; the factor outweighs that
        bound = np.bincount(place, weights=weight * self.summary_most[entries].astype(float)) * (1 + 1e-9)
        order = np.argsort(-bound, kind="stable")
        return blocks[order], bound[order]

    def _scores(self, docs: np.ndarray, gains: np.ndarray) -> np.ndarray:
        at = _ranges(self.starts[docs], self.starts[docs + 1])
        ends = np.cumsum(self.starts[docs + 1] - self.starts[docs])
        return np.add.reduceat(gains[self.terms[at]] * self.impacts[at], np.concatenate([[0], ends[:-1]]))

    def search(self, query: int, k: int, best: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """The ``k`` best of ``best`` (ids, scores) and of the documents here."""
        gains = np.zeros(len(self.queries.vocabulary), np.int64)
        own = self.queries.terms[query]
        gains[own] = self.queries.weights[own] * self.queries.repeats[query]
        blocks, bound = self._bounds(query, gains)
        seen = np.zeros(len(self.ids), bool)
        at, step = 0, 4
        while at < len(blocks):
            least = best[1][k - 1] if len(best[1]) >= k else 1
            if bound[at] < least:
                break  # and so are all that follow
            opened = blocks[at : at + step][bound[at : at + step] >= least]
            at, step = at + step, 2 * step
            docs = self.block_docs[_ranges(self.block_starts[opened], self.block_starts[opened + 1])]
            docs = np.unique(docs[~seen[docs]])
            if not len(docs):
                continue
            seen[docs] = True
            score = self._scores(docs, gains)
            hit = score >= max(least, 1)
            best = _top(np.concatenate([best[0], self.ids[docs[hit]]]), np.concatenate([best[1], score[hit]]), k)
        return best


def _top(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


def _segments(queries: Queries, batches, postings: int) -> Iterator[Segment]:
    """Segments of about ``postings`` postings (and one batch) from batches of ``id, n, terms,
    counts``."""
    held, size = [], 0

    def segment() -> Segment:
        columns = list(zip(*held, strict=True))
        sizes = np.concatenate(columns[2])
        starts = np.concatenate([[0], np.cumsum(sizes)])
        ids, lengths, terms, counts = (np.concatenate(columns[i]) for i in (0, 1, 3, 4))
        return Segment(queries, ids, lengths, starts, terms, counts)

    for batch in batches:
        terms, counts = batch.column("terms"), batch.column("counts")
        held.append(
            (
                batch.column("id").to_numpy(), batch.column("n").to_numpy(),
                np.diff(terms.offsets.to_numpy()).astype(np.int64),
                terms.flatten().to_numpy(), counts.flatten().to_numpy().astype(np.int64),
            )
        )
        size += len(held[-1][3])
        if size >= postings:
            yield segment()
            held, size = [], 0
    if held:
        yield segment()


def _search_block(docs: DataFrame, asked: list, k: int, postings: int) -> DataFrame:
    """``query`` (place in ``asked``), ``doc_id, score``, at most ``k`` for each query and task."""
    context = docs.sparkSession.sparkContext
    queries = Queries([r["text"] for r in asked])
    model = context.broadcast(queries)
    vector = F.udf(
        lambda text: model.value.vector(text), "struct<n: bigint, terms: array<int>, counts: array<int>>",
        useArrow=False,
    )
    own = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("id"), vector("text").alias("v"))
    forward = written(own.select("id", "v.*"), "lexical_vectors")
    sums = forward.agg(F.count_if(F.col("n") > 0).alias("documents"), F.sum("n").alias("length")).first()
    # one row for each term of the block of queries
    holders = forward.select(F.explode("terms").alias("term")).groupBy("term").count().collect()
    queries.weigh(sums["documents"], sums["length"] or 0, {r["term"]: r["count"] for r in holders})
    weighed = context.broadcast(queries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = weighed.value
        none = (np.empty(0, np.int64), np.empty(0, np.int64))
        best = [none] * len(queries.terms)
        for segment in _segments(queries, batches, postings):
            for query in range(len(best)):
                best[query] = segment.search(query, k, best[query])
        sizes = [len(ids) for ids, _ in best]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(np.arange(len(best)), sizes), pa.int64()),
                pa.array(np.concatenate([ids for ids, _ in best] or [none[0]])),
                pa.array(np.concatenate([scores for _, scores in best] or [none[0]])),
            ],
            ["query", "doc_id", "score"],
        )

    return forward.where(F.size("terms") > 0).mapInArrow(run, "query long, doc_id long, score long")


def search(
    docs: DataFrame, items: DataFrame, k: int = 20, block_bytes: int = 16 << 20, postings: int = 400_000
) -> DataFrame:
    """``item_id, rank, doc_id, score``: for each row of ``items`` (``item_id``, ``text``) the ``k``
    documents of the highest score above 0, highest first, ties to the smaller doc_id (a whole
    number), a null one last.

    Items are taken in blocks of about ``block_bytes`` of text (and one item), each in one pass over
    all documents; a segment holds about ``postings`` postings. Null, empty and blank texts have no
    terms: as documents they are never found and not counted, as items they have no rows. Repeated
    rows of ``docs`` are documents of their own, repeated items are ranked once each, a null item_id
    is kept. An empty table gives no rows. Other columns, of any name, are not read.
    """
    spark = docs.sparkSession
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = size // block_bytes + 1
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    ids = items.select("item_id").schema
    found = []
    for number in range(blocks):
        asked = items.where(F.col("text").isNotNull() & (block == number)).select("item_id", "text").collect()
        names = spark.createDataFrame(
            [(i, r["item_id"]) for i, r in enumerate(asked)], f"query long, item_id {ids[0].dataType.simpleString()}"
        )
        best = written(_search_block(docs, asked, k, postings), "lexical_found")
        order = Window.partitionBy("query").orderBy(F.desc("score"), "doc_id")
        ranked = best.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k)
        doc_id = F.when(F.col("doc_id") < _NO_ID, F.col("doc_id")).alias("doc_id")
        # a block of queries is bounded, and so are its names
        found.append(ranked.join(F.broadcast(names), "query").select("item_id", "rank", doc_id, "score"))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out
