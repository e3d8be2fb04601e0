"""Benchmark decontamination with a generalised suffix automaton.

The automaton recognises every run of words of the test items. A document's words are streamed
through it while the length of the longest match that ends at the current word is tracked; where it
reaches the window, the words matched are part of the benchmark. A word that no item has leads back
to the root, so only runs of known words of at least the shortest window need to be streamed.
"""

from __future__ import annotations

import pickle
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starfold.llm.common import free, with_text, written

_NOT_WORD = bytes(
    32 if b < 0x30 or 0x3A <= b <= 0x60 or 0x7B <= b <= 0x7F else b for b in range(256)
)
_LOWERED = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")

_HITS = (
    "struct<n_words: bigint, spans: array<struct<first: bigint, last: bigint>>, items: array<string>>"
)


def words_of(text: str | None) -> list[bytes]:
    """Words of digits, letters and everything beyond ASCII, A-Z in lower case."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_LOWERED).translate(_NOT_WORD).split()


class Automaton:
    """Suffix automaton of the word sequences of ``items`` (id, text), with windows of ``window``
    words; an item of fewer words is one window, an item of none has none."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        self.window = window
        self.ids = [i for i, _ in items]
        self.vocabulary: dict[bytes, int] = {}
        self.step: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        sequences = []
        for _, text in items:
            words = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words_of(text)]
            sequences.append(words)
            at = 0
            for word in words:
                at = self._extend(at, word)
        self.shortest = min((min(len(s), window) for s in sequences if s), default=0)
        self._note_windows(sequences)

    def _state(self, length: int, link: int, step: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.step.append(step)
        return len(self.step) - 1

    def _divide(self, parent: int, word: int) -> int:
        """The target of ``parent`` by ``word``, divided if it also stands for longer runs."""
        target = self.step[parent][word]
        if self.length[target] == self.length[parent] + 1:
            return target
        twin = self._state(self.length[parent] + 1, self.link[target], dict(self.step[target]))
        self.link[target] = twin
        while parent >= 0 and self.step[parent].get(word) == target:
            self.step[parent][word] = twin
            parent = self.link[parent]
        return twin

    def _extend(self, last: int, word: int) -> int:
        if word in self.step[last]:  # another item has this run already
            return self._divide(last, word)
        new = self._state(self.length[last] + 1, 0, {})
        at = last
        while at >= 0 and word not in self.step[at]:
            self.step[at][word] = new
            at = self.link[at]
        if at >= 0:
            self.link[new] = self._divide(at, word)
        return new

    def _note_windows(self, sequences: list[list[int]]) -> None:
        owners: dict[int, set[int]] = defaultdict(set)
        self.short: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for item, words in enumerate(sequences):
            if not words:
                continue
            for state, matched, _ in self.follow(words):
                if matched >= self.window:
                    owners[self._suffix(state, self.window)].add(item)
            if len(words) < self.window:
                self.short[self._suffix(state, len(words))].append((len(words), item))
        self.owners = {k: sorted(v) for k, v in owners.items()}
        self.ends = [0] * len(self.link)  # the next state with short items, from here to the root
        for state in sorted(range(len(self.link)), key=self.length.__getitem__):
            up = self.link[state]
            self.ends[state] = state if state in self.short else (self.ends[up] if up >= 0 else -1)

    def _suffix(self, state: int, length: int) -> int:
        """The state of the last ``length`` words of what ``state`` stands for."""
        while self.length[self.link[state]] >= length:
            state = self.link[state]
        return state

    def follow(self, words):
        """``(state, longest match that ends here, position)`` after each word."""
        step, link, length = self.step, self.link, self.length
        state = matched = 0
        for position, word in enumerate(words):
            while word not in step[state] and state:
                state = link[state]
                matched = length[state]
            if word in step[state]:
                state = step[state][word]
                matched += 1
            yield state, matched, position

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Maximal hit spans (first and last word) and the ids of items with occurring windows."""
        if not self.shortest or len(words) < self.shortest:
            return [], set()
        known = np.fromiter(map(self.vocabulary.get, words, repeat(-1)), np.int64, len(words))
        breaks = np.concatenate([[-1], np.flatnonzero(known < 0), [len(words)]])
        long = np.flatnonzero(np.diff(breaks) - 1 >= self.shortest)
        spans: list[tuple[int, int]] = []
        items: set[int] = set()
        for run in long:
            start = int(breaks[run]) + 1
            for state, matched, at in self.follow(known[start : breaks[run + 1]].tolist()):
                reach = 0
                if matched >= self.window:
                    reach = self.window
                    items.update(self.owners[self._suffix(state, self.window)])
                end = self.ends[state]
                while end >= 0:
                    for size, item in self.short[end]:
                        if size <= matched:
                            reach = max(reach, size)
                            items.add(item)
                    up = self.link[end]
                    end = self.ends[up] if up >= 0 else -1
                if reach:
                    spans.append((start + at - reach + 1, start + at))
        return _merged(spans), {self.ids[i] for i in items}


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, last in sorted(spans):
        if out and first <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(out[-1][1], last))
        else:
            out.append((first, last))
    return out


class Shipped:
    """An automaton on its way to the tasks, as the bytes that a task built."""

    def __init__(self, spark: SparkSession, raw: bytes):
        self._raw = spark.sparkContext.broadcast(raw)

    @property
    def automaton(self) -> Automaton:
        return _unpacked(self._raw)

    def release(self) -> None:
        self._raw.unpersist()


@lru_cache(maxsize=1)
def _unpacked(raw) -> Automaton:
    return pickle.loads(raw.value)


def automata(items: DataFrame, window: int = 10, batch_words: int = 200_000) -> DataFrame:
    """``batch, automaton``: automata of all items, each of about ``batch_words`` words (and one item),
    dealt by a hash of the item and built in a task of its own; written. Items with a null id are left
    out, texts without words have no windows; an id is named by its text form."""
    chosen = items.where("item_id is not null").select(F.col("item_id").cast("string").alias("item_id"), "text")
    count = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"))
    batches = max(-(-(chosen.agg(F.sum(count)).first()[0] or 0) // batch_words), 1)
    batch = F.pmod(F.xxhash64("item_id", "text"), F.lit(batches)).cast("int")

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        texts = [t if isinstance(t, str) else None for t in rows["text"]]
        own = sorted(zip(rows["item_id"], texts, strict=True), key=lambda r: (r[0], r[1] or ""))
        raw = pickle.dumps(Automaton(own, window), protocol=5)
        return pd.DataFrame({"batch": rows["batch"].iloc[:1], "automaton": [raw]})

    dealt = chosen.withColumn("batch", batch).groupBy("batch")
    return written(dealt.applyInPandas(build, "batch int, automaton binary"), "decontamination_automata")


def _shipped(models: DataFrame, window: int) -> Iterator[Shipped]:
    """One automaton after the other, of bounded size; that of no items if there are none."""
    spark = models.sparkSession
    numbers = sorted(r["batch"] for r in models.select("batch").collect())
    for number in numbers:
        yield Shipped(spark, bytes(models.where(F.col("batch") == number).first()["automaton"]))
    if not numbers:
        yield Shipped(spark, pickle.dumps(Automaton([], window), protocol=5))


def _passes(frame: DataFrame, models: Iterable[Shipped], step) -> DataFrame:
    """``step(frame, shipped)`` for each automaton in turn; what a pass gives is written before the
    next one, so that no task holds two automata."""
    before = None
    for model in models:
        if before is not None:
            frame = written(frame, "decontamination_pass")
            before.release()
        before = model
        frame = step(frame, model)
    return frame


def contamination(
    docs: DataFrame, items: DataFrame, window: int = 10, batch_words: int = 200_000
) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` for every row of ``docs``.
    A null or empty text has no words; repeated rows stay repeated; other columns are not read."""

    def step(frame: DataFrame, model) -> DataFrame:
        def run(text, before):
            words = words_of(text)
            spans, found = model.automaton.scan(words)
            if before is not None:
                spans = _merged(spans + [tuple(s) for s in before.spans])
                found = found.union(before.items)
            return len(words), spans, sorted(found)

        return frame.withColumn("hit", F.udf(run, _HITS, useArrow=False)("text", "hit"))

    own = docs.select("doc_id", "text", F.lit(None).cast(_HITS).alias("hit"))
    found = _passes(own, _shipped(automata(items, window, batch_words), window), step)
    hits = F.aggregate("hit.spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"] + 1)
    named = F.sha2(F.array_join("hit.items", ",").cast("binary"), 256)
    return found.select(
        "doc_id", F.col("hit.n_words").alias("n_words"), hits.alias("n_hit"),
        F.size("hit.items").cast("long").alias("n_items"), named.alias("items_sha256"),
        (hits > 0).alias("contaminated"),
    )


def cut(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the characters from the first to the last word of each span."""
    places = [m.span() for m in _WORD.finditer(text)]
    for first, last in reversed(spans):
        text = text[: places[first][0]] + text[places[last][1] :]
    return text


def _taken(spans: list[tuple[int, int]]) -> int:
    return sum(last - first + 1 for first, last in spans)


def without_overlaps(text: str | None, model: Automaton) -> tuple[str | None, int, int]:
    """The text without the hit spans, the number of words taken out and the number there were. Taking
    a span out can bring the ends of another passage together, so it goes on until there is none."""
    taken, total = 0, None
    while text is not None:
        words = words_of(text)
        total = len(words) if total is None else total
        spans, _ = model.scan(words)
        if not spans:
            break
        taken += _taken(spans)
        text = cut(text, spans)
    return text, taken, total or 0


_CUT = "struct<text: string, taken: bigint, words: bigint>"
_SPANS = "array<struct<first: bigint, last: bigint>>"


def remove_overlaps(
    docs: DataFrame, items: DataFrame, window: int = 10, max_coverage: float = 0.5,
    batch_words: int = 200_000,
) -> DataFrame:
    """``docs`` without benchmark passages: spans of ``window`` words and more that an item has are
    taken out of the text, and documents of which more than ``max_coverage`` of the words were taken
    go altogether. ``n_chars``, if there is one, follows the text. Other documents, null and empty
    texts and all other columns, whatever their names, stay as they are; repeated rows stay repeated;
    an empty table on either side removes nothing.

    The result does not depend on ``batch_words``: with several automata the spans of all of them are
    found on the same text and merged before anything is cut, and rounds follow for the texts that
    were cut, until none is.
    """
    models = automata(items, window, batch_words)
    state, spans, still = free(docs, "_state", "_spans", "_open")
    if models.count() <= 1:
        (model,) = _shipped(models, window)
        clean = F.udf(lambda text: without_overlaps(text, model.automaton), _CUT, useArrow=False)
        done = docs.withColumn(state, clean("text"))
    else:
        def step(frame: DataFrame, model: Shipped) -> DataFrame:
            def find(text, before):
                own, _ = model.automaton.scan(words_of(text))
                return _merged([*map(tuple, before or []), *own])

            more = F.udf(find, _SPANS, useArrow=False)(f"{state}.text", spans)
            return frame.withColumn(spans, F.when(F.col(still), more).otherwise(F.col(spans)))

        def shorten(now, found):
            found = [tuple(s) for s in found or []]
            words = len(words_of(now.text)) if now.words is None else now.words
            return cut(now.text, found) if found else now.text, now.taken + _taken(found), words

        first = [F.lit(v).cast("bigint").alias(n) for n, v in (("taken", 0), ("words", None))]
        none = F.lit(None).cast(_SPANS)
        done = docs.withColumns(
            {state: F.struct("text", *first), spans: none, still: F.col("text").isNotNull()}
        )
        while True:
            found = written(_passes(done, _shipped(models, window), step), "decontamination_spans")
            hit = F.coalesce(F.size(spans) > 0, F.lit(False))
            now = F.udf(shorten, _CUT, useArrow=False)(state, spans)
            done = written(
                found.withColumn(state, now).withColumn(still, hit).withColumn(spans, none),
                "decontamination_round",
            )
            if done.where(still).isEmpty():
                break
    cleaned = done.where(F.col(f"{state}.taken") <= F.col(f"{state}.words") * max_coverage)
    return with_text(cleaned, F.col(f"{state}.text")).select(docs.columns)
