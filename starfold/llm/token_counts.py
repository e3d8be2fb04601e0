"""Token counts of a corpus, kept up to date by changes.

Totals by source, language and tokenizer version are sums, so a change is a signed row: an inserted
document adds its tokens and itself, a deleted one takes both away, a revised count takes the old one
away and adds the new one. Changes come in batches. A batch is summed to one delta for each group,
and the deltas of a batch are written to the batch's own folder in one committed write; a batch that
is there already is not written again, so a job that is run twice counts once. Totals are sums of
deltas, at any time. Old batches can be folded: their sums are committed as a batch of its own that
names those it stands for; these are read no more, but their names stay taken.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starfold.llm.common import written

KEYS = ["source", "lang", "tokenizer"]
SUMS = ["documents", "tokens"]
_SCHEMA = "source string, lang string, tokenizer string, documents bigint, tokens bigint, batch string"


def words(text: Column) -> Column:
    """Runs of anything but white space."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint")


def pieces(text: Column) -> Column:
    """Runs of digits, of letters and what is beyond ASCII, and single other marks."""
    pattern = r"[0-9]+|[A-Za-z\x{80}-\x{10FFFF}]+|[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]"
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(pattern)).cast("bigint")


def bpe(model: str, ranks: str, pattern: str) -> Callable[[Column], Column]:
    """A counter by a public byte-level BPE."""
    from starfold.llm.bpe import codec

    count = F.udf(lambda text: len(codec(model, ranks, pattern).encode(text or "")), "bigint", useArrow=False)
    return lambda text: count(text)


def change(docs: DataFrame, tokenizer: str, tokens: Column, sign: int) -> DataFrame:
    """Signed rows of ``docs``: ``source, lang, tokenizer, documents, tokens``. Null sources and
    languages are groups of their own; a null text has no tokens; each repeated row counts."""
    return docs.select(
        F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"),
        F.lit(tokenizer).alias("tokenizer"), F.lit(sign).cast("bigint").alias("documents"),
        (tokens * sign).cast("bigint").alias("tokens"),
    )


def inserted(docs: DataFrame, tokenizer: str, tokens: Column) -> DataFrame:
    return change(docs, tokenizer, tokens, 1)


def deleted(docs: DataFrame, tokenizer: str, tokens: Column) -> DataFrame:
    return change(docs, tokenizer, tokens, -1)


def revised(docs: DataFrame, before: tuple[str, Column], after: tuple[str, Column]) -> DataFrame:
    """The counts of one tokenizer version replaced by those of another (or by new counts)."""
    return deleted(docs, *before).unionByName(inserted(docs, *after))


class Rollup:
    """Totals under ``path``, a folder that all machines share."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _folder(self, path: str):
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()), place

    def _is_file(self, path: str) -> bool:
        files, place = self._folder(path)
        return files.exists(place)

    def _there(self, batch: str) -> bool:
        return self._is_file(f"{self.path}/batch={batch}/_SUCCESS")

    def batches(self) -> list[str]:
        """Names of the committed batches."""
        files, place = self._folder(self.path)
        names = [f.getPath().getName() for f in files.listStatus(place)] if files.exists(place) else []
        names = [n.removeprefix("batch=") for n in names if n.startswith("batch=")]
        return sorted(n for n in names if self._there(n))

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Add the sums of ``changes`` under the name ``batch`` (letters, digits, ``-`` and ``_``);
        false if that batch was there. A failed attempt leaves no ``_SUCCESS`` and is written over.
        One writer at a time for a batch name. A list that a fold of that name left behind when it
        failed does not make the batch a fold."""
        if self._there(batch):
            return False
        files, left = self._folder(f"{self.path}/fold={batch}")
        files.delete(left, True)
        return self._add(batch, changes)

    def _add(self, batch: str, changes: DataFrame) -> bool:
        sums = changes.groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in SUMS])
        sums.where("documents <> 0 OR tokens <> 0").write.mode("overwrite").parquet(f"{self.path}/batch={batch}")
        return True

    def _folded(self, batches: list[str]) -> set[str]:
        """What the committed folds among ``batches`` stand for."""
        lists = [f"{self.path}/fold={name}" for name in batches]
        lists = [path for path in lists if self._is_file(f"{path}/_SUCCESS")]
        return {r.value for r in self.spark.read.text(lists).collect()} if lists else set()

    def live(self) -> list[str]:
        """Names of the committed batches that totals are read from: those no fold stands for."""
        batches = self.batches()
        return sorted(set(batches) - self._folded(batches))

    def fold(self, batch: str, names: list[str] | None = None) -> bool:
        """Commit the sums of the live batches ``names`` (all, if not given) as ``batch``, which then
        stands for them; false if that batch was there. Totals do not change. The list of names is
        written first and counts from the commit on; a failed attempt changes nothing."""
        if self._there(batch):
            return False
        live = self.live()
        names = live if names is None else names
        if not set(names) <= set(live):
            raise ValueError(f"not live: {sorted(set(names) - set(live))}")
        listed = self.spark.createDataFrame([(n,) for n in names], "value string")
        listed.coalesce(1).write.mode("overwrite").text(f"{self.path}/fold={batch}")
        return self._add(batch, self._read(names))

    def deltas(self) -> DataFrame:
        return self._read(self.live())

    def _read(self, names: list[str]) -> DataFrame:
        paths = [f"{self.path}/batch={name}" for name in names]
        if not paths:
            return self.spark.createDataFrame([], _SCHEMA)
        return self.spark.read.schema(_SCHEMA).option("basePath", self.path).parquet(*paths)

    def totals(self) -> DataFrame:
        """``source, lang, tokenizer, documents, tokens``; groups that are empty again are left out."""
        sums = self.deltas().groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in SUMS])
        return sums.where("documents <> 0 OR tokens <> 0")


Version = tuple[str, Callable[[Column], Column]]


def build(
    docs: DataFrame, path: str, old: Version = ("words-1", words), new: Version = ("pieces-2", pieces),
    beside: Version | None = None,
) -> Rollup:
    """The life of a corpus as batches: every document is inserted as counted by ``old``, and by
    ``beside``, a version that stays; all are counted anew by ``new`` instead of ``old``; documents whose
    text one of a smaller doc_id has are deleted from each version; what came before that is folded.
    Then each batch is delivered a second time, which changes nothing. Texts are read once.

    A document without a doc_id is never deleted, null and empty texts are copies of each other, rows
    that repeat a doc_id stay, and an empty table gives no totals. Other columns are not read."""
    text = F.coalesce(F.col("text"), F.lit(""))
    versions = {"old": old, "new": new} | ({"beside": beside} if beside else {})
    counted = docs.select(
        "doc_id", "source", "lang", F.sha2(text, 256).alias("digest"),
        *[count(text).alias(c) for c, (_, count) in versions.items()],
    )
    counted = written(counted, "token_counts_of_documents")
    # texts of one document take no part; written, so that Spark can split the rows of a hot text
    first = counted.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("rows"))
    first = written(first.where("rows > 1").select("digest", "first"), "token_counts_of_copies")
    copies = counted.join(first, "digest").where("doc_id > first")
    by = {c: (name, F.col(c)) for c, (name, _) in versions.items()}
    kept = [by[c] for c in by if c != "old"]
    rollup = Rollup(docs.sparkSession, path)
    batches = {"load": inserted(counted, *by["old"])}
    if beside:
        batches["load_beside"] = inserted(counted, *by["beside"])
    batches["recount"] = revised(counted, by["old"], by["new"])
    earlier = list(batches)
    batches["deduplicate"] = reduce(DataFrame.unionByName, [deleted(copies, *version) for version in kept])
    for _ in range(2):
        for name, changes in batches.items():
            rollup.commit(name, changes)
        rollup.fold("fold", earlier)
    return rollup
