"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starfold.sources import shared_folder

_TO_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the folder all machines share, and read again. It cuts the lineage: what
    took long is not computed twice, and a lost executor costs no more than its running tasks."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free(df: DataFrame, *names: str) -> list[str]:
    """``names``, each lengthened until no column of ``df`` has it in any case: what an operator puts
    beside a user's columns must not meet one of them."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def ascii_lower(text: str | None) -> bytes:
    """UTF-8 bytes with A-Z in lower case; null is empty."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_TO_LOWER)


def held_out(doc_id: Column | str, folds: int, fold: int) -> Column:
    """True if crc32(doc_id as text) mod ``folds`` is ``fold``; a null doc_id is not held out."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    remainder = F.crc32(doc_id.cast("string").cast("binary")) % folds
    return F.coalesce(remainder == fold, F.lit(False))


def sampled(df: DataFrame, by: Column, rows: int, total: int) -> DataFrame:
    """About ``rows`` of the ``total`` rows of ``df``, for fitting a model: those whose hash ``by`` is
    in the lowest part of its range. All rows, if there are no more. Every task decides for its own
    rows, so nothing is sorted or gathered."""
    if total <= rows:
        return df
    return df.where(F.shiftrightunsigned(by, 33) < int(rows / total * (1 << 31)))


def labelled(labels: DataFrame, label: str, folds: int, fold: int, rows: int) -> DataFrame:
    """``doc_id, y``: about ``rows`` labels at most (a bound of the model, not of the corpus) that may
    be learned from, chosen by a hash of doc_id. Null ids, null labels and held-out ids are left out;
    of repeated rows one stays."""
    y = F.col(label).cast("int")
    usable = labels.where(F.col("doc_id").isNotNull() & y.isin(0, 1) & ~held_out("doc_id", folds, fold))
    usable = usable.select("doc_id", y.alias("y")).distinct()
    return sampled(usable, F.xxhash64("doc_id"), rows, usable.count())


def with_text(docs: DataFrame, text: Column) -> DataFrame:
    """``docs`` with another text; n_chars is counted anew where the text has changed."""
    if "n_chars" in docs.columns:
        changed = ~F.col("text").eqNullSafe(text)
        n_chars = F.when(changed, F.length(text)).otherwise(F.col("n_chars"))
        docs = docs.withColumn("n_chars", n_chars.cast(docs.schema["n_chars"].dataType))
    return docs.withColumn("text", text)
