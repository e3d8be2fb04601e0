"""BPE encoding and decoding by tree concatenation.

A short text is encoded at once. A long one is halved, its halves are encoded apart, and the tokens
are joined again: a window of tokens around the join is encoded anew and grows until its first and
last tokens are those that both sides had before. In byte pair encoding a sequence is the encoding
of its text if each neighbouring pair of tokens is, so the tokens beyond the window need no second
look; at worst the window grows to the whole.

Texts beyond ``spread`` characters are cut into pieces that different tasks encode, and the tokens of
the pieces are joined in the same way, two and two.
"""

from __future__ import annotations

import base64
import hashlib
import json
from array import array
from functools import lru_cache

import pandas as pd
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starfold.llm.common import free

#: Characters that are encoded at once, and that one task encodes of a text.
LEAF = 8_192
SPREAD = 65_536


class Codec:
    """A byte-level BPE: ``model`` is a tokenizer file with its special tokens, ``ranks`` the same
    vocabulary as ranks. Special tokens in a text are encoded as such."""

    def __init__(self, model: str, ranks: str, pattern: str):
        with open(ranks, "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        with open(model, encoding="utf-8") as file:
            special = {t["content"]: t["id"] for t in json.load(file)["added_tokens"]}
        self._encoding = tiktoken.Encoding(
            "byte_bpe", pat_str=pattern, mergeable_ranks=table, special_tokens=special
        )
        self._special = list(special)
        table |= {content.encode(): i for content, i in special.items()}
        self._bytes = [b""] * (max(table.values()) + 1)
        for token, i in table.items():
            self._bytes[i] = token
        self._digits = [str(i).encode() for i in range(len(self._bytes))]

    def _leaf(self, text: str) -> list[int]:
        return self._encoding.encode(text, allowed_special="all")

    def encode(self, text: str) -> list[int]:
        at = self.cut(text, len(text) // 2, LEAF // 4) if len(text) > LEAF else 0
        if not 0 < at < len(text):
            return self._leaf(text)
        return self.join(self.encode(text[:at]), self.encode(text[at:]))

    def cut(self, text: str, at: int, within: int) -> int:
        """A place to cut near ``at``: never inside a special token; before white space that follows
        a word, if there is any near, as no token crosses it. Any such place gives the same tokens."""
        space = text.rfind(" ", max(1, at - within), at)
        while space > 1 and text[space - 1].isspace():
            space -= 1
        at = space if space > max(0, at - within) else at
        for token in self._special:
            start = text.find(token, max(0, at - len(token) + 1), at + len(token) - 1)
            if 0 <= start < at:
                return start or len(token)
        return at

    def pieces(self, text: str, size: int) -> list[str]:
        """``text`` in pieces of about ``size`` characters at most."""
        out, start = [], 0
        while len(text) - start > size:
            end = max(self.cut(text, start + size, size // 4), start)
            end = end if end > start else start + max(len(t) for t in self._special)
            out.append(text[start:end])
            start = end
        return [*out, text[start:]]

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The tokens of the text of ``left`` followed by the text of ``right``."""
        if not left or not right:
            return left + right
        size = 4
        while True:
            a, b = max(len(left) - size, 0), min(size, len(right))
            whole = a == 0 and b == len(right)
            try:
                tokens = self._leaf(self.raw(left[a:] + right[:b]).decode())
            except UnicodeDecodeError:  # the window begins or ends within a character
                tokens = None
            if tokens is not None:
                same_left = a == 0 or tokens[:2] == left[a : a + 2]
                same_right = b == len(right) or tokens[-2:] == right[b - 2 : b]
                if whole or same_left and same_right:
                    return left[:a] + tokens + right[b:]
            size *= 2

    def join_all(self, parts: list[list[int]]) -> list[int]:
        while len(parts) > 1:
            pairs = [self.join(*parts[i : i + 2]) for i in range(0, len(parts) - 1, 2)]
            parts = pairs + parts[2 * len(pairs) :]
        return parts[0] if parts else []

    def raw(self, ids: list[int]) -> bytes:
        return b"".join(map(self._bytes.__getitem__, ids))

    def decode(self, ids: list[int]) -> str:
        return self.raw(ids).decode("utf-8", "replace")

    def digests(self, ids: list[int]) -> tuple[int, str, str]:
        """Number of tokens, digest of their decimal ids joined by commas, digest of the decoded
        text."""
        listed = b",".join(map(self._digits.__getitem__, ids))
        text = self.decode(ids).encode()
        return len(ids), hashlib.sha256(listed).hexdigest(), hashlib.sha256(text).hexdigest()


@lru_cache(maxsize=4)
def codec(model: str, ranks: str, pattern: str) -> Codec:
    return Codec(model, ranks, pattern)


_OUT = "struct<n_tokens: bigint, ids_sha256: string, decoded_sha256: string, ids: array<int>>"


def encode(
    docs: DataFrame, model: str, ranks: str, pattern: str, keep_ids: bool = False,
    spread: int = SPREAD,
) -> DataFrame:
    """The rows of ``docs`` without ``text``, with ``n_tokens``, ``ids_sha256`` (of the decimal ids
    joined by commas), ``decoded_sha256`` (of the decoded text) and, with ``keep_ids``, ``ids``.

    Null is encoded as the empty text, with no tokens. Repeated rows stay repeated, an empty table
    gives none. Columns of ``docs`` that have one of these names, in any case, give way to the new
    ones; all others keep their values, whatever their names.
    """
    out, key = free(docs, "_bpe", "_key")

    def results(ids: list[int]) -> tuple:
        return *codec(model, ranks, pattern).digests(ids), ids if keep_ids else None

    whole = F.udf(lambda text: results(codec(model, ranks, pattern).encode(text or "")), _OUT, useArrow=False)
    is_long = F.length("text") > spread
    new = ["n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * keep_ids]
    kept = [c for c in docs.columns if c.lower() not in ("text", *new)]
    columns = [*kept, *[F.col(f"{out}.{c}").alias(c) for c in new]]

    short = docs.where(~F.coalesce(is_long, F.lit(False)))
    short = short.withColumn(out, whole("text")).select(columns)

    long = docs.where(is_long).withColumn(key, F.sha2("text", 256))
    divide = F.udf(
        lambda text: codec(model, ranks, pattern).pieces(text, spread), "array<string>", useArrow=False
    )
    part = F.udf(
        lambda text: array("i", codec(model, ranks, pattern).encode(text)).tobytes(), "binary",
        useArrow=False,
    )
    parts = (
        long.select(F.col(key).alias("_key"), F.posexplode(divide("text")).alias("place", "piece"))
        .dropDuplicates(["_key", "place"])  # equal texts are encoded once
        .select("_key", "place", part("piece").alias("tokens"))
    )

    def join_pieces(rows: pd.DataFrame) -> pd.DataFrame:
        lists = [list(array("i", bytes(b))) for b in rows.sort_values("place")["tokens"]]
        n, ids_sha256, decoded_sha256, ids = results(codec(model, ranks, pattern).join_all(lists))
        return pd.DataFrame(
            {"_key": rows["_key"].iloc[:1], "n_tokens": n, "ids_sha256": ids_sha256,
             "decoded_sha256": decoded_sha256, "ids": [ids]}
        )

    joined = parts.groupBy("_key").applyInPandas(
        join_pieces,
        "_key string, n_tokens long, ids_sha256 string, decoded_sha256 string, ids array<int>",
    )
    joined = joined.select(F.col("_key").alias(key), F.struct(*joined.columns[1:]).alias(out))
    return short.unionByName(long.drop("text").join(joined, key).select(columns))


def decode(tokens: DataFrame, model: str, ranks: str, pattern: str) -> DataFrame:
    """``tokens`` with ``text``, the text of the column ``ids``; null ids are the empty text."""
    read = F.udf(lambda ids: codec(model, ranks, pattern).decode(ids or []), "string", useArrow=False)
    return tokens.withColumn("text", read("ids"))
