"""Secrets in texts: known shapes, and strings that look random to character Markov models.

Two first-order Markov models over ASCII characters, one of random strings and one of ordinary
identifiers, give a candidate the log-likelihood ratio of its character steps. The models are trained
from labelled strings: encoded digests are random; the words of all documents, in each case and joined
as names are, are ordinary. Everything runs on Spark's own functions.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable
from string import ascii_lowercase, ascii_uppercase, digits

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starfold.llm.common import free, with_text
from starfold.llm.text_spans import digest, find_all, listed, of_kind, replaced

#: Known shapes, fixed values. Each is leftmost and without overlaps; runs are matched from their
#: beginning to their end, so the least length may stand in the pattern.
ASSIGN = (
    r"""(?i:(?:password|passwd|secret|token|api_?key)["']?\x20*+[:=]\x20*+["']?([A-Za-z0-9+/_.=-]++))"""
)
ACCESS = r"AKIA[A-Z0-9]{16,}+"
HEX = r"[0-9a-f]{24,}+"
KINDS = ("assign", "access", "hex")
_VALUE = r"[A-Za-z0-9+/_.=-]+$"

_CHARS = r"A-Za-z0-9+/_=-"
_CODES = 128
#: What stands between the words of a name.
JOINS = "_-/"


def _assigned(match: Column) -> Column:
    return F.regexp_extract(match, rf"""(?s)[:=]\x20*["']?({_VALUE})""", 1)


def base_spans(text: Column) -> Column:
    """Array of ``start, rank, end, kind, value``, by start, then kind."""
    assign = F.filter(find_all(text, ASSIGN), lambda s: F.length(_assigned(s["value"])) >= 6)
    access = find_all(text, ACCESS, F.contains(text, F.lit("AKIA")))
    return F.array_sort(
        F.concat(
            of_kind(assign, "assign", 0), of_kind(access, "access", 1),
            of_kind(find_all(text, HEX), "hex", 2),
        )
    )


def random_strings(spark: SparkSession, seeds: int = 4096) -> DataFrame:
    """``value``: strings labelled random, digests of the numbers up to ``seeds`` in the encodings that
    keys come in: hexadecimal, base64 with either alphabet, letters and digits, base 36."""
    sha = F.sha2(F.col("id").cast("string"), 256)
    base64, base36 = F.base64(F.unhex(sha)), [F.conv(F.substring(sha, at, 15), 16, 36) for at in (1, 16, 31)]
    forms = F.array(
        sha, F.upper(F.md5(sha)), base64, F.translate(base64, "+/=", ""), F.translate(base64, "+/=", "-_"),
        F.lower(F.concat(*base36)),
    )
    return spark.range(seeds).select(F.explode(forms).alias("value"))


def ordinary_words(docs: DataFrame) -> DataFrame:
    """``value, n``: the words of all texts in lower case, labelled ordinary, and how often they are
    there, between ``^`` and ``$``. A word is a run of 2 to 30 Latin letters that touches no digit and
    no mark of an encoding. The words of a task are counted there before they are shuffled."""
    edge = "[A-Za-z0-9+/=]"
    found = F.regexp_extract_all("text", F.lit(rf"(?<!{edge})([A-Za-z]{{2,30}}+)(?!{edge})"), F.lit(1))
    words = docs.select(F.explode(found).alias("value"))
    counts = words.groupBy(F.lower("value").alias("value")).agg(F.count("*").alias("n"))
    return counts.select(F.concat(F.lit("^"), "value", F.lit("$")).alias("value"), "n")


def _steps(strings: DataFrame) -> Counter:
    """Character steps of ``value``, each ``n`` times: whether it is the second step, and both
    characters. At most two counts for each pair of characters reach the driver."""
    chars = F.split("value", "")
    pairs = F.zip_with(
        F.slice(chars, 1, F.size(chars) - 1), F.slice(chars, 2, F.size(chars) - 1), lambda a, b: F.concat(a, b)
    )
    placed = strings.where(F.length("value") >= 2).select(F.posexplode(pairs).alias("at", "step"), "n")
    counts = placed.groupBy((F.col("at") == 1).alias("second"), "step").agg(F.sum("n").alias("n"))
    return Counter({(r.second, r.step): r.n for r in counts.collect()})


def _named(steps: Counter) -> Counter:
    """Counts of steps of the identifiers that are made of words: each word in lower case, in capitals
    and with a capital, between any two separators; one word after another with a capital; and numbers
    after one word in twenty, of two digits on average. The chance of a join is the product of the
    chances of the letters beside it."""
    counts, first, ends = Counter(), Counter(), Counter()
    for (second, (a, b)), n in steps.items():
        if a == "^":
            first[b] += n
        elif b == "$":
            ends[a] += n
        else:
            counts[a, b] += len(JOINS) * (n if second else 2 * n)
            counts[a.upper(), b.upper()] += len(JOINS) * n
            counts[a.upper(), b] += len(JOINS) * n if second else 0
    words = sum(first.values())
    for mark in JOINS:
        for c, n in first.items():
            counts[mark, c] += n
            counts[mark, c.upper()] += 2 * n
        for c, n in ends.items():
            counts[c, mark] += 2 * n
            counts[c.upper(), mark] += n
    for a, n in ends.items():
        for b, m in first.items():
            counts[a, b.upper()] += 2 * n * m / max(words, 1)
        for digit in digits:
            counts[a, digit] += n / 200
            counts[a.upper(), digit] += n / 200
    for digit in digits:
        for other in digits:
            counts[digit, other] += words / 2000
        for mark in JOINS:
            counts[digit, mark] += words / 200
        for c, n in first.items():
            counts[digit, c] += n / 400
            counts[digit, c.upper()] += n / 400
    counts["_", "_"] += words / 25
    return counts


def _kind(char: str) -> str:
    return next((kind for kind in (ascii_lowercase, ascii_uppercase, digits) if char in kind), "+/_=-")


def _chances(counts: Counter, of_kinds: float, repeated: float) -> Callable[[str, str], float]:
    """Logarithm of the chance of a step: that of both characters, mixed with a share ``of_kinds`` for
    the kinds of both (lower case, upper case, digits, marks) and a share ``repeated`` for the same
    character again. So a step that the corpus never shows stays possible."""
    left, kinds, kind_left = Counter(), Counter(), Counter()
    for (a, b), n in counts.items():
        left[a] += n
        kinds[_kind(a), _kind(b)] += n
        kind_left[_kind(a)] += n

    def log_p(a: str, b: str) -> float:
        p = (kinds[_kind(a), _kind(b)] + 1) / (kind_left[_kind(a)] + 4) / len(_kind(b))
        if left[a]:
            p = of_kinds / (1 - repeated) * p + (1 - of_kinds / (1 - repeated)) * counts[a, b] / left[a]
        return math.log((1 - repeated) * p + (repeated if a == b else 0))

    return log_p


def train(docs: DataFrame, of_kinds: float = 0.4, repeated: float = 0.05) -> str:
    """Log-likelihood ratio of every step ``128 * code + next code``, random against ordinary, as
    numbers joined by commas. The ordinary class is learned from the words of all ``docs``, so the
    model does not depend on how they are stored; no texts leave it with the kinds alone."""
    random = Counter()
    for (_, (a, b)), n in _steps(random_strings(docs.sparkSession).withColumn("n", F.lit(1))).items():
        random[a, b] += n
    of_random = _chances(random, 0.01, 0.0)
    of_names = _chances(_named(_steps(ordinary_words(docs))), of_kinds, repeated)
    chars = set(ascii_lowercase + ascii_uppercase + digits + "+/_=-")
    both = ((chr(step // _CODES), chr(step % _CODES)) for step in range(_CODES * _CODES))
    return ",".join(f"{of_random(a, b) - of_names(a, b) if {a, b} <= chars else 0:.4f}" for a, b in both)


def log_ratio(value: Column, model: str) -> Column:
    """Log-likelihood ratio of the character steps of an ASCII string."""
    table = F.split(F.lit(model), ",").cast("array<double>")

    def step(so_far: Column, char: Column) -> Column:
        code = F.ascii(char)
        gain = F.get(table, so_far["last"] * _CODES + code)
        return F.struct(
            code.alias("last"), (so_far["sum"] + F.when(so_far["last"] >= 0, gain).otherwise(0.0)).alias("sum")
        )

    first = F.struct(F.lit(-1).alias("last"), F.lit(0.0).alias("sum"))
    return F.aggregate(F.split(value, ""), first, step, lambda end: end["sum"])


def random_spans(
    text: Column, model: str, min_length: int = 16, min_ratio: float = 6.0, letterless: int = 20
) -> Column:
    """Runs of at least ``min_length`` characters of identifiers whose log-likelihood ratio is at
    least ``min_ratio``, that is e to that power times likelier if they are random. Without a letter
    they count from ``letterless`` characters on: shorter ones are card and other numbers."""
    runs = find_all(text, rf"(?:\G|(?<![{_CHARS}]))[{_CHARS}]{{{min_length},}}+")
    long = lambda s: (F.length(s["value"]) >= letterless) | F.regexp_like(s["value"], F.lit("[A-Za-z]"))
    return F.filter(runs, lambda s: long(s) & (log_ratio(s["value"], model) >= min_ratio))


def with_spans(docs: DataFrame, model: str, base: str = "_base", more: str = "_more") -> DataFrame:
    """``docs`` with ``base``, the spans of known shape, and ``more``, the random strings that are not
    part of one of these (kind ``markov``); both by start, then kind; the names must be free. A random string that reaches
    beyond a known shape stays whole beside it."""
    found = docs.withColumns({base: base_spans(F.col("text")), more: random_spans(F.col("text"), model)})
    beyond = F.filter(
        of_kind(F.col(more), "markov", 3),
        lambda s: ~F.exists(base, lambda b: (b["start"] <= s["start"]) & (s["end"] <= b["end"])),
    )
    return found.withColumn(more, beyond)


def ratios(spans: Column, model: str) -> Column:
    """Log-likelihood ratio of each span, of an assignment that of the value assigned."""
    value = lambda s: F.when(s["kind"] == "assign", _assigned(s["value"])).otherwise(s["value"])
    return F.transform(spans, lambda s: F.round(log_ratio(value(s), model), 3))


def scan(docs: DataFrame, model: str | None = None) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_markov, ratios`` for every row of
    ``docs``; the text forms of spans are ``kind:start:end`` by start, then kind, joined by commas, the
    digest is of those of known shape; ``ratios`` are those of all spans in the same order. ``model``:
    from ``train``, of ``docs`` themselves if none is given. Null and empty texts have no spans; texts
    of any length are read whole; no rows give no rows. Repeated rows stay repeated; other columns are
    not read."""
    model = model or train(docs)

    def count(kind: str) -> Column:
        return F.size(F.filter("_base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    spans = F.array_sort(F.concat("_base", "_more"))
    return with_spans(docs.select("doc_id", "text"), model).select(
        "doc_id", *map(count, KINDS), digest(F.col("_base")).alias("base_sha256"),
        listed(spans).alias("spans"), F.size("_more").cast("long").alias("n_markov"),
        ratios(spans, model).alias("ratios"),
    )


def redacted(docs: DataFrame, model: str | None = None) -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by ``[SECRET]``; n_chars follows the text. Other
    texts and all other columns, whatever their names, stay as they are, null stays null; texts of
    any length are read whole; repeated rows stay repeated, an empty table stays empty. ``model``: as
    of ``scan``."""
    base, more, secrets = free(docs, "_base", "_more", "_secrets")
    marked = with_spans(docs, model or train(docs), base, more)
    marked = marked.withColumn(secrets, F.array_sort(F.concat(base, more)))
    text = replaced(F.col("text"), F.col(secrets), lambda s: F.lit("[SECRET]"))
    return with_text(marked, text).select(docs.columns)
