"""Personal data in texts: regular expressions propose spans, checksums confirm them, words nearby
adjust their score. Everything runs on Spark's own functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starfold.llm.common import free
from starfold.llm.text_spans import bound, digest, find_all, listed, of_kind, replaced

#: Proposing patterns, fixed values. Runs are matched from their beginning to their end and are not
#: tried again from within, so long runs take linear time.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}"
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}+(?![\x20-]?[0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: An account number is proposed by its first four characters; what may belong to it reaches to the
#: last end of a word within 34 characters.
IBAN, IBAN_REST = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}", r"(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
BASE = ("email", "ip", "card", "phone")
ADDED = ("iban", "ssn")
_BYTE = r"^(?:0*+(?:[1-9][0-9]?|1[0-9]{2}|2[0-4][0-9]|25[0-5])|0++)$"

#: Score of a confirmed span without any context, and the words that add to it.
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.7, "phone": 0.6, "iban": 0.6, "ssn": 0.3}
CONTEXT = {
    "email": "e-?mail|mail|contact|address",
    "ip": "ip|address|host|server|login",
    "card": "card|credit|debit|visa|payment",
    "phone": "phone|call|mobile|tel|fax",
    "iban": "iban|bank|account|transfer",
    "ssn": "ssn|social|security|tax",
}
_GAIN = 0.3

#: Characters of an account number by country, as registered.
IBAN_LENGTH = {
    country: length
    for length, countries in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
        21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
        24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR",
        27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
        29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for country in countries.split()
}


def luhn(digits: Column) -> Column:
    """True if the digits pass the Luhn check."""

    def add(so_far: Column, digit: Column) -> Column:
        value = digit.cast("int") * F.when(so_far["even"], 2).otherwise(1)
        value = F.when(value > 9, value - 9).otherwise(value)
        return F.struct((~so_far["even"]).alias("even"), (so_far["sum"] + value).alias("sum"))

    first = F.struct(F.lit(False).alias("even"), F.lit(0).alias("sum"))
    total = F.aggregate(F.split(F.reverse(digits), ""), first, add, lambda end: end["sum"])
    return total % 10 == 0


def mod97(account: Column) -> Column:
    """True if an account number, whose first four characters count as the last, is 1 modulo 97;
    letters are numbers from 10."""

    def add(rest: Column, char: Column) -> Column:
        code = F.ascii(char)
        return F.when(code >= 65, rest * 100 + code - 55).otherwise(rest * 10 + code - 48) % 97

    turned = F.concat(F.substring(account, 5, 64), F.substring(account, 1, 4))
    return F.aggregate(F.split(turned, ""), F.lit(0), add) == 1


def _only(value: Column, chars: str) -> Column:
    return F.regexp_replace(value, f"[^{chars}]", "")


def _accounts(text: Column) -> Column:
    """Account numbers. Every proposed start is tried, also within what follows another, with every
    end of a word after it, the last one first, as capitals and digits of the next words may look
    like more of the number: of a registered country only its own length is right, of other codes
    15 to 34 characters are; mod-97 decides."""
    lengths = F.create_map(*[F.lit(x) for pair in IBAN_LENGTH.items() for x in pair])

    def best(span: Column) -> Column:
        value = span["value"]

        def right(n: Column) -> Column:
            account = _only(F.substring(value, 1, n), "A-Z0-9")
            of_country = F.coalesce(lengths[F.substring(value, 1, 2)] == F.length(account), F.length(account) >= 15)
            return (F.substring(value, n + 1, 1).isin("", " ")) & (F.substring(value, n, 1) != " ") & of_country & mod97(account)

        size = F.get(F.filter(F.sequence(F.length(value), F.lit(15), F.lit(-1)), right), 0)
        return bound(size, lambda n: F.struct(
            span["start"].alias("start"), (span["start"] + n).alias("end"), F.substring(value, 1, n).alias("value")
        ))

    return F.filter(F.transform(find_all(text, IBAN, ahead=IBAN_REST), best), lambda s: s["end"].isNotNull())


def _confirmed(text: Column, kind: str) -> Column:
    """Proposed spans of a kind that its validator confirms."""
    if kind == "email":
        return find_all(text, EMAIL, F.contains(text, F.lit("@")))
    if kind == "ip":
        bytes_ = lambda s: F.forall(F.split(s["value"], r"\."), lambda p: F.regexp_like(p, F.lit(_BYTE)))
        return F.filter(find_all(text, IP), bytes_)
    if kind == "card":
        return F.filter(find_all(text, CARD), lambda s: luhn(_only(s["value"], "0-9")))
    if kind == "phone":
        found = find_all(text, PHONE, F.contains(text, F.lit("+")))
        return F.filter(found, lambda s: F.length(_only(s["value"], "0-9")).between(8, 15))
    if kind == "iban":
        return _accounts(text)
    return find_all(text, SSN)


def _scored(text: Column, spans: Column, kind: str, reach: int) -> Column:
    """Spans with ``score``: the prior of the kind, and more if one of its words is within ``reach``
    characters."""

    def score(span: Column) -> Column:
        before = F.greatest(span["start"] - reach, F.lit(0)).cast("int")
        near = F.substring(text, before + 1, (span["end"] - before + reach).cast("int"))
        hint = F.regexp_like(near, F.lit(rf"(?i)\b(?:{CONTEXT[kind]})\b"))
        found = PRIOR[kind] + F.when(hint, _GAIN).otherwise(0.0)
        return span.withField("score", F.least(found, F.lit(1.0)))

    return F.transform(spans, score)


def find(docs: DataFrame, least: float = 0.5, reach: int = 40, name: str = "_pii") -> DataFrame:
    """``docs`` with ``name``, which must be free: spans ``start, rank, end, kind, value, score`` by kind, then start.
    Email, ip, card and phone spans that are confirmed always count; account and social security
    numbers count from a score of ``least``. A null or empty text has none."""
    text = F.col("text")
    parts = []
    for rank, kind in enumerate((*BASE, *ADDED)):
        spans = _scored(text, of_kind(_confirmed(text, kind), kind, rank), kind, reach)
        parts.append(F.filter(spans, lambda s: s["score"] >= least) if kind in ADDED else spans)
    return docs.withColumn(name, F.concat(*parts))


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_iban, n_ssn, scores`` for every
    row of ``docs``; the text forms of spans are ``kind:start:end`` by kind, then start, joined by
    commas, the digest is of the first four kinds. Null and empty texts have none. Repeated rows stay
    repeated; other columns are not read."""

    def count(kind: str) -> Column:
        return F.size(F.filter("_pii", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("_pii", lambda s: s["rank"] < len(BASE))
    return find(docs.select("doc_id", "text")).select(
        "doc_id", *map(count, BASE), digest(base).alias("base_sha256"),
        listed(F.col("_pii")).alias("spans"), *map(count, ADDED),
        F.transform("_pii", lambda s: s["score"]).alias("scores"),
    )


def masked(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """``docs`` with every span in ``text`` replaced by its kind in brackets; all other columns, whatever
    their names, stay as they are."""
    (name,) = free(docs, "_pii")
    by_start = bound(F.col(name), lambda spans: F.array_sort(spans))
    text = replaced(F.col("text"), by_start, lambda s: F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))
    return find(docs, least, name=name).withColumn("text", text).select(docs.columns)
