"""Documents with the awkward cases that every operator must stand."""

CLASHING = (
    "score double, fp bigint, shard int, spans string, ids string, n_tokens string, held_out string, "
    "stats string, component_id bigint, size bigint, predicted int, `key` string, y int"
)
#: Names that operators use inside, in either case, with values that have to survive.
INTERNAL = [
    "_fp", "_ROW", "_state", "_SPANS", "_open", "_bpe", "_KEY", "_toxic", "_base", "_MORE", "_secrets", "_pii", "_done", "fp_", "row",
]
SCHEMA = f"doc_id bigint, text string, lang string, source string, n_chars bigint, {CLASHING}, " + ", ".join(f"`{n}` string" for n in INTERNAL)

LONG = ("word tale " * 9_000) + "x" * 30_000 + " é😀 " * 5_000
TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog and runs far away from here."),
    (2, "The quick brown fox jumps over the lazy dog and runs far away from here."),
    (2, "The quick brown fox jumps over the lazy dog and runs far away from here."),
    (3, ""),
    (4, None),
    (5, "   \n\t "),
    (6, LONG),
    (7, LONG),
    (8, "password = hunter2222 and mail a.b@c-d.org, card 4111 1111 1111 1111"),
    (9, "<|endoftext|>é 'tis 123\r\n\x00\x1f 中文字 \U0001f600"),
    (None, "no id at all"),
    (None, None),
]


def documents(spark, rows=None):
    rest = (None,) * len(CLASHING.split(", ")) + tuple(f"own {n}" for n in INTERNAL)
    data = [(i, t, "en" if i else None, "s" if t else None, None if t is None else len(t), *rest) for i, t in (TEXTS if rows is None else rows)]
    return spark.createDataFrame(data, SCHEMA)


LABELS = "doc_id bigint, quality int, toxic int, score double"


def no_labels(spark):
    return spark.createDataFrame([], LABELS)


def some_labels(spark):
    data = [(1, 1, 0, None), (2, 0, 1, None), (2, 1, 1, None), (3, None, None, None), (None, 1, 1, None), (6, 7, 9, None)]
    return spark.createDataFrame(data, LABELS)
