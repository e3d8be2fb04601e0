import math

import numpy as np
import pandas as pd
import pytest

import starfold as sf
from plans import count, ran
from sample import rows
from starfold.operators import profile


@pytest.fixture(scope="module")
def small(spark):
    nan = float("nan")
    data = [(1.0, "x"), (nan, None), (nan, None), (1.0, "x"), (None, None)]
    return spark.createDataFrame(data, "a double, b string")


def test_structure_and_preview(small):
    assert rows(sf.structure(small)) == [(1, "a", "double", 5), (2, "b", "string", 5)]
    assert sf.preview(small).count() == 5
    assert sf.preview(small, 2).count() == 2


def test_missing(small):
    assert rows(sf.missing_values(small)) == [(1, "a", 3), (2, "b", 3)]
    assert rows(sf.total_missing(small)) == [(6,)]
    full = small.fillna({"a": 0.0, "b": ""})
    assert rows(sf.missing_values(full)) == []
    assert rows(sf.missing_values(full, only_present=False)) == [(1, "a", 0), (2, "b", 0)]
    assert rows(sf.total_missing(full)) == [(0,)]


def test_duplicates(small):
    assert rows(sf.duplicate_rows(small)) == [(5, 3, 2)]
    assert rows(sf.duplicate_rows(small.filter("false"))) == [(0, 0, 0)]


def test_duplicates_of_whole_long_texts(spark):
    stem = "word " * 4000
    texts = [stem + "a", stem + "b", stem + "a", "a", "a", None, None, "", "é" * 40, "é" * 40]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert rows(sf.duplicate_rows(df)) == [(10, 6, 4)]
    # A text that spells a digest is still told from the text it is the digest of.
    from pyspark.sql import functions as F

    long = df.limit(1)
    digest = long.select(F.sha2("t", 256).alias("t"))
    assert rows(sf.duplicate_rows(long.union(digest))) == [(2, 2, 0)]


def test_duplicates_like_pandas(spark):
    frame = pd.DataFrame(
        {"a": [0.0, -0.0, 1.5, np.nan, np.nan, 2.0], "b": ["x", "x", "y", None, None, "z"]}
    )
    df = spark.createDataFrame(
        [tuple(None if v is None else v for v in r) for r in frame.itertuples(index=False)],
        "a double, b string",
    )
    assert rows(sf.duplicate_rows(df))[0][2] == int(frame.duplicated().sum())


def test_one_rule_for_short_and_long_texts_of_a_collation(spark):
    texts = ["ABC", "abc", "A" * 80, "a" * 80, "x"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert rows(sf.duplicate_rows(df)) == [(5, 5, 0)]
    folded = df.selectExpr("t COLLATE UTF8_LCASE AS t")
    assert rows(sf.duplicate_rows(folded)) == [(5, folded.distinct().count(), 2)]


def test_duplicates_of_some_columns(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "id int, t string")
    assert rows(sf.duplicate_rows(df, ["t"])) == [(3, 2, 1)]
    assert rows(sf.duplicate_rows(df)) == [(3, 3, 0)]


def test_sketched_quartiles_have_the_right_ranks(spark):
    df = spark.range(20_000).selectExpr("id", "id % 7 AS few", "CAST(NULL AS DOUBLE) AS none").repartition(7)
    got = sf.sketch_check(df).collect()
    assert len(got) == 6 and all(r.enclosed for r in got)


def _described(df, **kwargs):
    return {r["column"]: r for r in sf.numeric_summary(df, **kwargs).collect()}


def test_numeric_summary_like_pandas(spark):
    random = np.random.default_rng(1)
    frame = pd.DataFrame(
        {
            "whole": random.integers(-50, 50, 999),
            "money": np.round(random.lognormal(5, 2, 999), 2),
            "gaps": np.where(random.random(999) < 0.3, np.nan, random.normal(0, 1, 999)),
            "same": np.full(999, 7.25),
        }
    )
    got = _described(spark.createDataFrame(frame).selectExpr("*", "true flag", "'t' text"))
    expected = frame.describe()
    assert set(got) == set(frame.columns)
    for name in frame.columns:
        for ours, theirs in zip(
            ("count", "mean", "std", "min", "p25", "p50", "p75", "max"), expected[name]
        ):
            assert got[name][ours] == pytest.approx(theirs, abs=0.00501), (name, ours)


@pytest.mark.parametrize("method", ["exact", "approx"])
def test_moments_of_parts_are_merged_without_losing_digits(spark, method):
    data = 1e9 + np.random.default_rng(3).normal(0, 0.5, 5000)
    df = spark.createDataFrame(pd.DataFrame({"v": data})).repartition(9)
    got = _described(df, method=method, scale=9)["v"]
    assert got["std"] == pytest.approx(np.std(data, ddof=1), rel=1e-6)
    assert got["mean"] == pytest.approx(np.mean(data), rel=1e-12)


@pytest.mark.parametrize("method", ["exact", "approx"])
def test_numeric_summary_of_nothing(spark, method):
    assert _described(spark.createDataFrame([("a",)], "t string"), method=method) == {}
    assert _described(spark.createDataFrame([], "a double"), method=method) == {}
    row = _described(spark.createDataFrame([(None,), (None,)], "a double"), method=method)["a"]
    assert row["count"] == 0 and row["mean"] is None and row["p50"] is None
    with pytest.raises(ValueError, match="method"):
        sf.numeric_summary(spark.createDataFrame([(1,)], "a int"), method="guess")


def test_single_value_and_decimal_columns(spark):
    df = spark.sql("SELECT 3.14BD AS d, 5 AS i, CAST(2.5 AS FLOAT) AS f")
    got = _described(df)
    assert (got["d"]["p50"], got["i"]["p25"], got["f"]["max"]) == (3.14, 5.0, 2.5)
    assert got["d"]["std"] is None


def test_column_names_are_literal(spark):
    df = spark.createDataFrame([(1, None), (1, None)], "`a.b` int, `c d` string")
    assert rows(sf.missing_values(df)) == [(2, "c d", 2)]
    assert rows(sf.duplicate_rows(df)) == [(2, 1, 1)]
    assert _described(df)["a.b"]["mean"] == 1.0


@pytest.mark.parametrize(
    "kind", ["heavy_tail", "cluster_and_outlier", "negative", "copies", "tiny_and_huge"]
)
def test_quantiles_by_counting_whatever_the_shape(spark, kind):
    random = np.random.default_rng(7)
    n = 4001
    data = {
        "heavy_tail": random.pareto(0.3, n),
        "cluster_and_outlier": np.append(1 + random.random(n) * 1e-9, [1.04, -5.0]),
        "negative": -np.exp(random.normal(0, 20, n)),
        "copies": np.where(random.random(n) < 0.4, 42.0, random.normal(42, 3, n)),
        "tiny_and_huge": np.concatenate(
            [[5e-324, -5e-324, 0.0, -0.0, 1.7e308, -1.7e308], random.normal(0, 1, n)]
        ),
    }[kind]
    wanted = {"lowest": 0.0, "p10": 0.1, "p333": 1 / 3, "p50": 0.5, "p99": 0.99, "highest": 1.0}
    df = spark.createDataFrame(pd.DataFrame({"v": data})).repartition(5)
    row = profile.quantiles(df, wanted, enough=10).first()
    for name, p in wanted.items():
        assert row[name] == pytest.approx(np.quantile(data, p), rel=1e-12, abs=0), name


def test_infinite_values_are_ordered(spark):
    data = [-math.inf, -1.0, 0.0, 1.0, math.inf]
    df = spark.createDataFrame([(v,) for v in data], "v double")
    row = profile.quantiles(df, {"a": 0.0, "b": 0.25, "c": 0.5, "d": 1.0}, enough=1).first()
    assert (row.a, row.b, row.c, row.d) == (-math.inf, -1.0, 0.0, math.inf)


def _typed(df, **kwargs):
    return {r["statistic"]: r for r in sf.typed_summary(df, **kwargs).collect()}


def test_large_whole_numbers_and_decimals_keep_every_digit(spark):
    top = 9007199254740993
    df = spark.range(101).selectExpr(
        f"{top - 100} + id AS big", "CAST(id - 50 AS SMALLINT) AS small",
        "CAST('12345678901234567890123456789.000000001' AS DECIMAL(38,9)) + CAST(id AS DECIMAL(3,0)) / 1000000000BD AS loose",
    ).selectExpr("*", "CAST(loose AS DECIMAL(38,9)) AS fine").drop("loose").repartition(7)
    for enough in (1 << 20, 3):
        got = _typed(df, enough=enough)
        assert [got[s].big for s in ("min", "p25", "p50", "p75", "max")] == [top - 100, top - 75, top - 50, top - 25, top]
        assert [got[s].small for s in ("min", "p50", "max")] == [-50, 0, 50]
        sorted_ = sorted(r.fine for r in df.select("fine").collect())
        assert [got[s].fine for s in ("min", "p25", "p50", "p75", "max")] == [sorted_[i] for i in (0, 25, 50, 75, 100)]
    assert [f.dataType for f in sf.typed_summary(df).schema][1:] == [f.dataType for f in df.schema]


@pytest.mark.parametrize("enough", [1, 40, 1 << 20])
def test_typed_values_are_those_at_the_rank(spark, enough):
    random = np.random.default_rng(5)
    frame = pd.DataFrame(
        {
            "wide": random.integers(-(2**63), 2**63 - 1, 997),
            "skewed": np.where(random.random(997) < 0.4, 42, random.integers(0, 10**6, 997)),
            "real": random.normal(0, 1e6, 997),
        }
    )
    got = _typed(spark.createDataFrame(frame).repartition(5), enough=enough)
    for name in frame:
        ordered = sorted(frame[name])
        for s, p in {"min": 0, "p25": 0.25, "p50": 0.5, "p75": 0.75, "max": 1}.items():
            assert got[s][name] == ordered[max(math.ceil(997 * p) - 1, 0)], (name, s)


def test_typed_summary_of_extremes_and_of_nothing(spark):
    ends = spark.sql("SELECT * FROM VALUES (-9223372036854775808L, -99999999999999999999999999999999999999BD), (9223372036854775807L, 99999999999999999999999999999999999999BD), (NULL, NULL) AS t(b, `d.e`)")
    got = _typed(ends, enough=1)
    assert (got["min"].b, got["max"].b, got["p50"].b) == (-(2**63), 2**63 - 1, -(2**63))
    assert (int(got["min"]["d.e"]), int(got["max"]["d.e"])) == (-(10**38 - 1), 10**38 - 1)
    odd = spark.createDataFrame([(math.nan, 1), (math.inf, None), (-0.0, 2), (None, 3)], "f double, statistic int")
    rows_ = {r["_statistic"]: r for r in sf.typed_summary(odd).collect()}
    assert (rows_["min"].f, rows_["max"].f, rows_["p50"]["statistic"]) == (0.0, math.inf, 2)
    assert [r.a for r in sf.typed_summary(spark.createDataFrame([], "a int")).collect()] == [None] * 5
    assert sf.typed_summary(spark.createDataFrame([("x",)], "t string")).columns == ["statistic"]


def test_one_scan_tells_the_same_as_the_single_operators(spark, tmp_path):
    nan = math.nan
    data = [(1, 9007199254740993, 1.5, "x", None), (2, None, nan, None, None), (None, 9007199254740992, 2.5, "", None)]
    spark.createDataFrame(data, "a int, `b.c` bigint, f double, t string, d date").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    profiled = sf.column_profile(df)
    got = profiled.collect()
    assert [(r.position, r["column"], r.type, r.rows) for r in got] == rows(sf.structure(df))
    assert [(r.position, r["column"], r.missing) for r in got] == rows(sf.missing_values(df, only_present=False))
    assert [r["column"] for r in got if r.numeric] == sf.numeric_columns(df)
    assert [(r.min, r.max) for r in got] == [("1", "2"), ("9007199254740992", "9007199254740993"), ("1.5", "2.5"), (None, None), (None, None)]
    described = _described(df)
    assert all((r.mean, r.std) == (described[r["column"]]["mean"], described[r["column"]]["std"]) for r in got if r.numeric)
    plan = ran(profiled)
    assert count(plan, r"FileScan|Scan parquet") == 1 and count(plan, r"Exchange SinglePartition") == 1
    empty = sf.column_profile(df.limit(0)).collect()
    assert [(r.rows, r.missing, r.min) for r in empty] == [(0, 0, None)] * 5
