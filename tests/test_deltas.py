import os
from datetime import date

import pytest

import sample
import starfold as sf
from starfold.sources import shared_folder


def rolled(df):
    return sample.rows(sf.rollup_levels(df))


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def test_batches_count_once_and_give_what_all_rows_give(spark):
    sales = sample.reporting(spark)
    mart = sf.DeltaMart(spark, shared_folder(spark, "deltas"))
    assert mart.read(sales).count() == 0
    late = sales["SaleDate"] >= date(2025, 5, 1)
    assert mart.commit("load", sales.filter(~late | sales["SaleDate"].isNull()))
    assert mart.commit("late", sales.filter(late))
    assert rolled(mart.read(sales)) == rolled(sales)
    assert not mart.commit("late", sales) and rolled(mart.read(sales)) == rolled(sales)
    assert mart.commit("wrong", sales.filter("Region = 'East'"))
    assert rolled(mart.read(sales)) != rolled(sales)
    assert mart.commit("corrected", removed=sales.filter("Region = 'East'"))
    assert rolled(mart.read(sales)) == rolled(sales)
    assert mart.commit("none", sales.limit(0)) and mart.commit("gone", removed=sales)
    assert mart.read(sales).count() == 0


def test_compaction_leaves_other_years_and_totals_as_they_were(spark):
    sales = sample.reporting(spark)
    path = shared_folder(spark, "deltas")
    mart = sf.DeltaMart(spark, path)
    mart.commit("load", sales.filter("SalesYear = 2024 OR SalesYear IS NULL OR YearMonth < '2025-05'"))
    mart.commit("late", sales.filter("YearMonth >= '2025-05'"))
    before = files(path)
    assert mart.compact("all", sales) and not mart.compact("all", sales)
    assert rolled(mart.read(sales)) == rolled(sales)
    assert {f: t for f, t in files(path).items() if f in before} == before
    folders = mart.folders()
    assert "batch=all/SalesYear=2025" in folders and "batch=load/SalesYear=2024" in folders
    assert len(folders) == len({f.split("/")[1] for f in folders})
    # a compaction that failed before its commit stands for nothing
    mart.commit("more", sales.filter("SalesYear = 2025"))
    mart.compact("failed", sales)
    os.remove(f"{path}/batch=failed/_SUCCESS")
    assert "batch=more/SalesYear=2025" in mart.folders()
    mart.commit("failed", removed=sales.filter("SalesYear = 2025"))
    assert rolled(mart.read(sales)) == rolled(sales)


def test_what_a_batch_may_be(spark):
    sales = sample.reporting(spark)
    mart = sf.DeltaMart(spark, shared_folder(spark, "deltas"))
    with pytest.raises(ValueError):
        mart.commit("a/b", sales)
    with pytest.raises(ValueError):
        mart.commit("a")
    with pytest.raises(ValueError):
        mart.commit("a", sales.withColumn("SaleAmount", sales["SaleAmount"].cast("double")))


def test_rows_that_do_not_fit_are_data(spark, tmp_path):
    (tmp_path / "a.csv").write_text('n,t\n1,x\ntwo,"y, z"\n,NA\n4\n5,u,v\n300,w\n')
    good, rejected = sf.sort_out_csv(spark, str(tmp_path), "t string, n tinyint")
    assert {tuple(r) for r in good.collect()} == {(None, None), ("x", 1)} and good.count() == 2
    got = {(r.record is None, tuple((f.column, f.value) for f in r.failed)) for r in rejected.collect()}
    assert (True, (("n", "two"),)) in got and (True, (("n", "300"),)) in got
    assert rejected.count() == 4 and rejected.filter("record IS NOT NULL").count() == 2
    assert {r.fields["n"] for r in rejected.collect()} >= {"two", "300"}
    assert {r.file for r in rejected.collect()} == {"a.csv"}
