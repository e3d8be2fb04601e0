import datetime as dt
import glob
import os
import shutil
import subprocess
import sys
from decimal import Decimal

import duckdb
import pandas as pd
import pytest
from pyspark.sql import types as T

import starfold as sf
from sample import reporting as make_reporting
from plans import planned, settings
from sample import rows, star
from starfold.schema import reporting_schema, schema_of
from starfold.sources import shared_folder


@pytest.fixture(scope="module")
def sales(spark):
    return make_reporting(spark)


def test_export_is_sorted_typed_and_complete(spark, sales, tmp_path):
    path = sf.export_csv(sales, str(tmp_path / "new" / "folder"))
    lines = []
    for part in sorted(glob.glob(f"{path}/part-*.csv")):
        with open(part) as f:
            header, *body = f.read().splitlines()
        assert header == ",".join(sales.columns)
        lines += body
    assert [line.split(",")[0] for line in lines] == ["1", "2", "3", "4", "5", "8", "7"]
    back = sf.read_reporting_csv(spark, path, schema_of(sales))
    assert back.schema["YearMonth"].dataType == T.StringType()
    assert sorted(map(str, rows(back))) == sorted(map(str, rows(sales)))
    assert rows(sf.rollup_levels(back)) == rows(sf.rollup_levels(sales))


def test_export_spreads_copies_of_one_row(spark, tmp_path):
    df = spark.range(0, 40000, 1, 8).selectExpr("'k' AS SaleDate", "1 AS TransactionID")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        path = sf.export_csv(df, str(tmp_path / "copies"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sizes = [len(open(p).read().splitlines()) - 1 for p in glob.glob(f"{path}/part-*.csv")]
    assert sum(sizes) == 40000
    assert max(sizes) <= 10000


def test_default_reporting_schema_is_explicit():
    schema = reporting_schema()
    assert schema["YearMonth"].dataType == T.StringType()
    assert schema["SaleDate"].dataType == T.DateType()
    assert schema["SaleAmount"].dataType == T.DecimalType(18, 2)


AWKWARD = [
    (1, '5" pipe, steel', dt.datetime(2025, 5, 1, 10, 0, 0, 123456)),
    (2, "two\nlines\r\nand a \\ backslash\\", dt.datetime(2025, 5, 2)),
    (3, " lead trail ", None),
    (4, "", dt.datetime(2025, 5, 4)),
    (5, '"', dt.datetime(2025, 5, 5)),
    (6, None, None),
]


def test_export_is_lossless_and_other_tools_read_the_same(spark, tmp_path):
    df = spark.createDataFrame(AWKWARD, "id int, name string, at timestamp_ntz")
    path = sf.export_csv(df.coalesce(1), str(tmp_path / "csv"), ["id"])
    back = sf.read_reporting_csv(spark, path, df.schema)
    assert rows(back.orderBy("id")) == AWKWARD
    files = sorted(glob.glob(f"{path}/part-*.csv"))
    names = [r[1] or "" for r in AWKWARD]
    read = [pd.read_csv(f, keep_default_na=False, lineterminator=None) for f in files]
    assert list(pd.concat(read)["name"]) == names
    found = duckdb.connect().execute(
        "SELECT id, name, \"at\" FROM read_csv(?, header = true, quote = '\"', escape = '\"', new_line = '\\n') ORDER BY id",
        [files],
    ).fetchall()
    assert [r[1] or "" for r in found] == names
    assert [r[2] for r in found] == [r[2] for r in AWKWARD]


def test_part_files_are_bounded(spark, tmp_path):
    path = sf.export_csv(spark.range(100).coalesce(1), str(tmp_path / "csv"), ["id"], rows_per_file=10)
    assert max(len(open(p).read().splitlines()) - 1 for p in glob.glob(f"{path}/part-*.csv")) == 10


def test_columns_are_found_by_name_and_bad_values_raise(spark, tmp_path):
    schema = T.StructType.fromDDL("TransactionID string, SaleAmount decimal(18,2)")
    (tmp_path / "a.csv").write_text("SaleAmount,extra,TransactionID\n12.50,x,T1\n")
    assert rows(sf.read_reporting_csv(spark, str(tmp_path / "a.csv"), schema)) == [("T1", Decimal("12.50"))]
    (tmp_path / "b.csv").write_text("TransactionID,SaleAmount\nT1,12.5O\n")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|malformed"):
        sf.read_reporting_csv(spark, str(tmp_path / "b.csv"), schema).collect()
    (tmp_path / "c.csv").write_text("TransactionID\nT1\n")
    with pytest.raises(ValueError, match="no column SaleAmount"):
        sf.read_reporting_csv(spark, str(tmp_path / "c.csv"), schema)
    failed = sf.failed_values(spark, str(tmp_path / "b.csv"), schema)
    assert rows(failed) == [("TransactionID", 0), ("SaleAmount", 1)]


def test_whole_numbers_of_any_length_stay_exact(spark, tmp_path):
    (tmp_path / "in.csv").write_text(
        "a,b,c,d\n1234567890123456789,99999999999999999999,1" + "0" * 40 + ",1.5\n"
        "1234567890123456788,1,1" + "0" * 39 + "1,2\n"
    )
    df = sf.read_csv(spark, str(tmp_path / "in.csv"))
    assert [f.dataType.simpleString() for f in df.schema] == ["bigint", "decimal(38,0)", "string", "double"]
    assert rows(sf.duplicate_rows(df, ["a"])) == [(2, 2, 0)]
    assert df.first().a == 1234567890123456789


def test_a_file_added_between_two_calls_is_seen(spark, tmp_path):
    import __spark_entry__ as entry

    for name in ("region", "nation", "customer", "part", "orders", "lineitem"):
        os.makedirs(tmp_path / f"{name}.parquet")
        shutil.copy(f"/root/testdata/sf0.001/{name}.parquet", tmp_path / f"{name}.parquet" / "0.parquet")
    first = entry.queries()["row_count"](spark, str(tmp_path)).first()[0]
    shutil.copy("/root/testdata/sf0.001/lineitem.parquet", tmp_path / "lineitem.parquet" / "1.parquet")
    assert entry.queries()["row_count"](spark, str(tmp_path)).first()[0] == 2 * first


def test_folders_go_with_the_session(tmp_path):
    code = (
        "from pyspark.sql import SparkSession; from starfold.sources import shared_folder; "
        f"s = SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false')"
        f".config('spark.checkpoint.dir', '{tmp_path}').getOrCreate(); "
        "s.range(1).write.parquet(shared_folder(s, 'x')); s.stop()"
    )
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", code], check=True, cwd=root, timeout=120, capture_output=True)
    assert not glob.glob(f"{tmp_path}/starfold-*")


def test_read_csv_missing_texts(spark, tmp_path):
    (tmp_path / "in.csv").write_text("id,amount,note\n1,2.5,NA\n2,,null\nx,nan,ok\n4,7,None\n")
    df = sf.read_csv(spark, str(tmp_path / "in.csv"), "id int, amount double, note string")
    assert rows(df) == [(1, 2.5, None), (2, None, None), (None, None, "ok"), (4, 7.0, None)]
    assert rows(sf.missing_values(df)) == [(1, "id", 1), (2, "amount", 2), (3, "note", 3)]
    kept = sf.read_csv(spark, str(tmp_path / "in.csv"), "id int, amount double, note string", [""])
    assert [r.note for r in kept.collect()] == ["NA", "null", "ok", "None"]


def test_read_csv_types_columns_itself(spark, tmp_path):
    (tmp_path / "in.csv").write_text(
        "id,amount,YearMonth,flag,code,none,day\n"
        "1,2.5,2025-05,True,007,NA,2025-05-01\n"
        "2,,2025-06,false,1d,,2025-06-01\n"
        "NA,1e3,2025-07,,12,,\n"
    )
    df = sf.read_csv(spark, str(tmp_path / "in.csv"))
    assert [f.dataType.simpleString() for f in df.schema] == [
        "bigint", "double", "string", "boolean", "string", "double", "string",
    ]
    assert rows(df)[1] == (2, None, "2025-06", False, "1d", None, "2025-06-01")
    assert sf.numeric_columns(df) == ["id", "amount", "none"]


def test_mart_partitions_and_prunes(spark, sales, tmp_path):
    path = sf.write_mart(sales, str(tmp_path / "mart"))
    assert sorted(p.split("/")[-1] for p in glob.glob(f"{path}/SalesYear=*")) == [
        "SalesYear=2024", "SalesYear=2025", "SalesYear=__HIVE_DEFAULT_PARTITION__",
    ]
    mart = sf.read_mart(spark, path, schema_of(sales))
    assert mart.columns == sales.columns
    assert sorted(map(str, rows(mart))) == sorted(map(str, rows(sales)))
    assert rows(sf.drill_levels(mart, 2025)) == rows(sf.drill_levels(sales, 2025))
    assert "PartitionFilters: [isnotnull(SalesYear" in planned(sf.drill_levels(mart, 2025))
    assert sf.read_mart(spark, path).count() == 7


def test_mart_splits_a_year_that_holds_most_rows(spark, tmp_path):
    df = spark.range(0, 300_000, 1, 8).selectExpr(
        "IF(id % 3 = 0, 2024, 2000 + CAST(id % 20 AS INT)) AS SalesYear", "uuid() AS Region"
    )
    limits = {
        "spark__sql__adaptive__advisoryPartitionSizeInBytes": "256k",
        "spark__sql__adaptive__coalescePartitions__minPartitionSize": "64k",
    }
    with settings(spark, **limits):
        path = sf.write_mart(df, str(tmp_path / "hot"))
    sizes = [os.path.getsize(p) for p in glob.glob(f"{path}/SalesYear=2024/part-*")]
    assert len(sizes) > 5 and max(sizes) < 0.25 * sum(sizes)
    assert spark.read.parquet(path).count() == 300_000


def test_cuboid_mart(spark, sales, tmp_path):
    cuboid = sf.base_cuboid(sales)
    mart = sf.read_mart(
        spark, sf.write_mart(cuboid, str(tmp_path / "cuboid")), schema_of(cuboid)
    )
    assert rows(sf.rollup_levels(mart)) == rows(sf.rollup_levels(sales))


def test_warehouse(spark, tmp_path):
    for name, df in zip(("fact_sales", "dim_customers", "dim_products"), star(spark)):
        df.write.parquet(str(tmp_path / name))
    tables = sf.open_warehouse(spark, str(tmp_path))
    reporting = sf.build_reporting(
        tables["fact_sales"], tables["dim_customers"], tables["dim_products"]
    )
    assert reporting.count() == 7
    with pytest.raises(RuntimeError, match="warehouse: a_table, z_table$"):
        sf.open_warehouse(spark, str(tmp_path), {"z_table": (), "fact_sales": (), "a_table": ()})
    with pytest.raises(ValueError, match="dim_products is missing columns: Colour"):
        sf.open_warehouse(spark, str(tmp_path), {"dim_products": ("Category", "Colour")})


def test_required_catalog_tables(spark):
    spark.range(1).createOrReplaceTempView("dim_customers")
    with pytest.raises(RuntimeError, match="warehouse: dim_products, fact_sales$"):
        sf.require_tables(spark)
    sf.require_tables(spark, ["dim_customers"])


def test_shared_folder_follows_the_session(spark):
    assert shared_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert shared_folder(spark, "x") != shared_folder(spark, "x")
