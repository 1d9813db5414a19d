from pyspark.sql import functions as F

from shelfstar.functions.text import is_blank
from shelfstar.operators import dedup

SALES = [("a", "S1"), ("a", "S1"), ("b", ""), ("b", ""), ("c", "  "), ("d", None), ("e", "S2")]


def sales(spark):
    return spark.createDataFrame(SALES, "id string, sku string")


def test_duplicates_go_before_the_split(spark, rows):
    valid, rejected = dedup.split(dedup.dedup_exact(sales(spark)), is_blank("sku"))
    assert rows(valid) == [("a", "S1"), ("e", "S2")]
    assert rows(rejected, "id") == [("b",), ("c",), ("d",)]


def test_split_loses_no_row_on_a_null_predicate(spark):
    valid, rejected = dedup.split(sales(spark), F.col("sku") == "S1")
    assert valid.count() + rejected.count() == len(SALES)


def test_duplicate_report(spark, rows):
    assert rows(dedup.duplicate_report(sales(spark))) == [("a", "S1", 2), ("b", "", 2)]


def test_reconcile(spark):
    assert tuple(dedup.reconcile_rows(sales(spark)).first()) == (7, 2, 2, 3, True)
    assert tuple(dedup.reconcile_rows(sales(spark).limit(0)).first()) == (0, 0, 0, 0, True)


def test_null_counts_as_a_key(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, "x"), (None, None)], "a int, b string")
    assert tuple(dedup.key_counts(df, ["a", "b"]).first()) == (4, 3, 1)


def test_copies_counted_in_pieces(spark, rows):
    df = spark.range(0, 900, 1, 6).selectExpr("if(id % 7 = 0, null, concat('a', id % 50)) as id", "if(id % 5 = 0, null, cast(id % 3 as string)) as sku")
    whole = rows(dedup.count_copies(df))
    pieces = [rows(p) for p in dedup.copies_in_pieces(df, 4)]
    assert sorted((r for p in pieces for r in p), key=repr) == whole and sum(map(bool, pieces)) > 1
    assert [rows(p) for p in dedup.copies_in_pieces(df, 1)] == [whole]
