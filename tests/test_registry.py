"""Registered queries against their SQL, and the plans they get."""

import math
import subprocess
import sys
from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from catalog import oracles, queries as registered

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def same(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


def test_every_query_has_its_sql():
    assert set(registered.queries()) == set(oracles.oracle_sql())
    assert set(registered.queries()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(registered.queries()))
def test_query_equals_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    cols = sorted(df.columns)
    cursor = duck.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == cols
    order = [names.index(c) for c in cols]
    want = Counter(tuple(same(r[i]) for i in order) for r in cursor.fetchall())
    got = Counter(tuple(same(r[c]) for c in cols) for r in df.collect())
    assert got == want


@pytest.mark.parametrize("missing", ["zstandard", "xxhash", "sentencepiece", "public_tokenizers", "shelfstar.llm"])
def test_a_missing_library_leaves_the_other_queries(missing):
    code = f"""
import sys
class Block:
    def find_spec(self, name, path=None, target=None):
        if name == {missing!r}:
            raise ModuleNotFoundError(name, name=name)
sys.meta_path.insert(0, Block())
import __spark_entry__ as entry
assert "sales_by_region" in entry.queries() and not any(q.startswith("op") and q[2].isdigit() for q in entry.queries())
assert set(entry.oracle_sql()) <= set(entry.queries())
"""
    subprocess.run([sys.executable, "-c", code], check=True, cwd=Path(entry.__file__).parent)


def test_flagship(spark):
    assert [r["region"] for r in entry.entry(spark).collect()]


def plan(spark, name):
    return entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


def test_report_reads_only_what_it_needs(spark):
    text = plan(spark, "sales_by_region")
    assert "l_shipdate" not in text and "l_orderkey" not in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoop" not in text


def test_filters_reach_the_scan(spark):
    assert "PushedFilters: [IsNotNull(s_nationkey), LessThan(s_nationkey,20)" in plan(spark, "completeness")


def test_references_group_the_fact_once(spark):
    text = plan(spark, "sales_references")
    assert text.count("l_suppkey") and len({line.split("FileScan")[1] for line in text.splitlines() if "FileScan" in line and "lineitem" in line}) == 1


@pytest.mark.parametrize("name", sorted(registered.queries()))
def test_no_python_and_no_cross_join_in_any_plan(spark, name):
    if name.startswith(("events_", "load_")) or name in ("delimited_round_trip", "verify_rows", "malformed_lines", "line_control", "anomalies_by_store_live"):
        pytest.skip("runs when built")
    text = plan(spark, name)
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert operator not in text


#: Sorted reports: their order as columns, a minus for the highest first.
SORTED = {
    "sales_by_region": ["-venta_total", "region"], "sales_by_category": ["-venta_total", "categoria"],
    "sales_cost_by_month": ["mes"], "sales_by_weekday": ["dia_semana_num"], "target_by_month": ["anio_mes"],
    "target_table": ["anio_mes", "nombre_tienda_display"], "fulfilment_by_store": ["-cumplimiento_pct", "nombre_tienda_display"],
    "closing_stock_by_month": ["mes"], "payment_counts": ["-count"], "tier_counts": ["tier_lealtad"],
}


@pytest.mark.parametrize("name", sorted(SORTED))
def test_reports_come_sorted(spark, name):
    rows = entry.queries()[name](spark, SF).collect()
    known = [c for c in SORTED[name] if c.lstrip("-") in rows[0].asDict()]
    assert rows and known

    def place(row):
        return [_place(c, row[c.lstrip("-")]) for c in known]

    assert rows == sorted(rows, key=place)


def _place(col, value):
    """Nulls are least: first in a rising order, last in a falling one."""
    if value is None:
        return (1, 0) if col[0] == "-" else (0, 0)
    return (0, -value) if col[0] == "-" else (1, value)
