"""Queries against their SQL, on a given and on an odd folder."""

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from shelfstar.llm import queries
from shelfstar.llm.oracles import ORACLES

from .test_operators import folder, odd_rows  # noqa: F401


def test_queries_are_registered():
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(ORACLES) <= set(entry.oracle_sql()) and set(ORACLES) <= set(queries.QUERIES)


@pytest.mark.parametrize("where", ["/root/testdata/sf0.001", "/root/testdata/sf0.01", "odd"])
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name, where, request):
    root = request.getfixturevalue("folder") if where == "odd" else where
    con = duckdb.connect()
    for table in ("documents", "labels", "pages"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{root}/{table}.parquet{'/*.parquet' if where == 'odd' else ''}'")
    df = queries.QUERIES[name](spark, root)
    cols = sorted(df.columns)
    cursor = con.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == cols
    want = Counter(tuple(r[names.index(c)] for c in cols) for r in cursor.fetchall())
    assert Counter(tuple(r[c] for c in cols) for r in df.collect()) == want


def test_quality_query_removes_lines_as_its_sql(spark, tmp_path):
    head = "\n".join(f"Line {k} that{k} stands{k} on{k} every{k} page{k}" for k in range(30))
    rows = [(i, (head.upper() if i % 2 else head) + "\n" + " ".join(f"w{i}x{k}" for k in range(10 if i % 7 == 0 else 200)), "hot" if i < 220 else "cold") for i in range(420)]
    spark.createDataFrame([(i, t, "en", s, len(t)) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    cursor = con.execute(ORACLES["op8_quality_rules"])
    names = [d[0] for d in cursor.description]
    got = queries.QUERIES["op8_quality_rules"](spark, str(tmp_path)).select(*names).collect()
    assert Counter(map(tuple, got)) == Counter(cursor.fetchall())
    assert {r["doc_id"] for r in got if r["n_removed_words"]} == set(range(220))
    assert {r["doc_id"] for r in got if not r["kept"]} == set(range(0, 220, 7)) and not any(r["base_failed"] for r in got)
