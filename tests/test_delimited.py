"""Lines that don't fit their header."""

import pytest

from shelfstar.operators.quality import QualityError
from shelfstar.sources import delimited, tables


@pytest.fixture
def own(spark, tmp_path):
    session = spark.newSession()
    session.conf.set(tables.PREFIX, f"d{abs(hash(str(tmp_path)))}_")
    session.conf.set(tables.ROOT, str(tmp_path / "tables"))
    return session


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "t.csv").write_text('x|y\n1|2\n3|4|5\n6\n"a|b"|c\n"a|b"|c|\n|\n\n7|\n', encoding="utf-8")
    return str(tmp_path / "raw")


ENTRIES = [delimited.Entry("t.csv", "t")]


def test_lines_that_do_not_fit_are_kept_apart(own, rows, folder):
    got = delimited.ingest(own, folder, ENTRIES)["t"]
    assert rows(got, "x", "y") == [("1", "2"), ("7", None), ("a|b", "c"), (None, None)]
    assert delimited.LINE not in got.columns and delimited.LINE not in tables.leer_bronze(own, "t").columns
    wrong = delimited.invalid_lines(own, ENTRIES)
    assert rows(wrong, "tabla", "linea", "motivo") == [
        ("t", '"a|b"|c|', "sobran columnas"), ("t", "3|4|5", "sobran columnas"), ("t", "6", "faltan columnas")]
    assert all(r["archivo"].endswith("t.csv") for r in wrong.collect())
    assert [tuple(r) for r in delimited.line_control(own, ENTRIES).collect()] == [("lineas_invalidas_t", 3, True)]


def test_the_control_may_be_fatal(own, folder):
    with pytest.raises(QualityError, match="lineas_invalidas = 3"):
        delimited.ingest(own, folder, ENTRIES, fatal_lines=True)
    assert tables.current_version(own, "bronze.t") is None


def test_a_header_may_be_given(own, rows, folder):
    entry = delimited.Entry("t.csv", "t", columnas=("x", "y", "z"))
    got = delimited.ingest(own, folder, [entry])["t"]
    assert rows(got, "x", "y", "z") == [("3", "4", "5"), ("a|b", "c", None)]
    assert {r["motivo"] for r in delimited.invalid_lines(own, [entry]).collect()} == {"faltan columnas"}


def test_reasons(spark):
    from pyspark.sql import functions as F
    lines = ["1|2||4", "", '"a|b\\"|"|c|', '"a|b|c', "a|b|c|", "|||", "x"]
    got = spark.createDataFrame([(t,) for t in lines], "t string").select(delimited.line_reason(F.col("t"), 3)).collect()
    assert [r[0].split()[0] for r in got] == ["sobran", "faltan", "comillas", "comillas", "sobran", "sobran", "faltan"]


def test_plain_reading_is_as_before(own, rows, folder):
    assert len(rows(delimited.read_delimited(own, f"{folder}/t.csv"))) == 7
