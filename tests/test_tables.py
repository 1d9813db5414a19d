"""Versions, views, the pointer of a load, and what is left behind."""

from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from shelfstar.operators.quality import QualityError
from shelfstar.plans import jobs
from shelfstar.sources import tables

from .test_jobs import SALES, write_files


@pytest.fixture
def own(spark, tmp_path):
    """A session with schemas and a folder of its own."""
    session = spark.newSession()
    session.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    session.conf.set("spark.sql.shuffle.partitions", "2")  # tables of a few rows
    session.conf.set(tables.PREFIX, f"t{abs(hash(str(tmp_path)))}_")
    session.conf.set(tables.ROOT, str(tmp_path / "tables"))
    return session


def star(session):
    """Sales by region through the published names, as a reader's SQL would join them."""
    p = session.conf.get(tables.PREFIX)
    rows = session.sql(f"""SELECT t.region, sum(v.venta_total) AS total, count(*) AS n FROM {p}gold.FactVentas v
        LEFT JOIN {p}gold.DimTienda t ON v.tienda_key = t.tienda_key GROUP BY t.region ORDER BY 1""").collect()
    return [tuple(r) for r in rows]



def more_sales(folder):
    """Another store before all others, so that every store key is renumbered, and a sale in it."""
    from .test_jobs import STORES as known
    return write_files(folder, tiendas=["50|Nueva|Lima|Chile|Chile|Express|2020/01/05", *known],
                       presupuesto_metas=[f"{t}|2025/{m:02d}|{100 + m}.50|{20 + m}" for t in (50, 101, 102, 125) for m in range(1, 13)],
                       ventas_transacciones=[*SALES, "T8|2025/02/02|10:00:00|50|5001|1|SKU-1|1|70.00|0|TARJETA"])


OLD = [("México", Decimal("0.50"), 1), ("Perú", Decimal("227.14"), 3)]
NEW = [("Chile", Decimal("70.00"), 1), *OLD]


@pytest.mark.parametrize("by_day", [False, True])
def test_a_reader_sees_one_star_at_every_statement(own, tmp_path, monkeypatch, by_day):
    jobs.run_batch(own, write_files(tmp_path / "a"))
    assert star(own) == OLD
    seen, run = [], tables._run

    def watched(spark, statement):
        run(spark, statement)
        if "gold" in statement:
            seen.append(star(spark))

    monkeypatch.setattr(tables, "_run", watched)
    jobs.run_batch(own, more_sales(tmp_path / "b"), partition_sales=by_day)
    assert len(seen) > 20 and seen[0] == OLD and seen[-1] == NEW
    assert seen == sorted(seen, key=lambda s: s == NEW) and all(s in (OLD, NEW) for s in seen)
    plan = own.sql(f"SELECT * FROM {own.conf.get(tables.PREFIX)}gold.FactVentas")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Union" not in plan


def test_a_load_that_fails_after_the_dimensions_leaves_the_old_star(own, tmp_path, monkeypatch):
    jobs.run_batch(own, write_files(tmp_path / "a"))
    before = {t: tables.versions(own, f"gold.{t}") for t in ("DimTienda", "FactVentas")}

    def fails(*args, **options):
        raise QualityError("no facts today")

    monkeypatch.setattr(jobs, "gold_facts", fails)
    with pytest.raises(QualityError, match="today"):
        jobs.run_batch(own, more_sales(tmp_path / "b"))
    assert star(own) == OLD and own.table(f"{own.conf.get(tables.PREFIX)}silver.dim_tienda").count() == 4
    assert {t: tables.versions(own, f"gold.{t}") for t in before} == before
    monkeypatch.undo()
    jobs.run_batch(own, more_sales(tmp_path / "c"))
    assert star(own) == NEW


def folders(root, table):
    return sorted(p.name for p in (root / table).iterdir() if p.is_dir())


def test_earlier_versions_go_but_pinned_ones_stay(own, tmp_path):
    df = own.range(5)
    tables.publish(df, "silver.x")
    first = tables.versions(own, "silver.x")[0]
    tables.pin(own, "silver.x", first)
    for n in range(3):
        tables.publish(own.range(n), "silver.x")
    root = tmp_path / "tables" / f"{own.conf.get(tables.PREFIX)}silver"
    left = tables.versions(own, "silver.x")
    assert len(left) == 3 and left[0] == first and folders(root, "x") == left
    assert tables.at_version(own, "silver.x", first).count() == 5
    assert own.table(tables.named(own, "silver.x")).count() == 2
    tables.pin(own, "silver.x", first, pinned=False)
    tables.publish(own.range(9), "silver.x")
    assert first not in tables.versions(own, "silver.x") and len(folders(root, "x")) == 2


def test_three_loads_leave_two_of_every_table_and_nothing_staged(own, tmp_path):
    for name in "abc":
        jobs.run_batch(own, write_files(tmp_path / name))
    prefix = own.conf.get(tables.PREFIX)
    for table in ("gold/FactVentas", "gold/DimTienda", "silver/ventas_enriquecidas", "bronze/ventas_transacciones"):
        assert len(folders(tmp_path / "tables", f"{prefix}{table}")) == 2, table
    assert folders(tmp_path / "tables" / f"{prefix}staging", "ventas_unicas") == []


def test_other_columns_and_partitions_without_a_gap(own, monkeypatch):
    first = own.range(6).withColumn("a", F.col("id") % 2)
    tables.publish(first, "silver.y")
    name, seen, run = tables.named(own, "silver.y"), [], tables._run

    def watched(spark, statement):
        run(spark, statement)
        seen.append((spark.table(name).columns, spark.table(name).count()))

    monkeypatch.setattr(tables, "_run", watched)
    tables.publish(first.withColumn("b", F.lit("x")), "silver.y", partition_by="a")
    tables.publish(own.range(3).select(F.col("id").cast("string").alias("id")), "silver.y")
    kinds = [k for n, k in enumerate(seen) if n == 0 or k != seen[n - 1]]
    assert kinds == [(["id", "a"], 6), (["id", "a", "b"], 6), (["id"], 3)]


def test_loads_with_other_columns_and_partitions(own):
    with tables.new_load(own) as load:
        load.write(own.range(4).withColumn("a", F.lit(1)), "T")
    with tables.new_load(own) as load:
        load.write(own.range(7).withColumn("b", F.col("id") % 3), "T", partition_by="b")
    assert own.table(tables.named(own, "gold.T")).columns == ["id", "b"] and own.table(tables.named(own, "gold.T")).count() == 7
    with tables.new_load(own) as load:
        load.write(own.range(0).withColumn("b", F.lit("x")), "T", partition_by="b")
    assert own.table(tables.named(own, "gold.T")).count() == 0


def test_observed_controls_stop_a_version(own, tmp_path):
    df = own.range(10)
    with pytest.raises(QualityError, match="pares = 5"):
        tables.publish(df, "silver.z", forbidden={"pares": F.col("id") % 2 == 0})
    with pytest.raises(QualityError, match="filas = -1"):
        tables.publish(df, "silver.z", measures=jobs.row_count(), expected={"filas": Decimal(11)})
    assert not own.catalog.tableExists(tables.named(own, "silver.z")) and tables.versions(own, "silver.z") == []
    tables.publish(df, "silver.z", measures=jobs.row_count() | jobs.amount("id"), expected={"filas": Decimal(10)})
    assert tables.measured(own, "silver.z") == {"filas": 10, "venta_total": 45}
    tables.publish(df.limit(0), "silver.z", forbidden={"pares": F.col("id") % 2 == 0}, measures=jobs.row_count() | jobs.amount("id"))
    assert tables.measured(own, "silver.z") == {"filas": 0, "venta_total": 0}


def test_the_fact_is_read_once_for_its_controls(own, tmp_path, monkeypatch):
    jobs.run_batch(own, write_files(tmp_path / "a"))
    plans, require = [], tables.require

    def kept(report):
        plans.append(report._jdf.queryExecution().executedPlan().toString())
        require(report)

    monkeypatch.setattr(tables, "require", kept)
    with tables.new_load(own) as load:
        jobs.gold_dims(own, load)
        plans.clear()
        jobs.gold_facts(own, load)
    scans = [line for p in plans for line in p.splitlines() if "FileScan" in line]
    assert len(scans) == 1 and scans[0].endswith("ReadSchema: struct<transaccion_id:string>")


def test_cost_that_does_not_fit_stops_the_load(own, tmp_path):
    folder = write_files(tmp_path / "a", productos=["SKU-1|Mesa|HOGAR|Sala|M1|99999999.99", "SKU-2|Radio|electronica|Audio||20.00"],
                         ventas_transacciones=[*SALES, "T9|2025/01/02|11:00:00|101|5001||SKU-1|2000000000|0.01|0|efectivo"])
    with pytest.raises(QualityError, match="no_convierte_costo_total = 1"):
        jobs.run_batch(own, folder)
    assert not own.catalog.tableExists(tables.named(own, "gold.FactVentas"))


def test_variation_that_does_not_fit_stops_the_load(own, tmp_path):
    from .test_jobs import BUDGET
    folder = write_files(tmp_path / "a", presupuesto_metas=["101|2025/01|0.02|0.01", *BUDGET[1:]],
                         ventas_transacciones=[*SALES, "T9|2025/01/02|11:00:00|101|5001||SKU-1|100000|90000.00|0|efectivo"])
    with pytest.raises(QualityError, match="no_convierte_variacion_pct = 1"):
        jobs.run_batch(own, folder)


def test_a_version_in_pieces_has_the_controls_of_the_whole(own, tmp_path):
    tables.ensure_schema(own, tables.named(own, "gold"))
    with tables.new_load(own) as load:
        parts = (own.range(n, n + 5) for n in (0, 5, 10))
        load.write(parts, "P", measures=jobs.row_count() | jobs.amount("id"), expected={"filas": Decimal(15), "venta_total": Decimal(105)})
    assert [r["id"] for r in own.table(tables.named(own, "gold.P")).orderBy("id").collect()] == list(range(15))
    with pytest.raises(QualityError, match="impares = 7"), tables.new_load(own) as load:
        load.write((own.range(n, n + 5) for n in (0, 5, 10)), "P", forbidden={"impares": F.col("id") % 2 == 1})
    files = [f.name for f in (tmp_path / "tables").rglob("part-*") if f.name.endswith("parquet")]
    assert len(files) >= 3 and all(".zstd." in name for name in files)


def test_the_load_keeps_no_files_beside_its_tables(spark):
    from catalog import load

    fact = load.loaded(spark, "/root/testdata/sf0.001", "gold.FactVentas")
    assert fact.count() > 5000
    top = fact.inputFiles()[0].removeprefix("file://").split("/tables/")[0]
    assert not list(Path(top, "raw").glob("*")) and not list(Path(top, "tables").rglob("staging/*/*"))
    bronze = [f.name for f in Path(top, "tables").rglob("*bronze/*/*/part-*")]
    assert bronze and all(".zstd." in name for name in bronze)


def test_a_large_fact_is_keyed_in_slices_of_its_table(own, rows, tmp_path, monkeypatch):
    from shelfstar.operators import joins

    plain = jobs.run_batch(own, write_files(tmp_path / "a"))
    want = rows(plain["FactVentas"])
    monkeypatch.setattr(joins, "SLICE_BYTES", 1)
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(jobs.facts, "keyed_pieces", lambda *args, **limits: joins.keyed_pieces(*args, broadcast_bytes=0, **limits))
    monkeypatch.setattr(jobs, "PIECE_BYTES", 1)
    totals = {t: rows(plain[t]) for t in ("ventas_diarias_por_tienda", "real_vs_presupuesto")}
    checked, one = [], jobs._one_row_per_id
    monkeypatch.setattr(jobs, "_one_row_per_id", lambda *args, **piece: checked.append(piece) or one(*args, **piece))
    again = jobs.run_batch(own, write_files(tmp_path / "b"))
    assert rows(again["FactVentas"]) == want and {t: rows(again[t]) for t in totals} == totals
    assert [c["piece"] for c in checked] == list(range(jobs.PIECES))
    with pytest.raises(QualityError, match="duplicados"):
        jobs.run_batch(own, write_files(tmp_path / "c", ventas_transacciones=[*SALES, SALES[2].replace("100.00", "101.00")]))
    assert folders(tmp_path / "tables" / f"{own.conf.get(tables.PREFIX)}staging", "claves_ventas") == []
