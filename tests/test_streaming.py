import json
from decimal import Decimal

import pytest
from pyspark.errors import StreamingQueryException

from shelfstar.sources import tables
from shelfstar.sources.events import event_schema, parse_events, read_event_lines, read_events, read_events_batch
from shelfstar.streaming import incremental, refine


def event(n, **changes):
    base = {
        "evento_id": f"EVT-{n % 5}", "timestamp_evento": f"2026-10-10T15:{n % 60:02d}:54.462420+00:00", "tienda_id": 101 + n % 3,
        "empleado_id": 5001, "sku": f"SKU-{n}", "cantidad": 1 + n % 5, "precio_unitario": 10.05 + n, "descuento_pct": 90 if n % 10 == 0 else 10,
    }
    return base | changes


def write(folder, name, events):
    folder.mkdir(exist_ok=True)
    (folder / f"{name}.json").write_text("".join(json.dumps(e) + "\n" for e in events), encoding="utf-8")


@pytest.fixture
def folder(tmp_path):
    first = [event(n) for n in range(30)] + [event(3)] * 200
    write(tmp_path / "in", "a", first)
    write(tmp_path / "in", "b", [event(n) for n in range(20, 40)] + [event(3)] * 50)
    return tmp_path


@pytest.mark.parametrize("spread", [1, 8])
def test_stream_equals_batch(spark, rows, folder, spread):
    batch = refine.refine_events(read_events_batch(spark, str(folder / "in")))
    stream = refine.refine_events(read_events(spark, str(folder / "in"), files_per_batch=1), spread=spread)
    refine.stream_to_table(stream, str(folder / f"out{spread}"), str(folder / f"cp{spread}")).awaitTermination()
    got = spark.read.parquet(str(folder / f"out{spread}"))
    assert batch.count() == 40
    assert rows(got, *batch.columns) == rows(batch)


def test_stream_continues_from_its_checkpoint(spark, rows, folder):
    def run():
        stream = refine.refine_events(read_events(spark, str(folder / "in")))
        refine.stream_to_table(stream, str(folder / "out"), str(folder / "cp")).awaitTermination()
        return spark.read.parquet(str(folder / "out"))

    assert run().count() == 40
    write(folder / "in", "c", [event(n) for n in range(35, 45)])
    assert run().count() == 45


def test_late_and_undated_events_are_kept(spark, rows, tmp_path):
    write(tmp_path / "in", "a", [event(n) for n in range(10)])
    late = [event(50, timestamp_evento="2020-01-01T00:00:00+00:00"), event(51, timestamp_evento="soon")]
    write(tmp_path / "in", "b", late * 3)
    stream = refine.refine_events(read_events(spark, str(tmp_path / "in"), files_per_batch=1), delay="1 second")
    refine.stream_to_table(stream, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 12


def test_fan_out_gives_every_sink_the_same_rows(spark, rows, folder):
    events = read_events(spark, str(folder / "in"), files_per_batch=1)
    sinks = [refine.append_parquet(str(folder / "live")), refine.append_parquet(str(folder / "bronze"))]
    refine.fan_out(events, sinks, str(folder / "cp")).awaitTermination()
    live, bronze = (spark.read.parquet(str(folder / n)) for n in ("live", "bronze"))
    assert live.count() == 300
    assert rows(live) == rows(bronze)


def test_event_typing(spark, folder):
    refined = refine.refine_events(read_events_batch(spark, str(folder / "in")))
    types = dict(refined.dtypes)
    assert types["precio_unitario"] == "decimal(10,2)" and types["tienda_id"] == "int" and types["timestamp_evento"] == "timestamp"
    row = refined.filter("sku = 'SKU-2'").first()
    assert row["venta_total"] == Decimal("32.54") and row["es_anomalia"] is False


def test_same_id_with_other_data_stays(spark, folder):
    refined = refine.refine_events(read_events_batch(spark, str(folder / "in")))
    assert refined.select("evento_id").distinct().count() == 5 and refined.count() == 40


def test_resend_with_another_arrival_time_stays(spark, tmp_path):
    sends = [event(1, EventEnqueuedUtcTime=f"2026-10-10T15:02:0{s}.000Z") for s in (0, 0, 5)]
    write(tmp_path / "in", "a", sends)
    refined = refine.refine_events(read_events_batch(spark, str(tmp_path / "in"), event_schema(with_arrival=True)))
    assert refined.count() == 2
    latencies = sorted(r["latencia_seg"] for r in refine.arrival_latency(refined).collect())
    assert latencies == pytest.approx([5.53758, 10.53758])


def test_latency_without_arrival_is_null(spark, folder):
    refined = refine.refine_events(read_events_batch(spark, str(folder / "in")))
    assert {r["latencia_seg"] for r in refine.arrival_latency(refined).collect()} == {None}


def test_anomaly_report(spark, folder):
    parts = refine.anomaly_report(refine.refine_events(read_events_batch(spark, str(folder / "in"))), n=2)
    summary = parts["resumen"].first()
    assert (summary["eventos"], summary["anomalias"], summary["pct_anomalias"]) == (40, 4, 10.0)
    assert [r["sku"] for r in parts["ultimas"].collect()] == ["SKU-30", "SKU-20"]
    assert [(r["tienda_id"], r["count"]) for r in parts["por_tienda"].collect()] == [(101, 2), (102, 1), (103, 1)]


def test_event_checks(spark, folder):
    refined = refine.refine_events(read_events_batch(spark, str(folder / "in")))
    assert {r["cumple"] for r in refine.event_checks(refined).collect()} == {True}
    bad = refined.withColumn("descuento_pct", refined["descuento_pct"] + 100)
    failed = {r["control"] for r in refine.event_checks(bad).collect() if not r["cumple"]}
    assert failed == {"descuento_fuera_de_rango", "anomalia_incoherente"}


def lines(folder, name, texts):
    folder.mkdir(exist_ok=True)
    (folder / f"{name}.json").write_text("".join(t + "\n" for t in texts), encoding="utf-8")


def test_records_that_are_no_events_are_letters(spark, tmp_path):
    good = json.dumps(event(1, sku="SKU-é\u2028"))
    broken = ['{"evento_id": "A", ', "[]", "null", "7", '{"evento_id": "B"}', json.dumps(event(2, cantidad="x")), json.dumps(event(3, descuento_pct=None)), "", "   "]
    lines(tmp_path / "in", "a", [good, *broken])
    told = parse_events(read_event_lines(spark, str(tmp_path / "in"), files_per_batch=None)).collect()
    assert [r["evento_id"] for r in told if r["_motivo"] is None] == ["EVT-1"]
    letters = {r["_registro"]: r["_motivo"] for r in told if r["_motivo"] is not None}
    assert set(letters) == {b for b in broken if b.strip()}
    assert letters['{"evento_id": "B"}'] == "falta timestamp_evento" and letters[broken[6]] == "falta descuento_pct" and letters[broken[0]] == "no se puede leer"
    assert all(r["evento_id"] is None and r["sku"] is None for r in told if r["_motivo"] is not None)


def test_letters_have_a_destination_of_their_own(spark, rows, folder):
    lines(folder / "in", "c", ['{"evento_id": ', '{"evento_id": ', '{"evento_id": "B"}'])
    stream = refine.refine_events(parse_events(read_event_lines(spark, str(folder / "in"), files_per_batch=1)))
    sinks = [refine.append_parquet(str(folder / n)) for n in ("live", "table")]
    refine.fan_out(stream, sinks, str(folder / "cp"), refine.append_parquet(str(folder / "letters"))).awaitTermination()
    live, table, letters = (spark.read.parquet(str(folder / n)).drop("batch_id") for n in ("live", "table", "letters"))
    assert live.count() == table.count() == 40 and "_registro" not in live.columns
    assert dict(rows(letters)) == {'{"evento_id": ': "no se puede leer", '{"evento_id": "B"}': "falta timestamp_evento"} and letters.count() == 2


@pytest.fixture
def own(spark, tmp_path):
    session = spark.newSession()
    for setting in ("spark.sql.session.timeZone", "spark.sql.shuffle.partitions"):
        session.conf.set(setting, spark.conf.get(setting))
    session.conf.set(tables.PREFIX, f"s{abs(hash(str(tmp_path)))}_")
    session.conf.set(tables.ROOT, str(tmp_path / "tables"))
    return session


def publish(own, folder, *others):
    stream = refine.refine_events(read_events(own, str(folder / "in"), files_per_batch=1))
    return incremental.publish_stream(stream, str(folder / "cp"), *others)


def test_stream_and_rebuild_agree_after_a_stop_in_a_batch(own, rows, folder):
    write(folder / "in", "c", [event(n) for n in range(35, 60)])
    calls = []

    def stops(batch, batch_id):
        calls.append(batch_id)
        if calls == [0, 1]:
            raise RuntimeError("stopped in the second batch")

    with pytest.raises(StreamingQueryException):
        publish(own, folder, stops).awaitTermination()
    assert incremental.live_events(own).count() > 0
    publish(own, folder, stops).awaitTermination()
    assert calls[:3] == [0, 1, 1]
    whole = refine.refine_events(read_events_batch(own, str(folder / "in")))
    assert rows(incremental.live_events(own), *whole.columns) == rows(whole)
    assert rows(incremental.anomalies_kept(own), "tienda_id", "anomalias") == rows(refine.anomalies_by_store(whole), "tienda_id", "count")


@pytest.mark.parametrize("when", ["before", "after"])
def test_a_stop_around_the_switch_shows_a_batch_once(own, rows, folder, monkeypatch, when):
    add, tries = incremental._add_partition, []

    def stops(rows_, table, batch):
        tries.append(batch)
        if len(tries) == 2 and when == "before":
            rows_.write.parquet(f"{incremental._folder(own, table)}/{batch}-left")
            raise RuntimeError("stopped")
        add(rows_, table, batch)
        if len(tries) == 2:
            raise RuntimeError("stopped")

    monkeypatch.setattr(incremental, "_add_partition", stops)
    with pytest.raises(StreamingQueryException):
        publish(own, folder).awaitTermination()
    publish(own, folder).awaitTermination()
    whole = refine.refine_events(read_events_batch(own, str(folder / "in")))
    assert rows(incremental.live_events(own), *whole.columns) == rows(whole)
    assert rows(incremental.anomalies_kept(own), "tienda_id", "anomalias") == rows(refine.anomalies_by_store(whole), "tienda_id", "count")
    prefix = own.conf.get(tables.PREFIX)
    left = [p.name for p in (folder / "tables" / f"{prefix}silver" / incremental.LIVE).iterdir() if p.is_dir()]
    assert len(left) == len(incremental._batches(own, f"{prefix}silver.{incremental.LIVE}")) and not any(n.endswith("-left") for n in left)


def test_a_batch_that_fails_a_control_is_set_aside(own, folder):
    write(folder / "in", "c", [event(70, descuento_pct=120), event(71)])
    publish(own, folder).awaitTermination()
    assert incremental.live_events(own).count() == 40
    aside = incremental.batches_aside(own).collect()
    assert len(aside) == 2 and {r["controles"] for r in aside} == {"total_negativo, descuento_fuera_de_rango"}
    assert sum(r["anomalias"] for r in incremental.anomalies_kept(own).collect()) == 4


def test_state_of_a_stream_is_kept_on_disk(spark, rows, folder):
    own = spark.newSession()
    own.conf.set("spark.sql.shuffle.partitions", "2")
    refined = refine.refine_events(read_events(own, str(folder / "in"), files_per_batch=1))
    refine.fan_out(refined, [refine.append_parquet(str(folder / "live"))], str(folder / "cp")).awaitTermination()
    assert spark.read.parquet(str(folder / "live")).count() == 40
    names = {p.suffix for p in (folder / "cp" / "state").rglob("*") if p.is_file()}
    assert ".changelog" in names and ".delta" not in names


def test_a_stream_goes_on_with_the_store_it_began_with(spark, folder, monkeypatch):
    own = spark.newSession()
    own.conf.set("spark.sql.shuffle.partitions", "2")

    def run():
        stream = refine.refine_events(read_events(own, str(folder / "in")))
        refine.stream_to_table(stream, str(folder / "out"), str(folder / "cp")).awaitTermination()
        return spark.read.parquet(str(folder / "out")).count()

    with monkeypatch.context() as heap:
        heap.setattr(refine, "ensure_disk_state", lambda session: None)
        assert run() == 40
    write(folder / "in", "c", [event(n) for n in range(35, 45)])
    assert run() == 45
