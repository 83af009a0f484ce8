"""Readers, writers and the incremental ingest on files written by the tests."""

import gzip
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from voltgrid import settings as S
from voltgrid.functions import geodesy as G
from voltgrid.operators import cleaning as C
from voltgrid.sources import delimited, fixed_width, geojson, sinks, sites_xml
from voltgrid.streaming import ingest


def fixed_line(date="05012020", brand="CITROËN", code="3", cc="*123", category="BEV", length=480, power="100.5", rng="400"):
    chars = [" "] * max(length, 480)
    values = {
        "registration_date": date, "brand": brand, "propulsion_code": code, "engine_cc": cc, "power_kw": power,
        "province_code_vehicle": "28", "ev_category": category, "ev_range_km": rng, "first_reg_date": "31022019",
    }
    for name, start, end in S.REGISTRATION_LAYOUT:
        text = values.get(name, "")[: end - start]
        chars[start : start + len(text)] = text
    return "".join(chars)[:length]


LINES = [
    fixed_line(),
    fixed_line(code="H", category="PHEV", date="31022020", cc="", power="x"),
    fixed_line(code="2"),  # other propulsion
    fixed_line(length=190),  # too short
    fixed_line(code="K", length=300, date="07032020"),  # long enough, no category field
]


def check_registrations(df):
    rows = df.orderBy("propulsion_code").collect()
    assert [r.propulsion_code for r in rows] == ["3", "H", "K"]
    first = rows[0]
    assert (str(first.registration_date), first.brand, first.engine_cc, first.power_kw) == ("2020-01-05", "CITROËN", 123.0, 100.5)
    assert first.first_reg_date is None and first.ev_range_km == 400.0 and first.propulsion == "Electric"
    assert rows[1].registration_date is None and rows[1].power_kw is None and rows[1].engine_cc is None
    assert rows[2].ev_category is None


def test_fixed_width_text_and_zip(spark, tmp_path):
    plain = tmp_path / "mat_202001.txt"
    plain.write_bytes("\r\n".join(LINES).encode("latin-1"))
    check_registrations(fixed_width.parse_registrations(fixed_width.read_lines(spark, str(plain))))
    archive = tmp_path / "mat_202001.zip"
    with zipfile.ZipFile(archive, "w") as z:
        z.writestr("a.txt", "\r\n".join(LINES).encode("latin-1"))
        z.writestr("b.txt", "ignored")
    lines = fixed_width.read_zipped_lines(spark, str(archive), partitions=2)
    df = fixed_width.parse_registrations(lines)
    check_registrations(df)
    stamped = fixed_width.with_file_month(df).first()
    assert (stamped.year, stamped.month) == (2020, 1)
    # the other reading of the code field is a parameter
    assert fixed_width.parse_registrations(lines, codes=["2"]).count() == 1


IBERDROLA = (
    "﻿Gestor de red ;Provincia;Municipio;Coordenada UTM X;Coordenada UTM Y;Subestación;Nivel de Tensión (kV);"
    "Capacidad firme disponible (MW);Capacidad de acceso firme de demanda ocupada (MW)\n"
    "i-DE;Madrid;Madrid;440.000,5;4.474.000,0;ST1;1.320,5;12,5;3\n"
    "i-DE;Madrid;Madrid;;;ST2;20;texto;\n"
    "i-DE;Fuera;Fuera;100;100;ST3;20;1;1\n"
)
ENDESA = (
    "Gestor de red;Provincia;Municipio;Provincia;Coordenada UTM X;Coordenada UTM Y;Subestación;Nombre Subestación;"
    "Nivel de Tensión (kV);Capacidad disponible (MW);Capacidad ocupada (MW)\n"
    "Endesa;41;091;Sevilla;240.000;4.140.000;E1;NORTE;66;1.234,5;2,5\n"
)
VIESGO = (
    "Gestor de red;Provincia;Municipio;Coordenada UTM X;Coordenada UTM Y;Subestación;Nombre subestación;"
    "Nivel de tensión (kV);Capacidad firme disponible (MW);Capacidad de acceso firme de demanda ocupada (MW)\n"
    "Viesgo;Cantabria;Reocín;430.000,0;4.800.000,0;V1;REOCÍN;55;0,7;0,1\n"
    "Viesgo;Cantabria;Reocín;430.000,0;4.800.000,0;V2;REOCÍN;55;1.234,5;0,1\n"
    "Viesgo;Cantabria;Reocín;430.000,0;4.800.000,0;;X;55;1;1\n"
)


def test_substation_files(spark, tmp_path):
    paths = {}
    for name, body, encoding in (("ib", IBERDROLA, "utf-8"), ("en", ENDESA, "utf-8"), ("vi", VIESGO, "latin-1")):
        paths[name] = str(tmp_path / f"{name}.csv")
        (tmp_path / f"{name}.csv").write_bytes(body.encode(encoding))
    ib = delimited.read_iberdrola(spark, paths["ib"])
    rows = ib.collect()
    assert len(rows) == 1  # no position, and outside the box, are gone
    assert (rows[0].substation_id, rows[0].capacity_available_mw, rows[0].voltage_kv) == ("ST1", 12.5, 1320.5)
    assert rows[0].latitude == pytest.approx(40.41, abs=0.01) and rows[0].longitude == pytest.approx(-3.707, abs=0.01)
    en = delimited.read_endesa(spark, paths["en"])
    row = en.first()
    assert (row.province_code, row.province_name, row.capacity_available_mw, row.source_file) == ("41", "Sevilla", 1234.5, "en.csv")
    vi = delimited.read_viesgo(spark, paths["vi"])
    got = {r.substation_id: r for r in vi.collect()}
    assert sorted(got) == ["V1", "V2"]
    assert got["V1"].municipality == "Reocín" and got["V1"].utm_x == 430000.0
    assert got["V2"].capacity_available_mw is None  # the dot stays in capacities of this source
    whole = C.unify_substations({"Iberdrola i-DE": ib, "Endesa e-distribución": en, "Viesgo": vi})
    counts = {r.grid_operator: r["count"] for r in whole.groupBy("grid_operator").count().collect()}
    assert counts == {"Iberdrola i-DE": 1, "Endesa e-distribución": 1, "Viesgo": 2}


def test_files_with_different_headers(spark, tmp_path):
    (tmp_path / "a b.csv").write_text("Subestación;Coordenada UTM X;Coordenada UTM Y\nA1;440.000;4.474.000\nA2;430.000\n")
    (tmp_path / "b.csv").write_text("Coordenada UTM Y;Subestación;Coordenada UTM X;Comentarios\n4.480.000;B1;450.000;x\n")
    (tmp_path / "c.csv").write_text("Subestación;Coordenada UTM X;Coordenada UTM Y\nC1;460.000;4.490.000\n")
    rows = {r.substation_id: r for r in delimited.read_endesa(spark, str(tmp_path / "*.csv")).collect()}
    assert {k: (r.utm_x, r.utm_y, r.source_file, r.comments) for k, r in rows.items()} == {
        "A1": (440_000.0, 4_474_000.0, "a b.csv", None),
        "A2": (430_000.0, None, "a b.csv", None),
        "B1": (450_000.0, 4_480_000.0, "b.csv", "x"),
        "C1": (460_000.0, 4_490_000.0, "c.csv", None),
    }
    twice = tmp_path / "twice.csv"
    twice.write_text("Subestación;Capacidad disponible (MW);Capacidad firme disponible (MW)\nT;1,5;2,5\n")
    raw = delimited.read_by_header(spark, str(twice), delimited.ENDESA_NAMES)
    assert raw.columns == ["substation_id", "capacity_available_mw", "capacity_available_mw_1"]
    for name, body in (("20240101_x.csv", "tramo;total\ns1;10\n"), ("20240102_x.csv", "total;tramo\n20;s2\n")):
        (tmp_path / "segments").mkdir(exist_ok=True)
        (tmp_path / "segments" / name).write_text(body)
    seg = delimited.read_segments(spark, str(tmp_path / "segments")).collect()
    assert sorted((r.segment_id, r.trips_total, str(r.date)) for r in seg) == [("s1", 10.0, "2024-01-01"), ("s2", 20.0, "2024-01-02")]


def test_delimited_details(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("a ;b\n1;2\n3;4;5\n6;7\n")
    assert delimited.read_strings(spark, str(path), ["a", "b"]).count() == 2
    short = tmp_path / "short.csv"
    short.write_text("a;b;c\n1;2;3\n4;5\n6\n7;8;9;\n7;8;9;10\n7;8;9;10;11\n")
    rows = delimited.read_strings(spark, str(short), ["a", "b", "c"]).collect()
    assert sorted(map(tuple, rows)) == [("1", "2", "3"), ("4", "5", None), ("6", None, None), ("7", "8", "9")]
    kept = delimited.read_strings(spark, str(path), ["a", "b"], skip_bad_lines=False)
    assert [r[delimited.CORRUPT] for r in kept.collect() if r[delimited.CORRUPT]] == ["3;4;5"]
    assert C.strip_headers(delimited.read_strings(spark, str(path))).columns == ["a", "b"]
    assert delimited.first_rows(kept).count() == 3
    assert [r.a for r in delimited.first_rows(kept, 1, ["a"]).collect()] == ["1"]
    df = spark.createDataFrame([(1, None)], "x int, y string")
    assert C.rename_present(df, {"x": "z", "nope": "q"}).columns == ["z", "y"]
    assert df.select(C.first_present(df, ["k", "y", "x"]).alias("v")).first().v is None


def test_flow_files(spark, tmp_path):
    with gzip.open(tmp_path / "20240331_OD_rutas.csv.gz", "wt") as f:
        f.write("date|origen|destino|ruta|distancia|viajes\n20240331|01001|28001|r1|12.5|3\n20240331||28001|r2|1|1\nbad|01001|28001|r3|x|2\n")
    od = delimited.read_raw_flows(spark, str(tmp_path / "20240331_OD_rutas.csv.gz"), "od_routes")
    rows = od.orderBy("route_id").collect()
    assert [(r.origin_zone, r.route_id, r.distance_km, r.trips) for r in rows] == [("01001", "r1", 12.5, 3.0), ("01001", "r3", None, 2.0)]
    assert str(rows[0].date) == "2024-03-31" and rows[1].date is None
    with gzip.open(tmp_path / "20240401_Tramos.csv.gz", "wt") as f:
        f.write("tramo;total;corto\ns1;10;x\n;5;1\n")
    seg = delimited.read_segments(spark, str(tmp_path / "20240401_Tramos.csv.gz")).collect()
    assert [(r.segment_id, r.trips_total, r.trips_short, str(r.date)) for r in seg] == [("s1", 10.0, None, "2024-04-01")]
    (tmp_path / "clean").mkdir()
    for d in ("20240331", "20240401"):
        (tmp_path / "clean" / f"{d}.csv").write_text(f"date,origin_zone,destination_zone,route_id,distance_km,trips\n{d[:4]}-{d[4:6]}-{d[6:]},01001,02001,007,1.5,2\n")
    clean = delimited.read_clean_od(spark, str(tmp_path / "clean" / "*.csv"))
    assert clean.count() == 2 and {r.route_id for r in clean.collect()} == {"007"}
    sinks.write_flows(clean, str(tmp_path / "flows"))
    assert sorted(p.name for p in (tmp_path / "flows").glob("date=*")) == ["date=2024-03-31", "date=2024-04-01"]


XML = """<?xml version="1.0"?>
<d:payload xmlns:d="urn:d" xmlns:e="urn:e" xmlns:l="urn:l" xmlns:c="urn:c"><e:table>
<e:energyInfrastructureSite id="s1"><e:name><c:values><c:value lang="es"> Área Norte </c:value></c:values></e:name>
 <l:locationReference><l:coordinatesForDisplay><l:latitude>40.5</l:latitude><l:longitude>-3.5</l:longitude></l:coordinatesForDisplay></l:locationReference>
 <e:operator><e:operatorName>Op</e:operatorName></e:operator>
 <e:energyInfrastructureStation><e:refillPoint>
  <e:energyInfrastructureConnector><e:connectorType>chademo</e:connectorType><e:maxPowerOutput>50000</e:maxPowerOutput></e:energyInfrastructureConnector>
  <e:energyInfrastructureConnector><e:connectorType>ccs</e:connectorType><e:maxPowerOutput>oops</e:maxPowerOutput></e:energyInfrastructureConnector>
  </e:refillPoint><e:refillPoint>
  <e:energyInfrastructureConnector><e:connectorType>ccs</e:connectorType><e:maxPowerOutput>150000</e:maxPowerOutput></e:energyInfrastructureConnector>
 </e:refillPoint></e:energyInfrastructureStation></e:energyInfrastructureSite>
<e:energyInfrastructureSite id="s2"><l:locationReference><l:coordinatesForDisplay><l:latitude>40.6</l:latitude><l:longitude>-3.6</l:longitude></l:coordinatesForDisplay></l:locationReference></e:energyInfrastructureSite>
<e:energyInfrastructureSite id="s3"><l:locationReference><l:coordinatesForDisplay><l:latitude></l:latitude></l:coordinatesForDisplay></l:locationReference></e:energyInfrastructureSite>
<e:energyInfrastructureSite id="s4"><l:locationReference><l:coordinatesForDisplay><l:latitude>60</l:latitude><l:longitude>-3.6</l:longitude></l:coordinatesForDisplay></l:locationReference></e:energyInfrastructureSite>
</e:table></d:payload>"""


def test_sites_xml(spark, tmp_path):
    (tmp_path / "sites.xml").write_text(XML)
    rows = {r.site_id: r for r in sites_xml.read_sites(spark, str(tmp_path / "sites.xml")).collect()}
    assert sorted(rows) == ["s1", "s2"]
    r = rows["s1"]
    assert (r.name, r.latitude, r.longitude, r.n_connectors) == ("Área Norte", 40.5, -3.5, 3)
    assert (r.max_power_kw, r.connector_types, r.operator) == (150.0, "ccs, chademo", "Op")
    assert (rows["s2"].name, rows["s2"].n_connectors, rows["s2"].max_power_kw, rows["s2"].connector_types) == ("", 0, None, None)
    assert len(sites_xml.read_sites(spark, str(tmp_path / "sites.xml"), boxed=False).collect()) == 3


def feature(kind, coordinates, **properties):
    return {"type": "Feature", "properties": properties, "geometry": {"type": kind, "coordinates": coordinates}}


def test_geojson(spark, tmp_path):
    def save(name, *features):
        (tmp_path / name).write_text(json.dumps({"type": "FeatureCollection", "features": list(features)}, indent=1))
        return str(tmp_path / name)

    points = save("p.json", feature("Point", [-8.72, 42.2], nombre="A"), feature("Point", [-8.7, 42.3], nombre="B"))
    got = geojson.read_points(spark, points, {"nombre": "string"}).orderBy("nombre").collect()
    assert [(r.nombre, r.longitude, r.latitude) for r in got] == [("A", -8.72, 42.2), ("B", -8.7, 42.3)]
    lines = save(
        "l.json",
        feature("LineString", [[-3, 40], [-2, 40]], type="Road", label="A7"),
        feature("MultiLineString", [[[-3, 41], [-3, 42]], [[0, 40], [0, 41], [0, 42]]], type="Major Highway", label=None),
    )
    rows = geojson.read_lines(spark, lines, {"type": "string", "label": "string"}).orderBy("feature", "part").collect()
    assert [(r.feature, r.part, r.label, len(r.vertices)) for r in rows] == [(0, 0, "A7", 2), (1, 0, None, 2), (1, 1, None, 3)]
    assert rows[0].vertices[0].x == pytest.approx(500_000) and rows[0].vertices[0].y == pytest.approx(4_427_757.2, abs=0.1)
    (tmp_path / "l.jsonl").write_text("\n".join(json.dumps(feature("LineString", [[-3, 40], [-2, 40]], label=k)) for k in "ab"))
    split = geojson.read_lines(spark, str(tmp_path / "l.jsonl"), {"label": "string"}, project=False, per_line=True).collect()
    assert sorted(r.label for r in split) == ["a", "b"] and len({r.feature for r in split}) == 2
    (tmp_path / "many").mkdir()
    for k in "xyz":
        save(f"many/{k}.json", feature("LineString", [[-3, 40], [-2, 40]], label=k))
    many = geojson.read_lines(spark, str(tmp_path / "many"), {"label": "string"}).collect()
    assert sorted((r.label, len(r.vertices)) for r in many) == [("x", 2), ("y", 2), ("z", 2)] and len({r.feature for r in many}) == 3
    ring = [[0, 0], [4, 0], [4, 4], [0, 4], [0, 0]]
    hole = [[1, 1], [2, 1], [2, 2], [1, 2], [1, 1]]
    polygons = save("g.json", feature("Polygon", [ring, hole], code="ESP"), feature("MultiPolygon", [[ring], [hole]], code="X"))
    areas = geojson.read_polygons(spark, polygons, {"code": "string"}, project=False)
    inside = {r.code: r.inside for r in areas.selectExpr("code", f"{G.inside_edges('1.5D', '1.5D', 'edges')} AS inside").collect()}
    assert inside["ESP"] is False and areas.selectExpr("size(edges) AS n").first().n == 8


def test_sinks(spark, tmp_path):
    path = str(tmp_path / "months")
    df = spark.createDataFrame([(2020, 1, "a"), (2020, 2, "b")], "year int, month int, v string")
    sinks.write_new_months(df, path)
    again = spark.createDataFrame([(2020, 2, "changed"), (2020, 3, "c")], "year int, month int, v string")
    sinks.write_new_months(again, path)
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == ["a", "b", "c"]
    sinks.write_new_months(again.where("month = 2"), path, overwrite=True)
    assert sorted(r.v for r in sinks.read_parquet(spark, path).collect()) == ["a", "c", "changed"]
    sinks.write_parquet(df, str(tmp_path / "whole"))
    assert list((tmp_path / "whole").glob("*.zstd.parquet"))
    sinks.write_result_csv({"planning": df}, str(tmp_path / "out"), single_file=True)
    files = list((tmp_path / "out" / "planning").glob("*.csv"))
    assert len(files) == 1 and files[0].read_text().splitlines()[0] == "year,month,v"


def test_incremental_ingest(spark, tmp_path):
    inbox, table, checkpoint = tmp_path / "in", str(tmp_path / "table"), str(tmp_path / "cp")
    inbox.mkdir()
    (inbox / "mat_202001.txt").write_text("\n".join([fixed_line(brand="FIAT"), fixed_line(brand="SEAT")]))

    def run():
        ingest.ingest_months(ingest.stream_lines(spark, str(inbox)), table, checkpoint, ingest.registrations_by_month)
        return sorted((r.year, r.month, r.brand) for r in spark.read.parquet(table).collect())

    first = [(2020, 1, "FIAT"), (2020, 1, "SEAT")]
    assert run() == first
    assert run() == first  # nothing new, nothing twice
    (inbox / "mat_202003.txt").write_text("\n".join([fixed_line(date="07032020", brand="KIA"), fixed_line(brand="AUDI")]))
    assert run() == sorted([*first, (2020, 3, "KIA"), (2020, 1, "AUDI")])
    assert spark.read.parquet(table).where(F.col("year") == 2020).count() == 4


def test_a_month_over_several_files_is_replaced_as_a_whole(spark, tmp_path):
    inbox, table, checkpoint = tmp_path / "in", str(tmp_path / "table"), str(tmp_path / "cp")
    inbox.mkdir()

    def run():
        lines = ingest.stream_lines(spark, str(inbox), files_per_trigger=1)
        ingest.ingest_months(lines, table, checkpoint, ingest.registrations_by_month, overwrite=True)
        return sorted((r.month, r.brand) for r in spark.read.parquet(table).collect())

    for brand in ("FIAT", "SEAT", "AUDI"):
        (inbox / f"mat_{brand}.txt").write_text(fixed_line(brand=brand))
    (inbox / "mat_march.txt").write_text(fixed_line(date="07032020", brand="KIA"))
    assert run() == [(1, "AUDI"), (1, "FIAT"), (1, "SEAT"), (3, "KIA")]
    (inbox / "mat_again.txt").write_text(fixed_line(brand="OPEL"))
    assert run() == [(1, "OPEL"), (3, "KIA")]


def test_many_files_need_a_constant_number_of_jobs(spark, tmp_path):
    orders = ["id;name;kind", "kind;id;name", "name;id", "\ufeffid;name;kind"]

    def read(n):
        folder = tmp_path / str(n)
        folder.mkdir()
        for i in range(n):
            header = orders[i % 4]
            values = {"id": str(i), "name": f"n {i}", "kind": "é"}
            row = ";".join(values[c] for c in header.lstrip("\ufeff").split(";"))
            (folder / f"202003{i % 28 + 1:02d} +%20{i}.csv").write_text("" if i == 5 else f"{header}\n{row}\n", encoding="utf-8")
        group = f"headers {n}"
        spark.sparkContext.setJobGroup(group, group)
        try:
            df = delimited.read_by_header(spark, str(folder), {"name": "called"}, source_file=True)
            jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        got = {int(r.id): (r.called, r.kind, r.source_file) for r in df.collect()}
        assert got == {i: (f"n {i}", None if i % 4 == 2 else "é", f"202003{i % 28 + 1:02d} +%20{i}.csv") for i in range(n) if i != 5}
        return jobs

    few, many = read(150), read(1_500)  # beyond 32 paths Spark lists them in jobs of its own
    assert many == few <= 8


def test_folders_without_lines(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("")
    assert delimited.read_by_header(spark, str(tmp_path)).isEmpty()


def _inbox(tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    for name in ("a1", "a2"):
        (inbox / f"{name}.txt").write_text(fixed_line(brand=name))
    return inbox


def _brands(spark, table):
    return sorted((r.month, r.brand) for r in ingest.read_months(spark, table).collect())


@pytest.mark.parametrize("files_per_trigger", [1, 100])
def test_a_second_checkpoint_loses_and_repeats_nothing(spark, tmp_path, files_per_trigger):
    inbox, table = _inbox(tmp_path), str(tmp_path / "table")

    def run(checkpoint, **how):
        lines = ingest.stream_lines(spark, str(inbox), files_per_trigger)
        ingest.ingest_months(lines, table, str(tmp_path / checkpoint), ingest.registrations_by_month, **how)
        return _brands(spark, table)

    first = [(1, "a1"), (1, "a2")]
    assert run("cp1") == first
    assert run("cp2") == first  # the same files under another checkpoint
    (inbox / "b1.txt").write_text(fixed_line(brand="b1"))
    assert run("cp3") == [*first, (1, "b1")]  # its batches are numbered from 0 again
    assert run("cp1") == run("cp2") == [*first, (1, "b1")]


def test_stored_months_are_skipped(spark, tmp_path):
    inbox, table = _inbox(tmp_path), str(tmp_path / "table")

    def run(checkpoint):
        lines = ingest.stream_lines(spark, str(inbox), files_per_trigger=1)
        ingest.ingest_months(lines, table, str(tmp_path / checkpoint), ingest.registrations_by_month, skip_stored=True)
        return _brands(spark, table)

    first = [(1, "a1"), (1, "a2")]
    assert run("cp1") == first
    (inbox / "again.txt").write_text("\n".join([fixed_line(brand="a1"), fixed_line(date="07032020", brand="c")]))
    assert run("cp1") == [*first, (3, "c")]
    assert run("cp2") == [*first, (3, "c")]


def test_a_batch_that_broke_before_its_record_does_not_count(spark, tmp_path):
    inbox, table = _inbox(tmp_path), str(tmp_path / "table")
    left = spark.createDataFrame([("x", 2020, 1, "gone-0")], "brand string, year int, month int, batch string")
    left.write.partitionBy("year", "month", "batch").parquet(table)
    assert _brands(spark, table) == []
    ingest.ingest_months(ingest.stream_lines(spark, str(inbox)), table, str(tmp_path / "cp"), ingest.registrations_by_month)
    assert _brands(spark, table) == [(1, "a1"), (1, "a2")]


def test_an_unreadable_table_is_not_a_new_one(spark, tmp_path):
    (tmp_path / "months").mkdir()
    (tmp_path / "months" / "part-0.parquet").write_text("no table")
    df = spark.createDataFrame([(2020, 1, "a")], "year int, month int, v string")
    with pytest.raises(Exception):  # noqa: B017
        sinks.write_new_months(df, str(tmp_path / "months"))
    assert [p.name for p in (tmp_path / "months").iterdir()] == ["part-0.parquet"]


def test_sites_are_written_in_several_files(spark, tmp_path, monkeypatch):
    from voltgrid.plans.catalog import files

    folder = str(tmp_path / "table")
    rows = spark.range(1, 61).selectExpr("id AS c_custkey", "concat('site ', id) AS c_name", "'M' AS c_mktsegment")
    rows.coalesce(1).write.parquet(f"{folder}/customer.parquet")
    monkeypatch.setattr(files, "_folder", lambda spark, name: str(tmp_path / name))
    monkeypatch.setattr(files, "SITES_PER_FILE", 20)
    got = files.site_xml_files(spark, folder).collect()
    assert sorted(int(r.site_id) for r in got) == list(range(1, 61))
    written = list((tmp_path / "sites").glob("part-*"))
    assert len(written) == 3 and all(p.read_text().count("<_id>") + p.read_text().count(" _id=") <= 20 for p in written)


def test_a_month_of_many_rows_is_several_files(spark, tmp_path, monkeypatch):
    from voltgrid.plans.catalog import files

    folder = str(tmp_path / "table")
    # 900 rows in one month, 60 in each of three others, one without a date
    months = "CASE WHEN id < 900 THEN DATE'1995-03-10' WHEN id < 1080 THEN add_months(DATE'1995-03-02', cast(id % 3 + 1 AS int)) END"
    rows = spark.range(1081).selectExpr("id AS l_orderkey", "2D AS l_quantity", "'O' AS l_linestatus", f"cast({months} AS timestamp) AS l_shipdate")
    rows.write.parquet(f"{folder}/lineitem.parquet")
    monkeypatch.setattr(files, "_folder", lambda spark, name: str(tmp_path / name))
    monkeypatch.setattr(files, "ROWS_PER_FILE", 100)
    got = {str(r.date): (r.n, r.orders, r.source_file) for r in files.files_by_header(spark, folder).collect()}
    assert got["1995-03-01"] == (900, sum(range(900)), "19950301 a+b%20.csv")
    assert {m: n[0] for m, n in got.items()} == {"1995-03-01": 900, "1995-04-01": 60, "1995-05-01": 60, "1995-06-01": 60}
    written = [p for p in (tmp_path / "headers").rglob("19950301*") if p.is_file()]
    assert len(written) > 5 and max(len(p.read_text().splitlines()) for p in written) < 200


def test_headers_are_found_without_sorting_the_lines(spark, tmp_path, monkeypatch):
    for i in range(7):
        (tmp_path / f"{i}.csv").write_text(("a;b\n" if i % 2 else "b;a;a\n") + "".join(f"{k};{i};x\n" for k in range(300 * i)))
    (tmp_path / "empty.csv").write_text("")
    plans, collect = [], type(spark.range(1)).collect

    def planned(df):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return collect(df)

    monkeypatch.setattr(type(spark.range(1)), "collect", planned)
    found = delimited.headers_of(spark, [str(tmp_path)])
    names = {header: sorted(f.rsplit("/", 1)[1] for f in own) for header, own in found.items()}
    assert names == {("a", "b"): ["1.csv", "3.csv", "5.csv"], ("b", "a", "a_1"): ["0.csv", "2.csv", "4.csv", "6.csv"]}
    # text in a buffer of an aggregate makes Spark sort the rows by key
    assert not any("min_by" in p.lower() or "minby" in p.lower() for p in plans)
