"""Readers, writers and incremental ingestion."""

import gzip
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from lotwise.sources import readers, transfers
from lotwise.streaming import ingest


def test_probe_and_csv(spark, tmp_path):
    path = str(tmp_path / "x_202403.csv.gz")
    with gzip.open(path, "wb") as f:
        f.write("marca;añó\nCitroën;1\n".encode("cp1252"))
    assert [tuple(r)[1:] for r in readers.probed(spark, path).select("path", "sep", "encoding").collect()] == [(";", "ISO-8859-1")]  # no letter that windows-1252 alone has
    assert [tuple(r) for r in readers.read_any(spark, path).collect()] == [("Citroën", "1")]
    assert readers.with_period(readers.read_csv(spark, path)).select("yyyymm").collect()[0][0] == 202403
    with pytest.raises(ValueError):
        readers.read_any(spark, "x.unknown", unknown="error")


def test_files_of_several_encodings_on_another_file_system(spark, tmp_path):
    late = "".join(f"plain {i},{i}\n" for i in range(3000)) + "Peñíscola – 5 €,9\n"
    (tmp_path / "a.csv").write_bytes("name;price\nJaén;1\n".encode())
    (tmp_path / "b.csv").write_bytes(("name,price\n" + late).encode("cp1252"))
    (tmp_path / "sub").mkdir()
    with gzip.open(tmp_path / "sub" / "c.csv.gz", "wb") as f:
        f.write("price|name|more\n3|Móra|x\n".encode("latin-1"))
    (tmp_path / "d.csv").write_bytes("name\tprice\nLleida\t4\n".encode())
    (tmp_path / "empty.csv").write_bytes(b"")
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.mixed.link./in", f"file://{tmp_path}")
    root = "viewfs://mixed/in"
    found = {r["path"].rsplit("/", 1)[-1]: (r["sep"], r["encoding"]) for r in readers.probed(spark, root).collect()}
    assert found == {"a.csv": (";", "UTF-8"), "b.csv": (",", "windows-1252"), "c.csv.gz": ("|", "ISO-8859-1"), "d.csv": ("\t", "UTF-8")}
    rows = readers.read_csv(spark, root)
    assert rows.count() == 3004 and set(rows.columns) == {"name", "price", "more"}
    named = {r["name"]: r["price"] for r in rows.where("not startswith(name, 'plain')").collect()}
    assert named == {"Jaén": "1", "Peñíscola – 5 €": "9", "Móra": "3", "Lleida": "4"}
    assert readers.read_csv(spark, f"{root}/empty.csv", "a string").count() == 0
    assert readers.read_csv(spark, f"{root}/a.csv", sep=";", encoding="UTF-8").count() == 1
    assert spark.conf.get("spark.sql.legacy.javaCharsets", "false") == "false"


def test_months(spark, tmp_path):
    for name in ("a_202401.txt", "b_202401.txt", "c_202403.txt", "sub/d_202402.txt", "none.txt"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text("x")
    listing = readers.files(spark, str(tmp_path))
    assert listing.count() == 5
    assert [r["name"] for r in readers.last_months(listing, 2).collect()] == ["c_202403.txt", "d_202402.txt"]
    loaded = spark.createDataFrame([(202403,)], "yyyymm long")
    assert [r["yyyymm"] for r in readers.backlog(listing.select("yyyymm").distinct(), loaded, 202402, 6).collect()] == [202402]
    with pytest.raises(ValueError):
        readers.raw_only(["x/agg_2024.parquet"])


OLD = "05042019 SEAT IBIZA 1.4 TDI 1VSSZZZ6JZ9R123456  401 x B0008019BARCELONA  y"
NEW = "17012025 MERCEDES C 220 D WDD20400112***********402 B0028079MADRID"


def test_archives_and_records(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "m_202403.zip", "w") as z:
        z.writestr("r.txt", OLD + "\nshort\n")
    lines = readers.zipped_lines(spark, str(tmp_path))
    assert lines.count() == 2
    r = transfers.records(lines, 2024, "line", "path").collect()
    assert len(r) == 1 and (r[0]["marca"], r[0]["combustible"], r[0]["tipo_vehiculo"], r[0]["antiguedad_anios"], r[0]["es_cruzable"], r[0]["codigo_provincia"], r[0]["transmision"]) == ("SEAT", "DIESEL", "TURISMO", 5, True, "08", "2024-03")


def test_transfer_lines_of_both_layouts(spark, tmp_path):
    (tmp_path / "transmisiones_202412.txt").write_text("\n".join([OLD, "", "   ", "no vehicle number SEAT", NEW, "99999999 LAND ROVER DISCOVERY SPORT 2SALCA2BN0FH12345X 016", "01012020 MERCEDES-BENZ CLASE A 1WDD1760121J00000X  907 A0000000AB", "02022020 LAND CRUISER 1JTEBR3FJ20K00000X 3009 B1801234PALMA DE x", "1JTEBR3FJ20K00000X 300"]))
    (tmp_path / "transmisiones_202501.txt").write_text("\n".join([NEW, OLD, "17012025 BMW BMW X 3 WBAPW123456***********4A2 B2228079MADRID", "17012025 MERCEDES BENZ VITO WDD20400112*************R12"]))
    found = transfers.records(transfers.lines(spark, str(tmp_path)), 2025)
    assert found.schema.simpleString() == spark.createDataFrame([], transfers.COLUMNS).schema.simpleString()
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    got = {(r["transmision"], r["vin"]): r for r in found.collect()}
    want = {
        ("2024-12", "1VSSZZZ6JZ9R123456"): ("05/04/2019", "SEAT", "IBIZA", "IBIZA 1.4 TDI", "DIESEL", "08019", "BARCELONA", "BARCELONA", "TURISMO", 6),
        ("2024-12", "2SALCA2BN0FH12345X"): (None, "LAND ROVER", "DISCOVERY", "DISCOVERY SPORT", "GLP", None, None, None, "CAMIÓN", None),
        ("2024-12", "1WDD1760121J00000X"): ("01/01/2020", "MERCEDES-BENZ", "CLASE", "CLASE A", "GNC", None, None, None, "CICLOMOTOR DE 2 RUEDAS", 5),
        ("2024-12", "1JTEBR3FJ20K00000X"): ("02/02/2020", "LAND", "CRUISER", "CRUISER", "GASOLINA", "01234", "PALMA", "ÁLAVA", "TODO TERRENO", 5),
        ("2025-01", "WDD20400112***********"): ("17/01/2025", "MERCEDES-BENZ", "C220", "C 220 D", "ELECTRICO", "28079", "MADRID", "MADRID", "TURISMO", 0),
        ("2025-01", "WBAPW123456***********"): ("17/01/2025", "BMW", "X3", "X 3", "ELECTRICO", "28079", "MADRID", "MADRID", "DESCONOCIDO", 0),
        ("2025-01", "WDD20400112*************"): ("17/01/2025", "MERCEDES-BENZ", "VITO", "VITO", None, None, None, None, "REMOLQUE PLATAFORMA", 0),
    }
    assert {k: (r["fecha_mat"], r["marca"], r["modelo"], r["submodelo"], r["combustible"], r["codigo_ine"], r["localidad"], r["provincia"], r["tipo_vehiculo"], r["antiguedad_anios"]) for k, r in got.items()} == want


def test_transfer_records_are_written_and_read_back(spark, tmp_path):
    rows = spark.createDataFrame(
        [("05/04/2019", "SEAT", "IBIZA 1.4", "1VSSZZZ6JZ9R123456", "TURISMO", "DIESEL", "08019", "BARCELONA"), (None, "BMW", "X 5", "2VSSZZZ6JZ9R123456", "QUAD", "ELECTRICO", "28079", "MADRID")],
        "fecha_mat string, marca string, submodelo string, vin string, tipo_vehiculo string, combustible string, codigo_ine string, localidad string",
    )
    for folder, masked in (("t_202402", False), ("t_202502", True)):
        transfers.as_lines(rows, masked).write.text(str(tmp_path / folder))
    back = transfers.to_parquet(spark, str(tmp_path), str(tmp_path / "out"), 2025, names="folder")
    assert back.count() == 4 and sorted(r[0] for r in back.select("transmision").distinct().collect()) == ["2024-02", "2025-02"]
    own = [c for c in rows.columns if c != "vin"]
    for month in ("2024-02", "2025-02"):
        assert sorted(map(str, back.where(F.col("transmision") == month).select(*own).collect())) == sorted(map(str, rows.select(*own).collect()))
    assert sorted(r["vin"] for r in back.where("transmision = '2024-02'").collect()) == ["1VSSZZZ6JZ9R123456", "2VSSZZZ6JZ9R123456"]
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "t_202402.txt").write_text("nothing here\n")
    empty = transfers.to_parquet(spark, str(tmp_path / "none"), str(tmp_path / "empty"), 2025)
    assert empty.count() == 0 and spark.read.parquet(str(tmp_path / "empty")).columns == empty.columns


def test_transfer_lines_of_both_layouts_in_one_pass(spark, tmp_path):
    """A column decides the layout of each row, and one job writes the folders of both months."""
    rows = spark.createDataFrame([("01/02/2020", "SEAT", "SEAT IBIZA", v, "TURISMO", "DIESEL", "08019", "SITIO", m) for v, m in (("1V" + "0" * 15 + "7", False), ("V0000000007", True))], "fecha_mat string, marca string, submodelo string, vin string, tipo_vehiculo string, combustible string, codigo_ine string, localidad string, masked boolean")
    transfers.as_lines(rows, F.col("masked"), F.when(F.col("masked"), "202503").otherwise("202412").alias("transmisiones")).write.partitionBy("transmisiones").text(str(tmp_path / "in"))
    found = {r["transmision"]: r for r in transfers.records(transfers.lines(spark, str(tmp_path / "in"), "folder"), 2025).collect()}
    assert {k: (r["vin"][:11], len(r["vin"]), r["submodelo"], r["fecha_mat"], r["codigo_ine"]) for k, r in found.items()} == {
        "2024-12": ("1V000000000", 18, "IBIZA", "01/02/2020", "08019"), "2025-03": ("V0000000007", 22, "IBIZA", "01/02/2020", "08019"),
    }


def test_preamble_and_tree(spark, tmp_path):
    p = tmp_path / "p.csv"
    p.write_text('Report of today\n\nLot number,Link,Note\n1,http://a,"x, y"\n2,,z\n')
    assert [tuple(r) for r in readers.preamble(spark, str(p), ["lot", "link"]).orderBy("Lot number").collect()] == [("1", "http://a", "x, y"), ("2", None, "z")]
    tree = spark.createDataFrame([([("A", [("m", [(2020,)])])],)], "makes array<struct<name: string, models: array<struct<name: string, years: array<struct<year: int>>>>>>")
    assert readers.expanded(tree, ["makes", "models", "years"]).select("__0.name", "__2.year").collect()[0][1] == 2020


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    assert readers.write_any(df, str(tmp_path / "x.xlsx")).endswith(".csv")
    calls = []
    make = lambda: calls.append(1) or df
    for _ in range(2):
        assert readers.reused(spark, str(tmp_path / "cache"), make).count() == 1
    assert len(calls) == 1
    readers.write_with_notes(df, str(tmp_path / "n"), {"b": 1})
    assert json.loads(spark.read.text(str(tmp_path / "n.meta.json")).collect()[0][0]) == {"b": 1}
    assert readers.dictionary(spark).count() == 3 * len(readers.DICTIONARY) + len(readers.RATIOS)


def test_merged_exports(spark):
    a = spark.createDataFrame([("http://X/1?b=2&a=1", "7"), ("", "8")], "link string, lot_number string")
    b = spark.createDataFrame([("http://x/1?a=1&B=2#f",), ("http://x/2",)], "link string")
    assert sorted((r["link_key"], r["lot_number"]) for r in readers.merged_exports([a], b).collect()) == [("http://x/1?a=1&b=2", "7"), ("http://x/2", None)]


def test_files_are_ingested_once(spark, tmp_path):
    source, sink, mark = (str(tmp_path / x) for x in ("in", "out", "mark"))
    schema = "k int, v string, t int"
    write = lambda rows: spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
    write([(1, "a", 1), (2, "b", 1)])
    run = lambda: ingest.drain(ingest.new_files(spark, source, schema), mark, ingest.append_to(sink))
    run()
    write([(1, "c", 2), (3, "d", 2)])
    run()
    run()
    assert sorted((r["k"], r["v"], r["batch"]) for r in spark.read.parquet(sink).collect()) == [(1, "a", 0), (1, "c", 1), (2, "b", 0), (3, "d", 1)]


def test_small_stream_operators(spark):
    df = spark.createDataFrame([(202401, 1), (202403, 2), (202306, 3)], "yyyymm long, v int")
    assert sorted(r["v"] for r in ingest.rolling(df, 3).collect()) == [1, 2]
    assert ingest.period_changed(df, df.where("v = 1")) and not ingest.period_changed(df, df)
    again = spark.createDataFrame([(202401, 9)], "yyyymm long, v int")
    assert sorted(r["v"] for r in ingest.retried(df, again, "yyyymm").collect()) == [2, 3, 9]
