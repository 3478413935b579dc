"""Column expressions against values worked out by hand."""

from datetime import date

from pyspark.sql import functions as F

from lotwise.functions import canon, numbers, text, web


def values(spark, rows, *columns, schema="a string"):
    df = spark.createDataFrame([r if isinstance(r, tuple) else (r,) for r in rows], schema)
    found = df.select(*(c.alias(f"c{i}") for i, c in enumerate(columns))).collect()
    return [r[0] if len(columns) == 1 else tuple(r) for r in found]


def test_keys(spark):
    assert values(spark, ["  Citroën  C4. ", "B.M.W.", "", None, "!!"], text.upper_key(F.col("a"))) == ["CITROEN C4", "BMW", None, None, None]
    assert values(spark, ["Ñandú-X 1", None, "a b"], text.lower_key(F.col("a"))) == ["nandu x 1", "", "a b"]
    assert values(spark, ["é́A"], text.ascii_upper(F.col("a"))) == ["EA"]


def test_tokens_and_overlap(spark):
    t = text.tokens(F.col("a"), ("de",))
    assert values(spark, ["Coche de Coche 5p"], t) == [["coche", "coche", "5p"]]
    a, b = text.tokens(F.col("a")), text.tokens(F.col("b"))
    assert values(spark, [("x y z", "z x w"), ("q", "r")], text.overlap(a, b), text.shared_terms(a, b), text.jaccard(a, b), schema="a string, b string") == [(2, "x z", 0.5), (0, "", 0.0)]
    assert values(spark, [("ab", "xabx"), ("", "q"), ("a", "b")], text.either_contains(F.col("a"), F.col("b")), schema="a string, b string") == [True, True, False]


def test_fuzzy_ratio(spark):
    found = values(spark, [("serie 3 touring", "touring serie 3"), ("golf", "golf variant"), ("abc", "xyz"), (None, "a")], text.fuzzy_ratio(F.col("a"), F.col("b")), schema="a string, b string")
    assert found[:2] == [100.0, 100.0] and found[2] < 40 and found[3] == 0.0


def test_places_and_ids(spark):
    assert values(spark, ["Madrid – Norte, ES", "Vigo, Galicia", "  Lugo. ", None], text.location_head(F.col("a"))) == ["Madrid", "Vigo", "Lugo", None]
    assert values(spark, ["Calle 28001 x", "12", None], text.zip_candidate(F.col("a"))) == ["28001", None, None]
    assert values(spark, ["1234.0", " 7 ", None], text.id_text(F.col("a"))) == ["1234", "7", None]
    assert values(spark, ["mat. 2019-05", "x1850", None], text.year_in(F.col("a"))) == [2019, None, None]
    assert text.file_safe("Q1: Mejor / subasta") == "Q1__Mejor___subasta"


def test_fuels(spark):
    rows = ["Eléctrico", "Gasolina y Eléctrico", "DIESEL", "gnl", "Solar", None, "MHEVPetrol"]
    assert values(spark, rows, canon.fuel(F.col("a"))) == ["electric", "phev", "diesel", "cng", "unknown", "unknown", "hev"]
    assert values(spark, ["ELECTRICO", "petrol", "PHEV", "HEV diesel", "gas"], canon.fuel_label(F.col("a"))) == ["BEV", "PETROL", "PHEV", "DIESEL", "GAS"]
    assert values(spark, ["Híbrido", "GNC", "Solar"], canon.fuel_code(F.col("a"))) == ["HEV", "GNC", "OTROS"]
    assert values(spark, ["plug-in", "híbrido enchufable", "gasoil", "gasóleo", None], canon.fuel_bucket(F.col("a"))) == ["PHEV", "HEV", "DIESEL", "OTROS", "OTROS"]


def test_states(spark):
    rows = ["Sold", "Not sold", "sale ended", "VENDIDO", None, "open"]
    assert values(spark, rows, canon.sold(F.col("a"))) == [True, False, True, True, False, False]
    assert values(spark, rows, canon.sold(F.col("a"), legacy=True))[1] is True
    assert values(spark, rows, canon.sold_exact(F.col("a"))) == [True, False, False, False, False, False]
    assert values(spark, ["Automatic 8", "Manuell", "cvt"], canon.gearbox(F.col("a"))) == ["automatic", "manual", "cvt"]
    assert values(spark, ["Station wagon", "Furgoneta", "Berlina", "Coupe X"], canon.body_category(F.col("a"), words={"suv": ["coupe x"]})) == ["suv", "lcv", "passenger_car", "suv"]
    assert values(spark, ["Land Rover Defender", "Land Cruiser", "Q"], canon.longest_prefix(F.col("a"), {"land rover": "LR", "land": "L"})) == ["LR", "L", None]
    assert values(spark, ["Cataluña", "Barcelona prov.", "total"], canon.region_code(F.col("a"))) == ["CAT", "BCN", "ESP"]


def test_origins(spark):
    countries = spark.createDataFrame([("ES", "Spain"), ("Alemania", "Germany")], "variant string, country_canonical string")
    places = spark.createDataFrame([("Vigo", "Spain")], "location_head string, country_canonical string")
    lots = spark.createDataFrame([(1, "alemania", "x"), (2, "Europe", "Vigo - norte"), (3, "", "ES, x"), (4, "Mars", None)], "id int, c string, p string")
    found = {r["id"]: r["origin"] for r in canon.origin_country(lots, "c", "p", countries, places).collect()}
    assert found == {1: "Germany", 2: "Spain", 3: "Spain", 4: "Mars"}


def test_numbers(spark):
    assert values(spark, ["1,5", " 2 ", "x", "NaN", None], numbers.number(F.col("a"))) == [1.5, 2.0, None, None, None]
    assert values(spark, [(4.0, 2.0), (1.0, 0.0), (None, 3.0)], numbers.ratio(F.col("a"), F.col("b")), numbers.ratio(F.col("a"), F.col("b"), zero=False), schema="a double, b double") == [(2.0, 2.0), (0.0, None), (0.0, None)]
    assert values(spark, [(100.0, "sek"), (100.0, ""), (100.0, "CHF")], F.round(numbers.to_euros(F.col("a"), F.col("b")), 4), schema="a double, b string") == [8.8, 100.0, None]


def test_periods(spark):
    assert values(spark, [202401, 202312], numbers.add_months(F.col("a"), -1), numbers.add_months(F.col("a"), 13), schema="a long") == [(202312, 202502), (202311, 202501)]
    assert values(spark, ["202405", "31/12/2020", "2021-03-04", "x"], numbers.period_of(F.col("a"))) == [202405, 202012, 202103, None]
    assert values(spark, ["export_202403_v2.parquet", "a_999999.csv"], numbers.period_in_name(F.col("a"))) == [202403, None]
    assert values(spark, ["2020", "05/04/2019", "0001-01-01", "2018-02-03 10:00:00", None], numbers.parse_date(F.col("a"))) == [date(2020, 1, 1), date(2019, 4, 5), None, date(2018, 2, 3), None]
    assert values(spark, ["8019", "8019.0", "123456", "x"], numbers.padded_code(F.col("a"), 5)) == ["08019", "08019", None, None]
    assert values(spark, [2020, 2030], numbers.age_in(2025, F.col("a")), schema="a int") == [5, None]


def test_addresses(spark):
    u = "HTTPS://Www.Shop.example/Lot?ItemId=A%201&x=1&id=77#top"
    assert values(spark, [u], web.lot_url(F.col("a"))) == ["https://www.shop.example/Lot?id=77&ItemId=A 1"]
    assert values(spark, ["http://A/b/?z=1&A=2#f", "http://a/b/"], web.sorted_url(F.col("a"))) == ["http://a/b?a=2&z=1", "http://a/b"]
    assert values(spark, ["x?ItemId=Q", "x?id=9", "http://y"], web.stable_key(F.col("a"))) == ["item:q", "lot:9", "raw:http://y"]
    assert values(spark, ["u?page=1&b=2", "u"], web.with_query(F.col("a"), "page", F.lit(3))) == ["u?page=3&b=2", "u?page=3"]


def test_pages(spark):
    page = "<a href='?q=1&amp;page=3'>x</a><a href='?page=12'>y</a><table><tr><td>Km</td><td> 120.500 km </td></tr><tr><th>Km</th><td>7</td></tr><tr><td>solo</td></tr></table><script>digitalData.push({\"a\":1});</script>"
    assert values(spark, [page, None], F.size(web.page_numbers(F.col("a")))) == [12, 1]
    assert values(spark, [page], web.two_column_table(F.col("a"))) == [{"Km": "7"}]
    assert values(spark, [page], web.pushed_json(F.col("a"))) == [['{"a":1}']]
    assert [tuple(x) for x in values(spark, [page], web.table_pairs(F.col("a")))[0]] == [("Km", "120.500 km"), ("Km", "7")]
    assert values(spark, ["1.6 TDI 110 CV, 120.500 km, 99 g/km"], web.mileage(F.col("a")), web.horsepower(F.col("a")), web.co2(F.col("a"))) == [(120500, 110, 99)]
