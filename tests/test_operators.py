"""Operators on small tables with known results, among them the traps of the blueprint."""

import math

import pytest
from pyspark.sql import functions as F

from lotwise.operators import cascade, columns, fees, filters, linkage, lookup, market, price, ranking, recommend, routes
from lotwise.plans import runner


def frame(spark, schema, *rows):
    return spark.createDataFrame(list(rows), schema)


def test_columns_resolve_in_each_mode(spark):
    names = ["Fecha Matriculación", "MAKE\r", "precio_final"]
    assert columns.resolve(names, ["fecha matriculacion"]) == names[0]
    assert columns.resolve(names, ["make"], "ci") == names[1]
    assert columns.resolve(names, ["precio"], "contains") == names[2] and columns.resolve(names, ["precio"], "ci") is None
    df = frame(spark, "MARCA string, modelo string", ("a", "b"))
    assert columns.rename_synonyms(df, {"marca_x": ["marca"], "modelo": ["model"]}).columns == ["marca_x", "modelo"]
    assert columns.conform(df).columns == list(columns.LISTING.columns)
    rows = frame(spark, "sale_name string, `Año` int, `kilómetros` int, fuel_type string, modelo string, other int", ("S", 2020, 7, "Híbrido enchufable", "m", 1))
    shown = columns.conform(rows, columns.RESULTS)
    assert shown.columns == list(columns.RESULTS.columns)
    r = shown.collect()[0]
    assert (r["auction_name"], r["year"], r["mileage"], r["combustible_norm"], r["modelo_base_x"], r["segmento"]) == ("S", 2020, 7, "PHEV", "m", None)
    with pytest.raises(ValueError):
        columns.require(df, ["nope"])


def test_filters(spark):
    df = frame(spark, "codigo_ine string, anio int, marca string, modelo string, combustible string", ("1", 2020, "Seat", "Ibiza", None), ("1", 2021, "SEAT ", "Leon", "D"), ("2", 2020, "Seat", "Ibiza", "D"))
    f = filters.Filters(("1",), None, (2020, 2021), "seat", "ibiza", "E")
    found, dropped = filters.relaxed(df, f)
    assert dropped == ["fuel"] and found.count() == 1
    assert filters.previous_period(2020, 2021) == (2018, 2019) and filters.period("202003-202105") == (2020, 2021)
    listing = frame(spark, "modelo string, anio int, precio_final_eur double, mileage double, segmento string, combustible_norm string, transmission string", ("X1", 2020, 9.0, 5.0, "Ñ", "DIESEL", "Auto"), ("IX1", 2020, 99.0, 5.0, None, "PETROL", "man"), ("X1", None, 9.0, None, "B", None, None))
    count = lambda **k: filters.listings(listing, filters.Listing(**k)).count()
    assert count(model="x1") == 3 and count(model="^x1$") == 2 and count(years=(2019, 2021)) == 2 and count(price=(None, 10)) == 2
    assert count(segment_in=("n",)) == 1 and count(segment_out=("b",)) == 2 and count(segment_in=("",)) == 3
    assert count(fuels=("petrol",)) == 1 and count(fuels=("",)) == 3 and count(gearbox="automatic") == 1 and count(max_age=5, as_of=2025) == 2


def test_places(spark):
    p = frame(spark, "codigo_ine string, municipio string, provincia string, ccaa string", ("1", "Vic", "B", "C"), ("2", "Vícar", "A", "S"), ("3", "Roda de Vic", "B", "C"))
    codes = lambda name, **k: sorted(r["codigo_ine"] for r in filters.find_places(p, name, **k).collect())
    assert codes("VIC") == ["1"] and codes("vi") == ["1", "2"] and codes("de vic") == ["3"] and codes("vi", policy="first") == ["1"] and codes("vi", province="a") == ["2"]
    with pytest.raises(ValueError):
        codes("vi", policy="fail")


def test_blank_masks(spark):
    df = frame(spark, "a string, b string", (" ", None), ("x", ""), ("x", "y"))
    assert [tuple(r) for r in df.select(filters.all_blank(F.col("a"), F.col("b")), filters.any_blank(F.col("a"), F.col("b"))).collect()] == [(True, True), (False, True), (False, False)]


def test_yoy_looks_back_a_year_and_counts_a_month_once(spark):
    df = frame(spark, "k string, yyyymm long, unidades long", ("a", 202301, 10), ("a", 202401, 15), ("a", 202402, 5), ("b", 202301, 0), ("b", 202401, 3), ("a", 202301, 2))
    got = {(r["k"], r["yyyymm"], r["unidades"]): (r["unidades_prev"], r["YoY_unidades_%"]) for r in market.add_yoy(df, ["k", "yyyymm"]).collect()}
    assert got[("a", 202401, 15)] == (12, 25.0) and got[("a", 202402, 5)] == (None, None) and got[("b", 202401, 3)] == (0, None)
    back = {(r["k"], r["yyyymm"]): r["unidades_prev"] for r in market.add_yoy(df.where("k = 'a' and unidades > 2"), ["k", "yyyymm"], legacy=True).collect()}
    assert back[("a", 202301)] == 15


def cohorts(spark):
    return frame(
        spark, "region string, marca string, modelo string, anio long, combustible string, yyyymm long, unidades double",
        ("ESP", "A", "x", 2019, "d", 201901, 10.0), ("ESP", "A", "x", 2019, "d", 201902, 30.0), ("ESP", "A", "x", 2021, "d", 202101, 50.0), ("ESP", "A", "x", 2021, "p", 202101, 50.0),
        ("ESP", "A", "y", 2021, "d", 202101, 100.0), ("ESP", None, "z", 2021, "d", 202101, 7.0), ("BCN", "A", "x", 2021, "d", 202101, 5.0),
    )


def test_features(spark):
    rows = {(r["region"], r["marca"], r["modelo"], r["anio"], r["combustible"]): r.asDict() for r in market.features(cohorts(spark)).collect()}
    a = rows[("ESP", "A", "x", 2021, "d")]
    assert a["YoY_%"] == 0.25 and a["trend_flag"] == 1 and a["YoY_weighted"] == 0.25 and a["Growth_3a_%"] is None
    assert a["best_fuel"] == "d" and a["best_fuel_units"] == 50 and a["is_best_fuel"] == 1 and rows[("ESP", "A", "x", 2021, "p")]["is_best_fuel"] == 0
    assert a["share_marca_%"] == 0.25 and math.isclose(a["share_año_%"], 50 / 207) and a["rank_general"] == 1 and a["HHI_marca"] == 0.5
    lost = rows[("ESP", None, "z", 2021, "d")]
    assert lost["share_marca_%"] == 0 and lost["share_combustible_%"] > 0
    first = rows[("ESP", "A", "x", 2019, "d")]
    assert math.isclose(first["coef_var_%"], math.sqrt(200) / 20) and first["YoY_%"] is None
    shares = {}
    for r in rows.values():
        shares[(r["region"], r["anio"])] = shares.get((r["region"], r["anio"]), 0) + r["share_año_%"]
    assert all(math.isclose(s, 1) for s in shares.values())


def test_calendar_trends_see_gaps(spark):
    by = {r["anio"]: r["YoY_%"] for r in market.trends(market.annual(cohorts(spark).where("region = 'ESP' and modelo = 'x' and combustible = 'd'")), by_calendar=True).collect()}
    assert by == {2019: None, 2021: None}


def test_regions_are_nested(spark):
    df = frame(spark, "p string, u long", ("b", 1), ("c", 2), ("e", 4))
    got = {r["region"]: r["u"] for r in market.by_region(df, F.col("p") == "b", F.col("p") == "c").groupBy("region").agg(F.sum("u").alias("u")).collect()}
    assert got == {"BCN": 1, "CAT": 3, "ESP": 7}


def test_bad_place_codes_raise(spark):
    places = frame(spark, "codigo_ine string, provincia string", ("8019", "Barcelona"))
    assert market.normalized_places(frame(spark, "codigo_ine string", ("08019",), (None,)), places).where("provincia_norm = 'BARCELONA'").count() == 1
    with pytest.raises(Exception, match="bad place code"):
        market.normalized_places(frame(spark, "codigo_ine string", ("x",)), places).collect()


def test_standardized(spark):
    raw = frame(spark, "MARCA string, modelo string, fecha_mat string, combustible string, codigo_ine string, provincia string, antiguedad_anios string, tipo string", ("B.M.W.", "x 1", "05/04/2019", "Gasóleo", "8019", "Álava", "NaN", "Turismo"))
    brands = frame(spark, "alias string, canonical string", ("B M W", "Bmw"), ("BMW", "Bmw"))
    r = market.standardized(raw, brands).collect()[0]
    assert (r["marca"], r["combustible"], r["codigo"], r["anio"], r["yyyymm"], r["antiguedad_anios"], r["provincia"]) == ("BMW", "OTROS", "08", 2019, 201904, None, "ALAVA")


def test_ranking_against_the_whole_previous_period(spark):
    rows = [("1", 2020, m, "x", "d", u) for m, u in (("a", 5), ("b", 3), ("c", 1))] + [("1", 2021, m, "x", "d", u) for m, u in (("c", 9), ("a", 1), ("e", 0))]
    df = frame(spark, "codigo_ine string, anio int, marca string, modelo string, combustible string, unidades long", *rows)
    f = filters.Filters(("1",), 2021)
    got = {r["marca"]: (r["rank"], r["unidades_prev"], r["rank_prev"], r["delta_rank"]) for r in ranking.versus_previous(df, f, ["marca"], 2).collect()}
    assert got == {"c": (1, 1, 3, 2), "a": (2, 5, 1, -1)}
    old = {r["marca"]: r["unidades_prev"] for r in ranking.versus_previous(df, f, ["marca"], 2, legacy=True).collect()}
    assert old == {"c": None, "a": 5}


def test_cascade_prefers_the_nearer_place(spark):
    f = market.features(frame(
        spark, "region string, marca string, modelo string, anio long, combustible string, yyyymm long, unidades double",
        ("BCN", "A", "x", 2020, "diesel", 202001, 4.0), ("CAT", "A", "x", 2020, "petrol", 202001, 9.0), ("ESP", "A", "w", 2020, "hydrogen", 202001, 2.0), ("ESP", "A", "v", None, "petrol", 202001, 3.0),
    ))
    lots = frame(spark, "id int, marca string, modelo string, anio long, combustible string", (1, "A", "x", 2020, "petrol"), (2, "A", "w", 2020, "cng"), (3, "A", "none", 2020, "petrol"), (4, "A", "v", None, "petrol"), (5, "A", "x", 2020, "cng"))
    got = {r["id"]: (r["units_abs"], r["match_kind"], r["geo_fallback"]) for r in cascade.match(lots, "id", f, market.without_fuel(f), ["units_abs"], "BCN").collect()}
    assert got == {1: (4.0, "fuel_fallback", "bcn"), 2: (2.0, "fuel_fallback", "esp"), 3: (None, None, None), 4: (3.0, "exact", "esp"), 5: (4.0, "fuel_fallback", "bcn")}
    wide = cascade.match_all(lots, f, market.without_fuel(f), ["units_abs"])
    joins = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("Join ")
    assert joins(wide) == joins(cascade.match(lots, "id", f, market.without_fuel(f), ["units_abs"], "BCN"))  # all targets take theirs of one pool
    assert wide.count() == 5 and {"units_abs_bcn", "match_kind_esp", "ratio_bcn_cat_%"} <= set(wide.columns)


RULES = "pais string, categoria string, subasta_o_tipo string, precio_min double, precio_max double, moneda string, tasa_valor double, tasa_unidad string, importe_minimo double"


def test_fee_bands(spark):
    table = fees.rules(frame(
        spark, RULES, ("España", "adquisicion", "otros", 0.0, 1000.0, "EUR", 10.0, "EUR", None), ("España", "adquisicion", "otros", 0.0, 500.0, "EUR", 5.0, "EUR", None), ("España", "adquisicion", "otros", 2000.0, None, "EUR", 1.0, "%", 50.0),
        ("España", "adquisicion", "Gold", None, None, "EUR", 77.0, "EUR", None), ("Global", "documentos", "otros", None, None, "SEK", 100.0, "SEK", None), ("Europa", "diagnostico", "", None, None, "EUR", 9.0, "EUR", None),
    ))
    lots = frame(spark, "id int, p double, c string, s string, ev boolean, sold boolean", (1, 400.0, "ESPAÑA", "x", True, True), (2, 900.0, "espana", "x", False, True), (3, 3000.0, "España", "x", False, True), (4, 9000.0, "España", "x", False, True), (5, 400.0, "España", "gold", False, True), (6, 400.0, "Mars", "x", False, True), (7, 400.0, "España", "x", False, False), (8, 1500.0, "España", "x", None, True), (9, 400.0, "España", "BEV", True, True), (10, 400.0, "Mars", "BEV", True, True))
    got = {r["id"]: (r["commission_adquisicion_eur"], r["commission_documentos_eur"], r["commission_diagnostico_eur"], r["commission_total_eur"], r["error"]) for r in fees.bundle(lots, "id", table, "p", "c", "s", "ev", "sold").collect()}
    assert got[1][:4] == pytest.approx((5.0, 8.8, 9.0, 22.8)) and got[2][0] == 10.0 and got[3][0] == 50.0 and got[4][0] == 90.0 and got[5][0] == 77.0 and got[8][0] == 5.0
    assert got[6][0] is None and got[6][1] == pytest.approx(8.8) and got[6][2] is None and "sin_regla_adquisicion" in got[6][4] and got[7] == (None, None, None, 0.0, "")
    old = {r["id"]: (r["commission_adquisicion_eur"], r["commission_documentos_eur"], r["commission_diagnostico_eur"], r["error"]) for r in fees.bundle(lots, "id", table, "p", "c", "s", "ev", "sold", legacy=True).collect()}
    bad = "sin_adquisicion_valida"  # the country's rules alone, but for acquisition and for sales of electric vehicles
    assert old == {1: (5.0, None, None, ""), 2: (10.0, None, None, ""), 3: (50.0, None, None, ""), 4: (90.0, None, None, ""), 5: (77.0, None, None, ""), 6: (None, None, None, bad), 7: (None, None, None, ""), 8: (None, None, None, bad), 9: (None, pytest.approx(8.8), 9.0, bad), 10: (None, pytest.approx(8.8), 9.0, bad)}
    assert {r["id"]: r["fee_eur"] for r in fees.lookup(lots, "id", table, "p", "c", "s", ("adquisicion",), legacy=True).collect()} == {1: 5.0, 2: 10.0, 3: 50.0, 4: 90.0, 5: 77.0, 7: 5.0}


def test_routes(spark):
    schema = "pais_origen string, pais_destino string, destino_zip long, origen_compound string, precio_passenger_car_eur double, precio_suv_eur double, precio_lcv1_eur double, precio_lcv2_eur double, dias_single_cars int"
    table = routes.routes(frame(spark, schema, ("Germany", "Spain", 28001, "Bremen Nord", 100.0, None, None, None, 3), ("Germany", "Spain", 28001, "Ulm", 200.0, 300.0, None, 400.0, 4), ("France", "Spain", 28001, "Lyon", 50.0, None, 70.0, None, 2)))
    lots = frame(spark, "id int, o string, u string, cat string", (1, "germany", "Bremen Hafen", "passenger_car"), (2, "Germany", "Bremen Nord", "suv"), (3, "France", None, "lcv"), (4, "Italy", "x", "suv"), (5, "Italy", "x", "boat"))
    got = {r["id"]: (r["transport_eur"], r["transport_confidence"], r["transport_days"]) for r in routes.priced(lots, "id", table, "o", "u", "cat", "Spain").collect()}
    assert got == {1: (100.0, 1.0, 3), 2: (300.0, 0.5, None), 3: (70.0, 1.0, 2), 4: (300.0, 0.3, None), 5: (0.0, 0.0, None)}
    old = {r["id"]: (r["transport_eur"], r["transport_confidence"], r["transport_days"]) for r in routes.priced(lots, "id", table, "o", "u", "cat", "Spain", ["bremen"], legacy=True).collect()}
    assert old == {1: (100.0, 0.9, 3), 2: (300.0, 0.5, None), 3: (70.0, 0.5, 2), 4: (0.0, 0.0, None), 5: (0.0, 0.0, None)}


def test_landed_price(spark):
    costs = price.fixed_costs(frame(spark, "pais string, valor_eur string", ("ES", "10,5"), ("ES", None)))
    lots = frame(spark, "winning_bid string, transport_eur double, commission_total_eur double, precio_venta_ganvam double", ("100", None, 5.0, 200.0), ("x", 1.0, None, None))
    got = [(r["precio_final_eur"], r["margin_abs"]) for r in price.margins(price.landed(lots, costs)).orderBy("precio_final_eur").collect()]
    assert got == [(11.5, None), (115.5, 84.5)]


def listing(spark):
    schema = "lot_id string, marca string, modelo string, anio int, combustible_norm string, sale_name string, sale_country string, precio_final_eur double, precio_venta_ganvam double, margin_abs double, segmento string, mileage double, `share_marca_%_bcn` double, units_abs_bcn double, `mix_0_3_%_bcn` double, best_fuel_bcn string, `row_vs_best_fuel_%_bcn` double, note string"
    return frame(
        spark, schema, ("1", "VW", "GOLF", 2020, "DIESEL", "S1", "DE", 10.0, 20.0, 10.0, "C", 5.0, 50.0, 100.0, 20.0, "diesel", 80.0, None), ("2", "VW", "GOLF", 2020, "DIESEL", "S2", "DE", 12.0, 20.0, 8.0, "C", 5.0, None, None, None, "petrol", 100.0, "b"),
        ("3", "VW", "GOLF", 2021, "PETROL", "S1", "FR", 15.0, 18.0, 3.0, "C", 5.0, 10.0, 50.0, 40.0, None, None, "c"), ("4", "VW", "POLO", 2021, "PETROL", "S1", "FR", 5.0, 5.0, 0.0, "B", 5.0, 0.0, 0.0, 0.0, "petrol", 10.0, "d"),
    )


def test_recommendations(spark):
    df = listing(spark)
    s = {r["lot_id"]: (r["demand"], r["rotation"], r["score"]) for r in recommend.scored(df, "bcn").collect()}
    assert s["1"] == (1.0, 0.2, pytest.approx(0.6 * 1 + 0.4 * 0.5)) and s["2"][0] == 0.5 and s["4"] == (0.0, 0.0, 0.0)
    picked = recommend.best(df, "bcn").collect()
    assert [r["lot_id"] for r in picked] == ["1", "3", "4"] and picked[0]["note"] is None
    assert [r["lot_id"] for r in recommend.best(df, "bcn", selection="max_margin", n=2).collect()] == ["1", "3"]
    means = recommend.best(df, "bcn", selection="mean", least=2).collect()
    assert len(means) == 1 and means[0]["precio_final_eur"] == 11.0
    top, sales = recommend.best_auction(df, filters.Listing(model="golf"), 2)
    assert [r["lot_id"] for r in top.collect()] == ["1", "3"]
    assert [(r["sale_name"], r["representation_pct"]) for r in sales.collect()] == [("S1", 100.0)]
    assert [r["lot_id"] for r in recommend.within_brand(df, filters.Listing(make="vw")).collect()] == ["4", "1"]
    assert [r["lot_id"] for r in recommend.within_segment(df, "bcn", filters.Listing(segment_in=("c",)), n=10).collect()] == ["1", "3"]
    a = recommend.attractiveness(df, "bcn", filters.Listing(model="golf")).collect()[0]
    assert a["n_lotes"] == 3 and a["fuel"] == "DIESEL,PETROL" and a["attractiveness_bucket"] in ("BAJO", "MEDIO", "ALTO")
    assert recommend.attractiveness(df, "bcn", filters.Listing(model="none")).collect()[0]["attractiveness_bucket"] == "SIN_DATOS"
    gap = recommend.best_fuel_gap(df, filters.Listing(model="golf", year=(2020,))).collect()
    assert [(r["region"], r["best_fuel"], r["gap_vs_rest_mean"]) for r in gap] == [("bcn", "DIESEL", pytest.approx(0.1))]


def test_constant_columns_scale_to_zero(spark):
    df = listing(spark).withColumn("margin_abs", F.lit(5.0))
    s = recommend.Scaled(df, {"m": F.col("margin_abs")})
    assert s.df.select(s.unit("m")).distinct().collect()[0][0] == 0.0
    old = recommend.Scaled(df, {"m": F.col("margin_abs")}, legacy=True)
    assert old.df.select(old.unit("m")).distinct().collect()[0][0] == 5.0


def test_runner(spark, tmp_path):
    config = {
        "alpha": 0.6, "global_filters": {"margin_cap_ratio": 2.0, "fuel_exclude": [""]}, "demand": {"weight_units_abs": 0.5},
        "queries": [
            {"name": "a", "type": "q1", "model": "GOLF", "top_n": 5, "filters": {}}, {"name": "b", "type": "q2", "brand": "VW"}, {"name": "c", "type": "q3", "segment": "C", "region": "bcn", "top_n": 5}, {"name": "d", "type": "q4", "modelo_base": "GOLF", "year": 2020},
            {"name": "e", "type": "q5", "modelo_base": "GOLF", "year": 2020}, {"name": "f", "type": "generic", "region": "bcn", "filters": {"modelo_base": "GOLF", "fuel_include": [""], "max_price": 14}},
        ],
    }
    found = runner.plans(listing(spark), config)
    assert [p.frame.count() for p in found] == [3, 2, 2, 1, 1, 1] and found[0].frame.columns == list(columns.LISTING.columns)
    listing(spark).write.parquet(str(tmp_path / "lots"))
    scans = [[p.frame._jdf.queryExecution().optimizedPlan().toString().count("parquet") for p in runner.plans(spark.read.parquet(str(tmp_path / "lots")), config, shared=on)] for on in (True, False)]
    assert not any(scans[0]) and all(scans[1])  # the shared listing is read once, before the plans
    index = runner.write(spark, found, str(tmp_path / "out"))
    assert index.count() == 7
    with pytest.raises(ValueError):
        runner.plans(listing(spark), {"queries": [{"type": "q9"}]})


def test_linkage(spark):
    schema_l = "lot_id string, make string, model string, year int, fuel string, power double, text string"
    schema_p = "price_id string, make string, model string, year int, fuel string, power double, text string, start int, end int, price double"
    prices = frame(
        spark, schema_p, ("p1", "A", "golf", 2020, "d", 110.0, "golf sport 5p", None, None, 1.0), ("p2", "A", "golf", 2020, "d", 150.0, "golf sport 5p", None, None, 2.0), ("p3", "A", "golf", 2019, "p", 90.0, "golf edition", None, None, 3.0),
        ("p4", "A", "golf variant", 2020, "d", 110.0, "variant sport", None, None, 4.0), ("p5", "B", "old", 2005, "d", 60.0, "old base", 2000, 2010, 5.0),
    )
    lots = frame(
        spark, schema_l, ("strict", "A", "golf", 2020, "d", 150.0, "golf sport"), ("fuelless", "A", "golf", 2020, "e", 110.0, "golf sport"), ("power", "A", "golf", 2020, "d", 145.0, "golf sport"), ("near", "A", "variant golf", 2020, "d", 110.0, "variant"),
        ("range", "B", "old", 2008, "d", None, "old"), ("words", "A", "golf", 2020, "d", 110.0, "zzz"), ("hint", "C", "x", 2020, "d", 1.0, "x"),
    )
    hints = frame(spark, "lot_id string, price_id string", ("hint", "p5"))
    assert {r["lot_id"]: r["price_id"] for r in linkage.match(lots, prices, hints=hints)[0].collect()}["near"] is None  # three rows of golf are as like, and come first
    best, audit = linkage.match(lots, prices, linkage.Rules(fuzzy_top=4), hints)
    got = {r["lot_id"]: (r["price_id"], r["matching_type"]) for r in best.collect()}
    assert got["strict"] == ("p2", "KEY_STRICT") and got["fuelless"] == ("p1", "KEY_STRICT") and got["power"] == ("p2", "KEY_STRICT") and got["range"] == ("p5", "KEY_STRICT")
    assert got["near"][0] == "p4" and got["near"][1].startswith("APROX") and got["words"][0] is None and got["hint"] == ("p5", "HINT")
    ranks = {(r["lot_id"], r["cand_rank"]): r["price_id"] for r in audit.collect()}
    assert ranks[("power", 1)] == "p2" and ranks[("power", 2)] == "p1"


def test_lookups(spark):
    df = frame(spark, "vin string, d int, v string", ("a", 1, "x"), ("a", 3, "y"), (None, 1, "p"), (None, 2, "q"), (" ", 1, "r"))
    assert sorted(r["v"] for r in lookup.latest(df, "vin", [F.desc("d")]).collect()) == ["p", "q", "r", "y"]
    left = frame(spark, "k int, v string", (1, None), (2, "l"), (3, None))
    right = frame(spark, "k int, v string, w int", (1, "r", 5), (2, "r", 6))
    assert sorted((r["k"], r["v"], r["w"]) for r in lookup.filled_from(left, right, "k", ["v", "w"]).collect()) == [(1, "r", 5), (2, "l", 6), (3, None, None)]
    assert sorted((r["k"], r["v"]) for r in lookup.written_back(left, right, "k", ["v"], F.col("k") == 2).collect()) == [(1, None), (2, "r"), (3, None)]
    both = lookup.first_of([frame(spark, "k int, a int", (1, 1)), frame(spark, "k int, b int", (1, 2), (2, 3))], "k", ["a"])
    assert sorted((r["k"], r["a"], r["b"]) for r in both.collect()) == [(1, 1, None), (2, None, 3)]
    gaps = lookup.with_gap_rows(frame(spark, "m string, y int", ("a", 2000), ("a", 2003)), ["m"], "y")
    assert sorted(r["y"] for r in gaps.collect()) == [2001, 2002]


def test_plans_prune_and_push_down(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    frame(spark, "codigo_ine string, anio int, marca string, modelo string, combustible string, unidades long, other string", ("1", 2020, "a", "b", "c", 1, "z")).write.parquet(path)
    plan = ranking.ranking(filters.apply(spark.read.parquet(path), filters.Filters(("1",), 2020)), ["marca"], 5)._jdf.queryExecution().toString()
    assert "EqualTo(anio,2020)" in plan and "other" not in plan.split("ReadSchema")[1] and "BatchEvalPython" not in plan and "CartesianProduct" not in plan


def test_choices_in_the_row_move_no_lot(spark):
    """Fees, routes and their bundle pick from arrays: no lot is shuffled or sorted."""
    from lotwise import queries

    plans = {}
    for name in ("fee_bands", "fee_bundle", "transport_price"):
        df = queries.QUERIES[name](spark, "/root/testdata/sf0.001")
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
    assert all("hashpartitioning(o_orderkey" not in p and "hashpartitioning(__k" not in p and "CartesianProduct" not in p for p in plans.values())


def test_flagship_has_rows(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0


def test_lots_are_dealt_out_before_repeats_drop_out(spark, tmp_path, monkeypatch):
    from lotwise import views

    folder = "/root/testdata/sf0.001"
    want = views.lots(spark, folder)
    plan = want._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate [") < plan.index("RepartitionByExpression [lot_id")
    monkeypatch.setattr(views, "LOTS_A_TASK", 100)
    got = views.lots(spark, folder)
    assert "RepartitionByExpression [lot_id" in got._jdf.queryExecution().optimizedPlan().toString()
    assert got.rdd.getNumPartitions() == 60 and got.exceptAll(want).count() == 0 and got.count() == want.count()
