"""Transport prices: the best route of a country pair, else mean prices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotwise.functions.text import plain_lower, tokens, zip_candidate
from lotwise.operators.lookup import long_prices

PRICES = {"passenger_car": "precio_passenger_car_eur", "suv": "precio_suv_eur", "lcv": "precio_lcv_eur"}


def routes(df: DataFrame, legacy: bool = False) -> DataFrame:
    """Route table with folded countries, one price for light commercials, days, and an explicit order.

    legacy: the smaller van's price first if it isn't zero, and the days of full trucks.
    """
    vans = ("precio_lcv1_eur", "precio_lcv2_eur") if legacy else ("precio_lcv2_eur", "precio_lcv1_eur")
    value = lambda c: F.nullif(F.col(c).cast("double"), F.lit(0.0)) if legacy else F.col(c).cast("double")
    out = df.withColumn("precio_lcv_eur", F.coalesce(*(value(c) for c in vans if c in df.columns)))
    days = F.coalesce(*(F.col(c).cast("double") for c in (("dias_full_truck",) if legacy else ("dias_transporte", "dias_single_cars", "dias_full_truck")) if c in df.columns), F.lit(None).cast("double"))
    out = out.withColumn("days", days.cast("int")).withColumn("o", plain_lower(F.col("pais_origen"))).withColumn("d", plain_lower(F.col("pais_destino")))
    return out.withColumn("route", F.row_number().over(Window.orderBy("o", "d", "origen_compound", F.col("destino_zip").cast("string"))))  # some hundred rows


def means(table: DataFrame) -> DataFrame:
    """(o, category, mean_price): by country and, with a null country, over all."""
    prices = long_prices(table, ["o"], PRICES)
    return prices.groupBy("o", "category").agg(F.avg("price").alias("mean_price")).unionByName(prices.groupBy("category").agg(F.avg("price").alias("mean_price")).withColumn("o", F.lit(None).cast("string")))


def priced(lots: DataFrame, key: str, table: DataFrame, origin: str, place: str, category: str, destination: str, brands: list[str] = (), stops: list[str] = (), legacy: bool = False) -> DataFrame:
    """``lots`` with the transport price, its rule, its confidence (1, 0.5, 0.3 or 0) and days.

    Of the routes between the countries the one with the best score is taken: words that its compound
    shares with the place, words that are compounds' brands, an equal zip code, and an equal start.
    Without a price there, the mean of the country and category, then of the category. The
    route table (some hundred rows) is broadcast.

    legacy: the older score (three for each brand that stands in both texts, words without digits, two for an equal zip code), a
    confidence of 0.9, 0.7 or 0.5 from it, a price of zero counts as none, and only the country's mean stands in.
    """
    fold = lambda words: [w.strip().lower() for w in words]
    route = F.struct("route", "days", F.col("origen_compound").alias("compound"), F.col("destino_zip").cast("string").alias("zip"), *(F.col(p).cast("double").alias(p) for p in PRICES.values()))
    from_ = table.where(F.col("d") == plain_lower(F.lit(destination))).groupBy(F.col("o").alias("d_o")).agg(F.collect_list(route).alias("__routes"))
    place_of = F.coalesce(F.col(place), F.lit(""))
    mine = F.array_distinct(tokens(place_of))

    def older(r: Column) -> Column:
        here, there = plain_lower(place_of), plain_lower(r["compound"])
        shared = F.filter(F.array_intersect(mine, tokens(r["compound"])), lambda w: ~w.rlike(r"^\d+$"))
        if stops:
            shared = F.array_except(shared, F.array(*(F.lit(x) for x in fold(stops))))
        score = F.size(shared).cast("double")
        for b in fold(brands):
            score = score + F.when(F.contains(here, F.lit(b)) & F.contains(there, F.lit(b)), 3.0).otherwise(0.0)
        return score + F.when(F.get(F.filter(tokens(place_of), lambda w: w.rlike(r"^\d+$")), F.lit(0)) == r["zip"], 2.0).otherwise(0.0)

    def order(r: Column) -> Column:
        price = F.coalesce(*(F.when(F.col(category) == c, r[p]) for c, p in PRICES.items()))
        if legacy:
            return F.struct((-older(r)).alias("back"), r["route"].alias("route"), price.alias("price"), r["days"].alias("days"), r["compound"].alias("compound"))
        theirs = F.array_distinct(tokens(r["compound"]))
        kept = F.array_except(theirs, F.array(*(F.lit(s) for s in fold(stops)))) if stops else theirs
        score = F.size(F.array_intersect(mine, kept)).cast("double")
        if brands:
            score = score + 1.5 * F.size(F.array_intersect(mine, F.array(*(F.lit(b) for b in fold(brands)))))
        score = score + F.when(zip_candidate(place_of) == r["zip"], 2.0).otherwise(0.0)
        start = F.substring(plain_lower(r["compound"]), 1, 10)
        score = score + F.when((start != "") & F.startswith(plain_lower(place_of), start), 0.5).otherwise(0.0)
        return F.struct((-score).alias("back"), r["route"].alias("route"), price.alias("price"), r["days"].alias("days"), r["compound"].alias("compound"))

    # Each row picks its own route from the array of its country: nothing is shuffled.
    out = lots.join(F.broadcast(from_), plain_lower(F.col(origin)) == F.col("d_o"), "left").withColumn("__best", F.array_min(F.transform("__routes", order)))
    out = out.withColumns({"direct": F.col("__best.price"), "d_days": F.col("__best.days"), "compound": F.col("__best.compound"), "d_score": -F.col("__best.back")}).drop("__best", "__routes", "d_o")
    m = means(table)
    local = m.where(F.col("o").isNotNull()).select(F.col("o").alias("l_o"), F.col("category").alias("l_c"), F.col("mean_price").alias("local"))
    whole = m.where(F.col("o").isNull()).select(F.col("category").alias("g_c"), F.col("mean_price").alias("whole"))
    out = out.join(F.broadcast(local), (plain_lower(F.col(origin)) == F.col("l_o")) & (F.col(category) == F.col("l_c")), "left").join(F.broadcast(whole), F.col(category) == F.col("g_c"), "left")
    if legacy:
        out = out.withColumn("direct", F.when(F.col("direct") > 0, F.col("direct"))).withColumn("whole", F.lit(None).cast("double"))
    rule = (
        F.when(F.col("direct").isNotNull(), F.concat(F.lit("direct|compound="), F.coalesce("compound", F.lit("")), F.lit("|score="), F.format_number("d_score", 2), F.lit("|cat="), F.col(category)))
        .when(F.col("local").isNotNull(), F.concat(F.lit("fallback_country|cat="), F.col(category)))
        .when(F.col("whole").isNotNull(), F.concat(F.lit("fallback_global|cat="), F.col(category)))
        .otherwise("sin_tarifa_transporte")
    )
    out = out.withColumns({
        "transport_eur": F.coalesce("direct", "local", "whole", F.lit(0.0)),
        "transport_rule": rule,
        "transport_confidence": F.when(F.col("direct").isNotNull(), F.when(F.col("d_score") >= 3, 0.9).when(F.col("d_score") >= 1, 0.7).otherwise(0.5) if legacy else F.lit(1.0)).when(F.col("local").isNotNull(), 0.5).when(F.col("whole").isNotNull(), 0.3).otherwise(0.0),
        "transport_days": F.when(F.col("direct").isNotNull(), F.col("d_days")),
    })
    return out.drop("direct", "d_days", "compound", "d_score", "l_o", "l_c", "local", "g_c", "whole")
