"""Recommendations: demand, composite score, picks by cluster, and the five fixed questions."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotwise.operators.columns import require
from lotwise.operators.filters import Listing, listings
from lotwise.operators.lookup import in_groups

REGIONS = ("bcn", "cat", "esp")
CLUSTER = ("marca", "modelo", "anio", "combustible_norm")


@dataclass(frozen=True)
class Demand:
    use_brand_share: bool = True
    use_units_abs: bool = True
    use_concentration_penalty: bool = False
    weight_brand_share: float = 0.5
    weight_units_abs: float = 0.5
    weight_concentration: float = 0.0


@dataclass(frozen=True)
class Config:
    alpha_margin: float = 0.6
    rotation_boost: float = 0.0
    demand: Demand = field(default_factory=Demand)
    legacy: bool = False  # a constant column scales to its own value instead of zero


class Scaled:
    """Scaling by the least and greatest of columns over all rows: one aggregation of one row, joined by broadcast."""

    def __init__(self, df: DataFrame, columns: dict[str, Column], legacy: bool = False):
        self.names, self.legacy = list(columns), legacy
        self.df = df.withColumns({f"__{n}": c for n, c in columns.items()})
        aggs = [f(F.col(f"__{n}")).alias(f"__{k}_{n}") for n in columns for k, f in (("min", F.min), ("max", F.max))]
        self.stats = self.df.agg(*aggs).withColumn("__one", F.lit(1))
        self.df = self.df.withColumn("__one", F.lit(1)).join(F.broadcast(self.stats), "__one").drop("__one")

    def unit(self, name: str) -> Column:
        """0 to 1; null stays null unless the whole column is null; a constant column is zero."""
        x, a, b = F.col(f"__{name}"), F.col(f"__min_{name}"), F.col(f"__max_{name}")
        flat = F.coalesce(x, F.lit(0.0)) if self.legacy else F.lit(0.0)
        return F.when(a.isNull() | (a == b), flat).otherwise((x - a) / (b - a))

    def share(self, name: str) -> Column:
        """The value, a hundredth of it if the column goes beyond one."""
        return F.when(F.col(f"__max_{name}") > 1, F.col(f"__{name}") / 100).otherwise(F.col(f"__{name}"))

    def drop(self, df: DataFrame) -> DataFrame:
        return df.drop(*(c for c in df.columns if c.startswith("__")))


def _column(df: DataFrame, name: str) -> Column | None:
    return F.col(f"`{name}`").cast("double") if name in df.columns else None


def scored(df: DataFrame, region: str, cfg: Config = Config()) -> DataFrame:
    """``df`` with demand, rotation and score of the region. Columns are scaled over the rows of ``df``."""
    require(df, ["precio_final_eur", "precio_venta_ganvam", "margin_abs"], "listings")
    d = cfg.demand
    wanted = {
        "share": _column(df, f"share_marca_%_{region}") if d.use_brand_share else None,
        "units": _column(df, f"units_abs_{region}") if d.use_units_abs else None,
        "grip": _column(df, f"dominancia_modelo_marca_%_{region}") if d.use_concentration_penalty else None,
    }
    weights = {"share": d.weight_brand_share, "units": d.weight_units_abs, "grip": d.weight_concentration}
    mix, rank = _column(df, f"mix_0_3_%_{region}"), _column(df, f"rank_year_model_{region}")
    columns = {k: v for k, v in wanted.items() if v is not None} | {"margin": F.col("margin_abs").cast("double")}
    if mix is not None:
        columns["turn"] = F.coalesce(mix, F.lit(0.0))
    else:
        columns["turn"] = F.coalesce(1 / (1 + rank), F.lit(0.0)) if rank is not None else F.lit(0.0)
    # One aggregate gives all bounds: scaling to shares keeps the order, so the rotation's bounds are those of what it is made of.
    s = Scaled(df, columns, cfg.legacy)
    rotation = s.share("turn") if mix is not None else F.col("__turn")
    out = s.df.withColumn("rotation", rotation)
    parts = {k: (1 - s.unit(k) if k == "grip" else s.unit(k)) for k in wanted if k in columns}
    if parts:
        top = sum((F.coalesce(p, F.lit(0.0)) * weights[k] for k, p in parts.items()), F.lit(0.0))
        low = sum((F.when(p.isNotNull(), weights[k]).otherwise(0.0) for k, p in parts.items()), F.lit(0.0))
        demand = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(F.try_divide(top, low), F.lit(0.5))))
    else:
        demand = F.lit(1.0)
    out = out.withColumn("demand", demand).withColumn("margin_unit", s.unit("margin"))
    flat = F.col("__min_turn").isNull() | (F.col("__min_turn") == F.col("__max_turn"))
    turning = F.when(flat, F.col("rotation") if cfg.legacy else F.lit(0.0)).otherwise(s.unit("turn"))
    margin, turn = max(0.0, cfg.alpha_margin), max(0.0, 1 - cfg.alpha_margin) + max(0.0, cfg.rotation_boost)
    total = margin + turn
    a, b = (margin / total, turn / total) if total > 0 else (0.5, 0.5)
    score = a * F.col("margin_unit") * F.col("demand") + b * turning
    return s.drop(out.withColumn("score", score)).drop("margin_unit")


def cluster_keys(df: DataFrame, with_country: bool = False, with_sale: bool = False) -> list[str]:
    return [c for c in (*CLUSTER, *(["sale_country"] if with_country else []), *(["sale_name"] if with_sale else [])) if c in df.columns]


def best(df: DataFrame, region: str, cfg: Config = Config(), f: Listing = Listing(), selection: str = "cheapest", n: int = 20, with_country: bool = False, with_sale: bool = False, least: int = 1, ignore_rotation: bool = False, prefer_fast: bool = False, tie: str = "lot_id") -> DataFrame:
    """One row for each cluster: the cheapest listing, that of the greatest margin, or the cluster's means.

    The score is scaled over all of ``df``, the filters come after. Whole rows are
    picked: attributes of different listings never mix.
    """
    if ignore_rotation:
        cfg = Config(1.0, 0.0, cfg.demand, cfg.legacy)
    elif prefer_fast:
        cfg = Config(cfg.alpha_margin, 0.3, cfg.demand, cfg.legacy)
    rows = listings(scored(df, region, cfg), f)
    keys = cluster_keys(rows, with_country, with_sale)
    if least > 1:
        rows = in_groups(rows, keys, least)
    down = ("margin_abs", "score") if ignore_rotation else ("score", "margin_abs")
    if selection == "mean":
        means = rows.groupBy(*keys).agg(F.avg("precio_final_eur").alias("precio_final_eur"), F.avg("margin_abs").alias("margin_abs"), F.count(F.lit(1)).alias("n_listings"), F.avg("score").alias("score"))
        return means.orderBy(*(F.desc_nulls_last(c) for c in down), *keys).limit(n)
    if selection == "max_margin":
        rows, order = rows.where("margin_abs is not null"), [F.desc("margin_abs"), F.desc_nulls_last("score"), F.asc(tie)]
        down = ("margin_abs", "score")
    else:
        rows, order = rows.where("precio_final_eur is not null"), [F.asc("precio_final_eur"), F.desc_nulls_last("score"), F.asc(tie)]
    picked = rows.withColumn("__i", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("__i = 1").drop("__i")
    return picked.orderBy(*(F.desc_nulls_last(c) for c in down), tie).limit(n)


def best_auction(df: DataFrame, f: Listing, n: int = 20, tie: str = "lot_id", legacy: bool = False) -> tuple[DataFrame, DataFrame]:
    """Listings of a model, the best of each year first, then the best of the rest; and the sales they come from.

    A sale's score is 0.6 of its scaled share of the listings and 0.4 of its scaled mean
    price advantage over the median of the cluster, taken over all of ``df``.
    """
    keys = [c for c in CLUSTER if c in df.columns]
    rows = df.withColumn("cluster_median", F.median("precio_final_eur").over(Window.partitionBy(*keys)))
    s = Scaled(listings(rows, f), {"margin": F.col("margin_abs").cast("double")}, legacy)
    rows = s.drop(s.df.withColumn("score_q1", F.coalesce(s.unit("margin"), F.lit(0.0))))
    order = [F.desc("score_q1"), F.asc(tie)]
    year = F.when(F.col("anio").isNotNull(), F.row_number().over(Window.partitionBy("anio").orderBy(*order)))
    lead = F.coalesce(year == 1, F.lit(False))
    rows = rows.withColumn("lead", lead)
    chosen = rows.orderBy(F.desc("lead"), F.when(F.col("lead"), F.col("anio")).asc_nulls_last(), *order).limit(n).drop("lead")
    advantage = 100 * F.try_divide(F.col("cluster_median") - F.col("precio_final_eur"), F.col("cluster_median"))
    sales = chosen.groupBy("sale_name").agg(F.count(F.lit(1)).alias("n"), F.avg(advantage).alias("price_adv_pct"))
    sales = sales.withColumn("representation_pct", 100.0 * F.col("n") / F.sum("n").over(Window.partitionBy()))
    u = Scaled(sales, {"rep": F.col("representation_pct"), "adv": F.col("price_adv_pct")}, legacy)
    score = 0.6 * F.coalesce(u.unit("rep"), F.lit(0.0)) + 0.4 * F.coalesce(u.unit("adv"), F.lit(0.0))
    ranked = u.drop(u.df.withColumn("auction_score", score)).select("sale_name", "auction_score", "representation_pct", "price_adv_pct")
    return chosen.orderBy(*order), ranked.orderBy(F.desc("auction_score"), "sale_name")


def within_brand(df: DataFrame, f: Listing, mode: str = "cheapest", model: str = "modelo", tie: str = "lot_id") -> DataFrame:
    """One listing of each model of a make: the cheapest, or that of the greatest margin."""
    column, order = ("margin_abs", F.desc("margin_abs")) if mode == "max_margin" else ("precio_final_eur", F.asc("precio_final_eur"))
    rows = listings(df, f).where(F.col(column).isNotNull())
    picked = rows.withColumn("__i", F.row_number().over(Window.partitionBy(model).orderBy(order, tie))).where("__i = 1").drop("__i")
    return picked.orderBy(order, tie)


def within_segment(df: DataFrame, region: str, f: Listing, cfg: Config = Config(), mode: str = "cheapest", n: int = 20, tie: str = "lot_id") -> DataFrame:
    """Listings of a segment in order, of which a cluster has at most a tenth of ``n`` (and one at least)."""
    rows = listings(scored(df, region, cfg).withColumn("score", F.coalesce("score", F.lit(0.0))), f)
    if mode == "max_margin":
        order = [F.desc_nulls_last("margin_abs"), F.desc("score"), F.asc_nulls_last("precio_final_eur"), F.asc(tie)]
    else:
        order = [F.asc_nulls_last("precio_final_eur"), F.desc_nulls_last("margin_abs"), F.desc("score"), F.asc(tie)]
    cap = max(1, n // 10)
    kept = rows.withColumn("__i", F.row_number().over(Window.partitionBy(*cluster_keys(rows)).orderBy(*order))).where(F.col("__i") <= cap).drop("__i")
    return kept.orderBy(*order).limit(n)


def attractiveness(df: DataFrame, region: str, f: Listing, cfg: Config = Config()) -> DataFrame:
    """One row: mean score of the listings of a model with its bucket, and what it comes from."""
    rows = listings(scored(df, region, cfg), f)
    out = rows.agg(
        F.count(F.lit(1)).alias("n_lotes"),
        F.avg(F.coalesce("score", F.lit(0.0))).alias("score_mean"),
        F.avg("demand").alias("demand_factor_mean"),
        F.avg("rotation").alias("rotation_proxy_mean"),
        F.array_join(F.sort_array(F.collect_set(F.upper("combustible_norm"))), ",").alias("fuel"),
    )
    bucket = F.when(F.col("score_mean").isNull(), "SIN_DATOS").when(F.col("score_mean") < 0.4, "BAJO").when(F.col("score_mean") < 0.7, "MEDIO").otherwise("ALTO")
    return out.withColumn("attractiveness_pct", F.round(100 * F.col("score_mean"), 1)).withColumn("attractiveness_bucket", bucket).withColumn("region", F.lit(region))


def best_fuel_gap(df: DataFrame, f: Listing, regions: tuple[str, ...] = REGIONS) -> DataFrame:
    """For each region the most frequent best fuel of a model's listings and how far they are behind it on average."""
    rows = listings(df, f)
    parts = []
    for r in regions:
        best_col, gap_col = f"best_fuel_{r}", f"row_vs_best_fuel_%_{r}"
        if best_col not in df.columns and gap_col not in df.columns:
            continue
        gap = F.col(f"`{gap_col}`").cast("double") if gap_col in df.columns else F.lit(None).cast("double")
        own = F.upper(F.col(best_col)) if best_col in df.columns else F.lit(None).cast("string")
        mean = F.avg(gap) / F.when(F.max(gap) > 1, 100.0).otherwise(1.0)
        parts.append(rows.agg(F.coalesce(F.mode(own, True), F.mode(F.upper("combustible_norm"), True)).alias("best_fuel"), (1 - mean).alias("gap_vs_rest_mean")).withColumn("region", F.lit(r)))
    if not parts:
        raise ValueError("no columns of best fuels")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("region", "best_fuel", "gap_vs_rest_mean")


def price_means(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Mean final price of each cluster by country, and by country and sale."""
    mean = lambda keys: df.groupBy(*keys).agg(F.avg("precio_final_eur").alias("precio_medio"))
    return mean(cluster_keys(df, True)), mean(cluster_keys(df, True, True))
