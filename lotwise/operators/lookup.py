"""Joins and set operations that several stages share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def mapped(df: DataFrame, table: DataFrame, key: str, table_key: str, value: str, out: str, default: Column | None = None) -> DataFrame:
    """``df`` with ``out``: the value of a small dimension, by equal keys, else the default (the key itself if none is given).

    The dimension has one value for each key, the least one; whether it is broadcast, Spark decides by its size.
    """
    dim = table.where(F.col(table_key).isNotNull()).groupBy(F.col(table_key).alias("__k")).agg(F.min(value).alias("__v"))
    joined = df.join(dim, F.col(key) == F.col("__k"), "left")
    return joined.withColumn(out, F.coalesce("__v", F.col(key) if default is None else default)).drop("__k", "__v")


def segments(df: DataFrame, dimension: DataFrame, make: str = "make_clean", model: str = "modelo_base") -> DataFrame:
    """``df`` with ``segmento`` by upper-cased, trimmed make and model."""
    dim = dimension.select(F.upper(F.trim("make_clean")).alias("__mk"), F.upper(F.trim("modelo_base")).alias("__md"), F.col("segmento").alias("__s")).groupBy("__mk", "__md").agg(F.min("__s").alias("segmento"))
    on = (F.upper(F.trim(F.col(make))) == F.col("__mk")) & (F.upper(F.trim(F.col(model))) == F.col("__md"))
    return df.drop("segmento").join(dim, on, "left").drop("__mk", "__md")


def filled_from(left: DataFrame, right: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Left join by key in which the left value wins where it is not null."""
    other = right.select(F.col(key).alias("__key"), *(F.col(c).alias(f"__{c}") for c in columns)).dropDuplicates(["__key"])
    joined = left.join(other, F.col(key) == F.col("__key"), "left")
    for c in columns:
        joined = joined.withColumn(c, F.coalesce(F.col(c), F.col(f"__{c}")) if c in left.columns else F.col(f"__{c}"))
    return joined.drop("__key", *(f"__{c}" for c in columns))


def written_back(left: DataFrame, right: DataFrame, key: str, columns: list[str], where: Column) -> DataFrame:
    """Left join by key that replaces the columns in the rows of the condition where the right has a value."""
    other = right.select(F.col(key).alias("__key"), *(F.col(c).alias(f"__{c}") for c in columns)).dropDuplicates(["__key"])
    joined = left.withColumn("__where", where).join(other, F.col(key) == F.col("__key"), "left")
    for c in columns:
        old = F.col(c) if c in left.columns else F.lit(None)
        joined = joined.withColumn(c, F.when(F.col("__where") & F.col(f"__{c}").isNotNull(), F.col(f"__{c}")).otherwise(old))
    return joined.drop("__key", "__where", *(f"__{c}" for c in columns))


def reattached(rows: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """The original columns and those of ``found`` that are new."""
    return rows.join(found.select(key, *(c for c in found.columns if c not in rows.columns)), key, "left")


def in_groups(df: DataFrame, keys: list[str], least: int) -> DataFrame:
    """Rows whose group has at least so many rows; one shuffle by the keys."""
    return df.withColumn("group_size", F.count(F.lit(1)).over(Window.partitionBy(*keys))).where(F.col("group_size") >= least)


def _dealt(df: DataFrame, missing: Column) -> Column:
    """Null for rows with a key; for those without one a number of their content, so that they don't meet in one task."""
    plain = [c for c, kind in df.dtypes if "map<" not in kind and "variant" not in kind]
    return F.when(missing, F.xxhash64(*plain))


def repeats(df: DataFrame, key: str, out: str = "n_apariciones") -> DataFrame:
    """``df`` with how often the key occurs; rows without a key count as single."""
    missing = F.col(key).isNull()
    counted = F.count(F.lit(1)).over(Window.partitionBy(key, _dealt(df, missing)))
    return df.withColumn(out, F.when(missing, F.lit(1)).otherwise(counted).cast("long"))


def latest(df: DataFrame, key: str, order: list[Column], blank: bool = True) -> DataFrame:
    """The last row of each key by the order; rows whose key is null or blank all stay.

    Without ``blank`` null and blank keys are keys like others.
    """
    missing = F.col(key).isNull() | (F.trim(F.col(key).cast("string")) == "")
    parts = [key, _dealt(df, missing)] if blank else [key]
    ranked = df.withColumn("__i", F.row_number().over(Window.partitionBy(*parts).orderBy(*order)))
    keep = (F.col("__i") == 1) | missing if blank else F.col("__i") == 1
    return ranked.where(keep).drop("__i")


def first_of(frames: list[DataFrame], key: str, order: list[str]) -> DataFrame:
    """Union of the frames, with missing columns as null; of each key the row of the first frame that has it."""
    parts = [f.withColumn("__from", F.lit(i)) for i, f in enumerate(frames)]
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p, allowMissingColumns=True)
    ranked = union.withColumn("__i", F.row_number().over(Window.partitionBy(key).orderBy("__from", *order)))
    return ranked.where("__i = 1").drop("__i", "__from")


def missing_from(expected: DataFrame, present: DataFrame, keys: list[str]) -> DataFrame:
    return expected.join(present.select(*keys).distinct(), keys, "left_anti")


def year_gaps(df: DataFrame, keys: list[str], year: str) -> DataFrame:
    """For each key the years from the first to the last, those present and those missing."""
    years = df.where(F.col(year).isNotNull()).groupBy(*keys).agg(F.array_sort(F.collect_set(F.col(year).cast("int"))).alias("present"), F.min(year).cast("int").alias("first_year"), F.max(year).cast("int").alias("last_year"))
    expected = F.sequence("first_year", "last_year")
    return years.withColumn("expected", expected).withColumn("missing", F.array_except("expected", "present")).withColumn("n_missing", F.size("missing").cast("long"))


def with_gap_rows(df: DataFrame, keys: list[str], year: str) -> DataFrame:
    """A row for each key and year that is missing between its first and its last."""
    return year_gaps(df, keys, year).select(*keys, F.explode("missing").alias(year))


def long_prices(df: DataFrame, keep: list[str], columns: dict[str, str]) -> DataFrame:
    """Price columns as rows (category, price); null prices drop out."""
    renamed = df.select(*keep, *(F.col(c).cast("double").alias(name) for name, c in columns.items()))
    return renamed.unpivot(keep, list(columns), "category", "price").where("price is not null")
