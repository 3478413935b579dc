"""Readers by extension with fall-backs, header and period probes, fixed-width records, archives."""

from __future__ import annotations

import io
import json
import os
import zipfile

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lotwise.functions.numbers import period_in_name
from lotwise.functions.web import sorted_url
from lotwise.operators.lookup import first_of

CSV = (".csv", ".txt", ".csv.gz", ".txt.gz", ".csv.bz2")


def kind(path: str) -> str:
    low = path.lower().rstrip("/")
    if low.endswith(CSV):
        return "csv"
    for name in ("parquet", "json", "orc", "xlsx"):
        if low.endswith("." + name):
            return name
    return ""


def read_any(spark: SparkSession, path: str | list[str], unknown: str = "parquet", **options) -> DataFrame:
    """By extension; unknown ones as ``unknown``, or an error if that is ``error``. Workbooks need a driver-side library."""
    what = kind(path if isinstance(path, str) else path[0]) or unknown
    if what == "csv":
        return read_csv(spark, path, **options)
    if what == "xlsx":
        return read_workbook(spark, path)
    if what == "error":
        raise ValueError(f"unknown kind of file: {path}")
    return spark.read.format(what).options(**options).load(path)


# What the bytes 0x80 to 0x9F are in windows-1252, where it has a letter for them.
_C1 = "\x80\x82\x83\x84\x85\x86\x87\x88\x89\x8a\x8b\x8c\x8e\x91\x92\x93\x94\x95\x96\x97\x98\x99\x9a\x9b\x9c\x9e\x9f"
_CP1252 = "€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ"
SEPARATORS = (",", ";", "|", "\t")


def probed(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, sep, encoding, header) of each text file below a path, gzipped ones too, on any file system.

    Lines are read as single bytes, in as many tasks as the files have splits, and added up by file. A file is UTF-8
    if all of its lines are, so one broken line far behind its head counts; else it is windows-1252 if it
    has bytes that only that has letters for, else ISO-8859-1. The separator is what its first line holds most of.
    """
    rows = spark.read.option("recursiveFileLookup", "true").option("encoding", "ISO-8859-1").option("sep", "\x01").option("quote", "").option("maxCharsPerColumn", -1).schema("line string").csv(path)
    rows = rows.select("line", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block")).withColumn("at", F.monotonically_increasing_id())
    valid = F.is_valid_utf8(F.encode("line", "ISO-8859-1").cast("string"))
    found = rows.where("line is not null").groupBy("path").agg(F.min(valid).alias("utf8"), F.max(F.col("line").rlike(f"[{_C1}]")).alias("c1"), F.min_by("line", F.struct("block", "at")).alias("header"))
    counts = F.array(*(F.struct(F.size(F.split("header", f"\\Q{x}\\E")).alias("n"), F.lit(-i).alias("i"), F.lit(x).alias("sep")) for i, x in enumerate(SEPARATORS)))
    encoding = F.when(F.col("utf8"), "UTF-8").when(F.col("c1"), "windows-1252").otherwise("ISO-8859-1")
    return found.select("path", F.array_max(counts)["sep"].alias("sep"), encoding.alias("encoding"), "header")


def read_csv(spark: SparkSession, path: str | list[str], schema: str | None = None, sep: str | None = None, encoding: str | None = None) -> DataFrame:
    """Text tables with a header; where separator or encoding aren't given they are probed for each file, on any file system.

    Files that agree are one scan, scans of files that don't are united by column names. Without a schema all columns are
    text: no guess of types. The driver gets a row for each file.
    """
    if sep is not None and encoding is not None:
        groups = {(sep, encoding): [path] if isinstance(path, str) else list(path)}
    else:
        groups = {}
        for r in probed(spark, path).collect():
            groups.setdefault((sep or r["sep"], encoding or r["encoding"]), []).append(r["path"])
    out = None
    for (by, letters), paths in sorted(groups.items()):
        masked = letters.lower() in ("windows-1252", "cp1252")
        reader = spark.read.option("header", True).option("mode", "PERMISSIVE").option("sep", by).option("encoding", "ISO-8859-1" if masked else letters)
        part = (reader.schema(schema) if schema else reader).csv(sorted(paths))
        if masked:  # as single bytes, then the letters that are its own
            part = part.select(*((F.translate(F.col(f"`{c}`"), _C1, _CP1252) if kind == "string" else F.col(f"`{c}`")).alias(c.translate(str.maketrans(_C1, _CP1252))) for c, kind in part.dtypes))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if out is None:
        return spark.createDataFrame([], schema or "value string")
    return out


def read_workbook(spark: SparkSession, path: str) -> DataFrame:
    """A small workbook, read on the driver; fails where no library for it is installed."""
    try:
        import pandas as pd

        return spark.createDataFrame(pd.read_excel(path).astype(object).where(lambda x: x.notna(), None))
    except ImportError as e:
        raise RuntimeError("workbooks need openpyxl on the driver") from e


def files(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """(path, name, yyyymm, size) of the files below a folder, each once."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(folder).select("path", F.col("length").alias("size"))
    name = F.regexp_extract("path", "([^/]+)$", 1)
    return found.distinct().withColumn("name", name).withColumn("yyyymm", period_in_name(name))


def last_months(listing: DataFrame, n: int) -> DataFrame:
    """Of files with a month in their name the last of each month, of the last n months."""
    w = Window.partitionBy("yyyymm").orderBy(F.desc("name"))
    one = listing.where("yyyymm is not null").withColumn("i", F.row_number().over(w)).where("i = 1").drop("i")
    return one.orderBy(F.desc("yyyymm")).limit(n)


def backlog(available: DataFrame, loaded: DataFrame, oldest: int, most: int) -> DataFrame:
    """Months that are available and not loaded, from ``oldest`` on, the newest ``most`` of them."""
    return available.join(loaded.select("yyyymm").distinct(), "yyyymm", "left_anti").where(F.col("yyyymm") >= oldest).orderBy(F.desc("yyyymm")).limit(most)


def with_period(df: DataFrame, column: str = "yyyymm") -> DataFrame:
    """``df`` (of a file source) with the month in its files' names."""
    return df.withColumn(column, period_in_name(F.col("_metadata.file_name")))


def raw_only(paths: list[str]) -> list[str]:
    """Refuses files that are aggregates already."""
    bad = [p for p in paths if "agg_" in os.path.basename(p).lower() or "agregado" in os.path.basename(p).lower()]
    if bad:
        raise ValueError(f"aggregated inputs where raw ones are wanted: {bad}")
    return paths


def preflight(df: DataFrame, needed: list[str]) -> dict:
    """Columns that are there and missing, and one row; no pass over the data."""
    first = df.limit(1).collect()
    return {"columns": df.columns, "missing": [c for c in needed if c not in df.columns], "sample": first[0].asDict() if first else None}


def zip_members(path: str, suffix: str = "") -> list[str]:
    """Texts of an archive's members."""
    with zipfile.ZipFile(path) as z:
        return [z.read(n).decode("utf-8", "replace") for n in z.namelist() if n.endswith(suffix) and not n.endswith("/")]


def zipped_lines(spark: SparkSession, folder: str, suffix: str = ".txt") -> DataFrame:
    """(path, member, line) of all archives below a folder, each opened on an executor."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist()):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    for name in z.namelist():
                        if not name.endswith(suffix):
                            continue
                        lines = []
                        for line in io.TextIOWrapper(z.open(name), encoding="utf-8", errors="replace"):
                            lines.append(line.rstrip("\r\n"))
                            if len(lines) == 50_000:
                                yield pa.RecordBatch.from_pydict({"path": [path] * len(lines), "member": [name] * len(lines), "line": lines})
                                lines = []
                        if lines:
                            yield pa.RecordBatch.from_pydict({"path": [path] * len(lines), "member": [name] * len(lines), "line": lines})

    archives = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.zip").load(folder)
    return archives.select("path", "content").mapInArrow(run, "path string, member string, line string")


def preamble(spark: SparkSession, path: str, header: list[str], sep: str = ",") -> DataFrame:
    """A text table whose header comes after other lines: the first line that holds all the words of ``header``."""
    lines = spark.read.text(path).withColumn("n", F.monotonically_increasing_id())
    test = F.lit(True)
    for word in header:
        test = test & F.contains(F.lower("value"), F.lit(word.lower()))
    first = lines.where(test).orderBy("n").limit(1).collect()
    if not first:
        raise ValueError(f"no header in {path}")
    names = [x.strip().strip('"') for x in first[0]["value"].split(sep)]
    body = lines.where((F.col("n") > first[0]["n"]) & (F.trim("value") != ""))
    cells = F.split("value", f"\\Q{sep}\\E(?=(?:[^\"]*\"[^\"]*\")*[^\"]*$)", -1)
    return body.select(*(F.nullif(F.trim(F.regexp_replace(F.get(cells, F.lit(i)), '^"|"$', "")), F.lit("")).alias(c) for i, c in enumerate(names)))


def merged_exports(exports: list[DataFrame], fallback: DataFrame | None, link: str = "link", lot: str = "lot_number") -> DataFrame:
    """Exports and fall-back links in one table, each lot once by its sorted address, exports first."""
    frames = [*exports, *([fallback] if fallback is not None else [])]
    keyed = [f.where(F.trim(F.coalesce(F.col(link), F.lit(""))) != "").withColumn("link_key", sorted_url(F.col(link))) for f in frames]
    return first_of(keyed, "link_key", [link])


def expanded(tree: DataFrame, levels: list[str]) -> DataFrame:
    """A nested tree (array of structs in arrays of structs ...) as rows: one column for each level's name."""
    out = tree.select(F.explode(levels[0]).alias("__0"))
    for i, name in enumerate(levels[1:], 1):
        out = out.select(*(c for c in out.columns), F.explode(F.col(f"__{i - 1}.{name}")).alias(f"__{i}"))
    return out


def write_any(df: DataFrame, path: str, partition: list[str] = (), mode: str = "overwrite") -> str:
    """By extension; Parquet where there is none. A workbook's rows come as CSV beside it."""
    what = kind(path) or "parquet"
    writer = df.write.mode(mode)
    if partition:
        writer = writer.partitionBy(*partition)
    if what == "csv":
        writer.option("header", True).csv(path)
    elif what == "xlsx":
        path = path[:-5] + ".csv"
        writer.option("header", True).csv(path)
    else:
        writer.format(what).save(path)
    return path


def write_sheets(sheets: dict[str, DataFrame], folder: str) -> None:
    for name, df in sheets.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}")


def write_with_notes(df: DataFrame, path: str, notes: dict) -> None:
    """One CSV file for a small result, and its notes as JSON beside it."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
    df.sparkSession.createDataFrame([(json.dumps(notes, ensure_ascii=False, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(path.rstrip("/") + ".meta.json")


def reused(spark: SparkSession, path: str, make, again: bool = False) -> DataFrame:
    """The Parquet table at the path, made first if it isn't there."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)
    if again or not there:
        make().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


#: What the columns of the enriched table hold. Shares and growth are fractions of one, mixes are percent.
#: What each feature of a region says, and how it comes about.
DICTIONARY = {
    "units_abs": ("units of the cohort (make, model, year, fuel) in the year", "sum of the units of its months"),
    "share_marca_%": ("share of the make's units in the year, 0 to 1", "units_abs / units of the make"),
    "share_combustible_%": ("share of the fuel's units in the year, 0 to 1", "units_abs / units of the fuel"),
    "share_año_%": ("share of all units in the year, 0 to 1", "units_abs / units of the year"),
    "share_cohorte_%": ("share of the units of the same year and fuel, 0 to 1; the same as that of the fuel", "units_abs / units of the year and fuel"),
    "rank_general": ("rank of the model among all models of the year", "dense rank of the units over all fuels, descending"),
    "rank_brand_year": ("rank of the model within its make and year", "dense rank of the units over all fuels, descending, by make"),
    "rank_year_model": ("rank of the model in the year; the same as the general one", "rank_general"),
    "rank_year_fuel_model": ("rank of the model within the year and fuel", "dense rank of units_abs, descending, by fuel"),
    "is_top3_brand_year": ("whether the model is among the first three of its make and year", "rank_brand_year <= 3"),
    "best_fuel_units": ("units of the model's leading fuel in the year", "greatest units_abs over the fuels"),
    "best_fuel": ("fuel of most units of the model and year", "fuel of the greatest units_abs, ties by its name"),
    "is_best_fuel": ("whether the row is of the leading fuel; null without a fuel", "fuel = best_fuel"),
    "row_vs_best_fuel_%": ("units against those of the leading fuel, 0 to 1", "units_abs / best_fuel_units"),
    "YoY_%": ("growth against the year before, fraction; null without units then", "units_abs / units of the year before - 1"),
    "YoY_weighted": ("growth damped where the year before had under 20 units", "YoY * min(1, units before / 20)"),
    "Growth_3a_%": ("growth against three years before, fraction", "units_abs / units three years before - 1"),
    "trend_flag": ("1 rising, 0 falling, null steady", "YoY over 10 %, under -10 %"),
    "year_rank_in_model": ("rank of the year within the model and fuel", "dense rank of units_abs, descending"),
    "antiguedad_media": ("mean age of the transfers, years", "mean of the monthly means"),
    "p50_antiguedad": ("median age of the transfers, years", "mean of the monthly medians"),
    "p75_antiguedad": ("upper quartile of the age of the transfers, years", "mean of the monthly upper quartiles"),
    "mix_0_3_%": ("share of cars of up to 3 years, percent", "monthly shares weighted by units"),
    "mix_4_7_%": ("share of cars of over 3 to 7 years, percent", "monthly shares weighted by units"),
    "mix_8mas_%": ("share of cars of over 7 years, percent", "monthly shares weighted by units"),
    "dominancia_modelo_marca_%": ("share of the model, all fuels, in its make and year, 0 to 1", "units of the model / units of the make"),
    "HHI_marca": ("concentration of the make's models in the year, 0 to 1", "sum of the squared shares of its models"),
    "stddev_mensual_units": ("deviation of the monthly units, of the months that are there", "sample standard deviation of the months' sums"),
    "coef_var_%": ("deviation of the monthly units against their mean", "stddev_mensual_units / mean of the months' sums"),
}
#: What stands between regions.
RATIOS = {"ratio_bcn_cat_%": ("units of the province against those of its area", "units_abs_bcn / units_abs_cat"), "ratio_cat_esp_%": ("units of the area against those of the nation", "units_abs_cat / units_abs_esp")}


def dictionary(spark: SparkSession, regions: tuple[str, ...] = ("bcn", "cat", "esp")) -> DataFrame:
    """(column, description, formula, region) of every feature; ratios of regions have none."""
    rows = [(f"{name}_{r}", *texts, r) for name, texts in DICTIONARY.items() for r in regions] + [(name, *texts, None) for name, texts in RATIOS.items()]
    return spark.createDataFrame(rows, "column string, description string, formula string, region string")
