"""Registration transfer files: lines of two layouts as records, and records as lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.functions.canon import lookup

# Fuel codes.
FUELS = {
    "0": "GASOLINA", "1": "DIESEL", "2": "ELECTRICO", "3": "OTRO", "4": "BUTANO", "5": "SOLAR", "6": "GLP", "7": "GNC", "8": "GNL", "9": "HIDROGENO",
    "A": "BIOMETANO", "B": "ETANOL", "C": "BIODIESEL",
}
# Vehicle types.
TYPES = {
    "01": "CAMIÓN", "02": "FURGONETA", "03": "FURGÓN", "04": "DERIVADO TURISMO", "05": "TRACTOCAMIÓN", "10": "AUTOCARAVANA", "20": "AUTOBÚS", "30": "TODO TERRENO", "31": "AUTOBÚS", "40": "TURISMO", "41": "CUADRICICLO",
    "50": "MOTOCICLETA DE 2 RUEDAS", "51": "MOTOCICLETA CON SIDECAR", "52": "TRICICLO", "60": "VEHÍCULO MIXTO ADAPTABLE", "70": "VEHÍCULO ESPECIAL", "80": "QUAD", "90": "CICLOMOTOR DE 2 RUEDAS", "91": "CICLOMOTOR CON SIDECAR",
    "92": "CICLOMOTOR DE 3 RUEDAS", "R1": "REMOLQUE PLATAFORMA", "R2": "REMOLQUE CISTERNA", "R3": "REMOLQUE CAJA ABIERTA", "R4": "REMOLQUE CAJA CERRADA", "S1": "SEMIRREMOLQUE PLATAFORMA", "S2": "SEMIRREMOLQUE CISTERNA",
    "S3": "SEMIRREMOLQUE CAJA ABIERTA", "S4": "SEMIRREMOLQUE CAJA CERRADA",
}
# Provinces in the order of their codes, from 01.
PROVINCES = (
    "ÁLAVA", "ALBACETE", "ALICANTE", "ALMERÍA", "ÁVILA", "BADAJOZ", "BALEARES", "BARCELONA", "BURGOS", "CÁCERES", "CÁDIZ", "CASTELLÓN", "CIUDAD REAL", "CÓRDOBA", "A CORUÑA", "CUENCA", "GIRONA", "GRANADA", "GUADALAJARA", "GUIPÚZCOA",
    "HUELVA", "HUESCA", "JAÉN", "LEÓN", "LLEIDA", "LA RIOJA", "LUGO", "MADRID", "MÁLAGA", "MURCIA", "NAVARRA", "OURENSE", "ASTURIAS", "PALENCIA", "LAS PALMAS", "PONTEVEDRA", "SALAMANCA", "SANTA CRUZ DE TENERIFE", "CANTABRIA", "SEGOVIA",
    "SEVILLA", "SORIA", "TARRAGONA", "TERUEL", "TOLEDO", "VALENCIA", "VALLADOLID", "VIZCAYA", "ZAMORA", "ZARAGOZA", "CEUTA", "MELILLA",
)
# Patterns of the fields; from this year on the vehicle number is masked.
MONTH, MASKED_FROM = r"(20\d{2})(\d{2})", 2025
MASKED_VIN, VIN, BLOCK, PLACE = r"[A-Z0-9]{11}\*{11,}", r"([0-9][A-Z0-9]{17})(?=\s+[0-9][A-Z0-9][0-9])", r"\s+([0-9][A-Z0-9][0-9])", r"(B0\d{6}|A0\d{6}|B18\d{5}|A18\d{5}|B22\d{5})([A-Z].{3,})"
COLUMNS = (
    "fecha_mat string, marca string, modelo string, submodelo string, vin string, combustible string, codigo_ine string, localidad string, provincia string, tipo_vehiculo string, transmision string, `año_mat` int, mes_mat int, "
    "antiguedad_anios int, nombre_archivo string, es_cruzable boolean, codigo_provincia string"
)


def lines(spark: SparkSession, folder: str, names: str = "file", pattern: str = "*.txt") -> DataFrame:
    """(value, file_name) of all text files below a folder; large files are split.

    With ``names`` = "folder" a line bears the name of the folder its file lies in.
    """
    rows = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).text(folder)
    name = F.col("_metadata.file_name") if names == "file" else F.element_at(F.split("_metadata.file_path", "/"), -2)
    return rows.select("value", name.alias("file_name"))


def _found(text: Column, pattern: str, group: int = 0) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def records(rows: DataFrame, as_of: int, value: str = "value", file_name: str = "file_name") -> DataFrame:
    """Records of lines, in the columns of ``COLUMNS``; lines without a capital letter or a vehicle number drop out.

    The month in a file's name decides how its vehicle numbers are written: open ones of 18 characters before
    MASKED_FROM, eleven characters and stars afterwards; files of both kinds can be read at once, and a
    name without a month counts as old. Make, model and version stand between the first letter and the
    vehicle number, fuel and type behind it, the place anywhere. Null and blank lines have no record. The age is
    that in the year ``as_of``. All of it is expressions over the line: nothing is shuffled.
    """
    c = F.col(value)
    month = F.regexp_extract(F.coalesce(F.col(file_name), F.lit("")), MONTH, 0)
    masked = F.coalesce(F.try_to_number(F.nullif(F.substring(month, 1, 4), F.lit("")), F.lit("9999")).cast("int") >= MASKED_FROM, F.lit(False))
    first = F.regexp_instr(c, F.lit("[A-Z]"))
    rest = F.substring(c, first, F.length(c))
    # What several fields read is a column of its own, and none of it stands in a lambda, so that a line goes through each pattern once.
    inside = F.when(masked, F.regexp_instr(c, F.lit(MASKED_VIN))).otherwise(F.regexp_instr(rest, F.lit(VIN)))
    out = rows.where(first > 0).select(c.alias("line"), F.col(file_name).alias("nombre_archivo"), month.alias("month"), masked.alias("masked"), first.alias("first"), inside.alias("inside")).where("inside > 0")
    line = F.col("line")
    out = out.withColumn("at", F.when(F.col("masked"), F.col("inside")).otherwise(F.col("first") + F.col("inside") - 1))
    out = out.withColumn("vin", F.when(F.col("masked"), F.regexp_extract(line, MASKED_VIN, 0)).otherwise(F.substring(line, F.col("at"), F.lit(18))))
    out = out.withColumn("behind", F.substring(line, F.col("at") + F.length("vin"), F.length(line)))
    out = out.withColumn("block", F.trim(F.substring(line, F.col("first"), F.greatest(F.col("at") - F.col("first"), F.lit(0)))))
    near = F.substring("behind", 1, 3)
    code = F.when(F.col("masked"), F.when(near.rlike(r"^\d.\d$"), F.substring(near, 3, 1))).otherwise(F.substring(F.regexp_extract("behind", BLOCK, 1), 3, 1))
    out = out.withColumn("written", F.regexp_extract("block", r"^[A-Z][A-Z0-9&\-]*", 0))
    written = F.col("written")
    make = F.when(written == "MERCEDES", "MERCEDES-BENZ").when((written == "LAND") & F.contains("block", F.lit("ROVER")), "LAND ROVER").otherwise(F.nullif(written, F.lit("")))
    # What follows the make as it is written, Mercedes with or without Benz.
    after = F.regexp_replace("block", r"^(?:MERCEDES[ \-]+BENZ\b|LAND\s+ROVER\b|[A-Z][A-Z0-9&\-]*)", "")
    words = F.filter(F.split(after, r"\s+"), lambda w: (w != "") & (~F.coalesce(F.upper(w) == F.col("marca"), F.lit(False))))
    out = out.withColumn("marca", make).withColumn("words", words).withColumn("combustible", lookup(code, FUELS))
    head, second = F.get("words", F.lit(0)), F.get("words", F.lit(1))
    model = F.coalesce(F.when((F.length(head) == 1) & second.rlike(r"^\d"), F.concat(head, second)).otherwise(head), F.lit(""))
    out = out.withColumn("date", F.try_to_date(F.when(line.rlike(r"^\d{8}"), F.substring(line, 1, 8)), "ddMMyyyy"))
    date = F.col("date")
    kind = F.regexp_replace("behind", "[^A-Z0-9]", "")
    out = out.withColumn("codigo_ine", F.nullif(F.right(F.regexp_extract(line, PLACE, 1), F.lit(5)), F.lit("")))
    names = {f"{i:02d}": p for i, p in enumerate(PROVINCES, 1)}
    age = (F.lit(as_of) - F.year(date)).cast("int")
    return out.select(
        F.date_format(date, "dd/MM/yyyy").alias("fecha_mat"), "marca", model.alias("modelo"), F.array_join("words", " ").alias("submodelo"), "vin", "combustible", "codigo_ine", F.get(F.split(F.nullif(F.regexp_extract(line, PLACE, 2), F.lit("")), r"\s+"), F.lit(0)).alias("localidad"),
        lookup(F.substring("codigo_ine", 1, 2), names).alias("provincia"), lookup(F.substring(kind, 1, 2), TYPES, F.lit("DESCONOCIDO")).alias("tipo_vehiculo"),
        F.when(F.col("month") != "", F.concat(F.substring("month", 1, 4), F.lit("-"), F.substring("month", 5, 2))).alias("transmision"), F.year(date).alias("año_mat"), F.month(date).alias("mes_mat"), age.alias("antiguedad_anios"), "nombre_archivo",
        F.col("codigo_ine").isNotNull().alias("es_cruzable"), F.substring("codigo_ine", 1, 2).alias("codigo_provincia"),
    )


def as_lines(rows: DataFrame, masked: bool | Column, *kept: Column) -> DataFrame:
    """(value, and the columns ``kept``) of records (fecha_mat, marca, submodelo, vin, tipo_vehiculo, combustible, codigo_ine, localidad) in one of the layouts, which a column can decide row by row.

    ``records`` reads them back. An open vehicle number has 18 characters and begins with a digit; of a masked one the first eleven are written.
    """
    digit = lookup(F.col("combustible"), {v: k for k, v in FUELS.items() if k.isdigit()}, F.lit("3"))
    kind = lookup(F.col("tipo_vehiculo"), {v: k for k, v in reversed(TYPES.items()) if k.isdigit()}, F.lit("70"))
    masked = F.lit(masked) if isinstance(masked, bool) else masked
    vin = F.when(masked, F.rpad(F.substring("vin", 1, 11), 22, "*")).otherwise(F.concat(F.col("vin"), F.lit(" ")))
    place = F.when(F.col("codigo_ine").isNotNull(), F.concat(F.lit("  B00"), F.lpad("codigo_ine", 5, "0"), F.rpad(F.coalesce("localidad", F.lit("")), 24, " "))).otherwise(F.lit(""))
    return rows.select(F.concat(F.coalesce(F.date_format(F.try_to_date("fecha_mat", "dd/MM/yyyy"), "ddMMyyyy"), F.lit("00000000")), F.lit(" "), F.concat_ws(" ", "marca", "submodelo"), F.lit(" "), vin, kind, digit, place).alias("value"), *kept)


def to_parquet(spark: SparkSession, folder: str, path: str, as_of: int, names: str = "file") -> DataFrame:
    """All transfer files of a folder as one Parquet table; without a record it is empty and has its columns."""
    records(lines(spark, folder, names), as_of).write.mode("overwrite").parquet(path)
    return spark.read.schema(COLUMNS).parquet(path)
