"""Unit conversion by a table of factors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Factors to each category's base unit; units in lower case, so
# that mJ and MJ, or mPa and MPa, are one.
FACTORS = {
    "energy": {"j": 1.0, "joule": 1.0, "joules": 1.0, "kj": 1e3, "kilojoule": 1e3, "mj": 1e6, "megajoule": 1e6, "cal": 4.184, "calorie": 4.184, "kcal": 4184.0, "kilocalorie": 4184.0, "kwh": 3.6e6, "ev": 1.602176634e-19, "electronvolt": 1.602176634e-19, "kev": 1.602176634e-16, "mev": 1.602176634e-13, "gev": 1.602176634e-10, "tev": 1.602176634e-7, "btu": 1055.06, "erg": 1e-7},
    "mass": {"kg": 1.0, "kilogram": 1.0, "g": 1e-3, "gram": 1e-3, "mg": 1e-6, "milligram": 1e-6, "ug": 1e-9, "microgram": 1e-9, "lb": 0.453592, "pound": 0.453592, "oz": 0.0283495, "ounce": 0.0283495, "ton": 1000.0, "tonne": 1000.0, "metric_ton": 1000.0, "amu": 1.66053906660e-27, "dalton": 1.66053906660e-27, "u": 1.66053906660e-27},
    "length": {"m": 1.0, "meter": 1.0, "metre": 1.0, "km": 1e3, "kilometer": 1e3, "cm": 1e-2, "centimeter": 1e-2, "mm": 1e-3, "millimeter": 1e-3, "um": 1e-6, "micrometer": 1e-6, "micron": 1e-6, "nm": 1e-9, "nanometer": 1e-9, "pm": 1e-12, "picometer": 1e-12, "fm": 1e-15, "femtometer": 1e-15, "fermi": 1e-15, "angstrom": 1e-10, "å": 1e-10, "mi": 1609.344, "mile": 1609.344, "ft": 0.3048, "foot": 0.3048, "feet": 0.3048, "in": 0.0254, "inch": 0.0254, "yd": 0.9144, "yard": 0.9144, "au": 1.496e11, "ly": 9.461e15, "light_year": 9.461e15, "pc": 3.086e16, "parsec": 3.086e16},
    "time": {"s": 1.0, "sec": 1.0, "second": 1.0, "ms": 1e-3, "millisecond": 1e-3, "us": 1e-6, "microsecond": 1e-6, "ns": 1e-9, "nanosecond": 1e-9, "min": 60.0, "minute": 60.0, "h": 3600.0, "hr": 3600.0, "hour": 3600.0, "day": 86400.0, "week": 604800.0, "year": 3.156e7, "yr": 3.156e7},
    "radioactivity": {"bq": 1.0, "becquerel": 1.0, "kbq": 1e3, "mbq": 1e6, "gbq": 1e9, "ci": 3.7e10, "curie": 3.7e10, "mci": 3.7e7, "millicurie": 3.7e7, "uci": 3.7e4, "microcurie": 3.7e4},
    "dose": {"sv": 1.0, "sievert": 1.0, "msv": 1e-3, "millisievert": 1e-3, "usv": 1e-6, "microsievert": 1e-6, "rem": 0.01, "mrem": 1e-5, "millirem": 1e-5, "gy": 1.0, "gray": 1.0, "mgy": 1e-3, "rad": 0.01},
    "pressure": {"pa": 1.0, "pascal": 1.0, "kpa": 1e3, "mpa": 1e6, "bar": 1e5, "mbar": 100.0, "atm": 101325.0, "atmosphere": 101325.0, "psi": 6894.76, "torr": 133.322, "mmhg": 133.322},
}
TEMPERATURES = {"c": "c", "celsius": "c", "°c": "c", "f": "f", "fahrenheit": "f", "°f": "f", "k": "k", "kelvin": "k", "r": "r", "rankine": "r"}
# End of fixed values.

#: Fixed pattern of a request; what stands behind it doesn't count.
REQUEST = r"(?i)^\s*([\d.e+\-]+)\s+(\S+)\s+(?:to|in|->|=>)\s+(\S+)"


def table(spark: SparkSession) -> DataFrame:
    rows = [(c, u, f) for c, units in FACTORS.items() for u, f in units.items()]
    return spark.createDataFrame(rows, "category string, unit string, factor double")


def parse(request: Column) -> list[Column]:
    """value, source and target unit of ``<number> <unit> to <unit>``."""
    part = lambda k: F.nullif(F.regexp_extract(request, REQUEST, k), F.lit(""))
    return [part(1).try_cast("double").alias("amount"), F.lower(part(2)).alias("source"), F.lower(part(3)).alias("target")]


def temperature(value: Column, source: Column, target: Column) -> Column:
    """Null unless both units are temperatures. Goes by way of kelvin."""
    names = F.create_map(*[F.lit(x) for pair in TEMPERATURES.items() for x in pair])
    s, t = F.try_element_at(names, F.lower(source)), F.try_element_at(names, F.lower(target))
    k = F.when(s == "c", value + 273.15).when(s == "f", (value - 32) * 5 / 9 + 273.15).when(s == "k", value).when(s == "r", value * 5 / 9)
    return F.when(t == "c", k - 273.15).when(t == "f", (k - 273.15) * 9 / 5 + 32).when(t == "k", k).when(t == "r", k * 9 / 5)


def convert(df: DataFrame, amount: str = "amount", source: str = "source", target: str = "target") -> DataFrame:
    """df with ``converted`` (null if impossible) and ``problem``. Temperatures come
    first. The factor table is fixed and small, so both joins broadcast it."""
    t = table(df.sparkSession)
    a = F.broadcast(t.select(F.col("unit").alias("_s"), F.col("category").alias("_cs"), F.col("factor").alias("_fs")))
    b = F.broadcast(t.select(F.col("unit").alias("_t"), F.col("category").alias("_ct"), F.col("factor").alias("_ft")))
    j = df.join(a, F.lower(source) == F.col("_s"), "left").join(b, F.lower(target) == F.col("_t"), "left")
    degrees = temperature(F.col(amount), F.col(source), F.col(target))
    scaled = F.when(F.col("_cs") == F.col("_ct"), F.col(amount) * F.col("_fs") / F.col("_ft"))
    made = F.coalesce(degrees, scaled)
    problem = F.when(made.isNotNull(), F.lit(None).cast("string")).when(F.col("_cs").isNull() | F.col("_ct").isNull(), F.lit("unknown unit")).otherwise(F.concat(F.lit("cannot convert "), "_cs", F.lit(" to "), "_ct"))
    return j.select(*df.columns, made.alias("converted"), problem.alias("problem"))
