"""Countries and their codes, from the tables of the ICU library that Spark ships."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tesserae.functions.text import nz, strip

UNKNOWN = "XXX"


def countries(spark: SparkSession) -> DataFrame:
    """``name`` (English), ``alpha2``, ``alpha3`` and ``numeric`` (three digits) of every country: a dimension of some 250 rows."""
    icu = spark._jvm.com.ibm.icu.util
    english, rows = icu.ULocale.ENGLISH, []
    for code in icu.ULocale.getISOCountries():
        place = icu.ULocale("", code)
        number = icu.Region.getInstance(code).getNumericCode()
        rows.append((place.getDisplayCountry(english), code, place.getISO3Country(), f"{number:03d}" if number > 0 else None))
    return spark.createDataFrame(rows, "name string, alpha2 string, alpha3 string, numeric string")


def with_codes(rows: DataFrame, country: str = "country", alpha3: str = "iso3", numeric: str = "ISO3N") -> DataFrame:
    """``rows`` with the codes of a country told by name, two or three letters; unknown ones are ``XXX`` and null."""
    dim = countries(rows.sparkSession)
    keys = dim.select(F.explode(F.array(F.lower("name"), F.lower("alpha2"), F.lower("alpha3"))).alias("_key"), F.col("alpha3").alias("_a3"), F.col("numeric").alias("_n"))
    keys = F.broadcast(keys.dropDuplicates(["_key"]))
    out = rows.join(keys, folded_name(F.col(country)) == F.col("_key"), "left")
    return out.select(*[c for c in rows.columns if c not in (alpha3, numeric)], F.coalesce("_a3", F.lit(UNKNOWN)).alias(alpha3), F.col("_n").alias(numeric))


def folded_name(c: Column) -> Column:
    return F.lower(strip(nz(c)))
