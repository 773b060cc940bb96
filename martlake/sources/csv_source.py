"""The nine-CSV source package: presence check, reading, typing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from martlake.sources import contracts as K
from martlake.sources.bindings import RetailSources

# Text tokens read as missing (the common CSV missing-value
# spellings, e.g. NA, null, NaN, None, N/A), so 'NA' never reaches silver as text.
MISSING_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
                  "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")

# Declared types per column (everything else is a string).
INT_COLUMNS = {"customer_zip_code_prefix", "geolocation_zip_code_prefix", "order_item_id",
               "payment_sequential", "payment_installments", "seller_zip_code_prefix"}
# a review score keeps its fraction, so that the range check sees 5.9 as it is
DOUBLE_COLUMNS = {"review_score", "geolocation_lat", "geolocation_lng", "price", "freight_value", "payment_value",
                  "product_name_lenght", "product_description_lenght", "product_photos_qty",
                  "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm"}


# The only table whose text may hold line breaks: the others stay splittable.
MULTILINE_TABLES = {"order_reviews"}


def missing_files(spark: SparkSession, source_dir: str) -> list[str]:
    """Required files absent from ``source_dir`` (file listing only, no content read)."""
    listing = (spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(source_dir)
               .select(F.regexp_extract("path", r"([^/]+)$", 1).alias("name")))
    required = spark.createDataFrame([(n,) for n in K.SOURCE_FILES], "name string")
    return sorted(r["name"] for r in required.join(listing, "name", "left_anti").collect())


def read_csv(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """Headered CSV, every column as the text it is.

    The header decides the columns; a doubled quote inside quotes is a quote
    (``escape='"'``).  Missing-value tokens are kept here and become null when
    the columns are typed.  ``multiline`` allows line breaks inside quotes, at
    the price of one task a file.
    """
    options = {"header": True, "multiLine": multiline, "escape": '"'}
    schema = StructType([StructField(c, StringType()) for c in spark.read.options(**options).csv(path).columns])
    return spark.read.schema(schema).options(**options).option("mode", "PERMISSIVE").csv(path)


def read_sources(spark: SparkSession, source_dir: str) -> dict[str, DataFrame]:
    """Every source file as a text DataFrame, keyed by short table name."""
    missing = missing_files(spark, source_dir)
    if missing:
        raise FileNotFoundError(f"missing source files: {', '.join(missing)}")
    return {K.table_name(f): read_csv(spark, f"{source_dir.rstrip('/')}/{f}", K.table_name(f) in MULTILINE_TABLES)
            for f in K.SOURCE_FILES}


def present(c: str) -> Column:
    """The column's text, null where it is a missing-value token."""
    return F.when(~F.col(c).isin(*MISSING_TOKENS), F.col(c))


def timestamp(text: Column) -> Column:
    """Text as a time-zone-free timestamp; bad text is null.  No instant is involved, so
    the session's time zone has no effect."""
    return text.try_cast("timestamp_ntz")


def typed(df: DataFrame, table: str, parse_dates: bool = True) -> DataFrame:
    """Declared types: ints, doubles, and (if ``parse_dates``) timestamps.  Missing-value
    tokens, bad text and fractions in an integer column are null."""
    dates = set(K.DATE_COLUMNS.get(table, ()))
    out = []
    for c in df.columns:
        if c in INT_COLUMNS:
            number = present(c).try_cast("double")
            out.append(F.when(number == F.floor(number), number.try_cast("int")).alias(c))
        elif c in DOUBLE_COLUMNS:
            out.append(present(c).try_cast("double").alias(c))
        elif c in dates and parse_dates:
            out.append(timestamp(present(c)).alias(c))
        else:
            out.append(present(c).alias(c))
    return df.select(out)


def typed_sources(raw: dict[str, DataFrame], parse_dates: bool = True) -> RetailSources:
    return RetailSources(**{t: typed(df, t, parse_dates) for t, df in raw.items()})
