"""Silver typing rules applied to canonical sources.

Rules (same for CSV-landed and driver-bound sources):
* every string column is stripped of surrounding whitespace of any kind;
* products get ``is_category_missing`` and a missing category becomes ``unknown``
  (strip runs first, so a whitespace-only category is '' and is not missing).
Row counts are preserved exactly; nothing is filtered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from martlake.functions import strip
from martlake.sources.bindings import RetailSources

# Fixed value: the label given to products without a category.
UNKNOWN_CATEGORY = "unknown"


def strip_strings(df: DataFrame) -> DataFrame:
    """Strip every string column, keep the others untouched (one projection)."""
    return df.select([
        strip(F.col(f.name)).alias(f.name) if isinstance(f.dataType, StringType) else F.col(f.name)
        for f in df.schema.fields
    ])


def fill_category(products: DataFrame) -> DataFrame:
    """Flag then fill the missing product category."""
    missing = F.col("product_category_name").isNull()
    return (products
            .withColumn("is_category_missing", missing)
            .withColumn("product_category_name",
                        F.coalesce(F.col("product_category_name"), F.lit(UNKNOWN_CATEGORY))))


def to_silver(src: RetailSources) -> RetailSources:
    def clean(name: str, df: DataFrame) -> DataFrame:
        stripped = strip_strings(df)
        return fill_category(stripped) if name == "products" else stripped

    return src.map(clean)
