"""Comma-separated text inputs (S2) and the quoted-CSV form the original job wrote.

A rating line is ``user_id,product_id,rating``. Bad lines are not dropped: every line
comes out with either typed values or an ``error`` code, so a caller can split clean
rows from a reject table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Error codes, checked in this order.
ERR_FIELDS = "fields"            # not exactly three comma-separated fields
ERR_NUMBER = "not_a_number"      # a field does not parse as a number
ERR_RANGE = "out_of_range"       # rating outside [0, 5]
ERR_PRODUCT = "unknown_product"  # product id not in products or new_products

RATING_MIN, RATING_MAX = 0.0, 5.0


def parse_rating_lines(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """(category, line) -> (category, line, user_id, product_id, rating, error)."""
    parts = F.split(F.col(line_col), ",", -1)
    n = F.size(parts)
    user = F.trim(parts.getItem(0)).try_cast("long")
    product = F.trim(parts.getItem(1)).try_cast("long")
    rating = F.trim(parts.getItem(2)).try_cast("double")
    three = n == 3
    out = lines.select(
        "category",
        F.col(line_col).alias("line"),
        F.when(three, user).alias("user_id"),
        F.when(three, product).alias("product_id"),
        F.when(three, rating).alias("rating"),
    )
    error = (
        F.when(~three, F.lit(ERR_FIELDS))
        .when(F.col("user_id").isNull() | F.col("product_id").isNull() | F.col("rating").isNull(),
              F.lit(ERR_NUMBER))
        .when((F.col("rating") < RATING_MIN) | (F.col("rating") > RATING_MAX), F.lit(ERR_RANGE))
    )
    return out.withColumn("error", error)


def check_products(parsed: DataFrame, all_products: DataFrame) -> DataFrame:
    """Mark parsed lines whose product is unknown in their category."""
    known = all_products.select("category", "product_id").distinct().withColumn("_known", F.lit(True))
    return (
        parsed.join(known, on=["category", "product_id"], how="left")
        .withColumn(
            "error",
            F.when(F.col("error").isNull() & F.col("_known").isNull(), F.lit(ERR_PRODUCT))
            .otherwise(F.col("error")),
        )
        .drop("_known")
    )


def read_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    """Headerless, quoted CSV as the original job's writer produced (a name may hold a
    comma inside quotes)."""
    return spark.read.schema(schema).option("header", "false").option("quote", '"').csv(path)
