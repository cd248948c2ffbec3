"""User and product registry, set-wise over request tables.

The original answers one mail id or product name per Spark job; here a request table of
any size is answered by one join. The big table is first cut to the requested keys by a
semi-join (no shuffle of it while the requests are small enough for Spark to broadcast them),
and only what is left is aggregated or joined. Existence tests are left joins against a
distinct key set (never a count per request). New ids are ``max id of the category + 1, 2, ...`` in
name order over the distinct unseen requests, assigned by ``dense_positions`` so that a
category with a huge batch of new names is not numbered by a single task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pickwise.functions.broadcast import checked
from pickwise.functions.sequence import dense_positions
from pickwise.operators.ratings import all_products

USER_KEY = ["category", "mail_id"]
NAME_KEY = ["category", "product_name"]


def requested(rows: DataFrame, requests: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key is requested."""
    return rows.join(requests.select(*on), on=on, how="left_semi")


def _flag(requests: DataFrame, keys: DataFrame, on: list[str], name: str) -> DataFrame:
    k = requested(keys.select(*on), requests, on).distinct().withColumn(name, F.lit(True))
    return requests.join(k, on=on, how="left").withColumn(
        name, F.coalesce(F.col(name), F.lit(False))
    )


def _next_ids(unseen: DataFrame, existing_ids: DataFrame, id_col: str, order: str) -> DataFrame:
    """``unseen`` distinct (category, order) rows numbered after the category's max id."""
    top = checked(existing_ids.groupBy("category").agg(F.max(id_col).alias("_max")))
    ranked = dense_positions(unseen, ["category"], [order], "_pos")
    return ranked.join(top, on="category", how="left").withColumn(
        id_col, (F.coalesce(F.col("_max"), F.lit(0)) + F.col("_pos") + 1).cast("long")
    ).drop("_max", "_pos")


# --- users ----------------------------------------------------------------------------
def user_exists(requests: DataFrame, users: DataFrame) -> DataFrame:
    """(category, mail_id, user_exists) for every request row."""
    return _flag(requests.select(*USER_KEY), users, USER_KEY, "user_exists")


def lookup_user_id(requests: DataFrame, users: DataFrame) -> DataFrame:
    """R2: id of each known requested mail id (lowest id if repeated); unknown: no row."""
    ids = requested(users, requests, USER_KEY).groupBy(*USER_KEY).agg(F.min("user_id").alias("user_id"))
    return requests.select(*USER_KEY).join(ids, on=USER_KEY, how="inner")


def assign_user_ids(requests: DataFrame, users: DataFrame) -> DataFrame:
    """Ids for the distinct mail ids not yet registered in their category."""
    unseen = requests.select(*USER_KEY).distinct().join(
        requested(users.select(*USER_KEY), requests, USER_KEY).distinct(), on=USER_KEY, how="left_anti"
    )
    return _next_ids(unseen, users, "user_id", "mail_id").select("category", "user_id", "mail_id")


def register_users(requests: DataFrame, users: DataFrame) -> DataFrame:
    """The users table after registering every unseen requested mail id."""
    return users.select("category", "user_id", "mail_id").unionByName(
        assign_user_ids(requests, users)
    )


# --- products -------------------------------------------------------------------------
def product_exists(requests: DataFrame, products: DataFrame, new_products: DataFrame) -> DataFrame:
    """(category, product_name, product_exists) over both product tables."""
    return _flag(
        requests.select(*NAME_KEY), all_products(products, new_products), NAME_KEY,
        "product_exists",
    )


def product_ids(products: DataFrame, new_products: DataFrame) -> DataFrame:
    """Name -> id: an established product wins over a new one, then the lowest id.
    ``in_new`` tells whether the name is listed among the new products at all."""
    first = F.min(F.struct("is_new", "product_id"))
    return all_products(products, new_products).groupBy(*NAME_KEY).agg(
        first.alias("_f"), F.max("is_new").alias("in_new")
    ).select(
        *NAME_KEY, F.col("_f.product_id").alias("product_id"), F.col("_f.is_new").alias("is_new"),
        "in_new",
    )


def lookup_product_id(requests: DataFrame, products: DataFrame, new_products: DataFrame) -> DataFrame:
    """(category, product_name, product_id, is_new) for every known requested name."""
    ids = product_ids(requested(products, requests, NAME_KEY), requested(new_products, requests, NAME_KEY))
    return requests.select(*NAME_KEY).join(ids.drop("in_new"), on=NAME_KEY, how="inner")


def assign_product_ids(requests: DataFrame, products: DataFrame, new_products: DataFrame) -> DataFrame:
    """Ids for distinct unseen names, after the max id over both product tables."""
    both = all_products(products, new_products)
    unseen = requests.select(*NAME_KEY).distinct().join(
        requested(both.select(*NAME_KEY), requests, NAME_KEY).distinct(), on=NAME_KEY, how="left_anti"
    )
    return _next_ids(unseen, both, "product_id", "product_name").select(
        "category", "product_id", "product_name"
    )


def onboard_products(requests: DataFrame, products: DataFrame, new_products: DataFrame) -> DataFrame:
    """Rows to append to ``new_products`` for names not yet known in their category.

    A name requested twice keeps its lowest manufacturer.
    """
    ids = assign_product_ids(requests, products, new_products)
    maker = requests.groupBy(*NAME_KEY).agg(F.min("manufacturer").alias("manufacturer"))
    return ids.join(maker, on=NAME_KEY, how="inner").select(
        "category", "product_id", "product_name", "manufacturer"
    )


def product_is_new(requests: DataFrame, new_products: DataFrame) -> DataFrame:
    """(category, product_name, is_new) for every request row."""
    return _flag(requests.select(*NAME_KEY), new_products, NAME_KEY, "is_new")


def has_ratings(users: DataFrame, ratings_all: DataFrame) -> DataFrame:
    """(category, user_id, has_ratings) -- true when the user rated anything."""
    return _flag(
        users.select("category", "user_id"), ratings_all, ["category", "user_id"], "has_ratings"
    )
