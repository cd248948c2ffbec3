"""Feedback and recommendation history.

The original asks one user for three ratings on the console; here a feedback table of
any size is deduplicated, validated and routed in one plan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pickwise.functions.lists import explode_list, ordered_join
from pickwise.operators.registry import NAME_KEY, product_ids, requested
from pickwise.sources.text import ERR_PRODUCT, ERR_RANGE, RATING_MAX, RATING_MIN

USER = ["category", "user_id"]

TARGET_NEW = "new_product_ratings"
TARGET_ESTABLISHED = "ratings"
TARGET_REJECTED = "rejected"
ERR_MISSING = "missing_rating"
ERR_USER = "unknown_user"


def feedback_batch(feedback: DataFrame) -> DataFrame:
    """The last rating (highest ``seq``; tie: higher rating) per user and product
    name, as a map keyed by name would keep it."""
    last = F.max(F.struct("seq", "rating"))
    return feedback.groupBy("category", "user_id", "product_name").agg(last.alias("_l")).select(
        "category", "user_id", "product_name", F.col("_l.rating").alias("rating"),
        F.col("_l.seq").alias("seq"),
    )


def route_feedback(feedback: DataFrame, products: DataFrame, new_products: DataFrame,
                   users: DataFrame | None = None) -> DataFrame:
    """Where each feedback rating goes.

    The target table is decided by whether the name is in ``new_products`` (R9); the id
    by the established-first lookup (R6); both come from one lookup table, so feedback is
    joined once. Unknown names, missing ratings, ratings outside [0, 5] and, when ``users`` is
    given, unknown users go to the reject table with a reason.
    """
    asked = lambda t: requested(t, feedback, NAME_KEY)
    ids = product_ids(asked(products), asked(new_products)).select(
        "category", "product_name", "product_id", F.col("in_new").alias("_new")
    )
    r = F.col("rating")
    reason = (
        F.when(F.col("product_id").isNull(), F.lit(ERR_PRODUCT))
        .when(r.isNull() | F.isnan(r), F.lit(ERR_MISSING))
        .when((r < RATING_MIN) | (r > RATING_MAX), F.lit(ERR_RANGE))
    )
    if users is not None:
        known = requested(users.select(*USER), feedback, USER).distinct().withColumn("_known", F.lit(True))
        feedback = feedback.join(known, on=USER, how="left")
        reason = F.when(F.col("_known").isNull(), F.lit(ERR_USER)).otherwise(reason)
    routed = feedback.join(ids, on=["category", "product_name"], how="left").withColumn(
        "reason", reason
    )
    target = (
        F.when(F.col("reason").isNotNull(), F.lit(TARGET_REJECTED))
        .when(F.col("_new"), F.lit(TARGET_NEW))
        .otherwise(F.lit(TARGET_ESTABLISHED))
    )
    return routed.select(
        "category", "user_id", "product_name", "product_id", "rating", "seq",
        target.alias("target"), "reason",
    )


def routed_rows(routed: DataFrame, target: str) -> DataFrame:
    """Rating rows (category, user_id, product_id, rating) routed to ``target``."""
    return routed.where(F.col("target") == target).select(
        "category", "user_id", "product_id", "rating"
    )


def latest_lists(history: DataFrame) -> DataFrame:
    """Each user's latest row of the history (highest batch_id; tie: greater list). The latest rows of
    parts of a history give those of the whole."""
    latest = history.groupBy(*USER).agg(F.max(F.struct("batch_id", "product_list")).alias("_l"))
    return latest.select(*USER, F.col("_l.batch_id").alias("batch_id"), F.col("_l.product_list").alias("product_list"))


def last_recommendations(history: DataFrame) -> DataFrame:
    """C11 / F2: items of each user's latest list (highest batch_id), one row per slot. ``history``:
    the history or a snapshot's ``latest``."""
    return explode_list(latest_lists(history), "product_list")


def push_recommendations(recs: DataFrame, batch_id: int | F.Column) -> DataFrame:
    """One history row per user: names joined by ':' in slot order."""
    b = batch_id if isinstance(batch_id, F.Column) else F.lit(batch_id)
    return recs.groupBy(*USER).agg(ordered_join("slot", "product_name").alias("product_list")).select(
        *USER, b.cast("long").alias("batch_id"), "product_list"
    )
