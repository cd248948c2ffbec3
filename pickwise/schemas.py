"""Table schemas. Every table carries ``category``; keys are (category, id)."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, D = T.StringType(), T.LongType(), T.DoubleType()


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


USERS = _schema(("category", S), ("user_id", L), ("mail_id", S))
PRODUCTS = _schema(("category", S), ("product_id", L), ("product_name", S), ("manufacturer", S))
NEW_PRODUCTS = PRODUCTS
RATINGS = _schema(("category", S), ("user_id", L), ("product_id", L), ("rating", D))
NEW_PRODUCT_RATINGS = RATINGS
SHOWN = _schema(("category", S), ("product_name", S))
# maintained with every commit that touches a rating table: one mergeable state per product of a segment, and
# the segment's raters
RATING_STATE = _schema(("category", S), ("product_id", L), ("sum", D), ("n", L))
RATERS = _schema(("category", S), ("user_id", L))
# the hash order of new products, replaced with every commit that touches them
NEW_PRODUCT_ORDER = _schema(("category", S), ("position", L), ("product_id", L), ("product_name", S))
CATEGORY_RECS = _schema(
    ("category", S), ("rank", L), ("product_id", L), ("product_name", S), ("mean_rating", D)
)
USER_RECS = _schema(("category", S), ("user_id", L), ("product_id", L), ("score", D))
HISTORY = _schema(("category", S), ("user_id", L), ("batch_id", L), ("product_list", S))

# request tables (what the interactive prompts of the original become)
USER_REQUESTS = _schema(("category", S), ("mail_id", S))
PRODUCT_REQUESTS = _schema(("category", S), ("product_name", S), ("manufacturer", S))
FEEDBACK = _schema(
    ("category", S), ("user_id", L), ("product_name", S), ("rating", D), ("seq", L)
)
RAW_RATING_LINES = _schema(("category", S), ("line", S))

FEEDBACK_REJECTS = _schema(
    ("category", S), ("user_id", L), ("product_name", S), ("product_id", L), ("rating", D), ("seq", L),
    ("target", S), ("reason", S), ("batch_id", L),
)
IMPORT_REJECTS = _schema(("category", S), ("dataset", S), ("line", S), ("reason", S))
BATCH_RECS = _schema(
    ("category", S), ("mail_id", S), ("user_id", L), ("slot", L), ("product_id", L), ("product_name", S),
    ("source", S), ("stage", L), ("batch_id", L),
)

TABLES = {
    "users": USERS,
    "products": PRODUCTS,
    "new_products": NEW_PRODUCTS,
    "ratings": RATINGS,
    "new_product_ratings": NEW_PRODUCT_RATINGS,
    "ratings_state": RATING_STATE,
    "ratings_raters": RATERS,
    "new_product_ratings_state": RATING_STATE,
    "new_product_ratings_raters": RATERS,
    "new_product_order": NEW_PRODUCT_ORDER,
    "new_product_shown_list": SHOWN,
    "category_recommendation_data": CATEGORY_RECS,
    "user_recommendation_data": USER_RECS,
    "previous_user_recommendations": HISTORY,
    # the last lists of the history's users, kept up by its commits
    "previous_user_recommendations_latest": HISTORY,
    "feedback_rejects": FEEDBACK_REJECTS,
    "batch_recommendations": BATCH_RECS,
    "import_rejects": IMPORT_REJECTS,
}

# recommendation rows produced by every strategy
RECS = _schema(
    ("category", S), ("user_id", L), ("slot", L), ("product_id", L), ("product_name", S),
    ("source", S),
)
