"""Import of the original on-disk layout into a ``TableStore``.

The original keeps every dataset as headerless comma-separated text, one folder per
category: ``<base>/<dataset>/<category>/part-*``. Fields are positional (FIXTURES.md part
1). Here the category comes from the folder name (the file-path metadata column), fields
are typed by an explicit schema, quoted fields may hold commas, and rating files go
through the rating-line parser so bad lines come out as rejects instead of failing the
job. Everything is one distributed read per dataset.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from pickwise.config import Config
from pickwise.functions.topk import top_k
from pickwise.operators.ratings import all_products
from pickwise.sources.tables import TableStore
from pickwise.sources.text import check_products, parse_rating_lines

L, S, D = T.LongType(), T.StringType(), T.DoubleType()

# dataset -> positional fields (without category)
LAYOUT = {
    "users": [("user_id", L), ("mail_id", S)],
    "products": [("product_id", L), ("product_name", S), ("manufacturer", S)],
    "new_products": [("product_id", L), ("product_name", S), ("manufacturer", S)],
    "new_product_shown_list": [("product_name", S)],
    "category_recommendation_data": [("product_id", L), ("mean_rating", D)],
    "user_recommendation_data": [("user_id", L), ("product_id", L), ("score", D)],
    "previous_user_recommendations": [("user_id", L), ("product_list", S)],
}
RATING_SETS = ("ratings", "new_product_ratings")


def _category(dataset: str) -> F.Column:
    """Category from the folder name: ``<dataset>/<c>/file`` (the original's layout) or
    ``<dataset>/category=<c>/file`` (Spark's partitioned layout)."""
    return F.regexp_extract(
        F.col("_metadata.file_path"), rf"/{dataset}/(?:category=)?([^/]+)/[^/]*$", 1
    )


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.text(path).limit(0).collect()
        return True
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return False


BAD = "_bad_line"
ERR_LINE, ERR_KEY = "unparseable", "missing_id"


def read_dataset(spark: SparkSession, base: str, dataset: str) -> DataFrame:
    """One dataset of the original layout as a typed DataFrame with ``category`` and ``reason``: null, or why
    the row can't be taken (a field that does not parse or is not there, a null first field); then ``line`` holds it."""
    schema = T.StructType([T.StructField(n, t, True) for n, t in LAYOUT[dataset]])
    names = schema.fieldNames()
    df = spark.read.schema(T.StructType([*schema.fields, T.StructField(BAD, S, True)])).option("header", "false").option("quote", '"').option(
        "columnNameOfCorruptRecord", BAD).csv(f"{base}/{dataset}/*/*")
    reason = F.when(F.col(BAD).isNotNull(), F.lit(ERR_LINE)).when(F.col(names[0]).isNull(), F.lit(ERR_KEY))
    line = F.coalesce(F.col(BAD), F.to_csv(F.struct(*names)))
    return df.select(_category(dataset).alias("category"), *names, reason.alias("reason"), F.when(reason.isNotNull(), line).alias("line"))


def read_rating_lines(spark: SparkSession, base: str, dataset: str) -> DataFrame:
    """(category, line) of a rating dataset."""
    return spark.read.text(f"{base}/{dataset}/*/*").select(
        _category(dataset).alias("category"), F.col("value").alias("line")
    )


def import_legacy(store: TableStore, base: str, cfg: Config) -> dict[str, DataFrame]:
    """Append every dataset found under ``base`` to ``store``, as one commit that names the folder: a crash
    leaves nothing, and a second import of the same folder changes nothing.

    Rows that can't be taken are in ``import_rejects`` (category, dataset, line, reason): lines that do not
    parse or lack their id, and ratings out of range or of unknown products. Returns them per dataset."""
    spark, commit_id = store.spark, f"import {base.rstrip('/')}"
    if not store.committed(commit_id):
        found = [d for d in (*LAYOUT, *RATING_SETS) if _exists(spark, f"{base}/{d}/*/*")]
        read = {d: read_dataset(spark, base, d) for d in found if d in LAYOUT}
        good = {d: df.where("reason is null") for d, df in read.items()}
        bad = [df.where("reason is not null").select("category", F.lit(d).alias("dataset"), "line", "reason") for d, df in read.items()]
        known = [store.read(t).unionByName(good[t].select(*store.read(t).columns)) if t in good else store.read(t) for t in ("products", "new_products")]
        prods = all_products(*known)
        out = {d: df for d, df in good.items() if d != "category_recommendation_data"}
        if "previous_user_recommendations" in out:
            # the original's lists carry no batch: imported lists form batch 0
            out["previous_user_recommendations"] = out["previous_user_recommendations"].withColumn("batch_id", F.lit(0).cast("long"))
        for d in RATING_SETS:
            if d in found:
                parsed = check_products(parse_rating_lines(read_rating_lines(spark, base, d)), prods)
                out[d] = parsed.where(F.col("error").isNull())
                bad.append(parsed.where(F.col("error").isNotNull()).select("category", F.lit(d).alias("dataset"), "line", F.col("error").alias("reason")))
        if "category_recommendation_data" in good:
            # every stored row, in the list's own order; a product no longer known keeps a null name
            ranked = top_k(good["category_recommendation_data"], ["category"], [F.col("mean_rating").desc(), F.col("product_id")], None)
            names = prods.select("category", "product_id", "product_name")
            out["category_recommendation_data"] = ranked.join(names, ["category", "product_id"], "left")
        if bad:
            out["import_rejects"] = reduce(DataFrame.unionByName, bad)
        store.commit(out, commit_id=commit_id)
    rejects = store.read("import_rejects")
    return {d: rejects.where(F.col("dataset") == d) for d in (*LAYOUT, *RATING_SETS)}


def export_text(df: DataFrame, base: str, dataset: str) -> None:
    """Write (category, line) rows as headerless text, one folder per category."""
    df.select("category", "line").write.mode("overwrite").partitionBy("category").text(
        f"{base}/{dataset}"
    )


def export_csv(df: DataFrame, base: str, dataset: str) -> None:
    """Write a dataset as headerless quoted CSV in positional order, one folder per category."""
    cols = [n for n, _ in LAYOUT[dataset]]
    df.select("category", *cols).write.mode("overwrite").partitionBy("category").option(
        "header", "false").option("quote", '"').csv(f"{base}/{dataset}")
