"""Training-data pipeline over ``documents``: toxicity, line dedup, n-gram Jaccard join,
benchmark decontamination, SentencePiece encoding.

Every stage takes all documents that its predecessor kept, and its decisions take effect:
rejected, duplicate and contaminated documents go, repeated lines are cut, and the last stage
returns the encoded documents. ``run`` writes each stage's result as Parquet to the shared
checkpoint folder and reads it again as the next one's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pickwise.llm import decontamination, line_dedup, ngram_join, sentencepiece_codec, toxicity
from pickwise.llm.common import table
from pickwise.llm.queries import tokenizer_file
from pickwise.session import cut_lineage, scratch_path

BROADCAST_ROWS = 2_000_000
ROW = "__row_key"


def _nested(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text`` and all other columns in one, so that no name meets one of an operator's."""
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", F.struct(F.lit(0).alias("__none"), *rest).alias("__rest"))


def _as_before(out: DataFrame, docs: DataFrame, **changed) -> DataFrame:
    """The columns of ``docs`` from a result over ``_nested(docs)``; ``changed`` ones where ``docs`` has them."""
    held = lambda c: F.col(c) if c in ("doc_id", "text") else F.col("__rest").getField(c)
    return out.select(*[changed.get(c, held(c)).cast(docs.schema[c].dataType).alias(c) for c in docs.columns])


def _keyed(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``docs`` with a key of its own for every row, written, so that every reader sees the same keys."""
    path = scratch_path(spark, "pipeline-keyed")
    docs.withColumn(ROW, F.monotonically_increasing_id()).write.parquet(path)
    return spark.read.parquet(path)


def _without(keyed: DataFrame, gone: DataFrame) -> DataFrame:
    """Rows whose key is not in ``gone``; the keys go to all tasks while they are few."""
    gone = cut_lineage(gone.select(F.col(ROW).alias("__gone")))
    few = F.broadcast(gone) if gone.count() <= BROADCAST_ROWS else gone
    return keyed.join(few, F.col(ROW) == F.col("__gone"), "left_anti").drop(ROW)


# Every stage judges rows by themselves, not by their id: a null or repeated id neither saves a bad row nor takes
# a clean one with it. All columns come back, whatever their names; an empty table stays empty.


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text is not rejected; null and empty texts stay. Labels are found by ``doc_id``."""
    chain = toxicity.train_on_labels(docs, table(spark, sf_dir, "labels"))
    return _as_before(toxicity.score(_nested(docs), chain).where("rejected = 0"), docs)


def cut_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, without lines that an earlier document holds; ``n_chars`` counts what is left. Rows of one id are
    one document, null ids one after all others (see ``line_dedup.dedup_lines``); null texts become empty."""
    return _as_before(line_dedup.dedup_lines(_nested(docs)), docs, n_chars=F.length("text"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of similar rows the one with the smallest id stays (nulls last; of equal ids one of them).
    Null, empty and blank texts are in no group and stay."""
    keyed = _keyed(spark, docs)
    group = ngram_join.jaccard_components(keyed, id_col=ROW).select(F.col("doc_id").alias(ROW), "component_id")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", ROW)
    first = keyed.select("doc_id", ROW).join(group, ROW).groupBy("component_id").agg(F.min_by(ROW, order).alias("first"), F.count("*").alias("n"))
    gone = group.join(first.where("n > 1"), "component_id").where(F.col(ROW) != F.col("first"))
    return _without(keyed, gone)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text holds no benchmark item; null, empty and wordless texts stay."""
    keyed = _keyed(spark, docs)
    found = decontamination.find_contaminated(keyed, table(spark, sf_dir, "benchmark"), id_col=ROW)
    return _without(keyed, found.where("contaminated"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)`` of every row; null and empty texts have no ids."""
    return sentencepiece_codec.encode_digests(docs, tokenizer_file("piece_bpe_32k.model"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", cut_repeated_lines),
    ("ngram_jaccard", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("sentencepiece", encode),
]

# a trained chain, latent retrieval and piece encoding have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)`` of the documents that all stages keep."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
