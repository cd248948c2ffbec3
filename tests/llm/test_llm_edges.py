"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing column names."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from pickwise.llm import (
    decontamination, embedding_dedup, line_dedup, ngram_join, pii_surrogates, quality, sentencepiece_codec, token_counts, toxicity, url_filters,
)
from pickwise.llm.queries import tokenizer_file

LONG = " ".join(f"word{i % 997}" for i in range(40_000))
SHAPE = "doc_id long, text string, doc string, t string, row string, sig long, n long, key string, block int, score string, n_lines string, component string"


def table(spark, rows):
    return spark.createDataFrame([(i, t, *["x"] * 3, 1, 2, "k", 3, "s", "l", "c") for i, t in rows], SHAPE)


ROWS = [
    (1, "a line that repeats here\nsecond"), (2, None), (3, ""), (4, "  \n\t "), (5, LONG), (6, LONG), (7, "short"),
    (8, "A Line That Repeats Here  \nother"), (8, "A Line That Repeats Here  \nother"), (None, "a line that repeats here"), (9, "öß 世界 \x00 ▁"),
]


@pytest.fixture(scope="module")
def edge(spark):
    return table(spark, ROWS).repartition(3)


def by_id(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["doc_id"], []).append(r)
    return out


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def test_line_dedup_edges(spark, edge):
    got = by_id(line_dedup.dedup_lines(edge))
    assert sum(map(len, got.values())) == len(ROWS)
    assert got[1][0]["n_dropped"] == 0 and got[1][0]["text"] == ROWS[0][1]
    assert [r["text"] for r in got[8]] == ["other", "other"]          # repeated rows are one document, after document 1
    assert got[None][0]["text"] == "" and got[None][0]["n_dropped"] == 1  # a null id comes last
    for i in (2, 3):
        assert (got[i][0]["n_lines"], got[i][0]["n_dropped"], got[i][0]["kept_sha256"]) == (1, 0, sha(""))
    assert got[4][0]["n_lines"] == 2 and got[4][0]["text"] == "  \n\t "
    assert got[6][0]["n_dropped"] == 1 and got[5][0]["n_dropped"] == 0
    assert got[1][0]["row"] == "x" and got[1][0]["n_lines"] == 2        # clashing names: kept, replaced
    empty = line_dedup.dedup_lines(table(spark, []))
    assert empty.count() == 0 and "kept_sha256" in empty.columns


def test_line_dedup_repeated_rows_alone_keep_their_lines(spark):
    got = by_id(line_dedup.dedup_lines(table(spark, [(4, "the very same line"), (4, "the very same line")])))
    assert [r["n_dropped"] for r in got[4]] == [0, 0]


def test_ngram_join_edges(spark, edge):
    got = by_id(ngram_join.jaccard_components(edge))
    assert sum(map(len, got.values())) == len(ROWS)
    assert [(got[i][0]["n_shingles"], got[i][0]["component_id"]) for i in (2, 3, 4)] == [(0, 2), (0, 3), (0, 4)]
    assert got[5][0]["component_id"] == got[6][0]["component_id"] == 5 and got[5][0]["n_shingles"] == 997
    assert got[7][0]["n_shingles"] == 1 and {r["component_id"] for r in got[8]} == {8}
    assert got[None][0]["component_id"] is None
    assert ngram_join.jaccard_components(table(spark, [])).count() == 0


def test_codec_edges(spark, edge):
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=tokenizer_file("piece_bpe_32k.model"))
    got = by_id(sentencepiece_codec.encode_documents(edge, tokenizer_file("piece_bpe_32k.model")))
    dig = by_id(sentencepiece_codec.encode_digests(edge, tokenizer_file("piece_bpe_32k.model")))
    assert sum(map(len, got.values())) == len(ROWS)
    for i, t in ROWS:
        ids = lib.encode(t or "")
        assert list(got[i][0]["ids"]) == ids and got[i][0]["decoded"] == lib.decode(ids) and got[i][0]["n_tokens"] == len(ids)
        assert dig[i][0]["ids_sha256"] == sha(",".join(map(str, ids))) and dig[i][0]["decoded_sha256"] == sha(lib.decode(ids))
    assert sentencepiece_codec.encode_digests(table(spark, []), tokenizer_file("piece_bpe_32k.model")).count() == 0


def test_token_count_edges(spark, edge):
    got = by_id(token_counts.count_tokens(edge, ["word", "s", "a"], ["hort"] + [str(i) for i in range(10)]))
    assert [(got[i][0]["n_words"], got[i][0]["n_tokens"]) for i in (2, 3, 4)] == [(0, 0)] * 3
    assert got[7][0]["n_tokens"] == 2 and got[5][0]["n_words"] == 40_000
    assert got[5][0]["n_tokens"] == sum(1 + len(str(i % 997)) for i in range(40_000))
    assert token_counts.count_tokens(table(spark, []), ["a"], ["b"]).count() == 0


def test_quality_edges(spark, edge):
    labels = spark.createDataFrame([(1, 1, 0), (5, 0, 1), (5, 1, 0), (None, 1, 1), (7, None, None)], "doc_id long, quality int, toxic int")
    got = quality.classify(edge, labels).collect()
    assert len(got) == len(ROWS) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    nothing = quality.classify(edge, labels.limit(0)).collect()
    assert {r["score"] for r in nothing} == {0.5}
    assert quality.classify(table(spark, []), labels).count() == 0


def test_toxicity_edges(spark, edge):
    labels = spark.createDataFrame([(1, 1, 0), (5, 0, 1), (None, 1, 1), (7, None, None)], "doc_id long, quality int, toxic int")
    chain = toxicity.train_on_labels(edge, labels)
    got = toxicity.score(edge, chain)
    assert got.count() == len(ROWS) and {"p_insult", "p_contempt", "p_toxic", "rejected", "row"} <= set(got.columns)
    nothing = toxicity.score(edge, toxicity.train_on_labels(edge, labels.limit(0))).collect()
    assert {r["p_insult"] for r in nothing} == {0.5}
    assert toxicity.score(table(spark, []), chain).count() == 0


def test_pii_edges(spark, edge):
    got = by_id(pii_surrogates.replace_entities(edge, b"key"))
    assert got[2][0]["text"] is None and got[3][0]["text"] == "" and got[5][0]["text"] == LONG
    assert all(r["n_entities"] == 0 for rs in got.values() for r in rs)
    assert pii_surrogates.replace_entities(table(spark, []), b"key").count() == 0


def test_decontamination_edges(spark, edge):
    bench = spark.createDataFrame([(1, LONG[:600]), (2, None), (None, "x y z"), (3, "  ")], "item_id long, text string")
    got = by_id(decontamination.find_contaminated(edge, bench))
    assert sum(map(len, got.values())) == len(ROWS)
    assert got[5][0]["items"] == got[6][0]["items"] == [1]
    assert not any(got[i][0]["contaminated"] for i in (1, 2, 3, 4, 7, 9))
    none = decontamination.find_contaminated(edge, bench.limit(0))
    assert none.where("contaminated").count() == 0 and none.count() == len(ROWS)
    assert decontamination.find_contaminated(table(spark, []), bench).count() == 0


def test_url_filter_edges(spark):
    caps = spark.createDataFrame(
        [(1, "http://A.Example.com/x", "2024-02-01 00:00:00", "z"), (1, "http://a.example.com/x", "2024-02-01 00:00:00", "z"), (2, None, "2024-02-01 00:00:00", "z"),
         (3, "nonsense", "2024-02-01 00:00:00", "z"), (4, "http://a.example.com", None, "z"), (None, "http://u@a.example.com:8080/", "2024-01-01 00:00:00", "z")],
        "page_id long, url string, fetched_at string, pattern string",
    )
    ev = spark.createDataFrame(
        [("ads", "Example.com", "add", "2024-01-15 00:00:00"), ("ads", "example.com", "add", "2024-01-15 00:00:00"), ("ads", "a.example.com", "add", "2024-01-01 00:00:00"),
         ("ads", "a.example.com", "remove", "2024-02-01 00:00:00"), ("x", None, "add", "2024-01-01 00:00:00")],
        "list string, pattern string, action string, at string",
    ).withColumn("at", F.to_timestamp("at"))
    got = url_filters.judge_captures(caps, ev).collect()
    assert len(got) == 6
    at = lambda i: [(r["n_entries"], r["lists"], r["blocked"]) for r in got if r["page_id"] == i]
    assert at(1) == [(1, "ads", True)] * 2           # removed at the very instant; the parent still covers it
    assert at(None) == [(1, "ads", True)]            # valid from the instant of the add
    assert at(2) == at(3) == at(4) == [(0, "", False)]
    assert url_filters.judge_captures(caps, ev.limit(0)).where("blocked").count() == 0
    assert url_filters.judge_captures(caps.limit(0), ev).count() == 0


def test_embedding_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (5, [1.0, 0.0], 1, "a"), (2, [1.0, 0.0], 1, "a"), (3, [2.0, 0.1], 1, "a"), (4, [1.0, 0.0], 2, "a"), (6, [1.0, 0.0], None, "a"), (7, None, 1, "a"),
        (8, [0.0, 0.0], 1, "a"), (9, [1.0, None], 1, "a"), (10, [nan, 1.0], 1, "a"), (11, [inf, 1.0], 1, "a"), (12, [], 1, "a"), (13, [1.0, 0.0, 0.0], 1, "a"),
        (None, [1.0, 0.0], 1, "a"), (14, [0.0, 1.0], 1, "a"), (15, [1e300, 0.0], 1, "a"),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, key string")
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embedding_dedup.near_duplicates(df).collect()}
    assert len(got) == len(rows)
    assert got[2] == (3, 2, True) and got[5] == (3, 2, False) and got[3] == (3, 2, False) and got[15] == (3, 2, False)
    for i in (4, 6, 7, 8, 9, 10, 11, 12, 13, 14):
        assert got[i] == (0, i, True)
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0
    assert np.isfinite(embedding_dedup.unit_rows([[1e300, 1e300]])).all()
