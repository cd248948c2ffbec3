"""Rows that the pipeline's stages and the decontamination slices keep, judged by row and not by id."""

import random
from collections import Counter

import pytest

import corpus_pipeline as pipeline
from pickwise.llm import decontamination, token_counts
from pickwise.session import scratch_path

PASSAGE = "the quiet river turned slowly under seven stone bridges while lanterns burned along both banks all winter night"
OTHER = "a completely different sentence about engines valves pistons and the long road that leads over dry hills to town"
CLEAN = "my grandmother kept bees behind the old orchard and sold pale honey at the market every second saturday morning"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", k, "s", -1, 0.5) for k, (i, t) in enumerate(rows)],
                                 "doc_id long, text string, lang string, n long, component_id string, n_chars long, rejected double")


def texts(df):
    return Counter((r["doc_id"], r["text"]) for r in df.collect())


ODD = [(None, None), (7, ""), (7, "  \n\t"), (None, "")]


def test_near_copies_go_by_row(spark):
    rows = [(1, PASSAGE), (None, PASSAGE), (5, OTHER), (5, OTHER), (3, PASSAGE), (3, CLEAN), *ODD]
    docs = table(spark, rows).repartition(3)
    got = pipeline.drop_near_copies(spark, docs, "")
    assert got.columns == docs.columns
    assert texts(got) == Counter([(1, PASSAGE), (5, OTHER), (3, CLEAN), *ODD])
    only_null = pipeline.drop_near_copies(spark, table(spark, [(None, PASSAGE), (None, PASSAGE)]), "")
    assert texts(only_null) == Counter([(None, PASSAGE)])
    assert pipeline.drop_near_copies(spark, table(spark, []), "").count() == 0


def test_contaminated_rows_go_by_row(spark):
    path = scratch_path(spark, "bench")
    spark.createDataFrame([(1, PASSAGE)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    rows = [(3, PASSAGE), (3, CLEAN), (None, PASSAGE), (None, OTHER), (9, OTHER), (9, OTHER), *ODD]
    docs = table(spark, rows).repartition(2)
    got = pipeline.drop_contaminated(spark, docs, path)
    assert got.columns == docs.columns
    assert texts(got) == Counter([(3, CLEAN), (None, OTHER), (9, OTHER), (9, OTHER), *ODD])
    assert pipeline.drop_contaminated(spark, table(spark, []), path).count() == 0


def test_repeated_lines_keep_every_row_and_column(spark):
    rows = [(2, f"{PASSAGE}\nown line of two"), (1, PASSAGE), (None, PASSAGE), (4, PASSAGE), (4, PASSAGE), *ODD]
    docs = table(spark, rows)
    got = pipeline.cut_repeated_lines(spark, docs, "")
    assert got.columns == docs.columns and got.count() == len(rows)
    kept = texts(got)
    assert kept[(1, PASSAGE)] == 1 and kept[(2, "own line of two")] == 1 and kept[(4, "")] == 2
    assert all(r["n_chars"] == len(r["text"]) and r["component_id"] == "s" and r["rejected"] == 0.5 for r in got.collect())


def test_toxic_stage_keeps_clean_rows_and_columns(spark):
    path = scratch_path(spark, "labels")
    rnd, words = random.Random(2), [a + b for a in "b c d f g l m n p r s t".split() for b in "ara elo iki omu une yst".split()]
    bad = ["stupid", "idiot", "worthless", "scum", "moron", "useless", "vile", "trash"]
    say = lambda *more: " ".join(rnd.sample([*rnd.choices(words, k=25), *more], 25 + len(more)))
    rows = [(i, say()) for i in range(260)] + [(1000 + i, say(*rnd.sample(bad, 4))) for i in range(40)] + ODD
    clean = [r for r in rows if r[0] is None or r[0] < 1000]
    labels = [(i, 0, 0) for i in range(260)] + [(1000 + i, 0, 1) for i in range(40)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    docs = table(spark, rows)
    got = pipeline.drop_toxic(spark, docs, path)
    assert got.columns == docs.columns
    left = texts(got)
    assert not Counter(clean) - left and sum((left - Counter(clean)).values()) <= 4


@pytest.mark.parametrize("slice_words", [200_000, 10])
def test_every_row_is_judged_whatever_the_slices(spark, slice_words):
    bench = spark.createDataFrame([(1, PASSAGE), (2, OTHER), (3, None), (None, CLEAN)], "item_id long, text string")
    rows = [(5, PASSAGE), (5, CLEAN), (None, OTHER), (None, CLEAN), (6, f"{OTHER} {PASSAGE}"), (6, f"{OTHER} {PASSAGE}"), *ODD]
    got = decontamination.find_contaminated(table(spark, rows), bench, decontamination.Params(slice_words=slice_words)).collect()
    assert Counter((r["doc_id"], tuple(r["items"])) for r in got) == Counter(
        [(5, (1,)), (5, ()), (None, (2,)), (None, ()), (6, (1, 2)), (6, (1, 2)), *[(i, ()) for i, _ in ODD]])


def test_a_corpus_that_is_the_benchmark_is_found(spark):
    bench = spark.createDataFrame([(1, PASSAGE)], "item_id long, text string")
    for n in (1, 2, 5):
        got = decontamination.find_contaminated(table(spark, [(i, PASSAGE) for i in range(n)]), bench).collect()
        assert [r["contaminated"] for r in got] == [True] * n


def test_long_words_are_counted_piece_by_piece(spark):
    docs = spark.createDataFrame([(1, "ab" * 5000), (2, "世" * 5000), (3, "x" * 300 + " ab")], "doc_id long, text string")
    count = lambda **k: {r["doc_id"]: r["n_tokens"] for r in token_counts.count_tokens(docs, ["ab", "a", "世"], ["ab", "b", "世世", "世"], **k).collect()}
    assert count() == {1: 5000, 2: 2501, 3: 2}
    assert count(max_chars=200) == {1: 1, 2: 1, 3: 2}


def test_border_check_equals_merging_again():
    """Pairs of neighbouring and of random pieces, and characters that are in no piece."""
    import random

    from pickwise.llm.queries import tokenizer_file
    from pickwise.llm.sentencepiece_codec import Codec, parse_model

    with open(tokenizer_file("piece_bpe_32k.model"), "rb") as f:
        codec = Codec(parse_model(f.read()))
    rnd = random.Random(5)
    pieces = sorted(codec.usable)
    pairs = [(rnd.choice(pieces), rnd.choice(pieces)) for _ in range(5000)]
    # every cut of a piece into two usable ones: these merge across the border, or come out of another merge
    pairs += [(p[:i], p[i:]) for p in rnd.sample(pieces, 5000) for i in range(1, len(p)) if p[:i] in codec.usable and p[i:] in codec.usable]
    pairs += [("\x00", rnd.choice(pieces)) for _ in range(20)] + [(rnd.choice(pieces), "\U0001f9ff") for _ in range(20)]
    verdicts = [codec.compatible(a, b) for a, b in pairs]
    assert verdicts == [codec.merge(a + b) == [a, b] for a, b in pairs]
    assert {True, False} == set(verdicts)
