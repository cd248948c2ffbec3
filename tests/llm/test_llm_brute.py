"""Operators against brute force, the libraries, exact round trips and held-out labels."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from pickwise.llm import (
    decontamination, embedding_dedup, line_dedup, ngram_join, pii_surrogates, queries, sentencepiece_codec, token_counts,
)
from pickwise.llm.components import connected_components

SF = "/root/testdata/sf0.01"


def find(par, x):
    while par[x] != x:
        par[x] = par[par[x]]
        x = par[x]
    return x


def corpus(seed, n, words=30):
    """Documents with copies, near copies on both sides of the threshold, and a common passage."""
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    out, passage = [], [r.choice(vocab) for _ in range(12)]
    for i in range(n):
        kind = r.random()
        if out and kind < 0.15:
            t = r.choice(out)
        elif out and kind < 0.55:
            t = r.choice(out).split(" ")
            for _ in range(r.randint(1, 2)):
                t[r.randrange(len(t))] = r.choice(vocab)
            if r.random() < 0.3:
                t = t[:-r.randint(1, 4)] or ["w0"]
            t = " ".join(t)
        else:
            t = [r.choice(vocab) for _ in range(r.randint(1, words * 3))]
            if r.random() < 0.5:
                t[r.randrange(len(t)):0] = passage
            t = " ".join(t)
        out.append(t)
    return [(i, t.upper() if i % 7 == 0 else t) for i, t in enumerate(out)]


def brute_components(rows, percent=80):
    sets = {}
    for i, t in rows:
        w = (t or "").lower().split()
        sets[i] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    par = {i: i for i in sets}
    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                o = len(sets[a] & sets[b])
                if 100 * o >= percent * (len(sets[a]) + len(sets[b]) - o):
                    x, y = find(par, a), find(par, b)
                    par[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(par, i)) for i in ids}


@pytest.mark.parametrize("seed", [1, 2])
def test_ngram_join_equals_brute_force(spark, seed):
    rows = corpus(seed, 260)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.jaccard_components(df).collect()}
    want = brute_components(rows)
    assert got == want and len({c for _, c in want.values()}) < 240


def test_ngram_join_in_blocks(spark, monkeypatch):
    """Components cut into blocks of sets, and sketches cut into small chunks, give the same links."""
    rows = corpus(5, 200)
    monkeypatch.setattr(ngram_join, "BLOCK", 4)
    monkeypatch.setattr(ngram_join, "CHUNK_GRAMS", 100)
    monkeypatch.setattr(ngram_join, "BROADCAST_IDS", 0)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.jaccard_components(df).collect()}
    assert got == brute_components(rows)


def test_partial_overlaps():
    r = np.random.default_rng(3)
    segs = [np.unique(r.integers(0, 150, r.integers(0, 90))) for _ in range(6)]
    o = ngram_join._overlaps(segs, np.arange(6), np.arange(6))
    assert all(o[i, j] == len(np.intersect1d(segs[i], segs[j])) for i in range(6) for j in range(6) if i != j)


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(200, 201), (201, 200), (5, 5), (None, 3)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, 200: 200, 201: 200}


def line_dedup_brute(rows):
    ws = " \t\n\r\x0b\x0c"
    key = lambda x: "".join(c.lower() if "A" <= c <= "Z" else c for c in x.strip(ws))
    held = defaultdict(set)
    for i, t in rows:
        for x in (t or "").split("\n"):
            held[key(x)].add(i)
    out = {}
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (len(key(x)) >= 10 and len(held[key(x)]) > 1 and min(held[key(x)]) != i)]
        out[i] = (len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest())
    return out


def test_line_dedup_equals_brute_force(spark, monkeypatch):
    r = random.Random(4)
    lines = [f"{'é' * (k % 3)}line number {k} " + "x" * (k % 5) for k in range(60)] + ["short", "ninechars", "tenchars_0", "", "  \t"]
    rows = [(i, "\n".join(r.choice([str.upper, str, lambda s: " " + s + "\t"])(r.choice(lines)) for _ in range(r.randint(0, 12)))) for i in range(150)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = line_dedup_brute(rows)
    pick = lambda d: {x["doc_id"]: (x["n_lines"], x["n_dropped"], x["kept_sha256"]) for x in d.collect()}
    assert pick(line_dedup.dedup_lines(df, shard_keys=7)) == want
    monkeypatch.setattr(line_dedup, "heavy_floor", lambda lines: 3)  # most lines are answered as heavy ones
    assert pick(line_dedup.dedup_lines(df, shard_keys=7, keep_text=False)) == want


def test_minimal_perfect_hash_is_minimal_and_perfect():
    r = np.random.default_rng(1)
    for n in (0, 1, 2, 63, 5000):
        h = np.unique(r.integers(0, 2**63, n * 2).astype(np.uint64))[:n]
        sizes, bits, spare, slot = line_dedup.build_mph(h, h ^ np.uint64(5))
        assert sorted(slot) == list(range(len(h)))


def test_codec_equals_library_on_random_texts():
    import sentencepiece

    path = queries.tokenizer_file("piece_bpe_32k.model")
    lib, own = sentencepiece.SentencePieceProcessor(model_file=path), sentencepiece_codec.codec_of(open(path, "rb").read())
    r = random.Random(9)
    for k in range(3000):
        if k % 3 == 0:
            t = "".join(r.choice("aeiouthsrnl ▁\n\t<>0x\x00é𝄞ñ世界한ABC123.,!?") for _ in range(r.randint(0, 60)))
        elif k % 3 == 1:
            t = "".join(r.choice(own.pieces) for _ in range(r.randint(1, 12)))
        else:
            t = "".join(r.choice([" " * r.randint(1, 40), "the", "ing", "\n", "▁▁▁", chr(r.randint(1, 0xD7FF))]) for _ in range(r.randint(1, 12)))
        ids = lib.encode(t)
        assert own.encode(t) == ids and own.decode(ids) == lib.decode(ids)
        assert own.digest(t) == (len(ids), ",".join(map(str, ids)), lib.decode(ids))
    odd = [[r.randrange(32000) for _ in range(r.randint(0, 9))] for _ in range(500)] + [[r.randrange(3, 259) for _ in range(6)] for _ in range(500)]
    assert all(own.decode(ids) == lib.decode(ids) for ids in odd if 0 not in ids)


def greedy(word, first, rest, most):
    if not word:
        return 0
    if len(word) > most:
        return 1
    at = n = 0
    while at < len(word):
        known = first if at == 0 else rest
        end = next((e for e in range(len(word), at, -1) if word[at:e] in known), None)
        if end is None:
            return 1
        at, n = end, n + 1
    return n


def test_piece_counter_equals_greedy_matching():
    r = random.Random(2)
    for _ in range(60):
        first = {"".join(r.choice("abc") for _ in range(r.randint(1, 4))) for _ in range(r.randint(1, 8))}
        rest = {"".join(r.choice("abc") for _ in range(r.randint(1, 5))) for _ in range(r.randint(1, 10))}
        c = token_counts.PieceCounter(sorted(first), sorted(rest), 20)
        for _ in range(80):
            w = "".join(r.choice("abcd" if r.random() < 0.05 else "abc") for _ in range(r.randint(0, 24)))
            assert c.count(w) == greedy(w, first, rest, 20), (w, first, rest)


def test_embedding_links_equal_brute_force(spark):
    r = np.random.default_rng(8)
    base = r.standard_normal((60, 16))
    x = base[r.integers(0, 60, 600)] + r.standard_normal((600, 16)) * r.uniform(0.0, 0.5, (600, 1))
    x = np.vstack([x, np.repeat(x[:1], 40, axis=0)])
    lab = r.integers(0, 3, len(x))
    ids = r.permutation(len(x)).tolist()
    df = spark.createDataFrame([(i, v.tolist(), int(k)) for i, v, k in zip(ids, x, lab)], "vec_id long, embedding array<double>, label int")
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    link = (u @ u.T >= 0.93) & (lab[:, None] == lab[None, :]) & ~np.eye(len(x), dtype=bool)
    par = {i: i for i in ids}
    for a, b in zip(*np.nonzero(link)):
        p, q = find(par, ids[a]), find(par, ids[b])
        par[max(p, q)] = min(p, q)
    got = {z["vec_id"]: z for z in embedding_dedup.near_duplicates(df, bucket=32, block=16).collect()}
    found = sum(got[i]["n_links"] for i in ids)
    assert 0.99 * link.sum() <= found <= link.sum()
    assert all(got[i]["n_links"] <= n for i, n in zip(ids, link.sum(axis=1)))
    assert np.mean([got[i]["component_id"] == find(par, i) for i in ids]) > 0.99
    assert all(z["kept"] == (z["vec_id"] == z["component_id"]) for z in got.values())


def test_lcs_equals_dynamic_programme():
    r = random.Random(6)
    for _ in range(200):
        a, b = ([r.randint(1, 6) for _ in range(r.randint(1, 20))] for _ in range(2))
        d = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                d[i + 1][j + 1] = d[i][j] + 1 if x == y else max(d[i][j + 1], d[i + 1][j])
        assert decontamination.lcs_length(decontamination.lcs_masks(np.array(a)), len(a), b) == d[-1][-1]


def test_decontamination_finds_exact_and_reworded_passages(spark):
    r = random.Random(3)
    word = lambda: "".join(r.choice(["ka", "lo", "mi", "ra", "tu", "sen", "vor", "pel"]) for _ in range(r.randint(2, 4)))
    items = [(i, " ".join(word() for _ in range(r.randint(15, 120)))) for i in range(30)]
    rows, want = [], {}
    for d in range(300):
        w = [word() for _ in range(r.randint(20, 400))]
        if d % 5 == 0:
            i, t = r.choice(items)
            t = t.split()
            if d % 2:
                for _ in range(len(t) // 8):  # words replaced, dropped and added
                    k = r.randrange(len(t) * 3 // 4)
                    t[k:k + 1] = r.choice([[word()], [], [t[k], word()]])
            k = r.randrange(len(w))
            w[k:k] = [x.upper() + "," for x in t]
            want[d] = i
        rows.append((d, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {x["doc_id"]: x["items"] for x in decontamination.find_contaminated(docs, bench).collect() if x["contaminated"]}
    assert sum(want[d] in got.get(d, ()) for d in want) >= 0.9 * len(want)
    assert all(want[d] in got.get(d, ()) for d in want if d % 2 == 0)
    assert not set(got) - set(want)
    sliced = decontamination.find_contaminated(docs, bench, decontamination.Params(slice_words=600))
    again = {x["doc_id"]: x["items"] for x in sliced.collect() if x["contaminated"]}
    assert all(want[d] in again.get(d, ()) for d in want if d % 2 == 0) and not set(again) - set(want)


def planted(seed=9, items=200, docs=240):
    """Benchmark and documents over one Zipf vocabulary; the passage stands beside a line that repeats, topical text,
    random text, or is reworded among random text. ``{doc: (item, kind)}`` says where."""
    r = np.random.default_rng(seed)
    p = 1 / np.arange(1, 20_001)
    draw = lambda n, of=20_000: [f"w{x}" for x in r.choice(of, n, p=p[:of] / p[:of].sum())]
    bench = [(i, draw(int(r.integers(20, 60)))) for i in range(items)]
    rows, want = [], {}
    for d in range(docs):
        i, t = bench[r.integers(items)]
        kind = ("line", "topic", "random", "reworded")[d % 4]
        near = draw(150)
        if kind == "line":
            near = [w for _, x in bench for w in x][d * 7:d * 7 + 10] * 12
        elif kind == "topic":
            near = [near[x] for x in r.integers(0, 12, 150)]
        elif kind == "reworded":
            t = list(t)
            for k in r.choice(len(t) * 3 // 4, len(t) // 8, replace=False):
                t[k] = draw(1)[0]
        if d % 3:
            k = int(r.integers(len(near)))
            near, want[d] = near[:k] + t + near[k:], (i, kind)
        rows.append((d, " ".join(near)))
    return rows, [(i, " ".join(t)) for i, t in bench], want


@pytest.mark.parametrize("fit_passages", [100_000, 40])
def test_candidates_keep_what_all_pairs_would_find(spark, fit_passages):
    rows, items, want = planted()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")

    def found(**p):
        got = decontamination.find_contaminated(docs, bench, decontamination.Params(fit_passages=fit_passages, **p)).collect()
        return {(x["doc_id"], i) for x in got for i in x["items"]}

    got, every = found(), found(min_cosine=-2.0)  # every window against every passage: brute-force LCS
    assert got <= every and len(got) >= 0.98 * len(every)
    assert all((d, i) in got for d, (i, kind) in want.items() if kind != "reworded")


def test_surrogates_are_consistent_distinct_and_alike():
    key = b"secret"
    text = "Mrs. Anna Petrova met Mr Hans Müller. Mrs Petrova: +1 (212) 555-0187, 4111 1111 1111 1111 or 4111111111111111, a.b@mail.org, 10.1.2.3."
    new, n = pii_surrogates.replace(text, key, {})
    assert n == 10 and new == pii_surrogates.replace(text, key, {})[0] != pii_surrogates.replace(text, b"other", {})[0]
    for old in ("Petrova", "Hans", "212", "4111", "a.b@mail"):
        assert old not in new
    assert new.startswith("Mrs. ") and new.count(new.split("Mrs ")[1].split(":")[0]) == 2   # one person, one new name
    cards = [m for m in pii_surrogates.mentions(new) if m[2] == "card"]
    assert len({m[3] for m in cards}) == 1 and pii_surrogates._luhn(cards[0][3]) == 0
    ip = next(m for m in pii_surrogates.mentions(new) if m[2] == "ip")
    assert ip[3].startswith("10.")
    given = [pii_surrogates.surrogate(key, "given-f", x) for x in ("anna", "мария")]
    assert given[0].capitalize() in pii_surrogates.GIVEN["latin", "f"] and given[1].capitalize() in pii_surrogates.GIVEN["cyrillic", "f"]


def test_surrogates_that_collide_draw_again(spark):
    names = [f"{a}{b}" for a in "bcdfglmnprst" for b in ("aria", "olin", "ena", "iko")]
    rows = [(i, f"Mrs {n.capitalize()} Smith{n} wrote to 10.0.0.{i} today") for i, n in enumerate(names)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for limit in (1000, 0):  # through the broadcast and through the join
        got = pii_surrogates.replace_entities(df, b"k", broadcast_rows=limit).collect()
        assert len(got) == len(rows) and all(r["n_entities"] == 3 for r in got)
        given = [r["text"].split()[1] for r in got]
        assert len(set(given)) == len(names)
        assert len({r["text"].split()[5] for r in got}) == len(names)


def test_surrogates_of_mail_addresses_in_any_script(spark):
    mails = ["почта@пример.рф", "用户@例子.公司", "--@--.--", "_@_._", "élan.я@mail.org", "١٢٣@٤٥.org", "한글@도메인.kr"]
    df = spark.createDataFrame([(i, f"({m}) {m.upper()}") for i, m in enumerate(mails)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in pii_surrogates.replace_entities(df, b"k").collect()}
    assert len(got) == len(mails) and all(r["n_entities"] == 2 for r in got.values())
    new = [got[i]["text"].split(") ")[0][1:] for i in range(len(mails))]
    assert len(set(new)) == len(mails) and not set(new) & set(mails)
    for m, x in zip(mails, new):
        local, at = x.split("@")[0], m.split("@")[0]
        assert local != at and x.rpartition(".")[2] == m.rpartition(".")[2] and len(x) == len(m)
    assert set(new[0].split("@")[0]) <= set("абвгдежзийклмнопрстуфхцчшщъыьэюя")


def test_surrogates_of_a_full_format_get_longer(spark, monkeypatch):
    monkeypatch.setattr(pii_surrogates, "WIDEN", 2)
    letters = "abcdefghijklmnopqrstuvwxyz"
    mails = [f"{a}@{b}.co" for a in letters for b in letters]  # every address of the format
    df = spark.createDataFrame([(i, m) for i, m in enumerate(mails)], "doc_id long, text string")
    new = [r["text"] for r in pii_surrogates.replace_entities(df, b"k").collect()]
    assert len(set(new)) == len(mails) and not set(new) & set(mails)



def test_held_out_quality(spark):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    got = queries.QUERIES["op2_quality"](spark, SF).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)
    held = [(r["score"], labels[r["doc_id"]]) for r in got if r["held_out"] and r["doc_id"] in labels]
    pos, neg = [s for s, y in held if y == 1], [s for s, y in held if y == 0]
    auc = np.mean([[(p > n) + 0.5 * (p == n) for n in neg] for p in pos])
    assert auc > 0.9 and np.mean([(s >= 0.5) == y for s, y in held]) > 0.85


def test_toxicity_follows_the_labels(spark):
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    got = queries.QUERIES["op1_toxicity"](spark, SF).collect()
    seen = [(r["rejected"], labels[r["doc_id"]]) for r in got if r["doc_id"] in labels]
    assert np.mean([a == b for a, b in seen]) > 0.93
    assert np.mean([r["rejected"] for r in got]) < 0.2


def test_pipeline_stages_compose(spark):
    import corpus_pipeline as pipeline

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    clean = pipeline.drop_toxic(spark, docs, sf).cache()
    texts = {r["doc_id"]: r["text"] for r in clean.collect()}
    want = line_dedup_brute(sorted(texts.items()))
    lines = pipeline.cut_repeated_lines(spark, clean, sf).cache()
    rows = sorted((r["doc_id"], r["text"]) for r in lines.collect())
    assert {i: hashlib.sha256(t.encode()).hexdigest() for i, t in rows} == {i: x[2] for i, x in want.items()}
    comp = brute_components(rows)
    near = pipeline.drop_near_copies(spark, lines, sf).cache()
    assert sorted(r["doc_id"] for r in near.collect()) == [i for i, _ in rows if comp[i][1] == i]
    assert near.columns == docs.columns == lines.columns == clean.columns
    items = [r["text"] for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    kept = {r["doc_id"] for r in pipeline.drop_contaminated(spark, near, sf).collect()}
    left = {r["doc_id"]: r["text"] for r in near.collect()}
    assert not any(t in left[i] for i in kept for t in items) and len(kept) > 0.8 * len(left)
    out = pipeline.run(spark, sf)
    assert {r["doc_id"] for r in out.select("doc_id").collect()} == kept


@pytest.mark.parametrize("key", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, key):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    res = con.execute(queries.ORACLES[key])
    names, want = [d[0] for d in res.description], res.fetchall()
    df = queries.QUERIES[key](spark, SF)
    assert sorted(names) == sorted(df.columns)
    got = df.select(*names).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want)) and len(got) >= 250


def test_decontamination_fits_on_every_passage(spark):
    """The axes do not depend on how many passages are multiplied at once: all of them enter the fit."""
    r = np.random.default_rng(3)
    text = lambda: " ".join(f"w{int(x)}" for x in r.integers(0, 60, 200))
    docs = spark.createDataFrame([(d, text()) for d in range(40)], "doc_id long, text string")
    bench = decontamination.Benchmark.of([(i, text().encode()) for i in range(3)], decontamination.Params())
    axes = []
    for n in (3, 1000):
        p = decontamination.Params(fit_passages=n, rank=4, oversample=20)
        terms = decontamination._term_table(docs, spark.sparkContext.broadcast(bench.vocab), p, "doc_id", "text").where("passages is null")
        weight = np.linspace(0.1, 2, len(bench.vocab) + 1).astype(np.float32)
        axes.append(decontamination._fit(terms, bench, weight, 40 * 7, p))
    assert np.allclose(np.abs((axes[0] * axes[1]).sum(axis=0)), 1, atol=1e-3)
