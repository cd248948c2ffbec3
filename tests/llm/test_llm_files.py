"""Token segment files, fill-in-middle frames and the source divergence audit: brute force, round trips, edges."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from pickwise.llm import chunks, fim_frames, queries, source_divergence, token_files
from pickwise.llm.queries import tokenizer_file
from pickwise.session import scratch_path

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"word{i % 997} é" for i in range(30_000))
SHAPE = "doc_id long, text string, lang string, source string, doc string, t string, tie string, at long, n long, start string, part string, term string, form string, frames string"
ROWS = [
    (3, "a small text"), (1, "Über <P> marked"), (2, None), (4, ""), (5, LONG), (5, LONG), (5, "another text of document 5"), (None, "no id"),
    (None, "no id"), (-7, "negative id\n\nwith  blanks\tand 世界 <|endoftext|>"), (2**62, "a large id"), (-2**62, " leading blank"),
]


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", f"s{k % 3}", "x", "x", "x", 7, 8, "x", "x", "x", "x", "x") for k, (i, t) in enumerate(rows)], SHAPE)


def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_file("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t


def expected_files(rows):
    """Ids in ascending id order, nulls first; only the order among equal ids is left open."""
    t, out, at = library(), [], 0
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


# --- token files ---------------------------------------------------------------------------
def test_elias_fano_values_and_select():
    rnd = random.Random(4)
    for _ in range(150):
        v = np.sort(np.array([rnd.randrange(rnd.choice([1, 3, 1000, 2**40, 2**64 - 1])) for _ in range(rnd.randrange(900))], np.uint64))
        e = token_files.EliasFano(memoryview(token_files.ef_encode(v)))
        assert (e.values(0, len(v)) == v).all()
        for _ in range(4):
            if len(v):
                i = rnd.randrange(len(v))
                j = rnd.randrange(i, len(v)) + 1
                assert (e.values(i, j) == v[i:j]).all()
                assert e.below(int(v[i])) == int((v < v[i]).sum())
    gaps = np.cumsum(np.random.default_rng(0).integers(1, 1000, 50_000))
    assert len(token_files.ef_encode(gaps)) * 8 / len(gaps) < 11.3  # 64 in a table of offsets


def test_chunked_encoding_equals_the_library():
    t, e = library(), chunks.ChunkEncoder(open(tokenizer_file("byte_bpe_50k.json")).read(), cache_bytes=20_000)
    alphabet = [
        "a", "b", "Z", " ", "  ", "\n", "\n\n", "\t", "é", "世", "'", "s", "'t", "1", "²", "一", "\x1c", "\x85", "\xa0", " ", ".", "-", "́",
        "<|endoftext|>", "\r\n", "​", "'ll ", "🎉", "ß", "ſ", "«", "’", "×", "ª", "½", "—", "\x00",
    ]
    rnd = random.Random(9)
    for _ in range(8000):
        s = "".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 14)))
        assert e.encode(s).tolist() == t.encode(s, add_special_tokens=False).ids, s


def test_token_file_query_against_the_library(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, queries.token_file_query(spark, SF).collect())) == expected_files(rows)


@pytest.mark.parametrize("segment_tokens,task_bytes", [(1 << 20, 1 << 25), (50, 10)])
def test_token_file_edges(spark, segment_tokens, task_bytes):
    path = scratch_path(spark, "tokens")
    docs = table(spark, ROWS).repartition(3)
    token_files.write_token_files(docs, tokenizer_file("byte_bpe_50k.json"), path, 2, segment_tokens=segment_tokens, task_bytes=task_bytes)
    got = sorted(map(tuple, token_files.read_boundaries(spark, path).collect()), key=lambda r: r[1])
    want = expected_files(ROWS)
    assert [r[0] for r in got] == [r[0] for r in want] and got[0][1] == 0
    assert sorted((r[0] is not None, r[0], r[2], r[3]) for r in got if r[0] is not None) == sorted((True, r[0], r[2], r[3]) for r in want if r[0] is not None)
    assert Counter(r[2:] for r in got) == Counter(r[2:] for r in want)
    assert all(a[1] + a[2] == b[1] for a, b in zip(got, got[1:]))
    wanted = spark.createDataFrame([(5,), (5,), (None,), (99,), (-7,), (2**62,)], "doc_id long")
    found = Counter((r.doc_id, len(r.ids)) for r in token_files.fetch_documents(spark, path, wanted).collect())
    assert found == Counter((r[0], r[2]) for r in want if r[0] in (5, -7, 2**62))


def test_token_files_of_an_empty_table(spark):
    path = scratch_path(spark, "tokens")
    token_files.write_token_files(table(spark, []), tokenizer_file("byte_bpe_50k.json"), path, 2)
    assert token_files.read_boundaries(spark, path).count() == 0


# --- fill in the middle ----------------------------------------------------------------------
def brute_fim(i, text):
    t = text or ""
    n, h = len(t), hashlib.sha256(f"1:{'null' if i is None else i}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k:k + 8], 16) for k in (0, 8, 16, 24))
    if not t or any(m in t for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, t
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = t[:a], t[a:b], t[b:]
    out = f"<S>{s}<P>{p}<M>{m}" if h4 % 100 < 20 else f"<P>{p}<S>{s}<M>{m}"
    return n, "spm" if h4 % 100 < 20 else "psm", a, b - a, out


@pytest.mark.parametrize("frame_units", [3, 1 << 14])
def test_fill_in_middle_edges(spark, frame_units):
    rows = ROWS if frame_units > 3 else [(i, t if t != LONG else LONG[:2000]) for i, t in ROWS]
    rows = rows + [(i, f"text {i} <S <M P> " + "äöü世界" * (i % 5)) for i in range(100, 160)]
    path = scratch_path(spark, "frames")
    fim_frames.store_texts(table(spark, rows).repartition(3), path, frame_units)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = Counter((i, *brute_fim(i, t)[:4], sha(brute_fim(i, t)[4]), sha(t or "")) for i, t in rows)
    assert Counter(map(tuple, fim_frames.transform_digests(spark, path).collect())) == want
    texts = Counter()
    for r in fim_frames.transform(spark, path).collect():
        f = fim_frames.Frames([bytes(x) for x in r.frames], list(r.ends))
        text = "".join(f.stream())
        texts[(r.doc_id, text)] += 1
        assert f.units == len(text)
    assert texts == Counter((i, brute_fim(i, t)[4]) for i, t in rows)


def test_only_cut_frames_are_decompressed(monkeypatch):
    text = "".join(chr(97 + i % 26) for i in range(10_000))
    stored = fim_frames.Frames.store(text, 100)
    opened = []
    real = fim_frames._decompress
    monkeypatch.setattr(fim_frames, "_decompress", lambda f: opened.append(1) or real(f))
    out = fim_frames.rearrange(stored, "psm", 1234, 5678)
    assert len(opened) == 4  # each cut frame once for either side
    monkeypatch.undo()
    assert "".join(out.stream()) == f"<P>{text[:1234]}<S>{text[5678:]}<M>{text[1234:5678]}"
    assert "".join(out.stream(1230, 1245)) == "".join(out.stream())[1230:1245]


def test_fill_in_middle_of_an_empty_table(spark):
    path = scratch_path(spark, "frames")
    fim_frames.store_texts(table(spark, []), path)
    assert fim_frames.transform_digests(spark, path).count() == 0


# --- source divergence -----------------------------------------------------------------------
def brute_audit(rows, min_docs=10, top=10):
    rows = [tuple(x or "" for x in r) for r in rows]
    docs = [(la, so, [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", t)]) for la, so, t in rows]
    df, counts, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for la, so, ws in docs:
        df[la].update(set(ws))
        counts[la, so].update(ws)
        groups[la].add(so)
    out = []
    for la, sources in groups.items():
        kept = sorted(t for t, n in df[la].items() if n >= min_docs)
        v = len(kept)
        number = {so: {t: counts[la, so][t] for t in kept} for so in sources}
        whole = {t: sum(number[so][t] for so in sources) for t in kept}
        p = lambda c: {t: 1 + 10**9 * (c[t] + 2) // (sum(c.values()) + 2 * v) for t in kept}
        probs, q = {so: p(number[so]) for so in sources}, p(whole)
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for so in sources:
            pairs = [(-sum(f(probs[so][t], probs[o][t]) for t in kept), o.encode(), o) for o in sources if o != so]
            out += [(la, so, "pair", o, -x, r) for r, (x, _, o) in enumerate(sorted(pairs), 1)]
            terms = [(-f(probs[so][t], q[t]), t.encode(), t) for t in kept if number[so][t] and probs[so][t] > q[t]]
            out += [(la, so, "term", t, -x, r) for r, (x, _, t) in enumerate(sorted(terms)[:top], 1)]
    return sorted(out)


def audit_rows(seed, n, sources):
    rnd = random.Random(seed)
    words = ["The", "the", "ÄPFEL", "äpfel", "x1y", "don't", "世界", "z"] + [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(120)]
    rows = [(rnd.choice(["en", "en", "en", "", None, "rare"]), rnd.choice(sources), " ".join(rnd.choices(words, k=rnd.randint(0, 25)))) for _ in range(n)]
    return rows + [("one", "alone", "a b c")] * 12 + [("en", "silent", None), ("en", None, "123 ..."), ("none", "a", ""), ("none", "b", None)]


SOURCES = ["src", "Src", "日本", None, "", "a b", "é", "z"]


@pytest.mark.parametrize("knobs", [{}, {"max_cells": 20, "source_block": 3, "task_cells": 40}])
def test_audit_against_brute_force(spark, knobs):
    rows = audit_rows(3, 400, SOURCES)
    docs = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], "lang string, source string, text string, no int, term string, share string").repartition(5)
    got = source_divergence.audit(docs, **knobs)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == brute_audit(rows)


def test_audit_merges_a_term_over_many_spills(spark):
    rows = [("en", f"s{i % 2}", "common " * 3 + f"only{chr(97 + i % 26)}") for i in range(300)]
    docs = spark.createDataFrame(rows, "lang string, source string, text string").repartition(6)
    got = source_divergence.audit(docs, max_cells=1)
    assert sorted(map(tuple, got.collect())) == brute_audit(rows)


def test_audit_of_an_empty_table(spark):
    assert source_divergence.audit(spark.createDataFrame([], "lang string, source string, text string")).count() == 0


def test_probabilities_are_exact_for_large_counts():
    rnd = random.Random(1)
    for _ in range(500):
        v, total = rnd.randrange(1, 10**9), rnd.randrange(0, 8 * 10**15)
        c = rnd.randrange(0, total + 1)
        assert int(source_divergence.probabilities(np.array([c]), total, v)[0]) == 1 + 10**9 * (c + 2) // (total + 2 * v)
