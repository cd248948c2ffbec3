"""Exact merge-type (BPE) SentencePiece encoding by backtracking, and decoding.

Instead of running the merge queue, a piece sequence is searched from left to right:

1. an Aho-Corasick automaton over the reversed pieces gives, in one pass from the end of
   a chunk, the longest piece that starts at every position;
2. a piece may follow another only if re-merging the two pieces' characters gives exactly
   these two pieces again; if not, the next shorter piece that is a prefix is tried;
3. a position from which no piece fits is recorded in a bitfield of failed positions, the
   last piece is taken back, and no later attempt ends at that position again.

A text is cut where no piece can span: before a word mark that follows another character, at
characters that occur in no piece, and between punctuation and other characters as far as no
piece joins them. Results of chunks are cached per worker process, from task to task, as are transitions of the automaton and
compatible pairs: ``CACHE_BYTES``, ``MAX_JUMPS`` and ``MAX_PAIRS`` bound them to about 85 MB together. Chunks carry blanks for marks, so that most take a byte a character.
"""

from __future__ import annotations

import hashlib
import re
import struct
import sys
from collections import defaultdict, deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pickwise.llm.common import TwoGenerations, batch, text_bytes, worker_held

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MARK = "▁"
CACHE_BYTES = 32 << 20
MAX_JUMPS = 250_000    # about 100 bytes each
MAX_PAIRS = 150_000    # about 160 bytes each
NEVER = float("-inf")   # the score of no merge
REACH, FAIL = "", "fail"
NONE: dict = {}
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
# fixed values of the public model file format: piece types
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def _varint(b: bytes, i: int) -> tuple[int, int]:
    r = s = 0
    while True:
        x = b[i]
        i += 1
        r |= (x & 127) << s
        s += 7
        if x < 128:
            return r, i


def _fields(b: bytes) -> Iterator[tuple[int, object]]:
    """(field number, value) of one protocol-buffer message."""
    i = 0
    while i < len(b):
        key, i = _varint(b, i)
        wire = key & 7
        if wire == 0:
            v, i = _varint(b, i)
        elif wire == 2:
            n, i = _varint(b, i)
            v, i = b[i:i + n], i + n
        else:
            n = 8 if wire == 1 else 4
            v, i = b[i:i + n], i + n
        yield key >> 3, v


def parse_model(raw: bytes) -> dict:
    """Pieces ``(text, score, type)`` and the flags the codec needs. Raises if the file asks for
    what this codec does not do (another model type, text normalisation, user-defined symbols)."""
    pieces, norm, kind, fallback = [], {}, 1, False
    for f, v in _fields(raw):
        if f == 1:
            d = dict(_fields(v))
            pieces.append((d[1].decode(), struct.unpack("<f", d.get(2, b"\0\0\0\0"))[0], d.get(3, NORMAL)))
        elif f == 2:
            t = dict(_fields(v))
            kind, fallback = t.get(3, 1), bool(t.get(35, 0))
        elif f == 3:
            norm = dict(_fields(v))
    if kind != 2:
        raise ValueError("not a merge-type (BPE) model")
    if norm.get(2) or norm.get(4, 1) or not norm.get(5, 1):
        raise ValueError("models that normalise text or drop white space are not supported")
    if any(p[2] in (USER_DEFINED, UNUSED) for p in pieces):
        raise ValueError("user-defined and unused pieces are not supported")
    return {"pieces": pieces, "dummy_prefix": bool(norm.get(3, 1)), "byte_fallback": fallback}


class Codec:
    """Encoder and decoder of one parsed model."""

    def __init__(self, model: dict, cache_bytes: int = CACHE_BYTES, cache_chars: int = 48):
        self.pieces = [p[0] for p in model["pieces"]]
        self.number = [str(i) for i in range(len(self.pieces))]
        self.kinds = [p[2] for p in model["pieces"]]
        self.score = {p: s for p, s, t in model["pieces"] if t == NORMAL}
        self.ids = {p: i for i, (p, _, t) in enumerate(model["pieces"]) if t == NORMAL}
        self.unknown = next(i for i, t in enumerate(self.kinds) if t == UNKNOWN)
        self.byte_ids = {int(p[3:5], 16): i for i, (p, _, t) in enumerate(model["pieces"]) if t == BYTE}
        self.byte_of = {i: b for b, i in self.byte_ids.items()}
        self.dummy_prefix, self.fallback = model["dummy_prefix"], model["byte_fallback"]
        # per left piece its verdicts by right piece, at most MAX_PAIRS of them; the pieces' own merges
        self.verdicts: defaultdict[str, dict[str, bool]] = defaultdict(dict)
        self.n_verdicts, self.merges = 0, {}
        self.number_of = {p: self.number[i] for p, i in self.ids.items()}
        # the piece must come out of its own merge, or it can never be produced
        self.usable = {p for p in self.ids if len(p) == 1 or self.merge(p) == [p]}
        self.shorter = {p: self._shorter(p) for p in self.usable if len(p) > 1}
        self._automaton()
        # two characters that no piece holds side by side are never in one piece
        self.bigrams = {p[i:i + 2] for p in self.usable for i in range(len(p) - 1)}
        alphabet = {c for p in self.ids for c in p}
        inner_mark = any(MARK in p.lstrip(MARK) for p in self.ids)
        # characters that stand apart: white space other than the mark, if in no piece
        apart = "".join(re.escape(c) for c in "\n\t\r" if c not in alphabet)
        cut = f"[{apart}]|" if apart else ""
        word = rf" *[^ {apart}]+"
        letters, signs = self._apart_from_signs(alphabet)
        if letters and signs:
            word = rf" *[{letters}]+(?=[{signs} {apart}]|\Z)|[{signs}]+(?=[{letters} {apart}]|\Z)|{word}"
        self.chunk = re.compile(rf"{cut}.+", re.S) if inner_mark else re.compile(rf"{cut}{word}| +")
        self.cache = TwoGenerations(self._chunk_result, cache_bytes, cache_chars)

    def _apart_from_signs(self, alphabet: set[str]) -> tuple[str, str]:
        """Latin letters of the model, and the punctuation that no piece joins with any of them."""
        letters = {c for c in alphabet if c.isalpha() and c < "\u0250"}
        joined = {b if a in letters else a for a, b in self.bigrams if a in letters or b in letters}
        return "".join(sorted(letters)), "".join(re.escape(c) for c in PUNCTUATION if c not in joined)

    # --- merging --------------------------------------------------------------------
    def merge(self, text: str) -> list[str]:
        """Pieces of a short string by repeated best merge (highest score, then leftmost)."""
        parts, score = list(text), self.score
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _merges(self, piece: str) -> tuple[tuple, tuple, tuple]:
        """The merges that make a usable piece: their scores in order, and before each of them (and after the
        last) the piece's first and last part. Kept per piece of the vocabulary."""
        known = self.merges.get(piece)
        if known is not None:
            return known
        parts, score = list(piece), self.score
        scores, heads, tails = [], [parts[0]], [parts[-1]]
        while len(parts) > 1:
            found = [score.get(a + b, NEVER) for a, b in zip(parts, parts[1:])]
            best = max(found)
            at = found.index(best)
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            scores.append(best)
            heads.append(sys.intern(parts[0]))
            tails.append(sys.intern(parts[-1]))
        known = (*scores, NEVER), tuple(heads), tuple(tails)
        if len(piece) > 1:
            self.merges[piece] = known
        return known

    def compatible(self, left: str, right: str) -> bool:
        """Whether merging the two pieces' characters together gives these two pieces.

        Until a merge crosses their border, the two merge as they do alone, in turns by score (then leftmost),
        so only the parts at the border are looked at."""
        (mine, _, tails), (other, heads, _) = self._merges(left), self._merges(right)
        score, i, j = self.score, 0, 0
        cross = score.get(tails[0] + heads[0], NEVER)
        while True:
            a, b = mine[i], other[j]
            if cross > a and cross >= b:
                return False
            if a >= b:
                if a == NEVER:
                    return True
                i += 1
                moved = tails[i] is not tails[i - 1]
            else:
                j += 1
                moved = heads[j] is not heads[j - 1]
            if moved:
                cross = score.get(tails[i] + heads[j], NEVER)

    def verdict(self, left: str, right: str) -> bool:
        """``compatible``, kept for the first ``MAX_PAIRS`` pairs."""
        ok = self.compatible(left, right)
        if self.n_verdicts < MAX_PAIRS:
            self.verdicts[left][right] = ok
            self.n_verdicts += 1
        return ok

    # --- longest matches ------------------------------------------------------------
    def _shorter(self, piece: str) -> str:
        for n in range(len(piece) - 1, 1, -1):
            if piece[:n] in self.usable:
                return piece[:n]
        return piece[0]

    def _automaton(self) -> None:
        """States are dictionaries from a character to the next state; under ``REACH`` and ``FAIL`` (never
        a character) they hold the length of their longest piece and the state of the next shorter match."""
        self.root = root = {REACH: 1}
        for p in self.usable:
            if len(p) == 1:
                continue
            at = root
            for c in reversed(p):
                at = at.setdefault(c, {REACH: 1})
            at[REACH] = len(p)
        root[FAIL] = root
        todo = deque((root, c, s) for c, s in root.items() if len(c) == 1)
        while todo:
            parent, c, state = todo.popleft()
            todo.extend((state, d, s) for d, s in state.items() if len(d) == 1)
            f = parent[FAIL]
            while f is not root and c not in f:
                f = f[FAIL]
            state[FAIL] = root if parent is root else f.get(c, root)
            state[REACH] = max(state[REACH], state[FAIL][REACH])
        self.jumps = 0

    def longest_at(self, s: str) -> list[int]:
        """Length of the longest piece starting at each position (1 if only the character).

        A transition found by following failure links is added to its state, so that a character
        usually costs one look-up; the number of those added is bounded."""
        out, at = [], self.root
        for c in reversed(s):
            try:
                at = at[c]
            except KeyError:
                at = self._follow(at, c)
            out.append(at[REACH])
        out.reverse()
        return out

    def _follow(self, state: dict, c: str) -> dict:
        root, f = self.root, state[FAIL]
        while f is not root and c not in f:
            f = f[FAIL]
        to = f.get(c, root)
        if self.jumps < MAX_JUMPS:
            state[c] = to
            self.jumps += 1
        return to

    # --- encoding -------------------------------------------------------------------
    def spans(self, s: str) -> list[str]:
        """A chunk cut wherever no piece can hold the two neighbouring characters."""
        bigrams = self.bigrams
        cuts = [i + 1 for i, c in enumerate(map(str.__add__, s, s[1:])) if c not in bigrams]
        if not cuts:
            return [s]
        return [s[i:j] for i, j in zip([0, *cuts], [*cuts, len(s)])]

    def split(self, s: str) -> list[str]:
        """Piece texts of one chunk (characters in no piece stand alone)."""
        n = len(s)
        if n < 2 or s in self.usable:
            return [s] if s else []
        reach, shorter, verdicts, verdict = self.longest_at(s), self.shorter, self.verdicts, self.verdict
        failed, out, pos, last, after = 0, [], 0, None, NONE
        piece = s[:reach[0]]
        while True:
            end = pos + len(piece)
            if not (failed and (failed >> end) & 1):
                ok = last is None or after.get(piece)
                if ok or ok is None and verdict(last, piece):
                    out.append(piece)
                    if end == n:
                        return out
                    pos, last = end, piece
                    after = verdicts.get(piece, NONE)
                    piece = s[pos:pos + reach[pos]]
                    continue
            if end - pos > 1:
                piece = shorter[piece]
                continue
            if last is None:
                raise AssertionError("no piece sequence found")
            failed |= 1 << pos
            piece = out.pop()
            pos -= len(piece)
            last = out[-1] if out else None
            after = verdicts.get(last, NONE)

    def piece_ids(self, piece: str) -> list[int]:
        i = self.ids.get(piece)
        if i is not None:
            return [i]
        if self.fallback:
            return [self.byte_ids[b] for b in piece.encode()]
        return [self.unknown]

    def chunks(self, text: str) -> list[str]:
        """Chunks of a text, with blanks for marks."""
        if not text:
            return []
        s = text.replace(MARK, " ")
        return self.chunk.findall(" " + s if self.dummy_prefix else s)

    def encode(self, text: str) -> list[int]:
        return [i for c in self.chunks(text) for x in self.spans(c.replace(" ", MARK)) for p in self.split(x) for i in self.piece_ids(p)]

    # --- decoding -------------------------------------------------------------------
    def decode_raw(self, ids: list[int]) -> str:
        """Text of the ids before the leading dummy space is dropped."""
        if NORMAL == max(map(self.kinds.__getitem__, ids), default=NORMAL):
            return "".join(map(self.pieces.__getitem__, ids)).replace(MARK, " ")
        out, pending = [], bytearray()
        for i in ids:
            if self.kinds[i] == BYTE:
                pending.append(self.byte_of[i])
                continue
            if pending:
                out.append(_utf8(bytes(pending)))
                pending.clear()
            if self.kinds[i] == UNKNOWN:
                out.append(" ⁇ ")
            elif self.kinds[i] != CONTROL:
                out.append(self.pieces[i].replace(MARK, " "))
        if pending:
            out.append(_utf8(bytes(pending)))
        return "".join(out)

    def decode(self, ids: list[int]) -> str:
        s = self.decode_raw(ids)
        lead = next((i for i in ids if self.kinds[i] != CONTROL), None)
        if self.dummy_prefix and lead is not None and self.kinds[lead] == NORMAL and s.startswith(" "):
            return s[1:]
        return s

    def _chunk_result(self, chunk: str) -> str | tuple[str, str]:
        """The chunk's ids joined by commas, and what they decode to unless that is the chunk."""
        marked = chunk.replace(" ", MARK)
        if len(chunk) <= self.cache.longest:
            pieces = self.split(marked)
            try:
                joined = ",".join([self.number_of[p] for p in pieces])
            except KeyError:  # some character is in no piece
                pass
            else:  # normal pieces decode to their own text
                text = "".join(pieces).replace(MARK, " ")
                return joined if text == chunk else (joined, text)
        spans = self.spans(marked)
        if len(spans) > 1 and len(chunk) <= 4 * self.cache.longest:
            found = [self.cache[x.replace(MARK, " ")] for x in spans]
            if all(isinstance(x, str) for x in found):
                return ",".join(found)
        ids = [i for x in spans for p in self.split(x) for i in self.piece_ids(p)]
        joined, text = ",".join([self.number[i] for i in ids]), self.decode_raw(ids)
        return joined if text == chunk else (joined, text)

    def digest(self, text: str) -> tuple[int, str, str]:
        """(number of ids, ids joined by commas, decoded text) through the chunk cache."""
        chunks = self.chunks(text)
        if not chunks:
            return 0, "", ""
        found = list(map(self.cache.__getitem__, chunks))
        try:
            ids, s = ",".join(found), "".join(chunks)
        except TypeError:  # some chunk decodes to something else
            pairs = [(x, c) if isinstance(x, str) else x for x, c in zip(found, chunks)]
            ids, s = ",".join([x for x, _ in pairs]), "".join([t for _, t in pairs])
        lead = int(ids[:8].partition(",")[0])
        if self.dummy_prefix and self.kinds[lead] == NORMAL and s.startswith(" "):
            s = s[1:]
        return ids.count(",") + 1, ids, s


def _utf8(b: bytes) -> str:
    """Bytes as text; every byte that is not part of a character becomes U+FFFD."""
    try:
        return b.decode()
    except UnicodeDecodeError:
        out, i = [], 0
        while i < len(b):
            for n in (1, 2, 3, 4):
                try:
                    out.append(b[i:i + n].decode())
                    break
                except UnicodeDecodeError:
                    continue
            else:
                n = 1
                out.append("�")
            i += n
        return "".join(out)


def codec_of(raw: bytes) -> Codec:
    """One codec per worker process, of the model used last; later tasks find it with what it has cached."""
    held, key = worker_held("codec"), hashlib.sha256(raw).hexdigest()
    if held.get("key") != key:
        held.pop("codec", None)
        held.update(codec=Codec(parse_model(raw)), key=key)
    return held["codec"]


SCHEMA = "n_tokens long, ids array<int>, decoded string"
DIGESTS = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])


def encode_documents(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_tokens, ids, decoded)`` for every row: piece ids and the text they decode to.

    A null or empty text has no ids and decodes to the empty text; repeated rows are encoded
    each; other columns are ignored, whatever their names. The model file is read by the
    driver and sent to the workers (its size does not depend on the data)."""
    raw = docs.sparkSession.sparkContext.broadcast(open(model_file, "rb").read())
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_bytes(text_col).alias("__t"))
    out = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())])

    def run(batches):
        codec = codec_of(raw.value)
        for b in batches:
            ids = [codec.encode(t.decode(errors="replace")) for t in b.column(1).to_pylist()]
            yield batch(out, b.column(0), [len(i) for i in ids], ids, [codec.decode(i) for i in ids])

    return src.mapInArrow(run, f"doc_id long, {SCHEMA}")


def encode_digests(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)``: digests of what ``encode_documents``
    returns, without moving the ids. Same cases, same results."""
    raw = docs.sparkSession.sparkContext.broadcast(open(model_file, "rb").read())
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_bytes(text_col).alias("__t"))

    def run(batches):
        codec = codec_of(raw.value)
        for b in batches:
            rows = []
            for t in b.column(1):
                n, ids, text = codec.digest(t.as_py().decode(errors="replace"))
                rows.append((n, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
            yield batch(DIGESTS, b.column(0), *(map(list, zip(*rows)) if rows else ([], [], [])))

    return src.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
