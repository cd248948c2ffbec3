"""Personal data: keyed, type-consistent surrogates.

Detected entities (mail addresses, phone numbers, card and account numbers, national
numbers, IP addresses, access tokens, person names) are replaced, not masked. The surrogate
of an entity follows from a secret key and the entity's canonical form alone, so the same
person or number gets the same surrogate in every document (coreference), on every executor,
without a table. It keeps type and format: digits stay digits, letters keep case and script
(a mail address whose local part has none gets some), separators and lengths stay, a card
number that passes the Luhn check still does, names keep gender and script.

Distinctness is checked, not hoped for: the distinct entities of the corpus are drawn
surrogates, and an entity whose surrogate another one also got (all but the smallest), or
whose surrogate is itself an entity of the corpus, draws again. Only the entities that drew
again travel to the documents: broadcast while they are few (``broadcast_rows``), and beyond
that joined to the documents that mention them.
"""

from __future__ import annotations

import hashlib
import hmac
import re
import sys

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pickwise.llm.common import batch
from pickwise.session import cut_lineage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BROADCAST_ROWS = 100_000
MOST_DRAWS = 64
WIDEN = 8  # draws after which a mail's local part or a phone number gets longer, by one more each time

# Given names by (script, gender), and titles by gender
GIVEN = {
    ("latin", "f"): "Alice Anna Carmen Claire Clara Elena Emma Eva Helen Ines Julia Laura Lucia Maria Marta Nina Olga Paula Rosa Sofia".split(),
    ("latin", "m"): "Adam Carlos Daniel David Emil Felix Hans Hugo Ivan Jan Karl Louis Marco Mario Martin Oscar Pablo Paul Peter Thomas".split(),
    ("cyrillic", "f"): "Анна Вера Дарья Елена Ирина Мария Наталья Ольга Светлана Татьяна".split(),
    ("cyrillic", "m"): "Андрей Борис Виктор Дмитрий Иван Михаил Николай Олег Павел Сергей".split(),
}
TITLES = {
    "f": "Mrs Ms Miss Mme Madame Frau Señora Sra Госпожа".split(),
    "m": "Mr Mister Monsieur Herr Señor Sr Господин".split(),
    "": "Dr Prof Доктор".split(),
}
# parts of surnames, by script
SYLLABLES = {
    "latin": "bar bel cor dal den fer gan gor har hol kel kor lan len mar mel nor pel ral ren sal sen tal ten tor val ver wel wil zan".split(),
    "cyrillic": "бар бел вар вол гор дан дол кар ков лан мар мел нов пет рад ров сал сем тар юрь".split(),
}
# letters by range of characters
LATIN = "abcdefghijklmnopqrstuvwxyz"
LETTERS = [
    (lo, hi, "".join(chr(c) for c in range(ord(a), ord(b) + 1) if chr(c) != "ς"))
    for lo, hi, a, b in (
        ("A", "z", "a", "z"), ("Ͱ", "Ͽ", "α", "ω"), ("Ѐ", "ԯ", "а", "я"), ("א", "ת", "א", "ת"), ("ء", "ۿ", "ف", "ي"), ("ऄ", "ह", "क", "ह"),
        ("ก", "ฮ", "ก", "ฮ"), ("ぁ", "ゖ", "か", "ど"), ("ァ", "ヺ", "カ", "ド"), ("㐀", "鿿", "一", "龥"), ("가", "힣", "가", "힣"),
    )
]
GENDER_OF = {name: g for (_, g), names in GIVEN.items() for name in names}
TITLE_GENDER = {t: g for g, ts in TITLES.items() for t in ts}

_CAP = r"[A-ZÀ-ÖØ-ÞА-Я][a-zß-öø-ÿа-яё'’-]+"
_NAME = re.compile(
    rf"\b(?:(?P<title>{'|'.join(sorted(TITLE_GENDER, key=len, reverse=True))})\.?[ \t]+(?P<one>{_CAP})(?:[ \t]+(?P<two>{_CAP}))?"
    rf"|(?P<given>{'|'.join(sorted(GENDER_OF, key=len, reverse=True))})[ \t]+(?P<family>{_CAP}))(?!\w)"
)
_MAIL = re.compile(r"(?<![\w.+-])[\w+-]+(?:\.[\w+-]+)*@[\w-]+(?:\.[\w-]+)+")
_TOKEN = re.compile(r"(?<![0-9A-Za-z])(?:[0-9a-f]{32,128}|[0-9A-F]{32,128}|AKIA[0-9A-Z]{16}|gh[pousr]_[0-9A-Za-z]{36})(?![0-9A-Za-z])")
_IBAN = re.compile(r"(?<![0-9A-Za-z])[A-Z]{2}\d{2}(?: ?[0-9A-Z]{4}){3,7}(?: ?[0-9A-Z]{1,3})?(?![0-9A-Za-z])")
_IP = re.compile(r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d]|\.\d)")
_CARD = re.compile(r"(?<![\w+])(?:\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{1,7}|\d{13,19})(?!\w)")
_SSN = re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])")
_PHONE = re.compile(r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])\d{3,4}[ .-]?\d{3,4}(?!\w)|(?<![\w+])\+\d{8,14}(?!\w)")
_DIGIT = re.compile(r"\d")

Mention = tuple[int, int, str, str]  # start, end, kind, canonical form


def mentions(text: str) -> list[Mention]:
    """Entities of a text from left to right, without overlaps (the kinds named first win)."""
    found: list[Mention] = []
    if "@" in text:
        found += [(m.start(), m.end(), "mail", m.group().lower()) for m in _MAIL.finditer(text)]
    found += [(m.start(), m.end(), "token", m.group()) for m in _TOKEN.finditer(text)]
    if _DIGIT.search(text):
        found += [(m.start(), m.end(), "iban", m.group().replace(" ", "")) for m in _IBAN.finditer(text)]
        found += [(m.start(), m.end(), "ip", m.group()) for m in _IP.finditer(text)]
        for kind, rule in (("card", _CARD), ("ssn", _SSN), ("phone", _PHONE)):
            found += [(m.start(), m.end(), kind, re.sub(r"\D", "", m.group())) for m in rule.finditer(text)]
    for m in _NAME.finditer(text):
        if m["title"]:
            start, parts = m.start("one"), [m["one"], m["two"]] if m["two"] else [m["one"]]
            gender = TITLE_GENDER[m["title"]] or GENDER_OF.get(m["one"], "")
        else:
            start, parts = m.start(), [m["given"], m["family"]]
            gender = GENDER_OF[m["given"]]
        if len(parts) == 2:
            found.append((start, start + len(parts[0]), f"given-{gender}", parts[0].casefold()))
        found.append((m.end() - len(parts[-1]), m.end(), "family", parts[-1].casefold()))
    kinds = {"mail": 0, "token": 1, "iban": 2, "ip": 3, "card": 4, "ssn": 5, "phone": 6}
    out, taken = [], []
    for x in sorted(found, key=lambda x: (kinds.get(x[2], 7), x[0])):
        if all(x[1] <= a or x[0] >= b for a, b in taken):
            out.append(x)
            taken.append((x[0], x[1]))
    return sorted(out)


def _luhn(digits: str) -> int:
    return sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(int(c) for c in reversed(digits))) % 10


class Draw:
    """Keyed stream of small numbers for one (kind, entity, attempt)."""

    def __init__(self, key: bytes, kind: str, entity: str, attempt: int):
        self.seed, self.block, self.pool = (key, f"{kind}|{attempt}|{entity}".encode()), 0, b""

    def below(self, n: int) -> int:
        while len(self.pool) < 4:
            self.pool += hmac.new(self.seed[0], self.seed[1] + self.block.to_bytes(4, "big"), hashlib.sha256).digest()
            self.block += 1
        x, self.pool = int.from_bytes(self.pool[:4], "big"), self.pool[4:]
        return x % n

    def like(self, text: str) -> str:
        """Every digit and letter replaced by one of its kind and script (Latin for scripts not in ``LETTERS``)."""
        out = []
        for c in text:
            if c.isdecimal():
                out.append(chr(ord(c) - int(c) + self.below(10)))
            elif c.isalpha():
                letters = next((x for lo, hi, x in LETTERS if lo <= c <= hi), LATIN)
                new = letters[self.below(len(letters))]
                out.append(new.upper() if c.isupper() else new)
            elif c.isalnum():  # other numbers: superscripts, fractions
                out.append(chr(48 + self.below(10)))
            else:
                out.append(c)
        return "".join(out)

    def letters(self, n: int) -> str:
        return "".join(LATIN[self.below(26)] for _ in range(n))


def script_of(text: str) -> str:
    return "cyrillic" if re.search(r"[Ѐ-ӿ]", text) else "latin"


def surrogate(key: bytes, kind: str, entity: str, attempt: int = 0) -> str:
    """Canonical form of the surrogate of a canonical entity."""
    d = Draw(key, kind, entity, attempt)
    if kind == "mail":
        local, _, domain = entity.partition("@")
        host, _, top = domain.rpartition(".")
        new = d.like(local) if any(c.isalnum() for c in local) else d.letters(len(local))
        return f"{new}{d.letters(attempt // WIDEN)}@{d.like(host)}.{top}"
    if kind == "token":
        digits = "0123456789abcdef" if not re.search("[g-zG-Z_]", entity) else ""
        if not digits:
            n = 4
            return entity[:n] + d.like(entity[n:])
        upper = entity.upper() == entity and entity.lower() != entity
        s = "".join(digits[d.below(16)] for _ in entity)
        return s.upper() if upper else s
    if kind == "ip":
        a = entity.split(".")
        keep = 0 if attempt >= 16 else 2 if a[:2] == ["192", "168"] else 1 if a[0] in ("10", "127") else 0
        first = [x for x in range(1, 224) if x not in (10, 127, 192)]
        new = [str(first[d.below(len(first))] if i == 0 else 1 + d.below(254)) for i in range(keep, 4)]
        return ".".join(a[:keep] + new)
    if kind == "iban":
        return entity[:2] + d.like(entity[2:])
    if kind == "card":
        body = entity[0] + d.like(entity[1:])
        if _luhn(entity) == 0:
            body = next(body[:-1] + c for c in "0123456789" if _luhn(body[:-1] + c) == 0)
        return body
    if kind in ("phone", "ssn"):
        new = "".join(str(1 + d.below(9)) if c != "0" else "0" if i == 0 else str(d.below(10)) for i, c in enumerate(entity))
        return new + "".join(str(d.below(10)) for _ in range(attempt // WIDEN if kind == "phone" else 0))
    script = script_of(entity)
    if kind.startswith("given"):
        names = GIVEN[(script, kind[-1])] if kind[-1] in "fm" else GIVEN[(script, "f")] + GIVEN[(script, "m")]
        n = len(names)
        name = names[d.below(n)].casefold()
        parts = SYLLABLES[script]
        return "-".join([name, *(["".join(parts[d.below(len(parts))] for _ in range(attempt // 3))] if attempt >= 3 else [])])
    parts = SYLLABLES[script]
    return "".join(parts[d.below(len(parts))] for _ in range(3 + attempt // 4))


def dress(kind: str, mention: str, new: str) -> str:
    """The surrogate in the written form of a mention: separators, case."""
    if kind in ("card", "ssn", "phone", "iban"):
        left = iter(new)
        return "".join([*(next(left) if c.isalnum() else c for c in mention), *left])
    if kind == "mail":
        return new.upper() if mention.isupper() else new
    if kind in ("token", "ip"):
        return new
    if mention.isupper():
        return new.upper()
    return "-".join(x.capitalize() for x in new.split("-"))


def replace(text: str, key: bytes, attempts: dict[tuple[str, str], int]) -> tuple[str, int]:
    out, at, found = [], 0, mentions(text)
    for start, end, kind, entity in found:
        new = surrogate(key, kind, entity, attempts.get((kind, entity), 0))
        out += [text[at:start], dress(kind, text[start:end], new)]
        at = end
    return "".join([*out, text[at:]]), len(found)


def _family(kind):
    """Given names of one script share a space whatever their gender; other kinds have one each."""
    return F.when(F.col(kind).startswith("given"), F.lit("given")).otherwise(F.col(kind))


ENTITIES = pa.schema([("id", pa.int64()), ("kind", pa.string()), ("entity", pa.string())])


def find_entities(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, kind, entity)``: distinct entities of every document."""
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))

    def run(batches):
        for b in batches:
            rows = [(i, *e) for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) for e in sorted({m[2:] for m in mentions(t)})]
            if rows:
                yield batch(ENTITIES, *map(list, zip(*rows)))

    return src.mapInArrow(run, "id long, kind string, entity string")


def resolve(entities: DataFrame, key: bytes) -> DataFrame:
    """``(kind, entity, attempt)`` of the entities that had to draw again, for distinct surrogates.

    ``entities`` holds distinct ``(kind, entity)``. Given names share few surrogates by nature (a
    list of names per gender): they are kept apart within their gender up to the list's size and
    beyond it by a second part. Raises if a kind's format has no free surrogate left after
    ``MOST_DRAWS`` draws (a corpus that holds nearly all numbers of one format); mail addresses and
    phone numbers get longer before that."""

    def draw(frames):
        for pdf in frames:
            new = [surrogate(key, k, e, a) for k, e, a in zip(pdf["kind"], pdf["entity"], pdf["attempt"])]
            yield pdf[["kind", "entity", "attempt"]].assign(new=pd.Series(new, dtype=object))

    shape = "kind string, entity string, attempt int, new string"
    drawn = cut_lineage(entities.withColumn("attempt", F.lit(0)).mapInPandas(draw, shape))
    for _ in range(MOST_DRAWS):
        space = drawn.withColumn("space", _family("kind"))
        first = space.groupBy("space", "new").agg(F.count("*").alias("c"), F.min(F.struct("kind", "entity")).alias("first")).where("c > 1")
        twice = space.join(first, ["space", "new"]).where(F.struct("kind", "entity") != F.col("first")).select("kind", "entity")
        real = drawn.select(_family("kind").alias("space"), F.col("entity").alias("new")).distinct()
        same = space.join(real, ["space", "new"], "left_semi").select("kind", "entity")
        again = cut_lineage(twice.union(same).distinct())
        if again.isEmpty():
            return drawn.where("attempt > 0").select("kind", "entity", "attempt")
        more = drawn.join(again, ["kind", "entity"]).withColumn("attempt", F.col("attempt") + 1)
        rest = drawn.join(again, ["kind", "entity"], "left_anti")
        drawn = cut_lineage(rest.unionByName(more.select("kind", "entity", "attempt").mapInPandas(draw, shape)))
    raise ValueError("no distinct surrogates are left for some kind of entity")


def replace_entities(
    docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text", broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """All columns, with surrogates in ``text_col``, plus ``n_entities`` (a column of that name is replaced).

    Null texts stay null, with no entities; texts without entities stay as they are. Repeated rows get
    the same surrogates. A null id is allowed. An empty table stays empty."""
    spark = docs.sparkSession
    entities = find_entities(docs, id_col, text_col)
    again = cut_lineage(resolve(entities.select("kind", "entity").distinct(), key))
    n = again.count()
    keep = [c for c in docs.columns if c not in (text_col, "n_entities")]
    src = docs.select(F.col(id_col).cast("long").alias("__id"), F.col(text_col).alias("__t"), F.struct(*keep).alias("__row"))
    known: dict = {}
    if n <= broadcast_rows:
        known = {(r["kind"], r["entity"]): r["attempt"] for r in again.toLocalIterator()}
        src = src.withColumn("__again", F.lit(None).cast("array<struct<kind:string,entity:string,attempt:int>>"))
    else:
        per_doc = entities.join(again, ["kind", "entity"]).groupBy("id").agg(F.collect_set(F.struct("kind", "entity", "attempt")).alias("__again"))
        src = src.join(per_doc, F.col("__id").eqNullSafe(F.col("id")), "left")
    shared = spark.sparkContext.broadcast(known)

    def run(batches):
        for b in batches:
            texts, counts = [], []
            for t, extra in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                attempts = {(x["kind"], x["entity"]): x["attempt"] for x in extra} if extra else shared.value
                new, k = (None, 0) if t is None else replace(t, key, attempts)
                texts.append(new)
                counts.append(k)
            yield pa.RecordBatch.from_arrays([b.column(2), pa.array(texts, pa.string()), pa.array(counts, pa.int64())], names=["row", "text", "n_entities"])

    src = src.select("__t", "__again", "__row")
    row = src.schema["__row"].dataType.simpleString()
    got = src.mapInArrow(run, f"row {row}, text string, n_entities long")
    cols = [F.col("text").alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in docs.columns if c != "n_entities"]
    return got.select(*cols, "n_entities")
