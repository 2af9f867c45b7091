"""Surrogates for personal data: keyed, type-consistent, distinct, coreferent.

Entities (mail addresses, phones, IP addresses, card and account numbers,
secrets, titled person names) are found in whole texts. Each distinct entity
of the corpus gets one surrogate from a keyed hash: same kind, same format,
same script, and for names the gender that the title tells. A collision check
over all entities keeps different entities different and keeps surrogates off
real entities; losers try again with the next hash. Equal entities get equal
surrogates in every document.

Formats of few strings (a secret with one letter, short phones) may hold more
entities than can be drawn apart. Where a format's entities fill over a quarter
of its strings, they are assigned by a keyed permutation of those strings
instead, which is distinct by construction (such surrogates may be real strings
of that format, never the entity's own). Private addresses widen to the largest
private range, then to all. So every round leaves at least half of a format
free, and the rounds end. Mail domains are always permuted label by label:
different domains stay different.
"""

from __future__ import annotations

import hashlib
import hmac
import re
import unicodedata
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import frugal, save, spare

KEY_CONF = "spark.txrisk.pii.key"
DEFAULT_KEY = "txrisk"

_TITLES = {"Mr": "m", "Sir": "m", "Herr": "m", "Herrn": "m", "Señor": "m", "Monsieur": "m", "господин": "m",
           "Mrs": "f", "Ms": "f", "Miss": "f", "Madam": "f", "Frau": "f", "Señora": "f", "Señorita": "f",
           "Madame": "f", "Mme": "f", "госпожа": "f", "Dr": "n", "Prof": "n", "Доктор": "n"}
_L = r"[^\W\d_]"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
# In order of preference where matches overlap; the group "x" is the entity.
_PATTERNS = [
    ("email", re.compile(r"(?P<x>(?<![\w.%+-])[\w][\w.%+-]*@[\w-]+(?:\.[\w-]+)*\.[^\W\d_]{2,})")),
    ("secret", re.compile(r"(?i)\b(?:token|secret|password|passwd|pwd|api[_-]?key|access[_-]?key)\b[\"']?\s*[=:]\s*"
                          r"[\"']?(?P<x>[\w/+.-]{8,})")),
    ("secret", re.compile(r"(?<!\w)(?P<x>(?=[0-9a-f]*\d)(?=[0-9a-f]*[a-f])[0-9a-f]{32,128})(?!\w)")),
    ("iban", re.compile(r"(?<!\w)(?P<x>[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?)(?!\w)")),
    ("phone", re.compile(r"(?<![\w+])(?P<x>(?:\+\d{1,3}[ .-]?)?\(\d{3}\)[ .-]?\d{3}[ .-]\d{4}|"
                         r"\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}|\d{3}-\d{3}-\d{4})(?!\d)")),
    ("card", re.compile(r"(?<![\w.-])(?P<x>\d(?:[ -]?\d){12,18})(?![\w-])")),
    ("ssn", re.compile(r"(?<![\w-])(?P<x>\d{3}-\d{2}-\d{4})(?![\w-])")),
    ("ip", re.compile(rf"(?<![\w.])(?P<x>(?:{_OCTET}\.){{3}}{_OCTET})(?!\w|\.\d)")),
]
_NAME = re.compile(rf"\b(?P<t>{'|'.join(sorted(_TITLES, key=len, reverse=True))})\b\.?[ ]+"
                   rf"(?P<x>{_L}+(?:['’-]{_L}+)*(?: {_L}+(?:['’-]{_L}+)*){{0,2}})")
_NAME_WORD = re.compile(rf"(?<!\w){_L}+(?:['’-]{_L}+)*(?!\w)")
_LETTERS = re.compile(rf"{_L}+")
_DIGIT = re.compile(r"[0-9]")
_VOWELS, _CONSONANTS = "aeiou", "bcdfghjklmnprstvwxyz"
_SCRIPTS = ("абвгдежзиклмнопрстуфхцчшэюя", "αβγδεζηθικλμνξοπρστυφχψω", "áéíóúàèìòùâêîôûäëïöüñçãõåæøß")
# Mentions of a document in text order.
SCHEMA = T.ArrayType(T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType()),
                                   T.StructField("kind", T.StringType()), T.StructField("entity", T.StringType())]))


@lru_cache(maxsize=4096)
def _alphabet(c: str) -> str:
    """The lower-case characters that may stand for ``c``; itself if none may."""
    if c.isdecimal():
        zero = ord(c) - unicodedata.decimal(c)
        return "".join(map(chr, range(zero, zero + 10)))
    if not c.isalpha():
        return c
    low = c.lower()
    if low.isascii():
        return _VOWELS if low in _VOWELS else _CONSONANTS + "q"
    for letters in _SCRIPTS:
        if low in letters:
            return letters
    row = [x for x in map(chr, range(ord(c) & ~63, (ord(c) & ~63) + 64)) if x.isalpha() and x.lower() == x]
    return "".join(row) if low in row else c


def _canonical(kind: str, text: str) -> str:
    if kind in ("phone", "card", "ssn"):
        return re.sub(r"\D", "", text)
    if kind == "iban":
        return text.replace(" ", "")
    return text.casefold() if kind in ("email", "secret") or kind.startswith("name") else text


def mentions(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, entity) in text order, without overlaps."""
    found: list[tuple[int, int, str, str]] = []
    taken = bytearray(len(text)) if len(text) else bytearray()

    def add(a: int, b: int, kind: str):
        # What holds no letter or digit that could be another (a form's blank line) is no entity.
        if b > a and not any(taken[a:b]) and any(len(_alphabet(c)) > 1 for c in text[a:b]):
            taken[a:b] = b"\x01" * (b - a)
            found.append((a, b, kind, _canonical(kind, text[a:b])))

    digits = _DIGIT.search(text) is not None
    for kind, pattern in _PATTERNS:
        if "@" in text if kind == "email" else kind == "secret" or digits:
            for m in pattern.finditer(text):
                add(*m.span("x"), kind)
    for m in _NAME.finditer(text):
        gender, parts = _TITLES[m["t"]], []
        for w in re.finditer(r"[^ ]+", m["x"]):
            if not w.group()[0].isupper():
                break
            parts.append((m.start("x") + w.start(), m.start("x") + w.end()))
        for a, b in parts[:-1]:
            add(a, b, f"name-{gender}")
        for a, b in parts[-1:]:
            add(a, b, "name-family")
    # Further whole-word mentions of the names found, without a title too. A part
    # in two roles goes by its first one.
    roles: dict[str, str] = {}
    for _, _, kind, entity in sorted(found):
        if kind.startswith("name"):
            roles.setdefault(entity, kind)
    if roles:
        for m in _NAME_WORD.finditer(text):
            whole = m.group()
            if whole.casefold() in roles:
                spans = [m.span()]
            else:
                spans = [(m.start() + w.start(), m.start() + w.end()) for w in _LETTERS.finditer(whole)]
            for a, b in spans:
                if text[a].isupper() and (kind := roles.get(text[a:b].casefold())):
                    add(a, b, kind)
    return sorted(found)


class _Stream:
    """Numbers from a keyed hash of (kind, entity, attempt)."""

    def __init__(self, key: bytes, *parts: str):
        self.key, self.seed, self.block, self.at = key, "\x00".join(parts).encode(), b"", 0

    def below(self, n: int) -> int:
        if len(self.block) < 4:
            self.block = hmac.new(self.key, self.seed + self.at.to_bytes(4, "big"), hashlib.sha256).digest()
            self.at += 1
        v, self.block = int.from_bytes(self.block[:4], "big"), self.block[4:]
        return v % n

    def like(self, c: str) -> str:
        """A character of the same class and script; others stay."""
        letters = _CONSONANTS if c.isascii() and c.isalpha() and c.lower() not in _VOWELS else _alphabet(c)
        if len(letters) < 2:
            return c
        new = letters[self.below(len(letters))]
        return new.upper() if c.isupper() and len(new.upper()) == 1 else new


class _Permutation:
    """A keyed permutation of 0..n-1: a Feistel network, walked until below n."""

    def __init__(self, key: bytes, tag: str, n: int):
        self.key, self.tag, self.n = key, tag.encode(), n
        self.half = max(1, ((n - 1).bit_length() + 1) // 2)

    def _round(self, r: int, v: int) -> int:
        data = self.tag + b"\x00%d\x00%d" % (r, v)
        return int.from_bytes(hmac.new(self.key, data, hashlib.sha256).digest(), "big") & ((1 << self.half) - 1)

    def _walk(self, v: int, rounds) -> int:
        mask = (1 << self.half) - 1
        while True:
            left, right = v >> self.half, v & mask
            for r, back in rounds:
                left, right = (right ^ self._round(r, left), left) if back else (right, left ^ self._round(r, right))
            v = left << self.half | right
            if v < self.n:
                return v

    def forward(self, v: int) -> int:
        return self._walk(v, [(r, False) for r in range(6)])

    def inverse(self, v: int) -> int:
        return self._walk(v, [(r, True) for r in reversed(range(6))])

    def other(self, v: int) -> int:
        """One cycle through all numbers: a permutation without a fixed point (n > 1)."""
        return self.forward((self.inverse(v) + 1) % self.n)


def permuted(key: bytes, tag: str, text: str) -> str:
    """``text`` (lower case) moved by a keyed permutation of all strings of its
    character classes: different texts of a shape stay different."""
    classes = [_alphabet(c) if c in _alphabet(c) else c for c in text]
    n, v = 1, 0
    for c, letters in zip(text, classes):
        n, v = n * len(letters), v * len(letters) + letters.index(c)
    if n < 2:
        return text
    v = _Permutation(key, "\x00".join((tag, *classes)), n).other(v)
    out = []
    for letters in reversed(classes):
        v, i = divmod(v, len(letters))
        out.append(letters[i])
    return "".join(reversed(out))


def _luhn(digits: str) -> int:
    """Check sum modulo 10 of a whole card number."""
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        total += d if k % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10


def _iban_check(country: str, body: str) -> str:
    """The check digits that make the number valid (remainder 1 modulo 97)."""
    digits = "".join(str(int(c, 36)) for c in body + country + "00")
    return f"{98 - int(digits) % 97:02d}"


def space_of(kind: str, entity: str) -> tuple[str, float]:
    """The entity's format and how many strings of it can be drawn (infinite
    where later attempts get longer)."""
    if kind == "phone":
        return (f"{len(entity)}:{entity[:-10]}", 8e2 * 8e6) if len(entity) >= 10 else (str(len(entity)), 10.0 ** len(entity))
    if kind == "card":
        valid = _luhn(entity) == 0
        return f"{len(entity)}:{entity[0]}:{valid}", 10.0 ** (len(entity) - 2) * (1 if valid else 9)
    if kind == "ssn":
        return "", 566.0 * 99 * 9999
    if kind == "ip":
        return "", 254.0 ** 4
    if kind == "secret":
        classes, size = [_alphabet(c) for c in entity], 1.0
        for letters in classes:
            size = min(1e300, size * len(letters))
        return "".join(letters[0] for letters in classes), size
    return "", float("inf")


def crowded_surrogate(key: bytes, kind: str, entity: str) -> str:
    """Surrogate in a format that is too full to draw from: permuted."""
    if kind == "card":      # the check digit follows from the others, or is one of nine wrong ones
        new = entity[0] + permuted(key, f"card {entity[0]}", entity[1:-1])
        return new + next(c for c in "0123456789" if (_luhn(new + c) == 0)) if _luhn(entity) == 0 else \
            new + _wrong_digit(new, _wrong_rank(entity))
    if kind == "ip":
        v = 0
        for octet in entity.split("."):
            v = v * 256 + int(octet)
        v = _Permutation(key, "ip", 2**32).other(v)
        return ".".join(str(v >> k & 255) for k in (24, 16, 8, 0))
    if kind == "phone" and len(entity) > 10:
        return entity[:-10] + permuted(key, f"phone {entity[:-10]}", entity[-10:])
    return permuted(key, kind, entity)


def _wrong_digit(new: str, rank: int) -> str:
    return [c for c in "0123456789" if _luhn(new + c) != 0][rank]


def _wrong_rank(entity: str) -> int:
    return [c for c in "0123456789" if _luhn(entity[:-1] + c) != 0].index(str(int(entity[-1])))


def _valid_iban(entity: str) -> bool:
    return entity[2:4] == _iban_check(entity[:2], entity[4:])


def surrogate(key: bytes, kind: str, entity: str, attempt: int) -> str:
    """Canonical surrogate; later attempts that could run out of room get longer."""
    s = _Stream(key, kind, entity, str(attempt))
    if kind == "email":
        local, _, domain = entity.rpartition("@")
        *labels, top = domain.split(".")
        host = ".".join([*(permuted(key, "domain", x) for x in labels), top])
        grown = local + "a" * (attempt // 4)
        return "".join(map(s.like, grown)) + "@" + host
    if kind == "phone":
        country, rest = entity[:-10], entity[-10:]
        if len(rest) < 10:
            return "".join(map(s.like, entity))
        middle = "555" if rest[3:6] == "555" and attempt < 8 else f"{2 + s.below(8)}{s.below(10)}{s.below(10)}"
        return country + f"{2 + s.below(8)}{s.below(10)}{s.below(10)}" + middle + "".join(map(s.like, rest[6:]))
    if kind == "card":
        new = entity[0] + "".join(map(s.like, entity[1:-1]))
        valid = _luhn(entity) == 0
        last = [c for c in "0123456789" if (_luhn(new + c) == 0) == valid]
        return new + last[s.below(len(last))]
    if kind == "ip":
        a, b, *_ = map(int, entity.split("."))
        keep = [10] if a == 10 else [192, 168] if (a, b) == (192, 168) else [172, 16 + s.below(16)] \
            if a == 172 and 16 <= b < 32 else []
        if attempt >= 3 and keep:       # a full range: the largest private one, later all
            keep = [10] if attempt < 6 else []
        return ".".join(map(str, keep + [1 + s.below(254) for _ in range(4 - len(keep))]))
    if kind == "ssn":
        return f"{100 + s.below(566)}{1 + s.below(99):02d}{1 + s.below(9999):04d}"
    if kind == "iban":
        body = "".join(map(s.like, entity[4:] + "0" * (attempt // 8)))
        return entity[:2] + (_iban_check(entity[:2], body) if _valid_iban(entity) else "".join(map(s.like, entity[2:4]))) + body
    if kind == "secret":
        return "".join("0123456789abcdef"[s.below(16)] if c in "0123456789abcdef" else s.like(c) for c in entity)
    # Names: pronounceable in the script of the original, ending by gender.
    base = entity if len(entity) > 3 else entity + entity[-1] * (4 - len(entity))
    new = "".join(map(s.like, base + base[-1] * (attempt // 4)))
    ascii_ = entity.isascii()
    if kind == "name-f":
        return new[:-1] + ("a" if ascii_ or new[-1] not in _SCRIPTS[0] else "а")
    if kind == "name-m":
        return new[:-1] + ("nrsdl"[s.below(5)] if ascii_ else new[-1])
    return new


def render(kind: str, mention: str, new: str) -> str:
    """The surrogate in the mention's own format: separators and letter case."""
    if kind in ("phone", "card", "ssn", "iban"):
        left = iter(new)
        return "".join([next(left, "") if c.isalnum() else c for c in mention]) + "".join(left)
    letters = [c for c in mention if c.isalpha()]
    if letters and all(c.isupper() for c in letters):
        return new.upper()
    if kind.startswith("name") and mention[:1].isupper():
        return re.sub(rf"(^|['’-])({_L})", lambda m: m[1] + m[2].upper(), new)
    return new


def replace(text: str, known: dict[tuple[str, str], str], found=None) -> str:
    """``text`` with every mention (those ``found``) replaced by its entity's surrogate."""
    out, at = [], 0
    for a, b, kind, entity in mentions(text) if found is None else found:
        out += [text[at:a], render(kind, text[a:b], known[kind, entity])]
        at = b
    return "".join(out) + text[at:]


def _by_rows(fields: list[str], fn, types: list[pa.DataType]):
    """mapInArrow body: (kind, entity) rows plus ``fields`` computed by ``fn``."""
    def run(it):
        for b in it:
            rows = [fn(k, e) for k, e in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
            cols = [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *cols], names=["kind", "entity", *fields])
    return run


def assign_surrogates(entities: DataFrame, key: str) -> DataFrame:
    """``kind, entity, surrogate`` for distinct (kind, entity) rows.

    Entities of crowded formats are permuted first. Then each round proposes one
    surrogate per open entity. It is accepted if it is no entity of its kind,
    not taken, and its proposer the first of those who proposed it; the others
    go on to the next attempt. Names share one space, so that no two names of
    any gender meet.
    """
    secret = key.encode()
    space = F.when(F.col("kind").startswith("name"), "name").otherwise(F.col("kind"))
    formats = save(entities.mapInArrow(_by_rows(["format", "room"], space_of, [pa.string(), pa.float64()]),
                                       "kind string, entity string, format string, room double"), "entity-formats")
    full = formats.groupBy("kind", "format").agg(F.count("*").alias("n"), F.min("room").alias("room")) \
        .where(F.col("n") * 4 > F.col("room")).select("kind", "format")
    crowded = formats.join(full, ["kind", "format"], "left_semi").select("kind", "entity")
    done = save(crowded.mapInArrow(_by_rows(["surrogate"], lambda k, e: (crowded_surrogate(secret, k, e),), [pa.string()]),
                                   "kind string, entity string, surrogate string")
                .select(space.alias("space"), "kind", "entity", "surrogate"), "surrogates")
    open_ = save(formats.join(full, ["kind", "format"], "left_anti").select("kind", "entity"), "open-entities")
    real = entities.select(space.alias("space"), F.col("entity").alias("surrogate")).distinct()
    attempt = 0
    while not open_.isEmpty():
        offered = open_.mapInArrow(_by_rows(["surrogate"], lambda k, e, a=attempt: (surrogate(secret, k, e, a),), [pa.string()]),
                                   "kind string, entity string, surrogate string").withColumn("space", space)
        first = offered.groupBy("space", "surrogate").agg(F.min(F.struct("kind", "entity")).alias("w"))
        accepted = first.join(real, ["space", "surrogate"], "left_anti") \
            .join(done.select("space", "surrogate"), ["space", "surrogate"], "left_anti")
        accepted = save(accepted.select("space", "w.kind", "w.entity", "surrogate"), "surrogates")
        done = done.unionByName(accepted)
        open_ = save(open_.join(accepted, ["kind", "entity"], "left_anti").select("kind", "entity"), "open-entities")
        attempt += 1
    return done.select("kind", "entity", "surrogate")


def pseudonymize(docs: DataFrame, text_col: str = "text", key: str | None = None,
                 count_col: str | None = None) -> DataFrame:
    """``docs`` with personal data in ``text_col`` replaced; same columns, and
    the number of replaced mentions as long ``count_col`` if one is named.

    Documents without an entity (null and empty texts too) stay as they are.
    Ids are not read: null ids and repeated rows are handled like other rows,
    equal entities alike everywhere. Extra columns pass through; an empty table
    stays empty. The key is a parameter or the session's ``spark.txrisk.pii.key``.
    """
    spark = docs.sparkSession
    key = key or spark.conf.get(KEY_CONF, DEFAULT_KEY)
    names, at = docs.columns, docs.columns.index(text_col)
    n, ents, uid, known_as = (spare(docs, c) for c in ("n", "entities", "uid", "known"))
    marked_type = T.StructType([*docs.schema.fields, T.StructField(n, T.LongType()), T.StructField(ents, SCHEMA)])
    arrow = to_arrow_schema(marked_type)

    def detect(with_entities: bool):
        def run(it):
            for b in it:
                for k in range(0, b.num_rows, 1000):
                    part = b.slice(k, 1000)
                    found = [mentions(t) if t else [] for t in part.column(at).to_pylist()]
                    mask = pa.array([bool(f) == with_entities for f in found])
                    count = pa.array([len(f) for f in found], pa.int64())
                    spans = pa.array([[dict(zip(("a", "b", "kind", "entity"), m)) for m in f] for f in found],
                                     arrow.field(arrow.names.index(ents)).type)
                    yield pa.RecordBatch.from_arrays([*part.columns, count, spans], schema=arrow).filter(mask)
        return run

    private = save(docs.mapInArrow(frugal(detect(True)), marked_type).withColumn(uid, F.monotonically_increasing_id()),
                   "private-documents")
    own = F.array_distinct(F.transform(ents, lambda m: F.struct(m["kind"].alias("kind"), m["entity"].alias("entity"))))
    pairs = private.select(uid, F.explode(own).alias("e")).select(uid, "e.kind", "e.entity")
    mapping = assign_surrogates(save(pairs.select("kind", "entity").distinct(), "entities"), key)
    known = pairs.join(mapping, ["kind", "entity"]).groupBy(uid) \
        .agg(F.collect_list(F.struct("kind", "entity", "surrogate")).alias(known_as))
    out_type = T.StructType([*docs.schema.fields, T.StructField(n, T.LongType())])
    out_names = [f.name for f in out_type]

    def rewrite(it):
        for b in it:
            for k in range(0, b.num_rows, 1000):
                part = b.slice(k, 1000)
                spans, maps = (part.column(len(out_names) + k).to_pylist() for k in range(2))
                new = [replace(t, {(e["kind"], e["entity"]): e["surrogate"] for e in m},
                               [(x["a"], x["b"], x["kind"], x["entity"]) for x in f])
                       for t, f, m in zip(part.column(at).to_pylist(), spans, maps)]
                cols = [pa.array(new, c.type) if i == at else c for i, c in enumerate(part.columns[:-2])]
                yield pa.RecordBatch.from_arrays(cols, names=out_names)

    changed = private.join(known, uid).select(*names, n, ents, known_as) \
        .mapInArrow(frugal(rewrite), out_type)
    clean = docs.mapInArrow(frugal(detect(False)), marked_type).drop(ents)
    both = clean.unionByName(changed)
    return both.withColumnRenamed(n, count_col) if count_col else both.drop(n)
