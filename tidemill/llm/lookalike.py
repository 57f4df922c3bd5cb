"""Problem 10: visually identical text with different characters, brought to one form."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Letters whose whole glyph is drawn like the Latin letter on the left, after the confusable characters that the
# Unicode Consortium publishes (UTS 39), as far as a letter of one script is drawn like one letter of another.
ALIKE = {
    "a": "а", "c": "сϲ", "d": "ԁ", "e": "е", "g": "ɡ", "h": "һ", "i": "і", "j": "јϳ", "l": "ӏ", "o": "оο", "p": "рρ", "q": "ԛ",
    "s": "ѕ", "v": "νѵ", "w": "ԝ", "x": "х", "y": "у",
    "A": "АΑ", "B": "ВΒ", "C": "СϹ", "E": "ЕΕ", "F": "Ϝ", "G": "Ԍ", "H": "НΗ", "I": "ІΙӀ", "J": "ЈͿ", "K": "КΚ", "M": "МΜϺ", "N": "Ν", "O": "ОΟ", "P": "РΡ",
    "Q": "Ԛ", "S": "Ѕ", "T": "ТΤ", "V": "Ѵ", "W": "Ԝ", "X": "ХΧ", "Y": "ҮΥ", "Z": "Ζ",
    "Æ": "Ӕ", "æ": "ӕ", "Ə": "Ә", "ə": "әǝ", "Ʒ": "Ӡ", "ʒ": "ӡ", "Ɵ": "Ө", "ɵ": "ө", "Ɛ": "Ԑ", "ɛ": "ԑ", "Ɔ": "Ͻ", "ɔ": "ͻ", "Ƨ": "Ꙅ", "ƨ": "ꙅ",
}
# Further glyphs shared by Greek and Cyrillic, and small capitals drawn like Cyrillic letters.
ALIKE |= {"Г": "Γ", "Π": "П", "Φ": "Ф", "Λ": "Ʌ", "к": "ĸκ", "μ": "µ", "Ω": "Ω", "И": "Ͷ", "и": "ͷᴎ", "Ψ": "Ѱ", "ψ": "ѱ", "в": "ʙ", "н": "ʜ", "м": "ᴍ", "т": "ᴛ", "я": "ᴙ", "г": "ᴦ", "п": "ᴨ"}
# Hyphens, joined letters.
HYPHENS = "\u2010\u2011\ufe63\uff0d"
JOINED = {"ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "ﬅ": "ſt", "ﬆ": "st", "Ĳ": "IJ", "ĳ": "ij", "Ǆ": "DŽ", "ǅ": "Dž", "ǆ": "dž", "Ǉ": "LJ", "ǈ": "Lj", "ǉ": "lj", "Ǌ": "NJ", "ǋ": "Nj", "ǌ": "nj", "Ǳ": "DZ", "ǲ": "Dz", "ǳ": "dz"}
# Ranges of characters that draw nothing (default ignorable code points, and controls without effect on lines).
NOTHING = "\x00-\x08\x0e-\x1f\x7f-\x84\x86-\x9f\u00ad\u034f\u061c\u115f\u1160\u17b4\u17b5\u180b-\u180f\u200b-\u200f\u202a-\u202e\u2060-\u206f\u3164\ufe00-\ufe0f\ufeff\uffa0\U000e0000-\U000e0fff"
CONTROL = re.compile("[\x00-\x08\x0e-\x1f\x7f]")
# Blanks drawn as one space.
SPACES = "\u00a0\u2000-\u200a\u202f\u205f\u3000"


@cache
def joins_before() -> frozenset[int]:
    """Characters of which the quick check of composition says "maybe": some character and this one compose to another. They
    are those that stand second in the decomposition of a character which composition gives back, and the vowels and finals
    that make up Hangul syllables; many of them are letters of combining class 0."""
    found = {*range(0x1161, 0x1176), *range(0x11A8, 0x11C3)}
    for cp in range(0x110000):
        parts = unicodedata.decomposition(chr(cp)).split()
        if len(parts) == 2 and parts[0][0] != "<" and unicodedata.is_normalized("NFC", chr(cp)):
            found.add(int(parts[1], 16))
    return frozenset(found)


@cache
def _tables() -> tuple[dict[int, str], re.Pattern]:
    """What a single character becomes (before composition), and the pattern of unstable segments with their context.

    A character is stable if it becomes itself, has combining class 0, and the quick check of composition says "yes" (it does
    not change, and joins nothing before it); a segment is a run of others with the one character before it, to which what
    stands in it may join.
    """
    to = {ord(c): k for k, v in ALIKE.items() for c in v}
    to |= {ord(c): "-" for c in HYPHENS} | {ord(k): v for k, v in JOINED.items()}
    nothing, space = re.compile(f"[{NOTHING}]"), re.compile(f"[{SPACES}]")
    unstable = []
    for cp in range(0x110000):
        if 0x3400 <= cp < 0xA000 or 0xE000 <= cp < 0xF900 or 0x20000 <= cp < 0x2F800 or 0xD800 <= cp < 0xE000 or 0x30000 <= cp < 0xE0000 or cp >= 0xE1000:
            continue
        c = chr(cp)
        if nothing.match(c):
            to[cp] = ""
        elif space.match(c):
            to[cp] = " "
        elif cp not in to:
            kind, _, body = unicodedata.decomposition(c).partition(" ")
            if kind in ("<wide>", "<narrow>", "<noBreak>"):
                s = "".join(chr(int(x, 16)) for x in body.split())
                to[cp] = "".join(to.get(ord(x), x) for x in s)
        if cp in to or unicodedata.combining(c) or not unicodedata.is_normalized("NFC", c) or cp in joins_before():
            unstable.append(cp)
        elif any(ord(x) in to for x in unicodedata.normalize("NFD", c)):  # an accented look-alike letter
            unstable.append(cp)
    spans: list[list[int]] = []
    for cp in unstable:
        if spans and spans[-1][1] == cp - 1:
            spans[-1][1] = cp
        else:
            spans.append([cp, cp])
    kinds = "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in spans)
    return to, re.compile(f"[^{kinds}]?[{kinds}]+")


def _segment(m: re.Match) -> str:
    to = _tables()[0]
    s = m.group().translate(to)
    return unicodedata.normalize("NFC", unicodedata.normalize("NFD", s).translate(to))


def one_form(text: str) -> str:
    """The canonical form: equal for texts that look the same, and the text itself where nothing in it is unstable."""
    if text.isascii() and not CONTROL.search(text):
        return text
    return _tables()[1].sub(_segment, text)


def with_form(rows: DataFrame, text: str = "text", out: str = "form") -> DataFrame:
    """rows with the canonical form of a text column; null for null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            forms = [None if t is None else one_form(t) for t in b.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(forms, pa.string())], [*b.schema.names, out])

    return rows.mapInArrow(run, f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in rows.schema.fields)}, `{out}` string")


def alike(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """(doc_a, doc_b), doc_a < doc_b: documents whose texts are different strings of one canonical form.

    Equal texts are one row (the digests of text and form) until the end, so copies cost nothing and are no pair. Null
    texts and texts without a visible character are no case.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from hashlib import blake2b

        for b in batches:
            ids, texts, forms = [], [], []
            for i, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                if t is None or i is None:
                    continue
                f = one_form(t)
                if f.strip():
                    ids.append(i)
                    texts.append(blake2b(t.encode(), digest_size=16).digest())
                    forms.append(blake2b(f.encode(), digest_size=16).digest())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(texts, pa.binary()), pa.array(forms, pa.binary())], ["doc_id", "t", "f"])

    from tidemill.session import Scratch

    scratch = Scratch(spark, "alike")
    docs = scratch.keep(documents.select("doc_id", "text").mapInArrow(run, "doc_id bigint, t binary, f binary"))
    many = docs.groupBy("f").agg(F.min("t").alias("low"), F.max("t").alias("high")).filter("low <> high").select("f")
    docs = scratch.keep(docs.join(many, "f", "left_semi"))
    variants = docs.select("f", "t").distinct()
    pairs = variants.select("f", F.col("t").alias("ta")).join(variants.select("f", F.col("t").alias("tb")), "f").filter("ta < tb")
    a, b = docs.select(F.col("t").alias("ta"), F.col("doc_id").alias("i")), docs.select(F.col("t").alias("tb"), F.col("doc_id").alias("j"))
    met = pairs.join(a, "ta").join(b, "tb").filter("i <> j")
    return met.select(F.least("i", "j").alias("doc_a"), F.greatest("i", "j").alias("doc_b")).distinct()
