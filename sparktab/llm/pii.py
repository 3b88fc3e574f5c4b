"""Personal data, found also behind disguises, with offsets into the source text.

Plain identifiers are found in the text as it is. Transducers then rewrite the text (look-alike characters, spelled digits, "at" and "dot") and
carry the source position of every character along, so that identifiers found in the rewritten text are mapped back
to the characters they came from. Only texts with a trace of a disguise are rewritten.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparktab.llm.common import pa_type, rows_of, small_batches, texts

KINDS = ("email", "ip", "card", "phone")

# Patterns. The e-mail's local part is found backwards from its sign, a run of digits is entered at its start:
# the same matches as from left to right, in linear time.
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL_CHARACTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Spelled digits in four languages, and characters that look like Latin letters.
DIGIT_WORDS = {
    "zero": 0, "oh": 0, "one": 1, "two": 2, "three": 3, "four": 4, "five": 5, "six": 6, "seven": 7, "eight": 8, "nine": 9,
    "null": 0, "eins": 1, "zwei": 2, "drei": 3, "vier": 4, "fünf": 5, "sechs": 6, "sieben": 7, "acht": 8, "neun": 9,
    "zéro": 0, "un": 1, "deux": 2, "trois": 3, "quatre": 4, "cinq": 5, "sept": 7, "huit": 8, "neuf": 9,
    "cero": 0, "uno": 1, "dos": 2, "tres": 3, "cuatro": 4, "cinco": 5, "seis": 6, "siete": 7, "ocho": 8, "nueve": 9,
}
LOOK_ALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "ӏ": "l", "м": "m", "о": "o", "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x", "ԝ": "w",
    "А": "A", "В": "B", "С": "C", "Е": "E", "Н": "H", "І": "I", "Ј": "J", "К": "K", "М": "M", "О": "O", "Р": "P", "Ѕ": "S", "Т": "T", "Х": "X",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "Ϲ": "C", "ϲ": "c", "ϳ": "j",
    "α": "a", "ο": "o", "ν": "v", "ρ": "p", "ι": "i", "υ": "u", "ɑ": "a", "ɡ": "g", "ı": "i",
    "․": ".", "。": ".", "﹒": ".", "﹫": "@", "⁺": "+", "﹢": "+",
    "‐": "-", "‑": "-", "‒": "-", "–": "-", "—": "-", "−": "-", "﹣": "-",
}
INVISIBLE = re.compile("[­​-‏⁠﻿]+")


def _one_to_one() -> dict[int, str]:
    table = {ord(k): v for k, v in LOOK_ALIKES.items()}
    table |= {c: chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)}  # full-width forms
    table |= {c: " " for c in (0xA0, 0x3000, *range(0x2000, 0x200B), 0x202F, 0x205F)}
    for c in (*range(0x2100, 0x2150), *range(0x24B6, 0x24EA), *range(0x1D400, 0x1D800)):  # letter-like, circled and mathematical letters
        letter = unicodedata.normalize("NFKC", chr(c))
        if len(letter) == 1 and letter.isascii() and letter.isalpha():
            table[c] = letter
    for c in range(0x80, 0x1FBFA):
        digit = unicodedata.digit(chr(c), None)  # also super- and subscripts and circled digits
        if digit is not None:
            table[c] = str(digit)
    return table


ONE_TO_ONE = _one_to_one()
STRANGE = frozenset(map(chr, ONE_TO_ONE)) | frozenset("­​‌‍‎‏⁠﻿")
STRANGE_LATIN = [bytes([ord(c)]) for c in STRANGE if ord(c) < 256]
_WORD = "|".join(sorted(DIGIT_WORDS, key=len, reverse=True))
_GAP = r"[\s,;.()-]{0,3}"
_ITEM = rf"(?:(?<!\w)(?:{_WORD})(?!\w)|\+?[0-9])"
SPELLED = re.compile(rf"(?:(?<!\w)plus{_GAP})?{_ITEM}(?:{_GAP}{_ITEM}){{3,}}+", re.IGNORECASE)
_BY_LETTER = "|".join(f"{c}(?:{'|'.join(w[1:] for w in DIGIT_WORDS if w[0] == c)})" for c in sorted({w[0] for w in DIGIT_WORDS}))
# over lower-cased text after a blank; begins with a set of characters, which the matcher can skip to
SPELLED_HINT = re.compile(rf"[\s,;.()\[\]{{}}<>:/|=*+\"'-](?:{_BY_LETTER})[\s,;.()-]{{1,3}}(?:{_BY_LETTER}|[0-9])|[0-9][\s,;.()-]{{1,3}}(?:{_BY_LETTER})(?!\w)")
ONE_SPELLED = re.compile(rf"(?<!\w)(?:(plus)|({_WORD}))(?!\w)", re.IGNORECASE)
AT = re.compile(r"\s*(?:[\[({<]\s*(?:at|@)\s*[\])}>]|[_-]at[_-])\s*", re.IGNORECASE)
DOT = re.compile(r"\s*(?:[\[({<]\s*(?:dot|\.)\s*[\])}>]|[_-]dot[_-])\s*", re.IGNORECASE)
_PART, _LABEL = "[A-Za-z0-9_%+-]{1,64}+", "[A-Za-z0-9-]{1,63}"
BARE = re.compile(rf"(?<![\w.%+-])({_PART}(?:(?:\.| dot ){_PART}){{0,8}})( at | @ ?|@ )({_LABEL}(?:(?:\.| dot ){_LABEL}){{0,8}}(?: dot |\.)[A-Za-z]{{2,24}})(?!\w)", re.IGNORECASE)
DISGUISED = re.compile(r"[\[({<]\s*(?:at|dot|@|\.)\s*[\])}>]|[_-](?:at|dot)[_-]| dot | @|@ | at [a-z0-9-]{1,63}(?:\.[a-z0-9-]{1,63}){0,8}\.[a-z]{2,24}(?!\w)", re.IGNORECASE)
# Words after which a bare "name at host.example" is an address.
CONTACT = re.compile(r"(?<!\w)(?:(?:e-?)?mails?|mailto|mailen|courriel|correo|contact|contactez|contacto|kontakt|reach|write|schreiben|écrivez|escriba|address|adresse)(?: (?:me|us|to|at|is|him|her|them|an|à|a|uns|nous))?:? ?$", re.IGNORECASE)

Span = tuple[int, int, str]  # start, end, kind


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> Iterator[Span]:
    last = 0
    for m in DOMAIN.finditer(text):
        start = m.start()
        while start > last and text[start - 1] in LOCAL_CHARACTERS:
            start -= 1
        if start < m.start():
            last = m.end()
            yield start, last, "email"


def plain(text: str) -> tuple[list[Span], list[Span]]:
    """Identifiers as they stand, and matches that failed their test, which may hold one."""
    good, failed = list(emails(text)) if "@" in text else [], []
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) < 4 and int(p) <= 255 for p in m[0].split(".")):
            good.append((m.start(), m.end(), "ip"))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = only_digits(m[0])
            ok = 14 <= len(digits) <= 19 and luhn(digits)
            (good if ok else failed).append((m.start(), m.end(), "card"))
    if "+" in text:
        for m in PHONE.finditer(text):
            n = len(only_digits(m[0]))
            if n >= 10:
                (good if n <= 15 else failed).append((m.start(), m.end(), "phone"))
    return good, failed


def inside(text: str, failed: list[Span]) -> Iterator[Span]:
    """Identifiers that stand in one match with others: cut at the spaces."""
    for start, end, kind in failed:
        if kind == "card":
            at = start
            for word in text[start:end].split(" "):
                digits = only_digits(word)
                if 14 <= len(digits) <= 19 and luhn(digits):
                    yield at, at + len(word), "card"
                at += len(word) + 1
        else:
            ends = [m.start() for m in re.finditer(" ", text[start:end]) if 10 <= len(only_digits(text[start : start + m.start()])) <= 15]
            if ends:
                yield start, start + len(text[start : start + ends[-1]].rstrip(" ().-")), "phone"


class Traced:
    """A text and, for each of its characters, the span of source characters it came from."""

    def __init__(self, text: str, start: np.ndarray, end: np.ndarray):
        self.text, self.start, self.end = text, start, end

    @classmethod
    def of(cls, text: str) -> Traced:
        at = np.arange(len(text) + 1)
        return cls(text, at[:-1], at[1:])

    def rewrite(self, pattern: re.Pattern, new: Callable[[re.Match], str]) -> Traced:
        parts, starts, ends, last = [], [], [], 0
        for m in pattern.finditer(self.text):
            to = new(m)
            if to == m[0]:
                continue
            a, b = m.span()
            parts += [self.text[last:a], to]
            starts += [self.start[last:a], np.full(len(to), self.start[a])]
            ends += [self.end[last:a], np.full(len(to), self.end[b - 1])]
            last = b
        if not parts:
            return self
        parts.append(self.text[last:])
        return Traced("".join(parts), np.concatenate([*starts, self.start[last:]]), np.concatenate([*ends, self.end[last:]]))

    def source(self, span: Span) -> Span:
        return int(self.start[span[0]]), int(self.end[span[1] - 1]), span[2]


def fold_characters(t: Traced) -> Traced:
    """Look-alikes and foreign digits one to one; invisible characters go."""
    return Traced(t.text.translate(ONE_TO_ONE), t.start, t.end).rewrite(INVISIBLE, lambda m: "")


def fold_digits(t: Traced) -> Traced:
    """Runs of four or more spelled or written digits: one run of digits."""

    def run(m: re.Match) -> str:
        if not ONE_SPELLED.search(m[0]):
            return m[0]
        spelled = ONE_SPELLED.sub(lambda w: "+" if w[1] else str(DIGIT_WORDS[w[2].lower()]), m[0])
        return re.sub(r"[^0-9+]", "", spelled)

    return t.rewrite(SPELLED, run)


def fold_signs(t: Traced) -> Traced:
    """Written-out "at" and "dot": in brackets anywhere, bare where a whole address is spelled; a lone bare "at" needs a name with a dot or digit, or a contact word before it."""
    t = t.rewrite(AT, lambda m: "@").rewrite(DOT, lambda m: ".")

    def named(m: re.Match) -> bool:
        like_an_account = m[1][0].isalpha() and ("." in m[1] or any(c in "0123456789" for c in m[1]))
        return like_an_account or CONTACT.search(m.string[max(0, m.start() - 24) : m.start()]) is not None

    def whole(m: re.Match) -> str:
        dots = m[1].lower().count(" dot ") + m[3].lower().count(" dot ")
        if m[2].strip().lower() == "at" and not dots and not named(m):
            return m[0]
        return re.sub(" dot ", ".", f"{m[1]}@{m[3]}", flags=re.IGNORECASE)

    return t.rewrite(BARE, whole)


def has_strange(text: str) -> bool:
    if text.isascii():
        return False
    try:
        latin = text.encode("latin-1")
    except UnicodeEncodeError:
        return not STRANGE.isdisjoint(text)
    return any(c in latin for c in STRANGE_LATIN)


def disguised(text: str) -> list[Span]:
    """Identifiers of the rewritten text, in places of the source. Empty without a trace of a disguise."""
    if not (has_strange(text) or DISGUISED.search(text) or SPELLED_HINT.search(f" {text.lower()}")):
        return []
    t = reduce(lambda x, f: f(x), (fold_characters, fold_digits, fold_signs), Traced.of(text))
    if t.text == text:
        return []
    good, failed = plain(t.text)
    return [t.source(s) for s in (*good, *inside(t.text, failed))]


def ordered(spans: set[Span] | list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def find(text: str) -> tuple[list[Span], list[Span]]:
    """Plain spans, and all spans: the plain ones and those added that lie in no other span of their kind."""
    base, failed = plain(text)
    every = set(base)
    for s in sorted({*inside(text, failed), *disguised(text)}, key=lambda s: s[0] - s[1]):
        if not any(o[2] == s[2] and o[0] <= s[0] and s[1] <= o[1] for o in every):
            every.add(s)
    return ordered(base), ordered(every)


def masked(text: str, spans: list[Span]) -> str:
    """Each run of overlapping spans is replaced by the kind of its first one, in brackets."""
    out, last, run = [], 0, None
    for start, end, kind in [*spans, (len(text) + 1, 0, "")]:
        if run and start < run[1]:
            run = (run[0], max(run[1], end), run[2])
            continue
        if run:
            out += [text[last : run[0]], f"[{run[2].upper()}]"]
            last = run[1]
        run = (start, end, kind)
    return "".join(out) + text[last:]


def mask_all(text: str) -> str:
    """Mask until nothing is left to find (a cut can join its neighbours)."""
    while spans := find(text)[1]:
        text = masked(text, spans)
    return text


SPAN = "array<struct<kind: string, start: long, end: long>>"
SPAN_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def _array(spans: list[list[Span]]) -> pa.Array:
    return pa.array([[{"kind": k, "start": a, "end": b} for a, b, k in own] for own in spans], SPAN_TYPE)


def find_pii(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, base, spans`` for every row: arrays of (kind, start, end) in code points, end exclusive, by start, then kind.

    ``base`` are the plain identifiers, ``spans`` those and the ones the transducers add. No shuffle. Null and empty texts
    have no spans; repeated rows and null keys stay as they are; other columns are ignored; an empty table gives no rows.
    """
    kind = df.schema[key].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, bodies in rows_of(batches):
            found = [find(b.decode("utf-8", "replace")) for b in bodies]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa_type(kind)), _array([f[0] for f in found]), _array([f[1] for f in found])], ["key", "base", "spans"])

    return texts(df, key, text).mapInArrow(scan, f"key {kind}, base {SPAN}, spans {SPAN}").withColumnRenamed("key", key)


def mask_pii(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with every span of ``text`` replaced by its kind in brackets; all other columns and rows as they are.

    Null stays null, an empty text stays empty.
    """

    @F.pandas_udf("string")
    def cleaned(s):  # noqa: ANN001, ANN202
        return s.map(lambda t: t if t is None else mask_all(t))

    return small_batches(df).withColumn(text, cleaned(df[text]))


def listed(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Numbers of plain spans by kind, the hash of their list, and the list of all spans."""
    def number(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    numbers = [number(k) for k in KINDS]
    return found.select(key, *numbers, F.sha2(listed(F.col("base")).cast("binary"), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))
