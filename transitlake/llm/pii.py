"""Personal data in texts, also where it is disguised, with spans in the text as it stands.

A text is read twice. First plainly: e-mail addresses, IPv4 addresses, payment cards and phone numbers by fixed patterns;
these spans always stay. Then through a transducer that writes a normal form and, for each character of it, where it came
from: homoglyphs, compatibility forms and all scripts' digits become ASCII, spelled digits beside digits become digits, "at" and
"dot" in brackets, or between what can be parts of an address or a number, become marks, whatever the address ends with. What the same patterns find there maps back to
source characters, and is added, also where the plain reading has a piece of it.
"""

from __future__ import annotations

import hashlib
import re
import sys
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
#: What replaces a span when a text is cleaned.
MASKS = {"email": "<EMAIL>", "ip": "<IP>", "card": "<CARD>", "phone": "<PHONE>"}

# The patterns are those of the plain reading. Where a match could only begin inside a run of digits if it had failed at
# the run's start, the look-behind says so, which keeps long runs from being tried at every digit.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    # a match holds one @, and what stands before it is the whole run of local characters since the match before
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _ordered(spans) -> list[tuple[int, int, int]]:
    """Spans by start, then kind as listed; of a kind's spans that start together the shorter first."""
    return sorted(spans, key=lambda s: (s[0], s[2], s[1]))


def plain_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind's place in KINDS), leftmost and non-overlapping for each kind; failing matches are dropped, not retried."""
    out = [(a, b, 0) for a, b in _emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        if all(len(x) <= 3 or not x[:-3].strip("0") for x in m[0].split(".")) and all(int(x[-3:]) <= 255 for x in m[0].split(".")):
            out.append((*m.span(), 1))
    for m in _CARD.finditer(text):
        d = _digits(m[0])
        if 14 <= len(d) <= 19 and _luhn(d):
            out.append((*m.span(), 2))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_digits(m[0])) <= 15:
                out.append((*m.span(), 3))
    return _ordered(out)


# Characters that look like ASCII letters, digits and marks, beyond those that compatibility forms (NFKC) map there.
_GLYPHS = {
    "ı": "i", "İ": "I",
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "һ": "h", "ӏ": "l", "в": "b", "к": "k", "м": "m", "н": "h", "т": "t",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "Х": "X", "І": "I", "Ј": "J", "Ѕ": "S",
    "α": "a", "ο": "o", "ρ": "p", "ν": "v", "ι": "i", "κ": "k", "τ": "t", "υ": "u", "χ": "x", "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
    "‐": "-", "‑": "-", "‒": "-", "–": "-", "—": "-", "−": "-", "․": ".", "。": ".", "﹒": ".", "﹫": "@", " ": " ", " ": " ", " ": " ", " ": " ",
}
_NEGATIVE = (0x1F150, 0x1F170, 0x1F1E6)  # white on black and regional letters, which have no compatibility form


def _glyph_table() -> dict[int, str]:
    """Every character that stands for ASCII ones: compatibility forms, digits of all scripts, look-alikes; formatting ones for nothing."""
    table = {}
    for c in map(chr, range(0x80, sys.maxunicode + 1)):
        if unicodedata.category(c) == "Cf" or "\ufe00" <= c <= "\ufe0f":
            table[ord(c)] = ""
        elif (d := unicodedata.digit(c, None)) is not None:
            table[ord(c)] = str(d)
        elif (form := unicodedata.normalize("NFKC", c)).isascii():
            table[ord(c)] = form
    return table | {z + i: chr(0x41 + i) for z in _NEGATIVE for i in range(26)} | {ord(k): v for k, v in _GLYPHS.items()}


def _class_of(codes: list[int]) -> str:
    """A character class of code points, in ranges."""
    runs: list[list[int]] = []
    for c in codes:
        if runs and c == runs[-1][1] + 1:
            runs[-1][1] = c
        else:
            runs.append([c, c])
    return "[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in runs) + "]"


_TABLE = _glyph_table()
_ODD = re.compile(_class_of(sorted(_TABLE)))
# The names of digits in four languages, without those that are common words of other sorts.
_NUMBERS = {
    "zero": 0, "oh": 0, "one": 1, "two": 2, "three": 3, "four": 4, "five": 5, "six": 6, "seven": 7, "eight": 8, "nine": 9,
    "null": 0, "eins": 1, "zwei": 2, "zwo": 2, "drei": 3, "vier": 4, "fünf": 5, "sechs": 6, "sieben": 7, "acht": 8, "neun": 9,
    "zéro": 0, "un": 1, "deux": 2, "trois": 3, "quatre": 4, "cinq": 5, "sept": 7, "huit": 8, "neuf": 9,
    "cero": 0, "uno": 1, "dos": 2, "tres": 3, "cuatro": 4, "cinco": 5, "seis": 6, "siete": 7, "ocho": 8, "nueve": 9,
}
_NUMBER = "(?:" + "|".join(sorted(_NUMBERS, key=len, reverse=True)) + ")"
_WORD_DOT = r"(?:dot|punkt|point|punto)"
_SPELLED = re.compile(rf"(?<!\w){_NUMBER}(?!\w)", re.I)
_SPOKEN_DOT = re.compile(rf"\s{{1,2}}{_WORD_DOT}\s{{1,2}}", re.I)
#: Digits and spelled digits in a row, and what stands between them; what they make up must still pass as an identifier.
_FIGURE = rf"(?:{_NUMBER}|[0-9]++)(?!\w)"
_BETWEEN = rf"(?:\s{{1,2}}{_WORD_DOT}\s{{1,2}}|[\s,.;:/()-]{{1,3}})"
_FIGURES = re.compile(rf"(?<!\w){_FIGURE}(?:{_BETWEEN}{_FIGURE})++", re.I)
_FIGURE_OR_BETWEEN = re.compile(rf"({_FIGURE})|{_BETWEEN}", re.I)
_PLUS = re.compile(r"(?<!\w)plus\s{1,2}(?=[0-9])", re.I)
_AT = r"(?:\x20{0,2}[\[({<]\x20?(?:at|@|arroba|arobase|ät)\x20?[\])}>]\x20{0,2})"
_DOT = r"(?:\x20{0,2}[\[({<]\x20?(?:dot|\.|punkt|point|punto)\x20?[\])}>]\x20{0,2})"
_BRACKETED = re.compile(rf"{_AT}|{_DOT}", re.I)
_SPOKEN_AT = re.compile(r"(?P<mark>@)|(?<=[A-Za-z0-9_%+-])\s{1,2}(?:at|arroba|arobase|ät)\s{1,2}(?=[A-Za-z0-9])", re.I)
_HOST = re.compile(rf"[A-Za-z0-9-]++(?:(?:\s{{1,2}}{_WORD_DOT}\s{{1,2}}|\.)[A-Za-z0-9-]++)++", re.I)
_DOT_BEFORE = re.compile(rf"(?<=[A-Za-z0-9_%+-])\s{{1,2}}{_WORD_DOT}\s{{1,2}}\Z", re.I)
#: What cannot begin a host's name after a spoken at, and what cannot where the dot is a word of many meanings.
_NO_HOST = frozenset("the that this these those which what every each".split())
_NO_POINT = _NO_HOST | frozenset("a an any some one no another certain my your his her its our their gun knife".split())
class Normal:
    """A normal form of a text; ``begin[k]`` and ``end[k]`` are the source characters that its character k stands for."""

    def __init__(self, text: str):
        self.text, self.begin, self.end = text, list(range(len(text))), list(range(1, len(text) + 1))

    def copy(self) -> Normal:
        new = Normal("")
        new.text, new.begin, new.end = self.text, self.begin, self.end
        return new

    def rewrite(self, edits: list[tuple[int, int, str]]) -> None:
        """Puts the new string in place of each run (start, end), in order; each of its characters stands for the whole run."""
        out, begin, end, at = [], [], [], 0
        for a, b, new in edits:
            out += [self.text[at:a], new]
            begin += self.begin[at:a] + [self.begin[a]] * len(new)
            end += self.end[at:a] + [self.end[b - 1]] * len(new)
            at = b
        self.text = "".join(out) + self.text[at:]
        self.begin, self.end = begin + self.begin[at:], end + self.end[at:]

    def source(self, a: int, b: int) -> tuple[int, int]:
        return self.begin[a], self.end[b - 1]


def _figure_edits(text: str, dots: bool) -> list[tuple[int, int, str]]:
    """Spelled digits become digits, spoken dots between digits become marks. What else is beside a spelled digit goes, but with ``dots`` not a dot."""
    edits = []
    for m in _FIGURES.finditer(text):
        parts = [(x.start(), x.end(), x[1]) for x in _FIGURE_OR_BETWEEN.finditer(text, m.start(), m.end())]
        for k, (a, b, figure) in enumerate(parts):
            if figure:
                if (d := _NUMBERS.get(figure.lower())) is not None:
                    edits.append((a, b, str(d)))
            elif any(x.isalpha() for x in text[a:b]):
                edits.append((a, b, "."))
            elif any(parts[j][2][0].isalpha() for j in (k - 1, k + 1)):
                edits.append((a, b, "." if dots and "." in text[a:b] else ""))
    return edits


def _address_edits(text: str) -> list[tuple[int, int, str]]:
    """Spoken at and dot become marks, with as many parts as there are, where a name stands before and a host with a dot after them.

    A spoken at counts beside a spoken dot only.
    """
    edits, done, at = [], 0, 0
    while m := _SPOKEN_AT.search(text, at):
        at = m.end()
        host = _HOST.match(text, m.end())
        if not host or m.start() <= done or text[m.start() - 1] not in _LOCAL:
            continue
        after = [(d.start(), d.end(), ".") for d in _SPOKEN_DOT.finditer(text, host.start(), host.end())]
        before, start = [], m.start()
        while True:
            while start > done and text[start - 1] in _LOCAL:
                start -= 1
            d = _DOT_BEFORE.search(text[max(done, start - 16) : start])
            if not d:
                break
            stop, start = start, start - len(d[0])
            before.append((start, stop, "."))
        done = at = host.end()
        if m["mark"]:
            edits += [*reversed(before), *after]
        elif before or after:
            first = re.match(r"[A-Za-z0-9-]+", host[0])[0].lower()
            spoken = {text[a:b].strip().lower() for a, b, _ in [*before, *after]}
            if first not in (_NO_HOST if "dot" in spoken else _NO_POINT):
                edits += [*reversed(before), (m.start(), m.end(), "@"), *after]
    return edits


def normal_forms(text: str) -> list[Normal]:
    """The text without disguises; none if it has none. Two where dots between spelled digits can be parts or mere separators."""
    odd = not text.isascii() and _ODD.search(text)
    out = Normal(text)
    if odd:
        out.rewrite([(m.start(), m.end(), _TABLE[ord(m[0])]) for m in _ODD.finditer(text)])
    bracketed = any(x in out.text for x in "[({<") and _BRACKETED.search(out.text)
    spoken, spelled = _SPOKEN_DOT.search(out.text), _SPELLED.search(out.text) or _PLUS.search(out.text)
    if not (odd or bracketed or spoken or spelled):
        return []
    if bracketed:
        out.rewrite([(m.start(), m.end(), "." if re.search(r"dot|punkt|point|punto|\.", m[0], re.I) else "@") for m in _BRACKETED.finditer(out.text)])
    forms = [out]
    if spoken or spelled:
        edits, others = _figure_edits(out.text, False), _figure_edits(out.text, True)
        if others != edits:
            forms.append(out.copy())
            forms[1].rewrite(others)
        out.rewrite(edits)
    for form in forms:
        if spelled or spoken:
            form.rewrite([(m.start(), m.end(), "+") for m in _PLUS.finditer(form.text)])
        if spoken:
            form.rewrite(_address_edits(form.text))
    return [x for x in forms if x.text != text]


def every_span(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(plain spans, all spans), each sorted by start and kind: beside the plain ones all that the normal forms show.

    A disguised identifier of which the plain reading has a piece gives a span of its own around that piece.
    """
    base = plain_spans(text)
    found = {(*normal.source(a, b), kind) for normal in normal_forms(text) for a, b, kind in plain_spans(normal.text)}
    if not found:
        return base, base
    return base, _ordered(found | set(base))


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in spans)


def find(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Per document: doc_id, n_email, n_ip, n_card, n_phone (plain spans), base_sha256 of the plain spans, spans (all of them).

    A span is kind:start:end in code points, the end exclusive; a disguised one can overlap plain ones. A null text is empty; repeated rows and other columns do
    not matter.
    """
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: list[list[int]] = [[] for _ in KINDS]
            digests, joined = [], []
            for text in batch.column("text").to_pylist():
                base, every = every_span(text)
                for k, column in enumerate(counts):
                    column.append(sum(x[2] == k for x in base))
                digests.append(hashlib.sha256(_joined(base).encode()).hexdigest())
                joined.append(_joined(every))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in counts), pa.array(digests, pa.string()), pa.array(joined, pa.string())], ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def masked_text(text: str) -> str:
    """The text with a mask in place of each span; of overlapping spans the one that starts first, then the longest, gives the mask for all they cover."""
    out, at, runs = [], 0, []
    for a, b, kind in sorted(every_span(text)[1], key=lambda s: (s[0], -s[1], s[2])):
        if runs and a < runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], b)
        else:
            runs.append([a, b, kind])
    for a, b, kind in runs:
        out += [text[at:a], MASKS[KINDS[kind]]]
        at = b
    return "".join([*out, text[at:]])


def mask(docs: DataFrame) -> DataFrame:
    """``docs`` with every span of ``text`` masked; ``n_chars``, if there, is counted anew where a text changed. Null stays null."""
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            new = [None if x is None else masked_text(x) for x in batch.column("text").to_pylist()]
            yield batch.set_column(names.index("text"), batch.schema.field("text"), pa.array(new, batch.schema.field("text").type))

    out = docs.mapInArrow(run, docs.schema)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in names else out
