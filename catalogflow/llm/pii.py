"""Personal data in text, also behind disguises (offset-preserving deobfuscation).

Transducers rewrite a text: homoglyphs to ASCII, spelled digits to digits, and written-out
at and dot to ``@`` and ``.``, in mail addresses and between digits. Each keeps, for every character it writes, the span of source
characters it stands for. Identifiers are detected in the rewritten text as in the source, and
their spans are mapped back to source characters.

Null text counts as empty and has no spans. Rows are treated one by one, so repeated rows give
repeated results and an empty table an empty one. Columns of any name pass through.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalogflow.llm.common import given_back

KINDS = ("email", "ip", "card", "phone")
_SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("base", T.BooleanType())]))
_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))

Span = tuple[int, int]

# The patterns of the four kinds.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a number that does not go on as an address from its first digit does not from a later one, so only first digits are tried
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Letters that look like the ASCII character before them.
_LOOKALIKES = {
    "a": "аɑα", "b": "Ьƅ", "c": "сϲ", "d": "ԁ", "e": "еҽ", "g": "ɡ", "h": "һ", "i": "іι", "j": "јϳ", "k": "κк", "l": "ӏ", "m": "м", "n": "ո",
    "o": "оοօ", "p": "рρ", "q": "ԛ", "r": "г", "s": "ѕ", "u": "υս", "v": "νѵ", "w": "ԝ", "x": "хχ", "y": "уγү", "z": "ᴢ",
    "A": "АΑ", "B": "ВΒ", "C": "СϹ", "E": "ЕΕ", "H": "НΗ", "I": "ІΙ", "J": "Ј", "K": "КΚ", "M": "МΜ", "N": "Ν", "O": "ОΟ", "P": "РΡ",
    "S": "Ѕ", "T": "ТΤ", "X": "ХΧ", "Y": "ҮΥ", "Z": "Ζ", "-": "\u2010\u2011\u2012\u2013\u2014\u2212", ".": "\u2024\u3002\uff61", "@": "\ufe6b",
    " ": "\u00a0\u2002\u2003\u2007\u2009\u200a\u202f\u3000",
}
_ZERO_WIDTH = "\u00ad\u200b\u200c\u200d\u200e\u200f\u2060\ufeff"
# Digit names in English, German, French and Spanish, in the order 0 to 9.
_DIGIT_NAMES = (
    "zero oh null zéro cero", "one eins un uno", "two zwei deux dos", "three drei trois tres", "four vier quatre cuatro",
    "five fünf cinq cinco", "six sechs seis", "seven sieben sept siete", "eight acht huit ocho", "nine neun neuf nueve",
)

_GLYPHS = {ord(c): ascii_ for ascii_, same in _LOOKALIKES.items() for c in same}
_GLYPHS |= {0xFF01 + i: chr(0x21 + i) for i in range(94)}  # full-width forms
for _first in (0x0660, 0x06F0, 0x0966, *range(0x1D7CE, 0x1D800, 10)):  # digits of other scripts and of mathematics
    _GLYPHS |= {_first + i: str(i) for i in range(10)}
_GLYPHS |= {ord(c): "" for c in _ZERO_WIDTH}
_STRANGE = re.compile("[" + "".join(re.escape(chr(c)) for c in sorted(_GLYPHS)) + "]")

_DIGITS = {name: str(i) for i, names in enumerate(_DIGIT_NAMES) for name in names.split()}
_NAME = "(?:" + "|".join(sorted(_DIGITS, key=len, reverse=True)) + ")"
_GAP = r"[ ,-]{1,2}"
_DOT_NAME = r"(?:dot|point|punkt|punto)"
# a run of digit names, which may hold written-out dots and begin with a written-out plus
_SPELLED = re.compile(rf"(?<![^\W_])(?:plus{_GAP})?{_NAME}(?:{_GAP}(?:{_NAME}|{_DOT_NAME}(?={_GAP}{_NAME})))+(?![^\W_])", re.I)
_PART = re.compile(rf"plus|{_DOT_NAME}|{_NAME}", re.I)

_AT_MARK = r"\s{0,3}[\[({<]\s?(?:at|@|arroba)\s?[\])}>]\s{0,3}"
_DOT_MARK = rf"(?:\s{{0,3}}[\[({{<]\s?(?:{_DOT_NAME}|\.)\s?[\])}}>]\s{{0,3}}|\s{{1,3}}(?:dot|punkt|punto)\s{{1,3}})"
_HIDDEN = re.compile(rf"[\[({{<]\s?(?:at|@|arroba|{_DOT_NAME}|\.)\s?[\])}}>]|\s(?:dot|punkt|punto)\s", re.I)
_MARKS = ("[", "(", "{", "<", "dot", "point", "punkt", "punto")
_AT = re.compile(rf"{_AT_MARK}|\s{{1,3}}at\s{{1,3}}|\s?@\s?", re.I)
_DOT = re.compile(_DOT_MARK, re.I)
_HIDDEN_DOMAIN = re.compile(rf"[A-Za-z0-9-]+(?:(?:\.|{_DOT_MARK})[A-Za-z0-9-]+)+", re.I)
_HIDDEN_LOCAL = re.compile(rf"[A-Za-z0-9._%+-]+(?:{_DOT_MARK}[A-Za-z0-9._%+-]+)*$", re.I)
# a disguised dot before a digit or a digit name
_NUMBER_DOT = re.compile(rf"(?:[\[({{<]\s?(?:{_DOT_NAME}|\.)\s?[\])}}>]\s{{0,3}}|{_DOT_NAME}[\s,-]{{0,3}})(?=[0-9]|{_NAME}(?![^\W_]))", re.I)
_NAME_BEFORE = re.compile(rf"(?<![^\W_]){_NAME}$", re.I)
_NAME_AFTER = re.compile(rf"{_NAME}(?![^\W_])", re.I)
_NAME_REACH = 1 + max(map(len, _DIGITS))
_LOCAL_REACH = 320  # the longest address that mail allows


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) << (i & 1)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterable[Span]:
    """Every @ with a domain after it and a local part before it, in linear time for any text."""
    free = 0  # where the match before ended
    at = text.find("@")
    while at >= 0:
        begin = at
        while begin > free and text[begin - 1] in _LOCAL:
            begin -= 1
        found = _DOMAIN.match(text, at) if begin < at else None
        if found:
            yield begin, found.end()
            free = found.end()
        at = text.find("@", max(at + 1, free))


def detect(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the leftmost non-overlapping identifiers, by kind and start."""
    found = [(0, a, b) for a, b in _emails(text)] if "@" in text else []
    found += [(1, m.start(), m.end()) for m in _IP.finditer(text) if all(int(p[-4:] if len(p := x.lstrip("0")) > 3 else p or 0) <= 255 and len(p) < 4 for x in m[0].split("."))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and _luhn(digits):
                found.append((2, m.start(), m.end()))
    if "+" in text:
        found += [(3, m.start(), m.end()) for m in _PHONE.finditer(text) if 8 <= sum(c.isdigit() for c in m[0]) <= 15]
    return found


class Rewritten:
    """A rewritten text and, for stretches of it, where they come from.

    A stretch is copied (its characters stand for one source character each) or replaced (each
    stands for the whole source span).
    """

    def __init__(self, text: str):
        self.text = text
        self._stretches: list[tuple[int, int, int, bool]] = [(0, 0, len(text), True)]  # begin, source begin, source end, copied
        self._begins = [0]

    def source(self, start: int, end: int) -> Span:
        first, last = (self._stretches[bisect_right(self._begins, at) - 1] for at in (start, end - 1))
        a = first[1] + (start - first[0] if first[3] else 0)
        b = last[1] + (end - last[0]) if last[3] else last[2]
        return a, b

    def replace(self, edits: list[tuple[int, int, str]]) -> None:
        """Replace spans of the present text; ``edits`` are in order and do not overlap."""
        if not edits:
            return
        pieces, stretches, size, at = [], [], 0, 0

        def copy(a: int, b: int) -> None:
            nonlocal size
            i = bisect_right(self._begins, a) - 1
            while a < b:
                begin, s, e, copied = self._stretches[i]
                stop = min(b, self._begins[i + 1] if i + 1 < len(self._begins) else len(self.text))
                if stop > a:
                    stretches.append((size, s + a - begin, s + stop - begin, True) if copied else (size, s, e, False))
                    size += stop - a
                    a = stop
                i += 1

        for a, b, new in edits:
            copy(at, a)
            pieces += [self.text[at:a], new]
            if new:
                stretches.append((size, *self.source(a, b), False))
                size += len(new)
            at = b
        copy(at, len(self.text))
        pieces.append(self.text[at:])
        self.text, self._stretches, self._begins = "".join(pieces), stretches, [s[0] for s in stretches]


def _glyphs(now: Rewritten) -> None:
    now.replace([(m.start(), m.end(), _GLYPHS[ord(m[0])]) for m in _STRANGE.finditer(now.text)])


def _spelled(now: Rewritten) -> None:
    edits = []
    for run in _SPELLED.finditer(now.text):
        parts = list(_PART.finditer(now.text, run.start(), run.end()))
        for part, after in zip(parts, [*parts[1:], None]):
            word = part[0].lower()
            edits.append((part.start(), part.end(), _DIGITS.get(word) or ("+" if word == "plus" else ".")))
            if after:
                edits.append((part.end(), after.start(), ""))
    now.replace(edits)


def _number_dots(now: Rewritten) -> None:
    """Disguised dots between digits, of which single ones may still be spelled."""
    text, edits = now.text, {}
    for dot in _NUMBER_DOT.finditer(text):
        begin = dot.start()
        while dot.start() - begin < 3 and begin and (text[begin - 1].isspace() or text[begin - 1] in ",-"):
            begin -= 1
        names = []
        if not (begin and text[begin - 1] in "0123456789"):
            low = max(0, begin - _NAME_REACH)
            name = _NAME_BEFORE.search(text[low:begin])
            if not name:
                continue
            names.append((low + name.start(), low + name.end(), name[0]))
        if text[dot.end()] not in "0123456789":
            name = _NAME_AFTER.match(text, dot.end())
            names.append((*name.span(), name[0]))
        edits[begin, dot.end()] = "."
        edits |= {(a, b): _DIGITS[name.lower()] for a, b, name in names}
    now.replace(sorted((a, b, new) for (a, b), new in edits.items()))


def _addresses(now: Rewritten) -> None:
    text, free, edits = now.text, 0, []
    for at in _AT.finditer(text):
        if at.start() < free:
            continue
        domain = _HIDDEN_DOMAIN.match(text, at.end())
        local = _HIDDEN_LOCAL.search(text[max(free, at.start() - _LOCAL_REACH) : at.start()]) if domain else None
        if not local:
            continue
        begin = max(free, at.start() - _LOCAL_REACH) + local.start()
        dots = [m for a, b in ((begin, at.start()), domain.span()) for m in _DOT.finditer(text, a, b)]
        bare = at[0].strip().lower() in ("at", "@")
        # a bare "at" is a common word: the domain must have a disguised dot then
        if bare and not any(m.start() >= domain.start() for m in dots):
            continue
        edits += sorted([(m.start(), m.end(), ".") for m in dots] + [(at.start(), at.end(), "@")])
        free = domain.end()
    now.replace(edits)


def find(text: str | None) -> list[tuple[int, int, int, bool]]:
    """All (kind, start, end, base) of a text: those found in it as it is, and those found behind disguises.

    A span from the rewritten text is added unless a base span of its kind holds it whole.
    """
    if not text:
        return []
    base = detect(text)
    found = [(*span, True) for span in base]
    strange = not text.isascii() and _STRANGE.search(text)
    small = text.lower()
    spelled = _SPELLED.search(text)
    hidden = any(mark in small for mark in _MARKS) and (_HIDDEN.search(text) or _NUMBER_DOT.search(text))
    if strange or spelled or hidden:
        now = Rewritten(text)
        if strange:
            _glyphs(now)
        _addresses(now)
        _spelled(now)
        _number_dots(now)
        seen = set()
        for kind, a, b in detect(now.text):
            start, end = now.source(a, b)
            if (kind, start, end) not in seen and not any(k == kind and s <= start and end <= e for k, s, e in base):
                seen.add((kind, start, end))
                found.append((kind, start, end, False))
    return sorted(found)


@F.arrow_udf(_SPANS)
def _spans(texts: pa.Array) -> pa.Array:
    return given_back(pa.array([[(KINDS[k], a, b, base) for k, a, b, base in find(t.as_py())] for t in texts], _ARROW))


def redact(text: str | None) -> str | None:
    """The text with a mark in place of each span; spans that touch one another share a mark."""
    if text is None:
        return None
    out, at = [], 0
    merged: list[list] = []
    for a, b, kind in sorted((a, b, kind) for kind, a, b, _ in find(text)):
        if merged and a < merged[-1][1]:
            merged[-1][1] = max(b, merged[-1][1])
        else:
            merged.append([a, b, kind])
    for a, b, kind in merged:
        out += [text[at:a], f"<{KINDS[kind].upper()}>"]
        at = b
    return "".join([*out, text[at:]])


@F.arrow_udf(T.StringType())
def _redacted(texts: pa.Array) -> pa.Array:
    return given_back(pa.array([redact(t.as_py()) for t in texts], pa.string()))


def pii_spans(text: str | Column) -> Column:
    """Spans of personal data, ordered by kind as in ``KINDS`` and then start; end is exclusive, in code points."""
    return _spans(text)


def redact_pii(docs: DataFrame, text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """``docs`` with personal data replaced in ``text``; all rows and columns stay, ``n_chars`` follows the new text."""
    out = docs.withColumn(text, _redacted(text))
    if n_chars in docs.columns:
        out = out.withColumn(n_chars, F.when(F.col(text).isNull(), F.col(n_chars)).otherwise(F.length(text)).cast(docs.schema[n_chars].dataType))
    return out
