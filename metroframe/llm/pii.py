"""Personal data in texts, disguised or plain, as spans of the original text.

Every text is searched as it is (the base spans). Then three transducers
rewrite it: look-alike characters become ASCII and invisible ones go, written-out
``at`` and ``dot`` become ``@`` and ``.``, and spelled digits become digits. Each
keeps a list of its edits, so a place in the rewritten text leads back to the
place in the source. What the same detectors find only in the rewritten text is
mapped back through all three and added.

Texts in which no transducer finds anything to rewrite, nearly all, cost the
searches alone. All searches take time in proportion to the text, also where it
is one run of digits or letters. No shuffle; a row never meets another.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from metroframe.llm.common import sliced, texts_and_ids

KINDS = ["email", "ip", "card", "phone"]

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
#: a match never begins within a run of digits, so later places in one need no look
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: fixed values: characters that look like the ASCII one before them
LOOK_ALIKES = {
    "a": "аαɑ", "c": "сϲ", "d": "ԁ", "e": "еҽ", "g": "ɡ", "h": "һ", "i": "іıɩ", "j": "јϳ", "k": "κ", "l": "ӏ", "n": "ո", "o": "оοօ", "p": "рρ",
    "q": "ԛ", "s": "ѕ", "u": "ս", "v": "ѵν", "w": "ԝ", "x": "хχ", "y": "уү", "A": "АΑ", "B": "ВΒ", "C": "СϹ", "E": "ЕΕ", "H": "НΗ", "I": "ІΙ",
    "J": "Ј", "K": "КΚ", "M": "МΜ", "N": "Ν", "O": "ОΟ", "P": "РΡ", "S": "Ѕ", "T": "ТΤ", "X": "ХΧ", "Y": "ҮΥ", "Z": "Ζ",
    "-": "‐‑‒–—−", ".": "․。｡", " ": "    ", "+": "➕",
}
INVISIBLE = "­​‌‍⁠﻿"
ALIKE = {ord(c): plain for plain, listed in LOOK_ALIKES.items() for c in listed}


def plain_character(c: str) -> str:
    """The ASCII character that ``c`` stands for, else ``c``."""
    if c < "\x80":
        return c
    if ord(c) in ALIKE:
        return ALIKE[ord(c)]
    digit = unicodedata.digit(c, None)
    if digit is not None and unicodedata.category(c) == "Nd":
        return str(digit)
    folded = unicodedata.normalize("NFKC", c)  # full-width and mathematical forms
    return folded if len(folded) == 1 and "\x20" < folded < "\x80" and unicodedata.category(c) != "No" else c


class PlainCharacters(dict):
    """For ``str.translate``: works out a character when it is first met."""

    def __missing__(self, code: int) -> str:
        self[code] = plain = plain_character(chr(code))
        return plain


#: fixed values: the digits' names in English, German, Spanish and French; those
#: that are common words for something else (ein, un) are left out
DIGIT_NAMES = {
    0: "zero null cero zéro", 1: "one eins uno", 2: "two zwei dos deux", 3: "three drei tres trois", 4: "four vier cuatro quatre",
    5: "five fünf cinco cinq", 6: "six sechs seis", 7: "seven sieben siete sept", 8: "eight acht ocho huit", 9: "nine neun nueve neuf",
}
DIGITS = {name: str(d) for d, names in DIGIT_NAMES.items() for name in names.split()}
NAME = "|".join(sorted(DIGITS, key=lambda w: (-len(w), w)))
SPELLED_TOKEN = re.compile(rf"(?:{NAME}|plus|dot|punkt|punto|point)(?![^\W_])|[0-9]++|[+.]", re.I)
#: at least three names of digits, with digits, plus and dot between them
SPELLED = re.compile(rf"(?<![^\W_])(?:(?:plus\b|\+)[\x20-]?)?(?:{NAME})(?![^\W_])(?:[\x20,-]{{1,2}}(?:{NAME}|dot|punkt|punto|point|[0-9]++)(?![^\W_]))++", re.I)
NAMES_AMONG = re.compile(rf"(?<![^\W_])(?:{NAME})(?![^\W_])", re.I)
LEAST_NAMES = 3
SPLIT = re.compile(r"[^\w ]+|_+")
#: O for 0, l or I for 1 between digits
WITHIN_NUMBER = re.compile(r"[0-9]([OoIl])(?=[0-9])")

BRACKETED = re.compile(r"[\[({<][\x20]?(?:(?P<at>at|arroba|@)|(?P<dot>dot|punkt|punto|point|\.))[\x20]?[\])}>]", re.I)
#: at and dot as words of their own: only where a known top-level domain ends the address
TOP_LEVEL = "com|org|net|edu|gov|info|io|dev|biz|eu|de|fr|es|uk|us|ch|at|it|nl|be|ca|au"
WORDED = re.compile(rf"(?<=[A-Za-z0-9_%+-])\x20(?:at|arroba)\x20(?P<domain>[A-Za-z0-9-]++(?:(?:\x20(?:dot|punkt|punto|point)\x20|\.)(?!(?:dot|punkt|punto|point)\b)[A-Za-z0-9-]++)*?"
                    rf"\x20(?:dot|punkt|punto|point)\x20(?:{TOP_LEVEL}))(?![^\W_])", re.I)
WORDED_DOT = re.compile(r"\x20(?:dot|punkt|punto|point)\x20", re.I)
SPACED_AT = re.compile(r"(?<=[A-Za-z0-9_%+-])\x20@\x20(?=[A-Za-z0-9-]+\.[A-Za-z0-9])")

Edit = tuple[int, int, str]


class Rewritten:
    """A text after edits (start, end, replacement), in order and apart, and
    the way back from its places to those of the text before."""

    def __init__(self, text: str, edits: list[Edit]) -> None:
        out, at, size = [], 0, 0
        self.new_start, self.new_end, self.old_start, self.old_end = [], [], [], []
        for start, end, replacement in edits:
            out += [text[at:start], replacement]
            size += start - at
            self.new_start.append(size)
            size += len(replacement)
            self.new_end.append(size)
            self.old_start.append(start)
            self.old_end.append(end)
            at = end
        out.append(text[at:])
        self.text = "".join(out)

    def source(self, place: int) -> tuple[int, int]:
        """The source range of the character at ``place``."""
        i = bisect_right(self.new_start, place) - 1
        # an edit without a replacement holds no character
        if i < 0:
            return place, place + 1
        if place < self.new_end[i]:
            return self.old_start[i], self.old_end[i]
        old = place - self.new_end[i] + self.old_end[i]
        return old, old + 1


def plain_edits(text: str, folded: PlainCharacters) -> tuple[str, list[Edit]]:
    """The text with look-alikes replaced one for one, and the deletions."""
    if text.isascii() or all(folded[ord(c)] == c and c not in INVISIBLE for c in set(text)):
        return text, []
    return text.translate(folded), [(m.start(), m.end(), "") for m in re.finditer(f"[{INVISIBLE}]+", text)]


def address_edits(text: str) -> list[Edit]:
    def blank(at: int) -> int:
        return int(0 <= at < len(text) and text[at] in " \t")

    edits = []
    if any(c in text for c in "[({<"):
        edits += [(m.start() - blank(m.start() - 1), m.end() + blank(m.end()), "@" if m["at"] else ".") for m in BRACKETED.finditer(text)]
    low = text.lower()  # only to see whether a search is worth its time
    worded = any(f" {w} " in low for w in ("at", "arroba")) and any(f" {w} " in low for w in ("dot", "punkt", "punto", "point"))
    for m in WORDED.finditer(text) if worded else ():
        begin = m.start("domain")
        edits.append((m.start(), begin, "@"))
        edits += [(begin + d.start(), begin + d.end(), ".") for d in WORDED_DOT.finditer(m["domain"])]
    if "@" in text:
        edits += [(m.start(), m.end(), "@") for m in SPACED_AT.finditer(text)]
    out: list[Edit] = []
    for e in sorted(edits):
        if not out or e[0] >= out[-1][1]:
            out.append(e)
    return out


def digit_edits(text: str) -> list[Edit]:
    """Each spelled token is an edit of its own, with the blanks before it, so
    that a span may begin or end at any of them."""
    edits: list[Edit] = [(m.start(1), m.end(1), "0" if m[1] in "Oo" else "1") for m in WITHIN_NUMBER.finditer(text)]
    named = not DIGITS.keys().isdisjoint(SPLIT.sub(" ", text.lower()).split())
    for run in SPELLED.finditer(text) if named else ():
        if sum(1 for _ in NAMES_AMONG.finditer(run.group())) < LEAST_NAMES:
            continue
        for i, t in enumerate(SPELLED_TOKEN.finditer(text, run.start(), run.end())):
            word = t.group().lower()
            new = DIGITS.get(word) or {"plus": "+", "dot": ".", "punkt": ".", "punto": ".", "point": "."}.get(word, word)
            if i:
                edits.append((last, t.start(), ""))
            edits.append((t.start(), t.end(), new))
            last = t.end()
    out: list[Edit] = []
    for e in sorted(edits):
        if e[0] < e[1] and (not out or e[0] >= out[-1][1]):
            out.append(e)
    return out


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def detect(text: str) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end) of all matches, in order."""
    found, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            found.append((start, 0, m.end()))
            end = m.end()
        # without a domain the next match may begin behind this sign only
        end = max(end, at + 1) if not m else end
        at = text.find("@", max(end, at + 1))
    for m in IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in m.group().split(".")):
            found.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() <= 37:
            digits = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
    at = text.find("+")
    while at >= 0:
        m = PHONE.match(text, at)
        if m and 9 <= sum(map(str.isdigit, m.group())) <= 15:
            found.append((m.start(), 3, m.end()))
        at = text.find("+", m.end() if m else at + 1)
    return sorted(found)


def disguised(text: str, base: list[tuple[int, int, int]], folded: PlainCharacters) -> list[tuple[int, int, int]]:
    """What the detectors find in the rewritten text only, as source spans;
    none overlaps a base span of its kind."""
    plain, gone = plain_edits(text, folded)
    steps = [Rewritten(plain, gone)]
    for edits in (address_edits, digit_edits):
        made = edits(steps[-1].text)
        if made:
            steps.append(Rewritten(steps[-1].text, made))
    if plain == text and not gone and len(steps) == 1:
        return []
    plainly: dict[int, list[tuple[int, int]]] = {}
    for start, kind, end in base:
        plainly.setdefault(kind, []).append((start, end))
    out = []
    for start, kind, end in detect(steps[-1].text):
        first, last = start, end - 1
        for step in reversed(steps):
            first = step.source(first)[0]
            last = step.source(last)[1] - 1
        known = plainly.get(kind, ())
        i = bisect_right(known, (last, len(text))) - 1 if known else -1
        if i < 0 or known[i][1] <= first:
            out.append((first, kind, last + 1))
    return out


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``df``: doc_id, spans, an array of (kind, start, end,
    base) by start, then kind as in KINDS. Places count code points, ends are
    exclusive; ``base`` marks what the plain text shows. Null and empty texts
    have no spans; repeated rows and null ids get a row each; an empty table
    gives an empty one. Other columns are not read."""
    rows = texts_and_ids(df, id_col, text_col)
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        folded = PlainCharacters()
        span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())])
        for batch in sliced(batches, "text"):
            out = []
            for text in batch.column("text").to_pylist():
                base = detect(text)
                both = [(*s, True) for s in base] + [(*s, False) for s in disguised(text, base, folded)]
                out.append([{"kind": KINDS[kind], "start": start, "end": end, "base": plain} for start, kind, end, plain in sorted(both)])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.list_(span))], ["doc_id", "spans"])

    return rows.mapInArrow(run, f"doc_id {id_type}, spans array<struct<kind:string,start:long,end:long,base:boolean>>")
