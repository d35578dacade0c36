"""Personal data (operator 1): offset-preserving deobfuscation before detection.

Three transducers run one after the other over a whole text: (1) characters
that only look like ASCII become ASCII and invisible ones go, (2) spelled
digits become digits, (3) at/dot disguises become ``@`` and ``.``.  Each
reads its input left to right and writes an output together with the source
interval of every rewritten piece; text between two rewrites is copied, so an
output position maps back to the source by one binary search.  The detectors
run on the source (base spans) and, where anything was rewritten, on the
output; a span found there is mapped back and added, unless the source already
showed it or showed one of its kind that crosses it.
"""

from __future__ import annotations

import functools
import re
import unicodedata
from bisect import bisect_left
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import id_text, slices, texts_of

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]

# ---------------------------------------------------------------- detectors

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]")
_DOTTED = re.compile(r"(?<![0-9])[0-9]++\.[0-9][0-9.]*+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def emails(text: str) -> Iterator[Span]:
    """Leftmost non-overlapping addresses, anchored at each ``@`` so long runs stay linear."""
    done, at = 0, text.find("@")
    while at >= 0:
        domain = _DOMAIN.match(text, at + 1)
        if domain:
            start = at
            while start > done and _LOCAL_END.match(text, start - 1):
                start -= 1
            if start < at:
                yield "email", start, domain.end()
                done = domain.end()
        at = text.find("@", max(at + 1, done))


def ips(text: str) -> Iterator[Span]:
    """Four dotted numbers, taken greedily from the left of each run of digits and dots."""
    for run in _DOTTED.finditer(text):
        parts, ends, at = run.group().split("."), [], run.start()
        for part in parts:
            at += len(part)
            ends.append(at)
            at += 1
        i = 0
        while i + 3 < len(parts):
            four = parts[i : i + 4]
            if not all(four):
                i += 1
                continue
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in four):
                yield "ip", ends[i] - len(parts[i]), ends[i + 3]
            i += 4


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def cards(text: str) -> Iterator[Span]:
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m.group().replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                yield "card", m.start(), m.end()


def phones(text: str) -> Iterator[Span]:
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= sum(c.isdigit() for c in m.group()) <= 15:
                yield "phone", m.start(), m.end()


def detect(text: str) -> list[Span]:
    """All base spans of a text (code points, end exclusive), kind by kind."""
    return [*emails(text), *ips(text), *cards(text), *phones(text)]


# ------------------------------------------------------------- transducers

# Letters of other scripts that look like these ASCII letters.
HOMOGLYPHS = {
    "a": "аɑα", "b": "Ьƅ", "c": "сϲ", "d": "ԁ", "e": "еҽ", "g": "ɡ", "h": "һ", "i": "іıι", "j": "ј", "k": "κк",
    "l": "ӏ", "m": "м", "n": "ո", "o": "оοօ", "p": "рρ", "q": "ԛ", "r": "г", "s": "ѕ", "t": "т", "u": "υս", "v": "ν",
    "w": "ԝ", "x": "хχ", "y": "уγ", "z": "ᴢ",
    "A": "АΑ", "B": "ВΒ", "C": "СϹ", "E": "ЕΕ", "H": "НΗ", "I": "ІΙ", "J": "Ј", "K": "КΚ", "M": "МΜ", "N": "Ν", "O": "ОΟ",
    "P": "РΡ", "S": "Ѕ", "T": "ТΤ", "X": "ХΧ", "Y": "ΥҮ", "Z": "Ζ",
    "-": "‐‑‒–—−", ".": "․。", "@": "﹫",
}
# Characters without width.
INVISIBLE = "­​‌‍⁠﻿"
# The ten digits as words, and the words for the two signs.
DIGIT_WORDS = {
    "en": "zero one two three four five six seven eight nine",
    "de": "null eins zwei drei vier fünf sechs sieben acht neun",
    "fr": "zéro un deux trois quatre cinq six sept huit neuf",
    "es": "cero uno dos tres cuatro cinco seis siete ocho nueve",
}
EXTRA_DIGIT_WORDS = {"oh": "0", "nil": "0", "zwo": "2", "niner": "9"}
AT_WORDS = ("at", "arroba", "arobase", "ät", "klammeraffe")
DOT_WORDS = ("dot", "punkt", "point", "punto", "period")
PLUS_WORDS = ("plus", "más", "mas")
# Words before "at" and a plainly written domain that are no mailbox ("look at example.com").
NO_MAILBOX = (
    "a above account all also am an and arrive articles as available back be been below book buy by call check click contact "
    "details down download everyone find for found free from go good here host hosted in info is it join just learn live located "
    "look looking me more news not now of on online open or order out over page pages place register sale see shop sign site "
    "sites staff start stay stop store that the them there these this time to today up us via view visit was we website were work "
    "works you"
).split()


@functools.lru_cache(maxsize=1)
def character_table() -> dict[str, str]:
    """Character -> its ASCII reading: the fixed look-alikes and what Unicode itself calls compatible."""
    table = {c: a for a, cs in HOMOGLYPHS.items() for c in cs}
    table.update(dict.fromkeys(INVISIBLE, ""))
    for code in (*range(0x0660, 0x1100), *range(0x2000, 0x2500), *range(0xFB00, 0x10000), *range(0x1D400, 0x1D800)):
        c = chr(code)
        if c not in table and not c.isspace():
            digit = unicodedata.decimal(c, None)
            plain = str(digit) if digit is not None else unicodedata.normalize("NFKC", c)
            if len(plain) == 1 and "!" <= plain <= "~" and plain != c:
                table[c] = plain
    return table


@functools.lru_cache(maxsize=1)
def _patterns() -> dict[str, re.Pattern]:
    words = sorted(digit_words(), key=len, reverse=True)
    word = "(?:" + "|".join(map(re.escape, words)) + ")"
    gap = r"(?:[ ]{1,2}|[ ]?[-,][ ]?|\.)"
    at, dot, plus = ("|".join(map(re.escape, x)) for x in (AT_WORDS, DOT_WORDS, PLUS_WORDS))
    return {
        "sign hint": re.compile(r"[\[({<][ ]?(?:[@.]|" + at + r")[ ]?[\])}>]| @|@ ", re.I),
        # a spelled at before a plainly written domain
        "at hint": re.compile(rf"[A-Za-z0-9][ _-](?:{at})[ _-][A-Za-z0-9-]+\.[A-Za-z0-9]", re.I),
        # two spelled digits in a row, or one beside a written digit
        "digits": re.compile(rf"(?<!\w){word}(?:{gap}{word})+(?!\w)|(?<=[0-9][ -]){word}(?!\w)|(?<!\w){word}(?=[ -][0-9])|(?<=[0-9]\.){word}(?!\w)", re.I),
        "word": re.compile(word + r"|\.", re.I),
        "plus": re.compile(rf"(?<!\w)(?:{plus})[ ]+(?=[0-9])", re.I),
        "signs": re.compile(
            rf"(?P<at1>[ ]?[\[({{<][ ]?(?:{at}|@)[ ]?[\])}}>][ ]?)|(?P<dot1>[ ]?[\[({{<][ ]?(?:{dot}|\.)[ ]?[\])}}>][ ]?)"
            rf"|(?P<at2>(?<=[A-Za-z0-9])[ _-](?:{at})[ _-](?=[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*(?:[ _-](?:{dot})[ _-]|[ ]?[\[({{<][ ]?(?:{dot}|\.))[ ]?))"
            rf"|(?P<at4>(?<=[A-Za-z0-9])[ _-](?:{at})[ _-](?=[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{{2,}}(?![A-Za-z0-9-])))"
            rf"|(?P<dot2>(?<=[A-Za-z0-9])[ _-](?:{dot})[ _-](?=[A-Za-z0-9]))|(?P<at3>(?<=[A-Za-z0-9])[ ]@[ ]?(?=[A-Za-z0-9-]+(?:\.|[ ]\.[ ]))|(?<=[A-Za-z0-9])@[ ](?=[A-Za-z0-9-]+(?:\.|[ ]\.[ ])))"
            rf"|(?P<dot3>(?<=[A-Za-z0-9])[ ]\.[ ](?=[A-Za-z0-9]))",
            re.I,
        ),
    }


@functools.lru_cache(maxsize=1)
def digit_words() -> dict[str, str]:
    named = {w: str(i) for words in DIGIT_WORDS.values() for i, w in enumerate(words.split())}
    return named | EXTRA_DIGIT_WORDS


class Tape:
    """A text and, for each of its characters, the source interval it stands for."""

    def __init__(self, text: str):
        self.text = text
        self.starts: list[int] | None = None  # None: nothing rewritten yet
        self.ends: list[int] = []

    def rewrite(self, pattern: re.Pattern, replace: Callable[[re.Match], str | None]) -> None:
        """One transducer pass; ``replace`` may decline with None."""
        parts, starts, ends, last = [], [], [], 0
        for m in pattern.finditer(self.text):
            put = replace(m)
            if put is None:
                continue
            if self.starts is None:
                self.starts, self.ends = list(range(len(self.text))), list(range(1, len(self.text) + 1))
            i, j = m.span()
            parts += (self.text[last:i], put)
            starts += self.starts[last:i] + [self.starts[i]] * len(put)
            ends += self.ends[last:i] + [self.ends[j - 1]] * len(put)
            last = j
        if parts:
            self.text = "".join([*parts, self.text[last:]])
            self.starts, self.ends = starts + self.starts[last:], ends + self.ends[last:]

    def source(self, start: int, end: int) -> tuple[int, int]:
        """The source interval of a non-empty output interval."""
        return self.starts[start], self.ends[end - 1]


def _one_digit_run(m: re.Match) -> str:
    """The digits of a run of digit words; dots between them stay."""
    names = digit_words()
    return "".join(names.get(w.lower(), w) for w in _patterns()["word"].findall(m.group()))


_LAST_WORD = re.compile(r"[A-Za-z0-9._%+-]+$")
_HOST = re.compile(r"@[ ]?[A-Za-z0-9-]+(?:[ ]?\.[ ]?[A-Za-z0-9-]+)*$")


def _sign(m: re.Match) -> str | None:
    """The sign that a disguise stands for; None where it is none."""
    if m.lastgroup == "dot3" and not _HOST.search(m.string, max(0, m.start() - 255), m.start()):
        return None  # a spaced dot counts inside an address alone
    if m.lastgroup == "at4":
        before = _LAST_WORD.search(m.string, max(0, m.start() - 64), m.start())
        if before and before.group().lower() in NO_MAILBOX:
            return None
    return "@" if m.lastgroup.startswith("at") else "."


_BEYOND_LATIN = re.compile("[^\x00-\xff]|\xad")
_MARKS = "()[]{}<>,.;:-_+/|\"'!?*"  # what may touch a word


def normalise(text: str) -> Tape:
    """The text with disguises undone, and the way back.

    A pass is skipped where none of the words or signs it needs occurs.
    """
    p, tape, table = _patterns(), Tape(text), character_table()
    if _BEYOND_LATIN.search(text):
        tape.rewrite(_BEYOND_LATIN, lambda m: table.get(m.group()))
    bare = tape.text.lower()
    for c in _MARKS:
        if c in bare:
            bare = bare.replace(c, " ")
    tokens = set(bare.split())
    if not tokens.isdisjoint(DOT_WORDS) or any(c in tape.text for c in "@[({<") and p["sign hint"].search(tape.text) or not tokens.isdisjoint(AT_WORDS) and p["at hint"].search(tape.text):
        tape.rewrite(p["signs"], _sign)
    if not tokens.isdisjoint(digit_words()):
        tape.rewrite(p["digits"], _one_digit_run)
        if not tokens.isdisjoint(PLUS_WORDS):
            tape.rewrite(p["plus"], lambda m: "+")
    return tape


def find_spans(text: str) -> list[tuple[str, int, int, bool]]:
    """Base spans (True) and those that only the normalised text shows (False), by start, then kind."""
    base = detect(text)
    found = [(k, s, e, True) for k, s, e in base]
    tape = normalise(text)
    if tape.starts is not None:
        held = {kind: sorted((s, e) for k, s, e in base if k == kind) for kind in KINDS}
        for kind, o0, o1 in detect(tape.text):
            s, e = tape.source(o0, o1)
            stop = bisect_left(held[kind], (e, 0))
            met = [x for x in held[kind][max(0, bisect_left(held[kind], (s, 0)) - 1) : stop] if x[1] > s]
            if met != [(s, e)] and all(s <= x and y <= e for x, y in met):
                found.append((kind, s, e, False))
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


SPANS_DDL = "doc_id long, spans array<struct<kind:string,start:int,end:int,base:boolean>>"
_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())])


def find_pii(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Personal data of every whole text: ``doc_id`` and its spans.

    A span is kind, start, end (code points, end exclusive) and whether the
    plain text shows it (``base``).  Null or empty text: no spans.  Repeated
    rows give repeated rows; a null id stays null.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            spans = [[dict(zip(("kind", "start", "end", "base"), s)) for s in find_spans(t)] for t in texts_of(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(spans, pa.list_(_SPAN))], ["doc_id", "spans"])

    return id_text(df, id_col, text_col).mapInArrow(scan, SPANS_DDL)


def redact_text(text: str) -> str:
    """The text with every span replaced by its kind in angle brackets; overlapping spans become one."""
    out, last = [], 0
    for kind, s, e, _ in find_spans(text):
        if s >= last:
            out += (text[last:s], f"<{kind.upper()}>")
        last = max(last, e)
    return "".join([*out, text[last:]])


def redact(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with personal data in ``text_col`` masked; all other columns and null texts as they were."""
    columns, at = df.columns, df.columns.index(text_col)

    def mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col):
            texts = [t if t is None else redact_text(t) for t in batch.column(at).to_pylist()]
            arrays = [pa.array(texts, batch.schema.field(at).type) if i == at else batch.column(i) for i in range(len(columns))]
            yield pa.RecordBatch.from_arrays(arrays, names=columns)

    return df.mapInArrow(mask, df.schema)


def with_masked_length(df: DataFrame, text_col: str, length_col: str) -> DataFrame:
    """``redact`` and the length column brought up to date where the text has one."""
    return redact(df, text_col).withColumn(length_col, F.coalesce(F.char_length(text_col).cast("long"), F.col(length_col)))
