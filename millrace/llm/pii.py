"""Personal data by offset-preserving deobfuscation.

Plain identifiers are found in the text as it stands. Then transducers rewrite disguises, keeping for
every character they put out the span of source characters it stands for: look-alike letters, digits
of other scripts and wide forms become ASCII, invisible characters go, `(at)`, ` dot ` and the like
become signs, and spelled digits become digits. The same finders run on what comes out, and their
spans are mapped back to the source. Plain spans always stay; a disguised one is added unless it lies
inside a plain one of its kind.

Offsets count code points; ends are exclusive. Finders work in time linear in the text. Addresses and
runs of digits may be of any length; inside a disguise there are at most BLANKS blanks (or, between spelled
digits, separators) at a stretch, as words further apart aren't one identifier. A plain word "at" makes an
address only with a dot in words or brackets behind it, since prose says "look at example.com".

Defined results: null text counts as empty and has no spans; texts of any length are read whole; repeated
rows give equal spans; of overlapping spans of one kind in either pass the leftmost stays; other columns
pass through, and one named `spans` is replaced; an empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import html
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import slices, texts, with_columns

KINDS = ["email", "ip", "card", "phone"]
Span = tuple[str, int, int]

LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
LOCAL_SET = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# possessive, and tried only where a run of digits begins, these find what the plain patterns find
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """The pattern's matches, found from each @: its left side is the whole run of characters before."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL_SET:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def find(text: str) -> list[Span]:
    """Plain identifiers: leftmost non-overlapping matches of each kind that pass its test."""
    out: list[Span] = []
    if "@" in text:
        out += [("email", a, b) for a, b in emails(text)]
    for m in IP.finditer(text) if "." in text else ():
        if all(len(p.lstrip("0")) < 4 and int(p) < 256 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(d := NOT_DIGIT.sub("", m[0])) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    for m in PHONE.finditer(text) if "+" in text else ():
        if 9 <= len(NOT_DIGIT.sub("", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


# ---- the first transducer: one character to one or none

#: Letters of other scripts that look like the Latin ones below them.
LOOKALIKES = ("АВЕЅІЈКМНОРСТУХаеѕіјкорсухԁԛԝһɡΑΒΕΖΗΙΚΜΝΟΡΤΥΧοανι", "ABESIJKMHOPCTYXaesijkopcyxdqwhgABEZHIKMNOPTYXoavi")
#: Characters that have no width.
INVISIBLE = [0xAD, 0x34F, 0x61C, 0x180E, *range(0x200B, 0x2010), *range(0x202A, 0x202F), *range(0x2060, 0x2065), *range(0xFE00, 0xFE10), 0xFEFF]


class _Letters(dict):
    """str.translate's table, filled as characters turn up: by the look-alikes, else by compatibility forms."""

    def __missing__(self, code: int):
        c = chr(code)
        if code < 128:
            out = code
        elif c.isdecimal():
            out = ord("0") + unicodedata.decimal(c)
        else:
            form = unicodedata.normalize("NFKC", c)
            out = ord(form) if len(form) == 1 and " " < form < "\x7f" else code
            # dots and hyphens that compatibility forms leave alone
            out = {0x3002: 46, 0xB7: 46, 0x2024: 46, 0x2010: 45, 0x2011: 45, 0x2012: 45, 0x2013: 45, 0xA0: 32, 0x202F: 32, 0x2009: 32}.get(code, out)
        self[code] = out
        return out


LETTERS = _Letters({ord(a): ord(b) for a, b in zip(*LOOKALIKES)})
LETTERS.update(dict.fromkeys(INVISIBLE))
GONE = re.compile("[" + "".join(map(chr, INVISIBLE)) + "]")


class Tape:
    """A rewritten text; `at` maps a span of it to the source's. Pieces: (output start, source start, source end)."""

    def __init__(self, text: str, spans: list[tuple[int, int]] | None = None):
        self.text, self.spans = text, spans

    def at(self, start: int, end: int) -> tuple[int, int]:
        return (start, end) if self.spans is None else (self.spans[start][0], self.spans[end - 1][1])


#: A character written as an HTML entity; zeros may lead its number, and no character has one of more figures than these.
ENTITY = re.compile(r"&(?:#0*(?P<ten>[0-9]{1,7})|#[xX]0*(?P<hex>[0-9A-Fa-f]{1,6})|(?P<name>commat|period|plus|hyphen|lowbar|nbsp|lpar|rpar|lbrack|rbrack));")


def entities(text: str) -> Tape:
    """The text with entities as the one character that each stands for."""
    out, spans, at = [], [], 0
    for m in ENTITY.finditer(text):
        short = f"&#{m['ten']};" if m["ten"] else f"&#x{m['hex']};" if m["hex"] else m[0]
        if len(c := html.unescape(short)) == 1:
            out += [text[at : m.start()], c]
            spans += [*((k, k + 1) for k in range(at, m.start())), m.span()]
            at = m.end()
    out.append(text[at:])
    spans += [(k, k + 1) for k in range(at, len(text))]
    return Tape("".join(out), spans)


def letters(text: str) -> Tape:
    """The text with entities read, look-alikes as ASCII and without invisible characters."""
    first = entities(text) if "&" in text and ENTITY.search(text) else Tape(text)
    if first.text.isascii():
        return first
    out = first.text.translate(LETTERS)
    if len(out) == len(first.text):
        return Tape(out, first.spans)
    return Tape(out, [first.at(k, k + 1) for k, c in enumerate(first.text) if not GONE.match(c)])


# ---- the second: words and signs to signs

#: The most blanks at a stretch inside a disguise.
BLANKS = 3
_B = rf"\s{{0,{BLANKS}}}"
OPEN, SHUT = rf"[(\[{{<]{_B}", rf"{_B}[)\]}}>]"
#: What an at-sign and a dot are called, by language. Where neither is in brackets both must be of one language: "at this point in" is no address.
LANGUAGES = {"English": ("at", "dot"), "Spanish": ("arroba", "punto"), "French": ("arobase", "point"), "German": ("at", "punkt")}
AT_WORDS, DOT_WORDS = ("|".join(dict.fromkeys(words)) for words in zip(*LANGUAGES.values()))
DOTS_OF = {at: "|".join(dot for a, dot in LANGUAGES.values() if a == at) for at in AT_WORDS.split("|")}
BRACKET_AT = rf"{_B}{OPEN}(?:@|{AT_WORDS}){SHUT}{_B}"
BRACKET_DOT = rf"{_B}{OPEN}(?:\.|{DOT_WORDS}){SHUT}{_B}"
_SOME = rf"\s{{1,{BLANKS}}}"


def _bare(words: str) -> str:
    """One of some words between blanks or underscores."""
    return rf"(?:{_SOME}(?:{words}){_SOME}|_(?:{words})_)"


WORD_AT, WORD_DOT = _bare(AT_WORDS), _bare(DOT_WORDS)
SPACED_AT = rf"{_SOME}@{_B}|@{_SOME}"
LABEL = r"[A-Za-z0-9-]++"
#: What stands on the right of an at-sign's disguise, and on the left of it (read backwards), by the word for the sign.
AFTER_BRACKET = {at: re.compile(rf"{LABEL}(?:(?:{BRACKET_DOT}|{_bare(dots)}|\.){LABEL})++", re.I) for at, dots in DOTS_OF.items()}
AFTER_WORD = {at: re.compile(rf"{LABEL}(?:(?:{BRACKET_DOT}|{_bare(dots)}|\.){LABEL})*(?:{BRACKET_DOT}|{_bare(dots)}){LABEL}", re.I) for at, dots in DOTS_OF.items()}
AFTER_SPACED = re.compile(rf"{LABEL}(?:(?:{BRACKET_DOT}|{_bare(DOTS_OF['at'])}|\s\.\s|\.){LABEL})++", re.I)
BEFORE = {at: regex.compile(rf"(?r)[A-Za-z0-9_%+-]++(?:(?:{BRACKET_DOT}|{_bare(dots)}|\.)[A-Za-z0-9_%+-]++)*", regex.I) for at, dots in DOTS_OF.items()}
AT_NAME = re.compile(AT_WORDS, re.I)
AT_SIGN = re.compile(rf"({BRACKET_AT})|({WORD_AT})|({SPACED_AT})|@", re.I)
ANY_DOT = re.compile(rf"{BRACKET_DOT}|{WORD_DOT}|\s?\.\s?", re.I)
MAYBE_AT = re.compile(rf"{OPEN}(?:@|{AT_WORDS}){SHUT}|\s@|@\s", re.I)
MAYBE_DOT = re.compile(rf"{OPEN}(?:\.|{DOT_WORDS}){SHUT}|[\s_](?:{DOT_WORDS})[\s_]", re.I)


def _ends_domain(piece: str, spaced: bool) -> bool:
    """Whether the last label could end a domain: letters only, two or more; after blanks, of one case, unlike a sentence."""
    last = ANY_DOT.split(piece)[-1]
    return len(last) > 1 and last.isalpha() and (not spaced or last.islower() or last.isupper())


def disguised_emails(text: str) -> Iterator[tuple[int, int]]:
    """Spans of e-mail addresses with at-signs or dots in words, brackets or blanks."""
    dots = MAYBE_DOT.search(text)
    if not dots and not MAYBE_AT.search(text):
        return
    done = 0
    for m in AT_SIGN.finditer(text):
        if m[2] and not dots or not (m[1] or m[2] or m[3] or dots) or m.start() < done:
            continue
        at = named[0].lower() if (named := AT_NAME.search(m[0])) else "at"
        after = (AFTER_BRACKET[at] if m[1] else AFTER_SPACED if m[3] else AFTER_WORD[at]).match(text, m.end())
        if m[0] == "@" and not after:
            after = AFTER_BRACKET[at].match(text, m.end())
        # what precedes a sign is read backwards from it, as far as it goes
        if after and _ends_domain(after[0], bool(m[3])) and (before := BEFORE[at].match(text, done, m.start())):
            yield before.start(), after.end()
            done = after.end()


#: The names of the digits 0 to 9 in English, French, German and Spanish, and one more for 0.
NAMES = ["zero|zéro|null|cero|oh", "one|un|eins|uno", "two|deux|zwei|dos", "three|trois|drei|tres", "four|quatre|vier|cuatro", "five|cinq|fünf|cinco", "six|sechs|seis", "seven|sept|sieben|siete", "eight|huit|acht|ocho", "nine|neuf|neun|nueve"]
DIGIT = {w: str(d) for d, names in enumerate(NAMES) for w in names.split("|")}
#: "six" is a digit in two languages, so languages may mix.
_NAME = "|".join(sorted(DIGIT, key=len, reverse=True))
GAP = rf"[\s,./()_–-]{{0,{BLANKS}}}"
TOKEN = re.compile(rf"(?P<name>\b(?:{_NAME})\b)|(?P<times>\b(?:double|triple)\b)|(?P<plus>\bplus\b|\+)|(?P<dot>{BRACKET_DOT}|{WORD_DOT}|\b(?:dot|point)\b)|(?P<digits>[0-9]+)|(?P<sep>[\s,./()_–-])", re.I)
_FIGURE = r"(?<![0-9])[0-9]++"  # from its first digit only, so that a long figure is looked at once
RUN = re.compile(rf"(?:(?:\bplus\b|\+){GAP})?(?:\b(?:{_NAME}|double|triple|dot|point)\b|{_FIGURE}|{BRACKET_DOT})(?:{GAP}(?:\b(?:{_NAME}|double|triple|dot|point)\b|{_FIGURE}|{BRACKET_DOT}))+", re.I)
_WORD = rf"(?:\b(?:{_NAME}|double|triple|dot|point)\b|{OPEN}(?:\.|{DOT_WORDS}){SHUT})"
#: A digit's name or a dot's word next to another or to a figure: every run that isn't figures alone has it.
MAYBE_RUN = re.compile(rf"{_WORD}{GAP}(?:{_WORD}|[0-9])|[0-9]{GAP}{_WORD}", re.I)


def spelled(text: str) -> Iterator[Tape]:
    """Every run of spelled digits, as digits and signs."""
    if not MAYBE_RUN.search(text):
        return
    for run in RUN.finditer(text):
        out: list[str] = []
        spans: list[tuple[int, int]] = []
        words, times, at, opened = 0, 1, run.start(), None
        while at < run.end() and (m := TOKEN.match(text, at, run.end())):
            here = (at if opened is None else opened, m.end())
            at = m.end()
            if m["times"]:
                times, opened = (2 if m[0].lower() == "double" else 3), m.start()
                continue
            if m["sep"]:
                # between digits as such, separators count; around spelled ones they mean nothing
                put = m[0] if m[0] in " -()." and not words and times == 1 and out and out[-1][-1:].isdigit() else ""
            elif m["digits"]:
                put, here = m[0], None
            else:
                while m["dot"] and out and out[-1] in ("", " "):  # a dot's word takes the blanks before it along
                    del spans[len(spans) - len(out.pop()) :]
                put = "+" if m["plus"] else "." if m["dot"] else DIGIT[m["name"].lower()] * times
                words += bool(m["name"] or m["dot"])
                times, opened = 1, None
            out.append(put)
            spans += [(m.start() + k, m.start() + k + 1) for k in range(len(put))] if here is None else [here] * len(put)
        if words:
            yield Tape("".join(out), spans)


def disguised(text: str) -> list[Span]:
    """What the finders see only after rewriting, in source offsets."""
    first = Tape(text) if text.isascii() and "&" not in text else letters(text)
    found: list[Span] = []
    if first.text is not text:
        found += [(kind, *first.at(a, b)) for kind, a, b in find(first.text)]
    found += [("email", *first.at(a, b)) for a, b in disguised_emails(first.text)]
    for tape in spelled(first.text):
        whole = NOT_DIGIT.sub("", tape.text)
        inner = [(k, a, b) for k, a, b in find(tape.text) if k != "email"]
        if not inner and 10 <= len(whole) <= 15 and len(tape.text) == len(whole) and len(set(whole)) > 2:
            inner = [("phone", 0, len(tape.text))]  # spelled out, a number needs no plus
        for kind, a, b in inner:
            x, y = tape.at(a, b)
            found.append((kind, *first.at(x, y)))
    return found


def scan(text: str) -> list[tuple[str, int, int, bool]]:
    """All spans as (kind, start, end, plain), by kind as listed, then start, then end."""
    base = sorted(find(text))
    out = {s: True for s in base}
    for kind, a, b in disguised(text):
        # plain spans of a kind don't overlap, so only the last that begins no later can hold this one
        near = bisect.bisect_right(base, (kind, a, len(text) + 1)) - 1
        if near < 0 or base[near][0] != kind or base[near][2] < b:
            out.setdefault((kind, a, b), False)
    return sorted(((*s, plain) for s, plain in out.items()), key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("plain", pa.bool_())])
SPAN_TYPE = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("plain", T.BooleanType())]))


def _rows(strings: list[str]) -> pa.Array:
    return pa.array([[dict(zip(("kind", "start", "end", "plain"), s)) for s in scan(t)] for t in strings], pa.list_(SPAN))


def detect(df: DataFrame, column: str = "text") -> DataFrame:
    """df with `spans`: array of (kind, start, end, plain)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, column):
            yield with_columns(batch, spans=_rows(texts(batch, column)))

    return df.mapInArrow(run, T.StructType([*(f for f in df.schema.fields if f.name != "spans"), T.StructField("spans", SPAN_TYPE)]))


def cover(text: str, spans: list[Span]) -> str:
    """The text with each stretch that spans cover replaced by the kind of the first span there."""
    out, at = [], 0
    for start, end, kind in sorted((a, b, k) for k, a, b in spans):
        if start >= at:
            out += [text[at:start], f"[{kind}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact(df: DataFrame, column: str = "text") -> DataFrame:
    """df with every identifier in a text column replaced by its kind in brackets; null stays null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, column):
            strings = batch.column(batch.schema.get_field_index(column)).to_pylist()
            new = [None if s is None else cover(s, [x[:3] for x in found]) if (found := scan(s)) else s for s in strings]
            at = batch.schema.get_field_index(column)
            yield pa.RecordBatch.from_arrays([pa.array(new, pa.string()) if k == at else c for k, c in enumerate(batch.columns)], names=batch.schema.names)

    return df.mapInArrow(run, df.schema)


def listed(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
