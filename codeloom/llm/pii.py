"""Personal data with offset-preserving deobfuscation (operator 9).

A text is searched as it is for the base patterns. If it holds signs of a disguise, it also runs through
transducers that write a normalised text and, for each of its characters, the span of source characters it came
from: look-alike and wide characters become ASCII, spelled digits become digits, and disguised at signs and dots
become `@` and `.`. What the same patterns find there is mapped back to the source. One scan, no shuffle.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
MASKS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]"}

LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
# A match always begins where a run of digits begins and ends where one ends, so nothing has to be tried again.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]+")

# Letters of other scripts that look like Latin ones.
LOOK_ALIKES = dict(
    zip("аеорсухіјѕһԁԛԝАВЕКМНОРСТУХІЈЅΑΒΕΖΗΙΚΜΝΟΡΤΥΧοανρıɡ", "aeopcyxijshdqwABEKMHOPCTYXIJSABEZHIKMNOPTYXoavpig")
)
LOOK_ALIKES |= dict.fromkeys("‐‑‒–−", "-") | dict.fromkeys("․。｡﹒", ".") | {"﹫": "@"}
INVISIBLE = "​‌‍⁠﻿­"
# Number words.
DIGIT_WORDS = {w: str(i) for i, w in enumerate("zero one two three four five six seven eight nine".split())} | {"oh": "0"}
REPEATS = {"double": 2, "triple": 3}

ODD = re.compile("[" + "".join(LOOK_ALIKES) + INVISIBLE + "０-９Ａ-Ｚａ-ｚ．＠＋－٠-٩۰-۹𝐀-𝟿]")
WORD = "(?:" + "|".join([*DIGIT_WORDS, *REPEATS, "plus"]) + ")"
ITEM = f"(?:{WORD}|[0-9]+)"
JOINT = r"(?:[ \t]?[\[({<][ \t]?(?:dot|\.)[ \t]?[\])}>][ \t]?|[ \t]+dot[ \t]+|[ ,.()-]{1,2})"
SPELLED = re.compile(rf"(?<![A-Za-z]){ITEM}(?:{JOINT}{ITEM}(?![A-Za-z0-9]))+", re.I)
SPELLED_SIGNS = ("two ", "three", "four", "five", "six ", "seven", "eight", "nine ", "zero", "one ")
SPELLED_RUN = re.compile(rf"(?<![a-z]){WORD}(?:[ ,.-]{{1,2}}{WORD}){{3}}(?![a-z])")
SPELLED_BESIDE = re.compile(rf"[0-9][ ,.()-]{{1,2}}{WORD}(?![a-z])|(?<![a-z]){WORD}[ ,.()-]{{1,2}}[0-9]")
AT = re.compile(r"[ \t]?[\[({<][ \t]?(?:at|@)[ \t]?[\])}>][ \t]?|(?<=[A-Za-z0-9])[ \t]+at[ \t]+(?=[A-Za-z0-9])", re.I)
DOT = re.compile(r"[ \t]?[\[({<][ \t]?(?:dot|\.)[ \t]?[\])}>][ \t]?|(?<=[A-Za-z0-9])[ \t]+dot[ \t]+(?=[A-Za-z0-9])", re.I)
BARE_AT = re.compile(r"[ \t]+at[ \t]+\Z", re.I)
TAIL = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
SIGNS = ("dot", "[at", "(at", "{at", "<at", "[@", "(@", "{@", "[ at", "( at", "[.]", "(.)", "{.}", "[ @", "( @")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Every run before an at sign is read once, so that long runs without one cost nothing."""
    at, done = text.find("@"), 0
    while at >= 0:
        begin = at
        while begin > done and text[begin - 1] in LOCAL:
            begin -= 1
        match = DOMAIN.match(text, at + 1) if begin < at else None
        if match:
            yield begin, match.end()
            done = match.end()
        at = text.find("@", max(at + 1, done))


def numbers(text: str) -> Iterator[tuple[str, int, int]]:
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            yield "ip", m.start(), m.end()
    for m in CARD.finditer(text):
        digits = NOT_DIGIT.sub("", m.group()) if m.end() - m.start() < 80 else ""
        if 14 <= len(digits) <= 19 and luhn(digits):
            yield "card", m.start(), m.end()
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= sum(map(str.isdigit, m.group())) <= 15:
                yield "phone", m.start(), m.end()


def base_spans(text: str) -> list[tuple[int, int, str]]:
    found = [(a, b, "email") for a, b in emails(text)]
    return found + [(a, b, kind) for kind, a, b in numbers(text)]


class Tape:
    """A text and the source span of each of its characters; a transducer replaces stretches of it."""

    def __init__(self, text: str):
        self.text = text
        self.begins = list(range(len(text)))
        self.ends = list(range(1, len(text) + 1))

    def replace(self, edits: list[tuple[int, int, str]]) -> None:
        """Every character that is put in stands for the whole stretch that it replaces."""
        text, begins, ends, at = [], [], [], 0
        for a, b, new in edits:
            text += [self.text[at:a], new]
            begins += self.begins[at:a] + [self.begins[a]] * len(new)
            ends += self.ends[at:a] + [self.ends[b - 1]] * len(new)
            at = b
        self.text = "".join([*text, self.text[at:]])
        self.begins, self.ends = begins + self.begins[at:], ends + self.ends[at:]

    def source(self, a: int, b: int) -> tuple[int, int]:
        return self.begins[a], max(self.ends[a:b])


def plain_letters(tape: Tape) -> None:
    edits = []
    for m in ODD.finditer(tape.text):
        c = m.group()
        new = "" if c in INVISIBLE else LOOK_ALIKES.get(c) or unicodedata.normalize("NFKC", c)
        if new.isdigit() and not new.isascii():
            new = str(unicodedata.digit(new))
        edits.append((m.start(), m.end(), new))
    tape.replace(edits)


def dot_of(gap: str) -> int:
    """2 for a disguised dot, 1 for a plain one, else 0."""
    core = gap.lower().strip(" \t[](){}<>")
    return 2 if core == "dot" or core == "." and gap.strip() != "." else int(gap == ".")


def cut_at(parts: list[tuple[int, int, str, int]], least: int) -> list[list[tuple[int, int, str, int]]]:
    out: list[list[tuple[int, int, str, int]]] = []
    for p in parts:
        if not out or p[3] >= least:
            out.append([])
        out[-1].append(p)
    return out


def spelled_out(parts: list[tuple[int, int, str, int]]) -> str:
    out, times = "", 1
    for _, _, p, _ in parts:
        if p in REPEATS:
            times = REPEATS[p]
        elif p == "plus":
            out += "+"
        else:
            out, times = out + DIGIT_WORDS.get(p, p) * times, 1
    return out


def plain_digits(tape: Tape) -> list[tuple[int, int]]:
    """Spelled digits become digits; returns the runs of 10 to 15 digits that are phones without a plus sign.

    A run is taken if it holds four spelled digits or if the whole of it, figures included, is an address of four
    parts, a phone or a card.
    """
    edits, sizes = [], []
    for m in SPELLED.finditer(tape.text):
        parts, end = [], m.start()
        for p in re.finditer(r"[A-Za-z]+|[0-9]+", m.group()):
            word, a, b = p.group().lower(), p.start() + m.start(), p.end() + m.start()
            if word != "dot":
                parts.append((a, b, word, dot_of(tape.text[end:a])))
                end = b
        if not any(p[2] in DIGIT_WORDS for p in parts):
            continue
        address = [spelled_out(g) for g in cut_at(parts, 1)]
        if len(address) == 4 and all(g.isdigit() and len(g) <= 3 and int(g) <= 255 for g in address):
            edits.append((parts[0][0], parts[-1][1], ".".join(address)))
            sizes.append("")
            continue
        for run in cut_at(parts, 2):
            spelled = sum(p[2] in DIGIT_WORDS for p in run)
            out = spelled_out(run)
            digits = out.lstrip("+")
            signed = tape.text[run[0][0] - 1 : run[0][0]] == "+"
            phone = 10 <= len(digits) <= 15 and digits.isdigit()
            card = 14 <= len(digits) <= 19 and digits.isdigit() and luhn(digits)
            if spelled >= 4 or spelled and (card or phone and (signed or out != digits or spelled == 3)):
                edits.append((run[0][0], run[-1][1], out))
                sizes.append(out if phone and not signed and spelled >= 3 else "")
    tape.replace(edits)
    runs, shift = [], 0
    for (a, b, out), kept in zip(edits, sizes):
        if kept:
            runs.append((a + shift, a + shift + len(out)))
        shift += len(out) - (b - a)
    return runs


def plain_signs(tape: Tape) -> None:
    tape.replace([(m.start(), m.end(), ".") for m in DOT.finditer(tape.text) if good_dot(tape.text, m)])
    edits = []
    for m in AT.finditer(tape.text):
        if BARE_AT.match(m.group()):
            tail = TAIL.match(tape.text, m.end())
            # "at" between spaces is a word unless the dots of what follows are disguised too.
            if not tail or "." not in (tape.text[i] for i in range(*tail.span()) if tape.ends[i] - tape.begins[i] > 1):
                continue
        edits.append((m.start(), m.end(), "@"))
    tape.replace(edits)


def good_dot(text: str, m: re.Match) -> bool:
    return 0 < m.start() and m.end() < len(text) and text[m.start() - 1].isalnum() and text[m.end()].isalnum()


def disguised(text: str) -> bool:
    if not text.isascii() and ODD.search(text):
        return True
    low = text.lower()
    return any(s in low for s in SIGNS) or any(s in low for s in SPELLED_SIGNS) and (SPELLED_RUN.search(low) or SPELLED_BESIDE.search(low)) is not None


def spans_of(text: str) -> list[tuple[int, int, str, bool]]:
    """Spans (begin, end, kind, added) in code points, by begin, then kind as listed."""
    found = [(a, b, kind, False) for a, b, kind in base_spans(text)]
    if disguised(text):
        tape = Tape(text)
        plain_letters(tape)
        runs = plain_digits(tape)
        digits = [(*tape.source(a, b), "phone") for a, b in runs]
        plain_signs(tape)
        have = {kind: [(a, b) for a, b, k, _ in found if k == kind] for kind in KINDS}
        hidden = [(*tape.source(a, b), kind) for a, b, kind in base_spans(tape.text) if tape.text[a:b] != text[slice(*tape.source(a, b))]]
        cards = {(a, b) for a, b, kind in hidden if kind == "card"}
        hidden += [d for d in digits if d[:2] not in cards]
        for a, b, kind in dict.fromkeys(hidden):
            stuck = a > 0 and text[a - 1].isalpha() and text[a].isalpha()  # the rest of a word in another script
            own = kind != "email" or any(c.isalnum() and c not in LOOK_ALIKES for c in text[a:b])
            if own and not stuck and not any(x <= a and b <= y for x, y in have[kind]):
                found.append((a, b, kind, True))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def masked(text: str, spans: list[tuple[int, int, str, bool]]) -> str:
    """Overlapping spans become one mask, that of the first."""
    out, at, last = [], 0, -1
    for a, b, kind, _ in spans:
        if a >= last:
            out += [text[at:a], MASKS[kind]]
        last = at = max(last, b)
    return "".join([*out, text[at:]])


SPANS = "array<struct<kind:string,begin:long,end:long,added:boolean>>"


def find_spans(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, `spans` and `masked` text of every row.

    A null text is an empty one without spans and stays null in `masked`. Rows with equal or null keys are searched
    one by one; other columns are left out.
    """
    kind = docs.schema[key].dataType.simpleString()
    types = pa.list_(pa.struct([("kind", pa.string()), ("begin", pa.int64()), ("end", pa.int64()), ("added", pa.bool_())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, texts = [], []
            for text in batch.column(1).to_pylist():
                found = spans_of(text or "")
                spans.append([{"kind": k, "begin": a, "end": b, "added": new} for a, b, k, new in found])
                texts.append(masked(text, found) if found else text)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(spans, types), pa.array(texts, pa.string())], names=[key, "spans", "masked"]
            )

    return docs.select(F.col(key), F.col(text)).mapInArrow(run, f"`{key}` {kind}, spans {SPANS}, masked string")


def mask_documents(docs: DataFrame, text: str = "text", length: str = "n_chars") -> DataFrame:
    """docs with the personal data of `text` masked and `length`, if it is there, counted anew."""
    names = docs.columns
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col(text).alias("text"))
    out = find_spans(packed, "row", "text")
    cells = {c: F.col("row")[c] for c in names} | {text: F.col("masked")}
    if length in names:
        cells[length] = F.length("masked").cast(docs.schema[length].dataType)
    return out.select(*[cells[c].alias(c) for c in names])


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["begin"], s["end"])), ",")


def digests(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts and digest of the base spans; `spans` lists all."""
    base = F.filter("spans", lambda s: ~s["added"])
    # A second parameter of the lambda, even with a default, would be the position in the array.
    of = lambda kind: F.filter(base, lambda s: s["kind"] == kind)
    counts = [F.size(of(k)).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select(
        key, *counts, F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans")
    )
