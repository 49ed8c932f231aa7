"""Licences named in documents: identifier tags, notice phrases and licence expressions (operator 11).

One Aho-Corasick automaton runs over the words of a text, joined by single spaces, and finds every place of every
phrase; another runs over the lower-cased text and finds identifier tags such as `SPDX-License-Identifier:`. The
expression behind a tag, as far as it is one, is evaluated by a shunting-yard parser: `with` binds closer than `and`,
`and` closer than `or`. One scan without shuffle; a task holds one batch of texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Phrases of the base and their labels.
BASE_PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Further phrases of licence names, notices and addresses, as words.
NOTICE_PHRASES = {
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "opensource org licenses mit": "mit",
    "licensed under the mit": "mit",
    "apache org licenses license 2 0": "apache",
    "apache software license": "apache",
    "gnu lesser general public license": "lgpl",
    "gnu library general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "gnu gpl": "gpl",
    "gnu lgpl": "lgpl",
    "gnu agpl": "agpl",
    "bsd license": "bsd",
    "2 clause bsd": "bsd",
    "3 clause bsd": "bsd",
    "redistribution and use in source and binary forms": "bsd",
    "isc license": "isc",
    "permission to use copy modify and or distribute this software for any purpose": "isc",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "boost software license": "bsl",
    "artistic license": "artistic",
    "zlib license": "zlib",
    "python software foundation license": "psf",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "dedicated to the public domain": "cc0",
    "cc0": "cc0",
    "creative commons zero": "cc0",
    "creative commons attribution": "cc-by",
    "creative commons attribution sharealike": "cc-by-sa",
    "creative commons attribution share alike": "cc-by-sa",
    "creative commons attribution noderivatives": "cc-by-nd",
    "creative commons attribution noncommercial": "cc-by-nc",
    "creative commons attribution non commercial": "cc-by-nc",
    "licensed under cc by": "cc-by",
    "licensed under cc by sa": "cc-by-sa",
    "licensed under cc by nd": "cc-by-nd",
    "licensed under cc by nc": "cc-by-nc",
    "licensed under cc by nc sa": "cc-by-nc-sa",
    "licensed under cc by nc nd": "cc-by-nc-nd",
    "creativecommons org licenses by": "cc-by",
    "creativecommons org licenses by sa": "cc-by-sa",
    "creativecommons org licenses by nd": "cc-by-nd",
    "creativecommons org licenses by nc": "cc-by-nc",
    "creativecommons org licenses by nc sa": "cc-by-nc-sa",
    "creativecommons org licenses by nc nd": "cc-by-nc-nd",
    "creativecommons org publicdomain zero": "cc0",
}

# What may stand before a licence expression.
TAGS = ("spdx-license-identifier:", "license-expression:", "license:", "licence:")

# What a licence family permits, from 1 (network copyleft) to 5 (no conditions).
PERMISSIONS = {
    "agpl": 1, "gpl": 2, "cc-by-nc": 2, "cc-by-nc-sa": 2, "cc-by-nc-nd": 2, "cc-by-nd": 2, "cc-by-sa": 2, "lgpl": 3, "mpl": 3, "epl": 3,
    "mit": 4, "apache": 4, "bsd": 4, "isc": 4, "zlib": 4, "bsl": 4, "artistic": 4, "psf": 4, "python": 4, "cc-by": 4,
    "cc0": 5, "0bsd": 5, "unlicense": 5, "wtfpl": 5,
}

#: How much each kind of evidence counts; a document has the score of its strongest.
EXPRESSION_SCORE, NOTICE_SCORE, NAME_SCORE = 1.0, 0.8, 0.5

#: Bytes of a text to those of its words: A-Z lower, letters, figures and all beyond ASCII stay, others part words.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
LOWER_BYTES = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

TOKEN = re.compile(r"[ \t]*([()]|[a-z0-9][a-z0-9.+:-]*)")
LEAD = re.compile(r"[ \t\"'\[]*")
BINDS = {"or": 1, "and": 2, "with": 3}


def licence(identifier: str) -> tuple[frozenset, int | None] | None:
    """Label and permission of an identifier such as `gpl-2.0-or-later`; None if it is not known.

    An exception has no label and no permission; a reference to a licence of one's own has no label.
    """
    if "exception" in identifier:
        return frozenset(), None
    if identifier.startswith(("licenseref-", "documentref-")):
        return frozenset(), 0
    parts = identifier.rstrip("+").split("-")
    for size in (4, 3, 2, 1):
        family = "-".join(parts[:size])
        if family in PERMISSIONS and all(p[:1].isdigit() or p in ("only", "or", "later", "clause", "no") or family in ("bsd", "zlib", "mpl") for p in parts[size:]):
            label = {"0bsd": "bsd", "python": "psf"}.get(family, family)
            return frozenset([label]), PERMISSIONS[family]
    return None


def evaluate(tokens: list[str]) -> tuple[frozenset, int] | None:
    """Labels and permission of a licence expression; None if it is none.

    A choice permits what its freest part does, a conjunction what its strictest does, an exception one step more.
    """
    values: list[tuple[frozenset, int | None]] = []
    pending: list[str] = []

    def apply() -> bool:
        sign = pending.pop()
        (right, can), (left, could) = values.pop(), values.pop()
        if could is None or (can is None) != (sign == "with"):
            return False
        grade = min(could + 1, 5) if sign == "with" else max(could, can) if sign == "or" else min(could, can)
        values.append((left | right, grade))
        return True

    operand = True  # what comes next is an operand or an opening parenthesis
    for token in tokens:
        if operand != (token == "(" or token not in BINDS and token != ")"):
            return None
        if token == "(":
            pending.append(token)
        elif token == ")":
            while pending and pending[-1] != "(":
                if not apply():
                    return None
            if not pending:
                return None
            pending.pop()
        elif token in BINDS:
            while pending and pending[-1] != "(" and BINDS[pending[-1]] >= BINDS[token]:
                if not apply():
                    return None
            pending.append(token)
            operand = True
        else:
            value = licence(token)
            if value is None:
                return None
            values.append(value)
            operand = False
    while pending:
        if operand or pending[-1] == "(" or not apply():
            return None
    return values[0] if len(values) == 1 and values[0][1] is not None else None


def expression_at(text: str, start: int) -> list[str]:
    """The tokens from a place on, up to the first that cannot belong to the expression."""
    tokens, operand, depth = [], True, 0
    at = LEAD.match(text, start).end()
    while found := TOKEN.match(text, at):
        token = found[1].rstrip(".:")
        if not token or operand != (token == "(" or token not in BINDS and token != ")") or (token == ")" and not depth):
            break
        depth += (token == "(") - (token == ")")
        operand = token == "(" or token in BINDS
        tokens.append(token)
        at = found.end()
        if token != found[1]:
            break  # a full stop
    while tokens and tokens[-1] in BINDS:
        tokens.pop()
    return tokens


def automaton_of(patterns) -> object:
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for pattern in patterns:
        automaton.add_word(pattern, pattern)
    automaton.make_automaton()
    return automaton


class Scanner:
    def __init__(self) -> None:
        self.phrases = automaton_of(f" {p} " for p in [*BASE_PHRASES, *NOTICE_PHRASES])
        self.tags = automaton_of(TAGS)

    def places(self, words: list[bytes]) -> list[tuple[int, str]]:
        """First word and phrase of every place where a phrase's words stand, in order."""
        line = f" {b' '.join(words).decode('latin-1')} "
        found, word, seen = [], 0, 0
        for end, pattern in self.phrases.iter(line):
            start = end + 1 - len(pattern)
            word += line.count(" ", seen, start) if start >= seen else -line.count(" ", start, seen)
            seen = start
            found.append((word, pattern[1:-1]))
        return sorted(found)

    def expressions(self, raw: bytes) -> list[tuple[str, tuple[frozenset, int] | None]]:
        text = raw.translate(LOWER_BYTES).decode("latin-1")
        found = []
        for end, _ in self.tags.iter(text):
            tokens = expression_at(text, end + 1)
            if tokens:
                found.append((" ".join(tokens), evaluate(tokens)))
        return found

    def scan(self, raw: bytes | None) -> tuple:
        words = raw.translate(WORD_BYTES).split() if raw else []
        places = self.places(words) if words else []
        expressions = self.expressions(raw) if raw else []
        base = [(word, phrase) for word, phrase in places if phrase in BASE_PHRASES]
        longest = {}  # of the phrases that start at one word
        for word, phrase in places:
            if phrase not in BASE_PHRASES and len(phrase) > len(longest.get(word, "")):
                longest[word] = phrase
        named = {BASE_PHRASES[phrase] for _, phrase in base}
        noticed = {NOTICE_PHRASES[phrase] for phrase in longest.values()}
        stated = set().union(*[value[0] for _, value in expressions if value])
        score = max(
            EXPRESSION_SCORE if any(value for _, value in expressions) else 0.0, NOTICE_SCORE if noticed else 0.0, NAME_SCORE if named else 0.0
        )
        kept = sorted([(w, p, BASE_PHRASES[p]) for w, p in base] + [(w, p, NOTICE_PHRASES[p]) for w, p in longest.items()])
        return (
            len(words), len(base), base[0][0] if base else None, base[-1][0] if base else None, sorted(named), sorted(named | noticed | stated),
            [{"word": w, "phrase": p, "label": label} for w, p, label in kept],
            [{"expression": e, "valid": v is not None, "labels": sorted(v[0]) if v else [], "permission": v[1] if v else None} for e, v in expressions],
            score,
        )


COLUMNS = {
    "n_words": "long", "n_base": "long", "first_word": "long", "last_word": "long", "base_labels": "array<string>", "labels": "array<string>",
    "places": "array<struct<word:long,phrase:string,label:string>>",
    "expressions": "array<struct<expression:string,valid:boolean,labels:array<string>,permission:int>>", "score": "double",
}
ARROW = [
    pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.string()),
    pa.list_(pa.struct([("word", pa.int64()), ("phrase", pa.string()), ("label", pa.string())])),
    pa.list_(pa.struct([("expression", pa.string()), ("valid", pa.bool_()), ("labels", pa.list_(pa.string())), ("permission", pa.int32())])),
    pa.float64(),
]


def scan_licences(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, n_words, base places (n_base, first_word, last_word, base_labels), labels, places, expressions, score.

    `labels` holds those of the base, of further phrases (of those that start at one word the longest) and of the valid
    expressions behind tags. An expression is valid if it parses and all its licences are known; others give no label.
    score is 1 with a valid expression, 0.8 with a notice phrase, 0.5 with a name only, else 0. A null or empty text
    has no words, empty labels, null first and last word and score 0. Rows with equal or null keys are scanned one by
    one; other columns are left out, whatever their names; an empty table gives no rows.
    """
    schema = f"`{key}` {docs.schema[key].dataType.simpleString()}, " + ", ".join(f"{name} {kind}" for name, kind in COLUMNS.items())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner()
        for batch in batches:
            if batch.num_rows:
                found = list(zip(*[scanner.scan(raw.as_py()) for raw in batch.column(1)]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), *[pa.array(values, kind) for values, kind in zip(found, ARROW)]], names=[key, *COLUMNS]
                )

    return docs.select(F.col(key), F.col(text).cast("binary").alias("raw_")).mapInArrow(run, schema)


def digests(scanned: DataFrame, key: str = "doc_id") -> DataFrame:
    joined = [F.array_join(name, ",").alias(name) for name in ("base_labels", "labels")]
    return scanned.select(key, "n_words", "n_base", "first_word", "last_word", *joined, "score")
