"""Column expressions. All of them stay in the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Separators of an id query and the texts of its errors.
TOKEN_SEPARATORS = r"[\s,/\-]+"
EMPTY_QUERY = "Query is empty."


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Remove leading and trailing whitespace of any kind, tabs and newlines included."""
    return F.regexp_replace(_col(c), r"(?U)^\s+|\s+$", "")


def parse_flag(c: Column | str) -> Column:
    """'true' / 'false' in any case to a boolean; every other text is NULL."""
    text = F.lower(strip(c))
    return F.when(text == "true", True).when(text == "false", False)


def l2_norm(c: Column | str) -> Column:
    return F.sqrt(dot(c, c))


def dot(a: Column | str, b: Column | str) -> Column:
    products = F.zip_with(_col(a), _col(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def cosine(a: Column | str, b: Column | str) -> Column:
    """Cosine similarity; 0 for a zero vector, NULL if a vector is missing."""
    a, b = _col(a), _col(b)
    value = F.try_divide(dot(a, b), l2_norm(a) * l2_norm(b))
    return F.when(a.isNotNull() & b.isNotNull(), F.coalesce(value, F.lit(0.0)))


def squared_distance(a: Column | str, b: Column | str) -> Column:
    terms = F.zip_with(_col(a), _col(b), lambda x, y: (x.cast("double") - y) * (x.cast("double") - y))
    return F.aggregate(terms, F.lit(0.0), lambda acc, x: acc + x)


def id_string(levels: list[str], dedup: str = "dedup") -> Column:
    """Codes and slot joined by '-'. NULL if one is NULL, unlike concat_ws."""
    parts: list[Column] = []
    for name in [*levels, dedup]:
        parts += [F.lit("-"), F.col(name).cast("string")]
    return F.concat(*parts[1:])


def prefix_string(levels: list[str]) -> Column:
    parts: list[Column] = []
    for name in levels:
        parts += [F.lit("_"), F.col(name).cast("string")]
    return F.concat(*parts[1:])


def prefix_number(levels: list[str], width: int) -> Column:
    """Mixed-radix number of a code prefix, as a categorical feature."""
    if width ** len(levels) >= 2**63:
        raise ValueError("the prefix does not fit in a LONG; use prefix_string")
    return reduce(
        lambda acc, name: acc * F.lit(width).cast("long") + F.col(name).cast("long"),
        levels[1:],
        F.col(levels[0]).cast("long"),
    )


def shared_depth(a: list[Column], b: list[Column]) -> Column:
    """Number of leading equal codes."""
    depth = F.lit(0)
    agree = F.lit(True)
    for x, y in zip(a, b):
        agree = agree & F.coalesce(x == y, F.lit(False))
        depth = depth + agree.cast("int")
    return depth


def seeded_md5(key: Column | str, *seed: object) -> Column:
    """md5 of 'key:seed'. Independent of partitioning, the same in any engine."""
    tail = "".join(f":{part}" for part in seed)
    return F.md5(F.concat(_col(key).cast("string"), F.lit(tail)))


def leading_bits(md5_text: Column, digits: int = 13) -> Column:
    """The first hex digits as a LONG; keeps the order of the md5 texts."""
    return F.conv(F.substring(md5_text, 1, digits), 16, 10).cast("long")


def seeded_uniform(key: Column | str, *seed: object) -> Column:
    """A number in [0, 1) from 52 bits of the seeded hash."""
    return leading_bits(seeded_md5(key, *seed), 13).cast("double") / F.lit(float(16**13))


def split_tokens(query: Column | str) -> Column:
    pieces = F.split(_col(query), f"(?U){TOKEN_SEPARATORS}")
    return F.filter(pieces, lambda piece: piece != "")


def is_integer_text(text: Column) -> Column:
    return text.rlike(r"^[+]?[0-9]+(_[0-9]+)*$")


def token_numbers(pieces: Column) -> Column:
    """Integer texts as LONG. A number beyond LONG matches no code, so it becomes -1."""
    return F.transform(
        pieces,
        lambda piece: F.coalesce(
            F.regexp_replace(piece, "[_+]", "").try_cast("bigint"), F.lit(-1).cast("long")
        ),
    )


def token_error(pieces: Column, num_levels: int) -> Column:
    """NULL for a usable query, else the error text; first reason wins."""
    bad = F.filter(pieces, lambda piece: ~is_integer_text(piece))
    most = num_levels + 1
    return (
        F.when(pieces.isNull() | (F.size(pieces) == 0), F.lit(EMPTY_QUERY))
        .when(F.size(bad) > 0, F.concat(F.lit("'"), F.try_element_at(bad, F.lit(1)), F.lit("' is not an integer token.")))
        .when(
            F.size(pieces) > most,
            F.concat(
                F.lit("Too many tokens ("), F.size(pieces).cast("string"),
                F.lit(f"); expected at most {most} (c1..c{num_levels} + dedup)."),
            ),
        )
    )
