"""Quality rules with cross-document line frequency (operator 7). DataFrame functions only.

Two scans of the text: one hashes the normalised lines and counts, per host, the distinct documents that hold each;
the other computes the per-document rules. Lines above the limit are rare, so what joins the two is small.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codeloom.llm.shared import saved

SPACES = r"[\x20\x09-\x0D]+"
SYMBOLS = "[#*$%&|<>]"
WINDOW = 8
#: Frequent lines that are sent to every executor; a line takes about 50 bytes there.
BROADCAST_LINES = 200_000
#: What judge adds.
ADDED = [
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "lost_words", "lost_lines", "kept", "left_text",
]


@dataclass(frozen=True)
class QualityParams:
    """min_words: fewer fail, also after line removal; max_repeat_percent: of words in repeated windows.

    A line is frequent if more than `min_line_docs` distinct documents of a host hold it and they are more than
    `max_line_percent` of the host's distinct documents, or more than `max_line_docs` (None: without that): on a host
    with a large part of all rows a percentage would let boilerplate of any number of documents pass.
    """

    min_words: int = 20
    max_repeat_percent: int = 30
    min_line_docs: int = 10
    max_line_percent: int = 5
    max_line_docs: int | None = 1000


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACES), "")


def lower_letters(text: Column) -> Column:
    """A-Z in lower case, other letters as they are; translate, which looks up every character, only where it must."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, *letters()))


def lines_of(text: Column) -> Column:
    """The lines with a word, normalised: trimmed, white space as one space, A-Z in lower case."""
    normal = F.regexp_replace(text, r"[\x20\x09\x0B-\x0D]+", " ")
    lines = F.transform(F.split(normal, "\n"), lambda x: lower_letters(F.trim(x)))
    return F.array_remove(lines, "")


def without_lines(text: Column, gone: Column) -> Column:
    """The text without the lines whose normalised form has one of the hashes."""
    normal = lambda x: lower_letters(F.trim(F.regexp_replace(x, SPACES, " ")))
    return F.array_join(F.filter(F.split(text, "\n"), lambda x: ~F.array_contains(gone, F.xxhash64(normal(x)))), "\n")


def letters() -> tuple[str, str]:
    upper = "".join(map(chr, range(65, 91)))
    return upper, upper.lower()


def rest(array: Column, size: Column, skip: int) -> Column:
    return F.slice(array, F.lit(skip + 1), F.greatest(size - skip, F.lit(0)))


def first(array: Column, size: Column, skip: int) -> Column:
    return F.slice(array, F.lit(1), F.greatest(size - skip, F.lit(0)))


def with_repeats(docs: DataFrame) -> DataFrame:
    """Adds n_repeat_words from `_words`. Window hashes are built by doubling: 1, 2, 4, 8 words."""
    df = docs.withColumn("_h", F.transform("_words", lambda w: F.xxhash64(w)))
    width = 1
    while width < WINDOW:
        n = F.size("_h")
        df = df.withColumn("_h", F.zip_with(first(F.col("_h"), n, width), rest(F.col("_h"), n, width), lambda a, b: F.xxhash64(a, b)))
        width *= 2
    # Most texts repeat no window; only the others are sorted.
    repeats = F.size(F.array_distinct("_h")) < F.size("_h")
    df = df.withColumn(
        "_s", F.when(repeats, F.sort_array(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).otherwise(
            F.expr("cast(array() as array<struct<h: bigint, i: int>>)")
        ),
    )
    n = F.size("_s")
    equal = F.zip_with(
        first(F.col("_s"), n, 1), rest(F.col("_s"), n, 1),
        lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])).otherwise(F.expr("cast(array() as array<int>)")),
    )
    df = df.withColumn("_p", F.sort_array(F.array_distinct(F.flatten(equal))))
    n = F.size("_p")
    # A window covers its words up to the next repeated window.
    gaps = F.zip_with(first(F.col("_p"), n, 1), rest(F.col("_p"), n, 1), lambda a, b: F.least(b - a, F.lit(WINDOW)))
    covered = F.aggregate(gaps, F.lit(0).cast("long"), lambda total, gap: total + gap)
    return df.withColumn("n_repeat_words", F.when(n > 0, covered + WINDOW).otherwise(F.lit(0)).cast("long"))


def hashed(docs: DataFrame, key: str, text: str, host: str) -> DataFrame:
    """Hashes of the texts before lines are made of them, else every line computes that of its text."""
    return docs.select(
        F.col(host).alias("_host"), F.col(key).alias("_doc"), F.xxhash64(text, F.length(text)).alias("_text"), F.col(text).alias("_body")
    )


def frequent_lines(docs: DataFrame, params: QualityParams, key: str, text: str, host: str) -> DataFrame:
    """`_host`, `_line` and the first document `_owner` of the lines above the limit.

    Documents of a host are distinct by their text, so that copies count once. Counts are combined before every
    shuffle; a hot host is spread by line, a hot line by document.
    """
    lines = hashed(docs, key, text, host).select(
        "_host", "_doc", "_text", F.explode(F.array_distinct(F.transform(lines_of(F.col("_body")), lambda x: F.xxhash64(x)))).alias("_line")
    )
    per_text = lines.groupBy("_host", "_line", "_text").agg(F.min("_doc").alias("_doc"))
    per_line = per_text.groupBy("_host", "_line").agg(F.count(F.lit(1)).alias("_docs"), F.min("_doc").alias("_owner"))
    hosts = (
        docs.where(F.col(text).isNotNull())
        .select(F.col(host).alias("_host"), F.xxhash64(text, F.length(text)).alias("_text"))
        .groupBy("_host", "_text").agg(F.lit(1).alias("_one"))
        .groupBy("_host").agg(F.count(F.lit(1)).alias("_all"))
    )
    often = per_line.where(F.col("_docs") > params.min_line_docs).alias("l").join(
        hosts.alias("h"), F.col("l._host").eqNullSafe(F.col("h._host"))
    )
    above = F.col("_docs") * 100 > F.col("_all") * params.max_line_percent
    if params.max_line_docs is not None:
        above |= F.col("_docs") > params.max_line_docs
    return often.where(above).select("l._host", "_line", "_owner")


def judge(
    docs: DataFrame, params: QualityParams = QualityParams(), key: str = "doc_id", text: str = "text", host: str = "source"
) -> DataFrame:
    """All columns of docs and the base counts, `base_failed`, `lost_words` and `lost_lines` (in removed lines; their
    hashes, null without any), `kept` and `left_text`, the text without the removed lines.

    A line above the limit is removed from every document but the first (smallest key) of its host that has it, so
    no passage is lost everywhere. A document is rejected if it fails the base rules, or if lines were removed and
    fewer than min_words words are left. A null text has no words and fails. Null hosts form one host. Rows with
    equal keys are judged one by one, rows equal in key, text and host alike. Other columns pass through, whatever
    their names, but what is added replaces columns of the same name.
    """
    lean = docs.select(*dict.fromkeys([key, text, host]))
    often = saved(frequent_lines(lean, params, key, text, host), "lines")
    if often.count() <= BROADCAST_LINES:  # else both sides are shuffled by line
        often = F.broadcast(often)
    lines = hashed(lean.where(F.col(text).isNotNull()), key, text, host).select(
        "_host", "_doc", "_text",
        F.explode(F.transform(lines_of(F.col("_body")), lambda x, i: F.struct(i.alias("i"), F.xxhash64(x).alias("h"), F.size(F.split(x, " ")).alias("n")))).alias("_l"),
    ).select("_host", "_doc", "_text", F.col("_l.i").alias("_i"), F.col("_l.h").alias("_line"), F.col("_l.n").alias("_n"))
    removed = (
        lines.alias("a").join(often.alias("o"), (F.col("a._line") == F.col("o._line")) & F.col("a._host").eqNullSafe(F.col("o._host")))
        .where(~F.col("a._doc").eqNullSafe(F.col("o._owner")))
        .select("a._host", "a._doc", "a._text", "_i", "a._line", "_n").distinct()  # a document that is stored twice loses a line once
        .groupBy("_host", "_doc", "_text").agg(F.sum("_n").alias("lost_words"), F.sort_array(F.collect_set("_line")).alias("lost_lines"))
    )
    # The columns of docs stay in one, so that none of them meets a name used here.
    passed = [c for c in docs.columns if c not in ADDED]
    t = F.coalesce(F.col("_body"), F.lit(""))
    base = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in passed]).alias("_row"), F.col(key).alias("_key"), F.col(text).alias("_body"), F.col(host).alias("_at")
    ).withColumns(
        {
            "_words": words_of(t),
            "_lines": F.array_remove(F.transform(F.split(t, "\n"), lambda x: F.when(F.ltrim(x, F.lit(" \t\x0b\x0c\r")) == "", "").otherwise(x)), ""),
            "n_symbols": (F.length(t) - F.length(F.regexp_replace(t, SYMBOLS, ""))).cast("long"),
        }
    ).withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.length(F.array_join("_words", "")).cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        }
    )
    base = with_repeats(base)
    base = base.withColumns(
        {
            "base_failed": (F.col("n_words") < params.min_words) | (100 * F.col("n_repeat_words") > params.max_repeat_percent * F.col("n_words")),
            "_text": F.xxhash64("_body", F.length("_body")),
        }
    )
    out = base.alias("d").join(
        removed.alias("r"),
        F.col("d._text").eqNullSafe(F.col("r._text")) & F.col("d._key").eqNullSafe(F.col("r._doc")) & F.col("d._at").eqNullSafe(F.col("r._host")),
        "left",
    )
    lost = F.coalesce(F.col("lost_words"), F.lit(0))
    depleted = (lost > 0) & (F.col("n_words") - lost < params.min_words)
    kept = ~F.col("base_failed") & ~depleted
    left = F.when(F.col("lost_lines").isNull(), F.col("_body")).otherwise(without_lines(F.col("_body"), F.col("lost_lines")))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    return out.select(
        *[F.col("_row")[c].alias(c) for c in passed], *counts, lost.cast("long").alias("lost_words"), "lost_lines", kept.alias("kept"), left.alias("left_text")
    )


def keep_documents(
    docs: DataFrame, params: QualityParams = QualityParams(), key: str = "doc_id", text: str = "text", host: str = "source", length: str = "n_chars",
) -> DataFrame:
    """The rows that are kept, with the columns of docs, `text` without the removed lines and `length`, if there, counted anew."""
    lean = docs.select(F.col(key).alias("key"), F.col(text).alias("body"), F.col(host).alias("host"))
    verdicts = judge(lean, params, "key", "body", "host")
    # Written before the filter: pushed into the counts, it would repeat their expressions many times over.
    verdicts = saved(verdicts.select("key", "host", F.xxhash64("body", F.length("body")).alias("sum"), "kept", "lost_lines"), "verdicts")
    sums = [F.col("key").alias("_key"), F.col("host").alias("_host"), F.col("sum").alias("_sum")]
    changed = verdicts.where(~F.col("kept") | F.col("lost_lines").isNotNull()).select(*sums, F.col("kept").alias("_kept"), F.col("lost_lines").alias("_gone")).distinct()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    own = F.col("_row")[text]
    same = F.col("_row")[key].eqNullSafe(F.col("_key")) & F.col("_row")[host].eqNullSafe(F.col("_host")) & (F.xxhash64(own, F.length(own)) == F.col("_sum"))
    left = F.when(F.col("_gone").isNull(), own).otherwise(without_lines(own, F.col("_gone")))
    out = rows.join(changed, same, "left").where(F.coalesce("_kept", F.lit(True))).withColumn("_left", left)
    cells = {c: F.col("_row")[c] for c in docs.columns} | {text: F.col("_left")}
    if length in docs.columns:
        cells[length] = F.when(F.col("_gone").isNull(), F.col("_row")[length]).otherwise(F.length("_left").cast(docs.schema[length].dataType))
    return out.select(*[cells[c].alias(c) for c in docs.columns])
