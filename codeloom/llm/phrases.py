"""Collocations by direct-address tiling (operator 12).

A scan turns texts into chunks: the words of up to `CHUNK_WORDS` words of one language as numbers of the chunk, and the
chunk's own list of words with their counts. Those lists give the counts of all words; the frequent ones are ranked by
frequency, and the ranks go back to the chunks that use them. So neither the words nor their places are ever dealt by
word, and no list of words is sent to all tasks.

Neighbouring ranks of a chunk are counted in tiles of `SIDE` x `SIDE` pairs. A tile with many of the chunk's pairs has an
array with one cell for each pair, filled by `bincount`; those of all other tiles are sorted coordinates with counts.
Spark adds what the chunks counted. Frequent pairs are ranked in turn, and a chunk is written anew with the rank of the
pair that starts at each place: two pairs next to each other are three words, counted by the same step, and so on.

A chunk asks only for ranks of pairs that a bit table of fixed size (2 MB) admits. It holds the hashes of all frequent pairs;
when they outgrow it, it admits too many, and the join that follows sorts them out as ever.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import ExitStack

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codeloom.operators.ranking import first_in_group
from codeloom.session import stored, write_and_read

MIN_COUNT = 10
MAX_WORDS = 3
CONTAINED_PERCENT = 50
TOP = 2000
CHUNK_WORDS = 1 << 19
#: Words and list entries that a task holds in its open chunks, whatever the number of languages.
OPEN_WORDS, OPEN_ENTRIES = 3 << 19, 300_000
SIDE = 256
#: Tiles of the first NEAR x NEAR can be dense; they are if they hold so many of a chunk's pairs.
NEAR, DENSE = 64, 1 << 13
BIT_TABLE = 1 << 24
#: Rows of an Arrow batch with counts.
SLICE = 200_000
#: Ranks are 32-bit numbers.
MOST_RANKS = 1 << 31

#: Bytes of a text: A-Z lower, tab to space, what ends a piece to 0xFF, which UTF-8 never has.
PIECE_BYTES = bytes(b + 32 if 65 <= b <= 90 else 32 if b == 9 else 255 if b in b".,;:!?" or 10 <= b <= 13 else b for b in range(256))
END = b"\xff"


# ---- texts to chunks --------------------------------------------------------------------


def packed(codes: np.ndarray) -> bytes:
    """32-bit numbers, compressed byte plane by byte plane: most of the high bytes are zero."""
    planes = np.ascontiguousarray(codes, np.dtype("<i4")).view(np.uint8).reshape(-1, 4).T.tobytes()
    return len(codes).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def unpacked(value: pa.BinaryScalar) -> np.ndarray:
    raw = value.as_py()
    size = int.from_bytes(raw[:8], "little")
    planes = pa.decompress(raw[8:], 4 * size, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, size).T).view(np.dtype("<i4")).reshape(-1)


class Chunk:
    """Words of one language as numbers; number 0 ends a piece."""

    def __init__(self, lang: str):
        class Numbers(dict):
            def __missing__(self, word: bytes) -> int:
                value = self[word] = len(self)
                return value

        self.lang, self.numbers, self.parts, self.words = lang, Numbers({END: 0}), [], 0

    def add(self, words: list[bytes]) -> None:
        self.parts.append(np.fromiter(map(self.numbers.__getitem__, words), np.int32, len(words)))
        self.words += len(words)

    def row(self, number: int) -> tuple:
        codes = np.concatenate(self.parts)
        counts = np.bincount(codes, minlength=len(self.numbers))[1:]
        words = list(self.numbers)[1:]
        return number, self.lang, int(counts.sum()), packed(codes - 1), words, counts


def chunked_words(docs: DataFrame, text: str, lang: str, chunk_words: int = CHUNK_WORDS) -> DataFrame:
    """Rows (chunk, lang, n, codes, words, counts): packed numbers of the chunk's words, -1 between pieces."""

    def batch_of(row: tuple) -> pa.RecordBatch:
        number, name, n, codes, words, counts = row
        return pa.RecordBatch.from_arrays(
            [
                pa.array([number]), pa.array([name]), pa.array([n]), pa.array([codes], pa.binary()),
                pa.array([words], pa.list_(pa.binary())), pa.array([counts], pa.list_(pa.int64())),
            ],
            names=["chunk", "lang", "n", "codes", "words", "counts"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_chunks: dict[str, Chunk] = {}
        done = TaskContext.get().partitionId() << 33
        words = entries = 0
        for batch in batches:
            for name, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                raw = raw.as_py()
                found = raw.translate(PIECE_BYTES).replace(END, b" \xff ").split() if raw else []
                # A document longer than a chunk is cut where a piece ends.
                begin = 0
                while begin < len(found):
                    stop = min(begin + chunk_words, len(found))
                    while stop < len(found) and found[stop - 1] != END:
                        stop += 1
                    part, begin = found[begin:stop], stop
                    chunk = open_chunks.get(name)
                    if chunk is None:
                        chunk = open_chunks[name] = Chunk(name)
                    before = len(chunk.numbers)
                    chunk.add([*part, END])
                    words += len(part) + 1
                    entries += len(chunk.numbers) - before
                    while chunk.words >= chunk_words or words > OPEN_WORDS or entries > OPEN_ENTRIES:
                        full = chunk if chunk.words >= chunk_words else max(open_chunks.values(), key=lambda c: c.words)
                        yield batch_of(full.row(done))
                        done += 1
                        words, entries = words - full.words, entries - len(full.numbers) + 1
                        del open_chunks[full.lang]
                        if full is chunk:
                            break
            pa.default_memory_pool().release_unused()
        for chunk in open_chunks.values():
            yield batch_of(chunk.row(done))
            done += 1

    schema = "chunk long, lang string, n long, codes binary, words array<binary>, counts array<long>"
    return docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).cast("binary").alias("raw")).mapInArrow(run, schema)


# ---- ranks ------------------------------------------------------------------------------


def with_ranks(counted: DataFrame, ties: list[str], stack: ExitStack) -> DataFrame:
    """`id`, the place of a row by language and falling count `f`, from 0.

    The rows are sorted over all tasks; places follow from the sizes of the sorted parts.
    """
    placed = stack.enter_context(
        stored(counted.orderBy("lang", F.desc("f"), *ties).withColumn("at_", F.monotonically_increasing_id()), "ranks")
    )
    part = F.shiftright("at_", 33)
    sizes = {r["part"]: r["count"] for r in placed.groupBy(part.alias("part")).count().collect()}
    shifts, total = [], 0
    for number in sorted(sizes):
        shifts.append((number, total))
        total += sizes[number]
    if total > MOST_RANKS:
        raise ValueError("there are more frequent phrases than 32-bit ranks")
    shift = counted.sparkSession.createDataFrame(shifts, "part_ long, shift_ long")
    inside = F.col("at_").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.withColumn("part_", part).join(F.broadcast(shift), "part_").withColumn("id", inside + F.col("shift_")).drop("at_", "part_", "shift_")


def ranked_chunks(chunks: DataFrame, items: DataFrame, ranks: DataFrame, keys: list[str], stack: ExitStack) -> DataFrame:
    """The chunks with ranks in place of their own numbers; -1 for what is not frequent.

    `items` has a row for each number of a chunk, so no rank is asked for more than once per chunk. The join is the
    same at every size.
    """
    known = items.join(ranks.select(*keys, "id").hint("merge"), keys)
    lists = known.groupBy("chunk").agg(F.collect_list(F.shiftleft(F.col("number").cast("long"), 32) + F.col("id")).alias("ranks"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                codes, ranks = unpacked(batch.column(1)[at]), batch.column(2)[at].values.to_numpy()
                table = np.full(int(codes.max(initial=-1)) + 2, -1, np.int32)  # the last entry stands for -1
                table[ranks >> 32] = ranks & MOST_RANKS - 1
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, 1), pa.array([packed(table[codes])], pa.binary())], names=["chunk", "codes"])

    joined = chunks.select("chunk", "codes").join(lists.hint("merge"), "chunk").select("chunk", "codes", "ranks")
    return stack.enter_context(stored(joined.mapInArrow(run, "chunk long, codes binary"), "ranked"))


# ---- tiles ------------------------------------------------------------------------------


def count_pairs(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs of two rank arrays, as left * 2^31 + right, and how often each comes.

    Tiles are counted from the smallest rank, which is that of the language's most frequent item.
    """
    first = int(min(left.min(), right.min())) if len(left) else 0
    row, column = (left - first) // SIDE, (right - first) // SIDE
    tile = np.where((row < NEAR) & (column < NEAR), row * NEAR + column, NEAR * NEAR)
    del row, column
    filled = np.bincount(tile, minlength=NEAR * NEAR + 1)
    filled[-1] = 0
    dense = filled >= DENSE
    inside = dense[tile]
    pairs, counts = [], []
    if inside.any():
        cell = (left[inside] - first) % SIDE * SIDE + (right[inside] - first) % SIDE
        order = np.argsort(tile[inside].astype(np.int16), kind="stable")
        cell, numbers = cell[order], np.flatnonzero(dense)
        for number, part in zip(numbers, np.split(cell, np.cumsum(filled[numbers])[:-1])):
            cells = np.bincount(part, minlength=SIDE * SIDE)
            used = np.flatnonzero(cells)
            pairs.append((number // NEAR * SIDE + used // SIDE + first) << 31 | number % NEAR * SIDE + used % SIDE + first)
            counts.append(cells[used])
        del cell, order
    del tile
    sparse = left[~inside].astype(np.int64) << 31
    sparse |= right[~inside]
    sparse.sort()
    begin = np.flatnonzero(np.diff(sparse, prepend=-1))
    pairs.append(sparse[begin])
    counts.append(np.diff(begin, append=len(sparse)))
    return np.concatenate(pairs), np.concatenate(counts)


def pair_counts(ranked: DataFrame) -> DataFrame:
    """(pair, f) of neighbouring ranks in the chunks of `codes`; a pair is left * 2^31 + right."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                codes = unpacked(batch.column(0)[at])
                both = (codes[:-1] >= 0) & (codes[1:] >= 0)
                pairs, counts = count_pairs(codes[:-1][both], codes[1:][both])
                for begin in range(0, len(pairs), SLICE):
                    yield pa.RecordBatch.from_arrays([pa.array(c[begin : begin + SLICE]) for c in (pairs, counts)], names=["pair", "c"])
            pa.default_memory_pool().release_unused()

    return ranked.select("codes").mapInArrow(run, "pair long, c long").groupBy("pair").agg(F.sum("c").alias("f"))


def bit_of(pair):
    """Place of a pair in the bit table; the same for columns and for arrays."""
    return (pair % 1073741789 * 1000003 + pair % 16777213) % BIT_TABLE


def bit_table(pairs: DataFrame) -> bytes:
    """One bit for each place that some frequent pair has: at most 513 rows of 4 KB reach the driver."""
    place = pairs.select(bit_of(F.col("pair")).alias("place"))
    rows = place.groupBy(F.expr("bitmap_bucket_number(place)").alias("bucket")).agg(
        F.expr("bitmap_construct_agg(bitmap_bit_position(place))").alias("bits")
    )
    table = np.zeros((BIT_TABLE // 32768 + 1, 4096), np.uint8)
    for row in rows.collect():
        table[row["bucket"]] = np.frombuffer(bytes(row["bits"]), np.uint8)
    return table.tobytes()


def has_bit(table: np.ndarray, place: np.ndarray) -> np.ndarray:
    # Spark's buckets hold 32768 bits and start at 1 with place 1.
    before = place - 1
    bucket = np.where(place > 0, before // 32768 + 1, 0)
    at = np.where(place > 0, before % 32768, 0)
    return (table[bucket * 4096 + at // 8] >> (at % 8).astype(np.uint8) & 1).astype(bool)


def chunked_pairs(ranked: DataFrame, pairs: DataFrame) -> DataFrame:
    """The chunks with their own numbers for the pair that starts at each place, and lists of those pairs."""
    shared = ranked.sparkSession.sparkContext.broadcast(bit_table(pairs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            for at in range(batch.num_rows):
                codes = unpacked(batch.column(1)[at])
                left, right = codes[:-1], codes[1:]
                asked = (left >= 0) & (right >= 0)
                keys = left[asked].astype(np.int64) << 31
                keys |= right[asked]
                admitted = has_bit(table, bit_of(keys))
                asked[asked] = admitted
                keys, numbers = np.unique(keys[admitted], return_inverse=True)
                own = np.full(len(left), -1, np.int32)
                own[asked] = numbers
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, 1), pa.array([packed(own)], pa.binary()), pa.array([keys], pa.list_(pa.int64()))],
                    names=["chunk", "codes", "pairs"],
                )
            pa.default_memory_pool().release_unused()

    return ranked.select("chunk", "codes").mapInArrow(run, "chunk long, codes binary, pairs array<long>")


# ---- phrases ----------------------------------------------------------------------------


def lowest_cut(length: int) -> Column:
    """The cut with the lowest score and, of equal ones, the fewest words before it: (score, k, l, r)."""
    wide = lambda c: c.cast("decimal(19,0)")
    cuts = []
    for k in range(1, length):
        l, r = F.element_at("firsts", k), F.element_at("lasts", length - k)
        top = F.lit(1_000_000).cast("decimal(7,0)") * (wide(F.col("f")) * wide(F.col("f"))).cast("decimal(31,0)")
        score = F.call_function("div", top, (wide(l) * wide(r)).cast("decimal(38,0)")).alias("score")
        cuts.append(F.struct(score, F.lit(k).alias("k"), l.alias("l"), r.alias("r")))
    return F.array_min(F.array(*cuts)) if len(cuts) > 1 else cuts[0]


def mine_phrases(
    docs: DataFrame, text: str = "text", lang: str = "lang", max_words: int = MAX_WORDS, min_count: int = MIN_COUNT,
    contained_percent: int = CONTAINED_PERCENT, top: int = TOP, chunk_words: int = CHUNK_WORDS,
) -> DataFrame:
    """The best phrases of 2 to `max_words` words of each language: lang, rank, phrase, a, l, r, n, score.

    a counts the phrase, l and r the two parts at the cut with the lowest score, n all words of the language; counts are
    exact and over all texts. A phrase is left out if one that is a word longer, as frequent as `min_count`, holds it and
    has at least `contained_percent` of its count (one still longer is never more frequent). Ties go to the larger a,
    then by the bytes of the phrase. A null language is `und`; null and empty texts have no words; repeated rows count
    each; columns other than the two are left out, whatever their names. Languages without phrases and an empty table
    give no rows. Texts of any length are counted whole.
    """
    with ExitStack() as stack:
        keep = lambda df, label: stack.enter_context(stored(df, label))
        chunks = keep(chunked_words(docs, text, lang, chunk_words), "chunks")
        sizes = chunks.groupBy("lang").agg(F.sum("n").alias("n"))
        listed = chunks.select("chunk", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("number", "item"))
        items = listed.select("chunk", "lang", "number", F.col("item.words").cast("string").alias("word"), F.col("item.counts").alias("c"))
        words = items.groupBy("lang", "word").agg(F.sum("c").alias("f")).where(F.col("f") >= min_count)
        none = F.array().cast("array<long>")
        level = with_ranks(words, ["word"], stack).withColumns({"words": F.array("word"), "firsts": none, "lasts": none})
        ranked = ranked_chunks(chunks, items.drop("c"), level, ["lang", "word"], stack)

        found = []
        for length in range(2, max_words + 1):
            frequent = pair_counts(ranked).where(F.col("f") >= min_count)
            left, right = F.shiftright("pair", 31), F.col("pair").bitwiseAND(F.lit(MOST_RANKS - 1))
            one = level.select("lang", F.col("id").alias("left"), F.col("words").alias("head"), "firsts", F.col("f").alias("left_f"))
            two = level.select(F.col("id").alias("right"), F.element_at("words", -1).alias("tail"), "lasts", F.col("f").alias("right_f"))
            joined = frequent.withColumns({"left": left, "right": right}).join(one, "left").join(two, "right").select(
                "lang", "pair", "left", "right", "f", F.concat("head", F.array("tail")).alias("words"),
                F.concat("firsts", F.array("left_f")).alias("firsts"), F.concat("lasts", F.array("right_f")).alias("lasts"),
            )
            level = with_ranks(joined, ["pair"], stack)
            if found:  # the phrases of the level before that a longer one holds
                held = level.select("f", F.explode(F.array("left", "right")).alias("id")).groupBy("id").agg(F.max("f").alias("held_"))
                before = found.pop().join(held, "id", "left")
                found.append(before.where(F.coalesce(100 * F.col("held_") < contained_percent * F.col("f"), F.lit(True))).drop("held_"))
            found.append(level.withColumn("cut", lowest_cut(length)).select("id", "lang", F.array_join("words", " ").alias("phrase"), "f", "cut"))
            if length < max_words:
                numbered = keep(chunked_pairs(ranked, level), "numbered")
                pairs = numbered.select("chunk", F.posexplode("pairs").alias("number", "pair"))
                ranked = ranked_chunks(numbered, pairs, level, ["pair"], stack)

        every = found[0]
        for more in found[1:]:
            every = every.unionByName(more)
        every = every.select("lang", "phrase", F.col("f").alias("a"), "cut.l", "cut.r", "cut.score", (-F.col("cut.score")).alias("down_"), (-F.col("f")).alias("fewer_"))
        best = first_in_group(every, ["lang"], ["down_", "fewer_", "phrase"], top)
        result = best.join(sizes, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
        return write_and_read(result, "phrases")
