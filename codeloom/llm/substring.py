"""Substring dedup by matching statistics against suffix automata of reference shards (operator 10).

A window of `window` consecutive words is removed from every place but its first. Broadcasting the automaton of
every shard of the corpus to every document would cost the square of the corpus, so the shards are chosen such
that a document meets only those that can hold one of its windows:

1. In one scan, every task takes its rows in chunks of bounded size. Equal windows of one chunk are settled there.
   The others get an anchor, the smallest hash of the runs of `gram` words in the window: equal windows have equal
   anchors, and neighbouring windows mostly share one, so about one row per seven words leaves the task.
2. An anchor that occurs in one chunk only is dropped. The others name the first document that holds them, their
   reference; all places of a window thus name the same one. A reference and what names it form a shard.
3. Documents that name a reference are read again, and the stretches in question go to its shard. There they
   stream, in document order, through a suffix automaton over words: where the matching statistic reaches the
   window, an earlier place holds the same words; what is new is added to the automaton. A reference with more words
   than a shard may have, such as that of many near copies, is cut by the hash of the window: equal windows still meet,
   and each part streams through a set of window hashes instead of an automaton.
4. The spans found in 1 and 3 are brought to their documents and cut out.

A passage of a third of all rows reaches its shard at most once per chunk. Words are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codeloom.llm.shared import saved

WINDOW = 20
GRAM = 8
CHUNK_WORDS = 1_500_000
#: Rows of a batch that leaves a chunk.
SLICE = 10_000
#: Words in the shard of a reference; 365 bytes each in an automaton.
SHARD_WORDS = 200_000
#: Cut references that are sent to every executor.
BROADCAST_REFERENCES = 50_000
NO_ID = (1 << 63) - 1  # a null key counts as the largest


def word_hashes(words: list[bytes]) -> np.ndarray:
    import xxhash

    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of pairs of hashes."""
    x = a * np.uint64(0x9E3779B97F4A7C15) + b
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def runs_hash(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of `width` items: by doubling, then by joining two overlapping runs."""
    if len(hashes) < width:
        return np.empty(0, np.uint64)
    size, out = 1, hashes
    while 2 * size <= width:
        out = mixed(out[: len(out) - size], out[size:])
        size *= 2
    if size < width:
        out = mixed(out[: len(out) - (width - size)], out[width - size :])
    return out


def smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of `width` values."""
    size, out = 1, values
    while 2 * size <= width:
        out = np.minimum(out[: len(out) - size], out[size:])
        size *= 2
    return out if size == width else np.minimum(out[: len(out) - (width - size)], out[width - size :])


def ranges_of(starts: np.ndarray, width: int) -> np.ndarray:
    """The union of [s, s + width) over sorted starts as flat begin, end pairs."""
    if not len(starts):
        return np.empty(0, np.int32)
    gap = np.flatnonzero(np.diff(starts) > width)
    begins = starts[np.r_[0, gap + 1]]
    ends = starts[np.r_[gap, len(starts) - 1]] + width
    return np.stack([begins, ends], 1).astype("<i4").ravel()


class Chunk:
    """Documents of one task, compared with each other."""

    def __init__(self, number: int, window: int, gram: int):
        self.number, self.window, self.gram = number, window, gram
        self.keys: list[tuple[int, int]] = []
        self.hashes: list[np.ndarray] = []
        self.words = 0

    def add(self, key: tuple[int, int], words: list[bytes]) -> None:
        if len(words) >= self.window:
            self.keys.append(key)
            self.hashes.append(word_hashes(words))
            self.words += len(words)

    def rows(self) -> Iterator[pa.RecordBatch]:
        order = sorted(range(len(self.keys)), key=self.keys.__getitem__)
        keys = [self.keys[i] for i in order]
        if not keys:
            return
        sizes = np.array([len(self.hashes[i]) for i in order])
        h = np.concatenate([self.hashes[i] for i in order])
        self.hashes.clear()
        off = np.r_[0, np.cumsum(sizes)].astype(np.int32)
        width = self.window
        full = runs_hash(h, width)
        doc = np.repeat(np.arange(len(keys), dtype=np.int32), sizes)
        at = np.flatnonzero(doc[: len(full)] == doc[width - 1 :]).astype(np.int32)  # windows that lie in one document
        full, doc = full[at], doc[at]
        begin = at - off[doc]
        anchor = smallest(runs_hash(h, self.gram), width - self.gram + 1)[at]
        del h, at
        by_hash = np.argsort(full, kind="stable").astype(np.int32)
        full = full[by_hash]
        new = np.r_[True, full[1:] != full[:-1]]
        del full
        first = np.empty(len(by_hash), np.int32)
        first[by_hash] = by_hash[new][np.cumsum(new) - 1]
        del by_hash, new
        is_first = first == np.arange(len(first), dtype=np.int32)
        twin = np.array([i and keys[i] == keys[i - 1] for i in range(len(keys))], bool)
        if twin.any():  # rows equal in key and text are one document
            same = np.cumsum(~twin)
            repeat = ~is_first & ((same[doc] != same[doc[first]]) | (begin != begin[first]))
        else:
            repeat = ~is_first
        del first
        # Stretches of windows with one anchor, as far as they are new in this chunk.
        a, d, s = anchor[is_first], doc[is_first], begin[is_first]
        hit = np.flatnonzero(repeat)
        doc, begin = doc[hit], begin[hit]
        del anchor, is_first, repeat, hit
        if len(a):
            edge = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (d[1:] != d[:-1])])
            last = np.r_[edge[1:], len(a)] - 1
            a, d, s, last = a[edge].view(np.int64), d[edge], s[edge], s[last]
            for i in range(0, len(a), SLICE):
                part = slice(i, i + SLICE)
                yield self.batch(a[part], [keys[j] for j in d[part]], s[part], last[part], None)
        del a, d, s
        if len(doc):
            edge = np.flatnonzero(np.r_[True, np.diff(doc) > 0])
            ends = np.r_[edge[1:], len(doc)]
            for i in range(0, len(edge), SLICE):
                spans = [ranges_of(begin[b:e], width).tobytes() for b, e in zip(edge[i : i + SLICE], ends[i : i + SLICE])]
                nothing = np.full(len(spans), -1)
                yield self.batch(None, [keys[j] for j in doc[edge[i : i + SLICE]]], nothing, nothing, spans)

    def batch(self, anchors, keys, begins, ends, spans) -> pa.RecordBatch:
        n = len(keys)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(anchors, pa.int64()) if anchors is not None else pa.nulls(n, pa.int64()),
                pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64()),
                pa.array(begins.astype(np.int32)), pa.array(ends.astype(np.int32)), pa.array([self.number] * n, pa.int64()),
                pa.array(spans, pa.binary()) if spans else pa.nulls(n, pa.binary()),
            ],
            names=["anchor", "doc", "sum", "begin", "end", "chunk", "spans"],
        )


class Automaton:
    """Suffix automaton over word hashes, for several texts."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.length = [-1], [0]

    def grow(self, last: int, word: int) -> int:
        """The state of the text that led to `last`, longer by a word."""
        nxt, link, length = self.next, self.link, self.length
        known = nxt[last].get(word)
        if known is not None:
            return known if length[known] == length[last] + 1 else self.split(last, word, known)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        new = len(nxt) - 1
        p = last
        while p >= 0 and word not in nxt[p]:
            nxt[p][word] = new
            p = link[p]
        if p >= 0:
            q = nxt[p][word]
            link[new] = q if length[q] == length[p] + 1 else self.split(p, word, q)
        return new

    def split(self, p: int, word: int, q: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        nxt.append(dict(nxt[q]))
        length.append(length[p] + 1)
        link.append(link[q])
        copy = len(nxt) - 1
        link[q] = copy
        while p >= 0 and nxt[p].get(word) == q:
            nxt[p][word] = copy
            p = link[p]
        return copy

    def matches(self, words: list[int], window: int) -> list[int]:
        """Starts of the windows that the automaton holds, by the matching statistic at their last word."""
        nxt, link, length = self.next, self.link, self.length
        state = size = 0
        found = []
        for i, word in enumerate(words):
            step = nxt[state].get(word)
            while step is None and state:
                state = link[state]
                size = length[state]
                step = nxt[state].get(word)
            if step is not None:
                state, size = step, size + 1
            if size >= window:
                found.append(i + 1 - window)
        return found

    def add(self, words: list[int]) -> None:
        last = 0
        for word in words:
            last = self.grow(last, word)


def stream_shard(automaton: Automaton, words: list[int], window: int) -> list[int]:
    """Starts of windows that come earlier; the stretches of the others become part of the reference."""
    found = {*automaton.matches(words, window), *repeats(words, window)}
    at, total = 0, len(words) - window + 1
    while at < total:
        end = at
        while end < total and end not in found:
            end += 1
        if end > at:
            automaton.add(words[at : end - 1 + window])
        at = end + 1
    return sorted(found)


def repeats(words: list[int], window: int) -> list[int]:
    """Starts of windows that occur earlier in the same words."""
    full = runs_hash(np.array(words, np.uint64), window)
    if len(np.unique(full)) == len(full):
        return []
    seen, out = set(), []
    for i, value in enumerate(full.tolist()):
        if value in seen:
            out.append(i)
        seen.add(value)
    return out


def identity(key: str, text: str) -> list[Column]:
    return [F.coalesce(F.col(key).cast("long"), F.lit(NO_ID)).alias("doc"), F.xxhash64(text).alias("sum")]


def scan_chunks(rows: DataFrame, window: int, gram: int, chunk_words: int) -> DataFrame:
    """Anchors of the stretches that are new in their chunk, and spans (null anchor) of what is not."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 24
        chunk = Chunk(number, window, gram)
        for batch in batches:
            docs_, sums = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i, (d, s) in enumerate(zip(docs_, sums)):
                chunk.add((d, s), batch.column(2)[i].as_py().split())
                if chunk.words >= chunk_words:
                    yield from chunk.rows()
                    number += 1
                    chunk = Chunk(number, window, gram)
                    pa.default_memory_pool().release_unused()
        yield from chunk.rows()

    return saved(
        rows.where("raw is not null").select("doc", "sum", "raw").mapInArrow(scan, "anchor long, doc long, sum long, begin int, end int, chunk long, spans binary"), "anchors"
    )


def named_places(scanned: DataFrame, window: int, shard_words: int) -> DataFrame:
    """doc, sum and `places` (begin, end, ref, parts of the reference's shard) of anchors that several chunks hold.

    Counts are combined before every shuffle and joined, so that an anchor in many documents is spread.
    """
    anchors = scanned.where(F.col("anchor").isNotNull())
    several = anchors.groupBy("anchor").agg(F.min("chunk").alias("lo"), F.max("chunk").alias("hi")).where("lo < hi").select("anchor")
    shared = saved(anchors.join(several, "anchor").select("anchor", "doc", "sum", "begin", "end"), "shared-anchors")
    heads = shared.groupBy("anchor").agg(F.min(F.struct("doc", "sum")).alias("ref"), F.sum(F.col("end") - F.col("begin") + window).alias("n"))
    heads = saved(heads.select("anchor", F.col("ref.doc").alias("ref_doc"), F.col("ref.sum").alias("ref_sum"), "n"), "references")
    large = heads.groupBy("ref_doc", "ref_sum").agg(F.ceil(F.sum("n") / shard_words).cast("int").alias("parts")).where("parts > 1")
    large = saved(large, "large-references")
    if large.count() <= BROADCAST_REFERENCES:
        large = F.broadcast(large)
    heads = heads.join(large, ["ref_doc", "ref_sum"], "left").select(
        "anchor", F.struct(F.col("ref_doc").alias("doc"), F.col("ref_sum").alias("sum")).alias("ref"), F.coalesce("parts", F.lit(1)).alias("parts")
    )
    return shared.join(heads, "anchor").groupBy("doc", "sum").agg(F.collect_list(F.struct("begin", "end", "ref", "parts")).alias("places"))


def stretches_of(rows: DataFrame, places: DataFrame, window: int) -> DataFrame:
    """Stretches by reference and part; `words` has the hashes of the words, or of the windows at `starts` in a part."""

    def stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                hashes = word_hashes(row["raw"].split())
                at, open_ = [], {}
                for p in sorted(row["places"], key=lambda p: p["begin"]):
                    ref = (p["ref"]["doc"], p["ref"]["sum"])
                    if ref in open_ and p["begin"] <= open_[ref][1] + 1:
                        open_[ref][1] = max(open_[ref][1], p["end"])
                    else:
                        open_[ref] = [p["begin"], p["end"]]
                        at.append((ref, p["parts"], open_[ref]))
                for ref, parts, (b, e) in at:
                    if parts == 1:
                        out.append((*ref, 0, row["doc"], row["sum"], b, hashes[b : e + window].tobytes(), None))
                        continue
                    full = runs_hash(hashes[b : e + window], window)
                    part = (mixed(full, full) % np.uint64(parts)).astype(np.int64)
                    for i in np.unique(part).tolist():
                        starts = np.flatnonzero(part == i)
                        out.append((*ref, i, row["doc"], row["sum"], b + int(starts[0]), full[starts].tobytes(), (b + starts).astype("<i4").tobytes()))
            cols = list(zip(*out)) if out else [[]] * 8
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(cols, kinds)], names=["ref_doc", "ref_sum", "part", "doc", "sum", "begin", "words", "starts"]
            )

    # All columns, as in the last join of dedup_documents: so the texts are shuffled once for both.
    met = rows.join(places, ["doc", "sum"]).select("doc", "sum", "raw", "places", "row")
    return met.mapInArrow(stretches, "ref_doc long, ref_sum long, part int, doc long, sum long, begin int, words binary, starts binary")


def find_spans(rows: DataFrame, window: int, gram: int, chunk_words: int, shard_words: int = SHARD_WORDS) -> DataFrame:
    """Rows (doc, sum, spans): spans of words that occur earlier, as flat pairs of 32-bit numbers; several per document.

    rows: doc, sum, raw, row.
    """

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, automaton, seen, before = None, Automaton(), set(), None
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if (row["ref_doc"], row["ref_sum"], row["part"]) != shard:
                    shard, automaton, seen, before = (row["ref_doc"], row["ref_sum"], row["part"]), Automaton(), set(), None
                this = (row["doc"], row["sum"], row["begin"])
                if this == before:
                    continue  # the same document once more
                before = this
                words = np.frombuffer(row["words"], "<u8").tolist()
                if row["starts"] is None:
                    found = np.array(stream_shard(automaton, words, window), np.int64) + row["begin"]
                else:
                    found = []
                    for word, start in zip(words, np.frombuffer(row["starts"], "<i4").tolist()):
                        if word in seen:
                            found.append(start)
                        seen.add(word)
                    found = np.array(found, np.int64)
                if len(found):
                    out.append((row["doc"], row["sum"], ranges_of(found, window).tobytes()))
            cols = list(zip(*out)) if out else [[]] * 3
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int64(), pa.binary()))], names=["doc", "sum", "spans"]
            )

    scanned = scan_chunks(rows, window, gram, chunk_words)
    routed = stretches_of(rows, named_places(scanned, window, shard_words), window)
    by_shard = routed.repartition("ref_doc", "ref_sum", "part").sortWithinPartitions("ref_doc", "ref_sum", "part", "doc", "sum", "begin")
    matched = by_shard.mapInArrow(shards, "doc long, sum long, spans binary")
    return scanned.where(F.col("anchor").isNull()).select("doc", "sum", "spans").unionByName(matched)


def cut(raw: bytes, spans: list[bytes]) -> tuple[int, int, str]:
    """Words, removed words and what is left: a removed word goes with the white space behind it."""
    words = raw.split()
    if not spans:
        return len(words), 0, raw.decode()
    gone = np.zeros(len(words) + 1, np.int32)
    for span in spans:
        pairs = np.frombuffer(span, "<i4").reshape(-1, 2)
        np.add.at(gone, pairs[:, 0], 1)
        np.add.at(gone, pairs[:, 1], -1)
    gone = np.cumsum(gone)[:-1] > 0
    out, at, keep_from = [], 0, 0
    for word, lost in zip(words, gone.tolist()):
        begin = raw.index(word, at)
        if lost:
            if keep_from is not None:
                out.append(raw[keep_from:begin])
                keep_from = None
        elif keep_from is None:
            keep_from = begin
        at = begin + len(word)
    if keep_from is not None:
        out.append(raw[keep_from:])
    return len(words), int(gone.sum()), b"".join(out).decode()


def dedup_documents(
    docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, gram: int = GRAM, chunk_words: int = CHUNK_WORDS,
    shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """Columns of docs with the removed words cut out of `text`, and `n_words`, `n_removed`.

    A word goes if it lies in a window whose words also start earlier: in a document with a smaller key (a null key
    is the largest, equal keys go by a hash of the text) or earlier in the same one. Rows equal in key and text are
    one document and lose the same words. A null text stays null and has no words; texts shorter than a window stay
    as they are. Other columns pass through, whatever their names, but the new counts replace columns of their names.
    """
    names = [c for c in docs.columns if c not in ("n_words", "n_removed")]
    rows = docs.select(*identity(key, text), F.col(text).cast("binary").alias("raw"), F.struct(*[F.col(f"`{c}`") for c in names if c != text]).alias("row"))
    spans = find_spans(rows, window, gram, chunk_words, shard_words)
    per_doc = spans.groupBy("doc", "sum").agg(F.collect_list("spans").alias("all_spans"))
    row_type = rows.schema["row"].dataType.simpleString()

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = [cut(raw, spans or []) if raw is not None else (0, 0, None) for raw, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array([x[2] for x in done], pa.string()), pa.array([x[0] for x in done], pa.int64()),
                    pa.array([x[1] for x in done], pa.int64()),
                ],
                names=["row", "left", "n_words", "n_removed"],
            )

    out = rows.join(per_doc, ["doc", "sum"], "left").select("row", "raw", "all_spans").mapInArrow(
        finish, f"row {row_type}, left string, n_words long, n_removed long"
    )
    cells = [F.col("left").alias(c) if c == text else F.col("row")[c].alias(c) for c in names]
    return out.select(*cells, "n_words", "n_removed")


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: str = "n_chars") -> DataFrame:
    """The columns of docs, with repeats cut out of `text` and `length`, if it is there, counted anew."""
    names = docs.columns
    inside = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"), F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"))
    out = dedup_documents(inside, "_key", "_text")
    cells = {c: F.col("_row")[c] for c in names} | {text: F.col("_text")}
    if length in names:
        cells[length] = F.when(F.col("n_removed") > 0, F.length("_text").cast(docs.schema[length].dataType)).otherwise(F.col("_row")[length])
    return out.select(*[cells[c].alias(c) for c in names])
