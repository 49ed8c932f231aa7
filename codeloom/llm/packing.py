"""Packing documents into windows by minimum bin slack (operator 8).

Each task tokenises its documents once and cuts off whole windows; what remains of each document goes to a pool.
When the pool holds `pool_tokens` tokens, windows are filled from it: the longest remaining length opens a window,
and a subset-sum dynamic program over the multiset of the other lengths, kept as the bits of one integer per
length, finds the largest sum that still fits, so the window with the least slack; the counts are found by going back
through the integers, and the same multiset fills as many windows as the counts allow. Slack that no length can
fill is filled by the head of one more piece, the longest left, whose tail stays in the pool. So no window needs padding,
and at most one piece per window is cut.

What is left at the end of a task, less than one window and its pieces, is laid end to end and cut at powers of two.
Nothing is shuffled, no task holds more than its pool, one batch and one document, and a repeated task gives the
same pieces, because sequences are numbered within the partition of the scan.
"""

from __future__ import annotations

import unicodedata
import weakref
from bisect import insort
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codeloom.llm.bpe import WORD_PATTERN, byte_symbols

WINDOW = 2048
END_ID = 1
POOL_TOKENS = 1 << 21
#: Bytes that a worker's tables of seen chunks and words may take, with an estimate for an entry besides its texts.
CHUNK_BYTES, WORD_BYTES, ENTRY_BYTES = 224 << 20, 96 << 20, 200
#: Longer texts are not kept.
KEPT_BYTES = 64


class Seen(dict):
    """What a function gave for the texts it has seen, as bytes.

    When the table holds half of `most` bytes it becomes the older one, and what is asked of that comes back.
    """

    def __init__(self, give, most: int):
        super().__init__()
        self.give, self.half, self.held, self.older = give, most // 2, 0, {}

    def __missing__(self, text) -> bytes:
        value = self.older.get(text)
        if value is None:
            value = self.give(text)
        if len(text) <= KEPT_BYTES:
            if self.held >= self.half:
                self.older, self.held = dict(self), 0
                self.clear()
            self.held += ENTRY_BYTES + len(text) + len(value)
            self[text] = value
        return value


class Ids:
    """Token ids of texts as little-endian unsigned 32-bit numbers, by the tokenizers library.

    ASCII white space ends every token of this vocabulary, so the chunks between it are encoded one by one, and words
    of a chunk by the model of the tokenizer.
    """

    def __init__(self, spec: str, chunk_bytes: int = CHUNK_BYTES, word_bytes: int = WORD_BYTES):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.model = self.tokenizer.model
        self.find = regex.compile(WORD_PATTERN).findall
        self.symbols = byte_symbols()
        me = weakref.proxy(self)  # with a cycle, a worker that drops the broadcast would keep the tables until a full collection
        self.known, self.words = Seen(lambda raw: me.chunk(raw), chunk_bytes), Seen(lambda word: me.word(word), word_bytes)

    @staticmethod
    def of_worker(state: dict) -> Ids:
        """The one of this worker: `state` is a broadcast value, which the worker keeps for its next task."""
        if "ids" not in state:
            state["ids"] = Ids(state["spec"], *state["bytes"])
        return state["ids"]

    def word(self, word: str) -> bytes:
        text = word if word.isascii() and word.isprintable() else "".join([self.symbols[b] for b in word.encode()])
        return np.array([t.id for t in self.model.tokenize(text)], "<u4").tobytes()

    def chunk(self, raw: bytes) -> bytes:
        text = raw.decode()
        if "<|" in text:  # perhaps a special token
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # sigma has no final form here
        text = text.lower()
        if text.isascii() and text.isalpha():
            return self.words[text]
        return b"".join(map(self.words.__getitem__, self.find(text)))

    def of(self, raw: bytes | None) -> bytes:
        return b"".join(map(self.known.__getitem__, raw.split())) if raw else b""


def closest(counts: dict[int, int], lengths: list[int], room: int) -> list[int]:
    """The lengths, with repetition, whose sum is the largest that fits into `room`; `lengths` rises."""
    everything = (1 << (room + 1)) - 1
    reach, steps = 1, []  # bit s: a sum of s can be made
    for length in reversed(lengths):
        if reach >> room & 1:
            break
        left = counts.get(length, 0)
        if length > room or not left:
            continue
        steps.append((length, reach))
        most, take = min(left, room // length), 1
        while most > 0:
            take = min(take, most)
            reach |= reach << (length * take) & everything
            most, take = most - take, take * 2
    best, chosen = reach.bit_length() - 1, []
    for length, before in reversed(steps):
        while not before >> best & 1:
            best -= length
            chosen.append(length)
    return chosen


def fill(counts: dict[int, int], window: int) -> Iterator[tuple[list[int], int, int]]:
    """Multisets of lengths with the least slack in a window, a length to cut, and the number of such windows.

    The head of a piece of the length to cut fills the slack, and `counts` gets its tail; it is 0 if there is no slack.
    `counts` ends with less than a window.
    """
    lengths = sorted(length for length, n in counts.items() if n)
    while lengths:
        longest = lengths[-1]
        if not counts[longest]:
            lengths.pop()
            continue
        counts[longest] -= 1
        chosen = [longest, *closest(counts, lengths, window - longest)]
        counts[longest] += 1
        need, slack = Counter(chosen), window - sum(chosen)
        times = min(counts[length] // n for length, n in need.items())
        if not slack:
            for length, n in need.items():
                counts[length] -= n * times
            yield chosen, 0, times
            continue
        # No length left fits into the slack, so each is longer; the longest is cut.
        for length, n in need.items():
            counts[length] -= n
        spare = next((length for length in reversed(lengths) if counts[length]), 0)
        if not spare:  # less than a window is left
            for length, n in need.items():
                counts[length] += n
            return
        tail = spare - slack
        if tail not in counts or not counts[tail] and tail not in lengths:
            insort(lengths, tail)
        counts[spare] -= 1
        counts[tail] = counts.get(tail, 0) + 1
        yield chosen, spare, 1


class Packer:
    """Packs the documents of one partition; pieces come out as (row, start, ids, sequence, offset)."""

    def __init__(self, window: int, first: int):
        self.window, self.sequence = window, first
        self.pool: dict[int, list[tuple]] = defaultdict(list)
        self.held = 0
        self.out: list[tuple] = []

    def add(self, row: tuple, ids: bytes) -> None:
        n, w = len(ids) // 4, self.window
        whole = n - n % w
        for start in range(0, whole, w):
            self.out.append((row, start, ids[4 * start : 4 * (start + w)], self.sequence, 0))
            self.sequence += 1
        if n > whole:
            self.pool[n - whole].append((row, whole, ids[4 * whole :]))
            self.held += n - whole

    def pack(self) -> None:
        counts = {length: len(items) for length, items in self.pool.items() if items}
        for chosen, spare, times in fill(counts, self.window):
            for _ in range(times):
                offset = 0
                for length in chosen:
                    row, start, ids = self.pool[length].pop()
                    self.out.append((row, start, ids, self.sequence, offset))
                    offset += length
                if spare:
                    row, start, ids = self.pool[spare].pop()
                    slack = self.window - offset
                    self.out.append((row, start, ids[: 4 * slack], self.sequence, offset))
                    self.pool[spare - slack].append((row, start + slack, ids[4 * slack :]))
                self.sequence += 1
                self.held -= self.window

    def finish(self) -> None:
        """Lay what is left end to end and cut it at powers of two."""
        self.pack()
        items = [item for length in sorted(self.pool, reverse=True) for item in self.pool[length]]
        self.pool.clear()
        sizes = [1 << bit for bit in range(self.held.bit_length() - 1, -1, -1) if self.held >> bit & 1]
        at = offset = self.held = 0
        for row, start, ids in items:
            while ids:
                piece = ids[: 4 * (sizes[at] - offset)]
                self.out.append((row, start, piece, self.sequence, offset))
                start, ids, offset = start + len(piece) // 4, ids[len(piece) :], offset + len(piece) // 4
                if offset == sizes[at]:
                    at, offset, self.sequence = at + 1, 0, self.sequence + 1

    def settle(self, pool_tokens: int) -> None:
        if self.held >= pool_tokens:
            self.pack()


def pack_documents(
    docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", window: int = WINDOW,
    pool_tokens: int = POOL_TOKENS, end_id: int = END_ID, seen_bytes: tuple[int, int] = (CHUNK_BYTES, WORD_BYTES),
) -> DataFrame:
    """Pieces of all documents: key, start, length, ids (unsigned 32-bit, little-endian), doc_tokens, sequence_id, offset.

    Every id of a document and its `end_id` lie in one piece; a sequence holds `window` ids or a power of two of
    them, so none needs padding, and its pieces lie next to each other. A null or empty text is the end id alone.
    Rows with equal or null keys are packed as separate documents; other columns are ignored; an empty table gives
    no pieces. `pool_tokens` bounds a task's memory, not the result. So does `seen_bytes`, for the tables of seen chunks
    and words, which a worker keeps after its task, beside a JVM that may have grown to all of its heap in other jobs.
    """
    with open(path, encoding="utf-8") as file:
        spec = docs.sparkSession.sparkContext.broadcast({"spec": file.read(), "bytes": seen_bytes})
    kind = docs.schema[key].dataType.simpleString()
    names = [key, "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    schema = f"`{key}` {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    tail = np.array([end_id], dtype="<u4").tobytes()

    def pieces(out: list[tuple], key_type: pa.DataType) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(out), 1000):
            part = out[at : at + 1000]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([p[0][0] for p in part], key_type), pa.array([p[1] for p in part], pa.int64()),
                    pa.array([len(p[2]) // 4 for p in part], pa.int64()), pa.array([p[2] for p in part], pa.binary()),
                    pa.array([p[0][1] for p in part], pa.int64()), pa.array([p[3] for p in part], pa.int64()),
                    pa.array([p[4] for p in part], pa.int64()),
                ],
                names=names,
            )
        out.clear()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = Ids.of_worker(spec.value)
        packer = Packer(window, TaskContext.get().partitionId() << 36)
        key_type = None
        for batch in batches:
            key_type = batch.schema.field(0).type
            for name, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = ids_of.of(raw.as_py())
                packer.add((name, len(ids) // 4 + 1), ids + tail)
                packer.settle(pool_tokens)
                if len(packer.out) >= 1000:
                    yield from pieces(packer.out, key_type)
        if key_type is not None:
            packer.finish()
            yield from pieces(packer.out, key_type)

    return docs.select(F.col(key), F.col(text).cast("binary").alias("raw")).mapInArrow(run, schema)


def digests(pieces: DataFrame, key: str = "doc_id") -> DataFrame:
    return pieces.select(
        key, "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
