"""BPE encoding and decoding with a tokenization automaton (operator 6).

The merge list is compiled once, on the driver, into a deterministic automaton whose arcs carry tokens: a token
sequence is a path exactly if the merges, applied in order, produce that sequence. The compilation is the
successive merge-gadget construction. It starts with one state on which every base symbol loops; the gadget of
the i-th merge (u, v) -> w

* splits the state reached by u: its copy has no arc v, so u v is no longer a path;
* adds an arc w from every state with a path u v, to the state that v led to before the split.

By induction all arcs with one label lead to one state, so a state is named by the token that leads to it. The
full table would have |V|^2 entries, almost all copied by a gadget from an older state or an older arc. So an
arc is stored once, by the gadget that made or removed it: `left`, `right` and `made` say from which older arc
a gadget copied, `cut` which arc it removed and when. Arcs that were looked up are kept in a plain table.

A word is read by following arcs from the first state, the longest first. Exactly one path spells the word, and
at most one leads to each place in it, so a place without a way on is left for good. The labels on the path are
the encoding. Decoding emits the labels of the arcs.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The pattern and the special tokens are those of the vocabulary file.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORD_END = "</w>"

#: Entries of a worker's tables of seen words; a table is emptied when it is full.
CACHE_WORDS = 600_000
CACHE_ARCS = 2_000_000


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte value, by the usual byte-level rule."""
    printable = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAC + 1), *range(0xAE, 0xFF + 1)}
    symbols, spare = [], 256
    for byte in range(256):
        if byte in printable:
            symbols.append(chr(byte))
        else:
            symbols.append(chr(spare))
            spare += 1
    return symbols


def compile_automaton(path: str) -> dict:
    """Plain tables of the automaton for a vocabulary file of the tokenizers library.

    Plain lists and dicts, because a broadcast value must be readable without this package.
    """
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    vocab = spec["model"]["vocab"]
    labels = [""] * (1 + max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]))
    for token, number in vocab.items():
        labels[number] = token
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    for token, number in special.items():
        labels[number] = token
    left, right, made = [-1] * len(labels), [-1] * len(labels), [-1] * len(labels)
    cut: dict[int, int] = {}
    for step, (u, v) in enumerate(spec["model"]["merges"]):
        w = vocab[u + v]
        left[w], right[w], made[w] = vocab[u], vocab[v], step
        cut[vocab[u] * len(labels) + vocab[v]] = step
    tables = {"labels": labels, "left": left, "right": right, "made": made, "cut": cut, "arcs": {}}
    trie: dict = {}  # of the tokens inside a word: symbol -> [token or -1, what follows]
    whole = {}  # of those that end it
    for token, number in vocab.items():
        # A gadget without a path u v adds no arc.
        if made[number] >= 0 and not decided(tables, left[number], right[number], made[number] - 1):
            continue
        if token.endswith(WORD_END):
            whole[token.removesuffix(WORD_END)] = number
        else:
            node = trie
            for symbol in token:
                entry = node.setdefault(symbol, [-1, {}])
                node = entry[1]
            entry[0] = number
    return tables | {
        "special": special, "longest": max(map(len, vocab)), "trie": trie, "whole": whole, "words": {}, "chunks": {},
    }


def decided(t: dict, x: int, y: int, at: int) -> bool:
    """Did the state reached by x have an arc y after step `at`? Goes back to the gadget that decided it."""
    cut, made, left, right, size = t["cut"], t["made"], t["left"], t["right"], len(t["labels"])
    while True:
        gone = cut.get(x * size + y)
        if gone is not None and gone <= at:
            return False
        if made[y] < 0 and made[x] < 0:
            return True
        if made[y] >= made[x]:  # y came later: its arcs were copied from those of its left part, after the cut
            at, y = made[y], left[y]
        else:  # x came later: its state is that of its right part before the cut
            at, x = made[x] - 1, right[x]


class Automaton:
    """Reads words over the tables of `compile_automaton`; what it learns stays in the tables of the worker."""

    def __init__(self, tables: dict):
        self.t = tables
        self.symbols = byte_symbols()
        self.find = regex.compile(WORD_PATTERN).findall
        self.specials = regex.compile("|".join(regex.escape(s) for s in sorted(tables["special"], key=len)[::-1]) or r"(?!)")

    def arc(self, x: int, y: int) -> bool:
        """Does the state reached by token x have an arc y?"""
        arcs, key = self.t["arcs"], x * len(self.t["labels"]) + y
        found = arcs.get(key)
        if found is None:
            if len(arcs) >= CACHE_ARCS:
                arcs.clear()
            found = arcs[key] = decided(self.t, x, y, len(self.t["cut"]))
        return found

    def path(self, word: str) -> list[int]:
        """The tokens of one pre-split word."""
        plain = word.isascii() and word.isprintable()  # these characters stand for themselves
        symbols = word if plain else "".join([self.symbols[b] for b in word.encode()])
        t = self.t
        whole, arcs, size, longest = t["whole"], t["arcs"], len(t["labels"]), t["longest"]
        token = whole.get(symbols)
        if token is not None or not symbols:  # one arc is a path, and there is only one path
            return [token] if symbols else []
        n, tokens, last = len(symbols), [], -1
        at, above, dead = 0, [], set()
        while True:
            # The arcs from here, by length.
            found, node, end = [], t["trie"], at
            for symbol in symbols[at : n - 1]:
                entry = node.get(symbol)
                if entry is None:
                    break
                end += 1
                if entry[0] >= 0:
                    found.append((end, entry[0]))
                node = entry[1]
            if n - at <= longest:
                token = whole.get(symbols[at:])
                if token is not None:
                    found.append((n, token))
            while True:
                if found:
                    end, token = found.pop()
                    if end in dead:
                        continue
                    if last >= 0:
                        known = arcs.get(last * size + token)
                        if not (self.arc(last, token) if known is None else known):
                            continue
                    tokens.append(token)
                    if end == n:
                        return tokens
                    above.append((at, found))
                    at, last = end, token
                    break
                dead.add(at)  # one path only leads here, so no other is lost
                tokens.pop()
                at, found = above.pop()
                last = tokens[-1] if tokens else -1

    def words(self, text: str) -> list[str]:
        """Normalise and pre-split a text without special tokens."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # sigma has no final form here
        text = text.lower()
        return [text] if text.isascii() and text.isalpha() else self.find(text)

    def parts(self, text: str) -> list[tuple[list[int], str, str]]:
        """Ids of each word and special token of a text, also as joined numbers and labels."""
        out, seen, at = [], self.t["words"], 0
        spans = [m.span() for m in self.specials.finditer(text)] if "<|" in text else []
        for begin, end in [*spans, (len(text), len(text))]:
            for word in self.words(text[at:begin]):
                found = seen.get(word)
                if found is None:
                    if len(seen) >= CACHE_WORDS:
                        seen.clear()
                    found = seen[word] = self.shown(self.path(word))
                out.append(found)
            if end > begin:
                out.append(self.shown([self.t["special"][text[begin:end]]]))
            at = end
        return out

    def shown(self, ids: list[int]) -> tuple[list[int], str, str]:
        return ids, " ".join(map(str, ids)), self.decode(ids)

    def encode(self, text: str) -> list[int]:
        return [i for ids, _, _ in self.parts(text) for i in ids]

    def chunks(self) -> dict:
        """A table from chunks between ASCII white space (UTF-8) to their joined ids and labels.

        No token spans white space. Chunks without a token are empty strings.
        """
        automaton = self

        class Chunks(dict):
            def __missing__(self, chunk: bytes) -> tuple[str, str]:
                if len(self) >= CACHE_WORDS:
                    self.clear()
                parts = automaton.parts(chunk.decode())
                if len(parts) == 1:
                    value = parts[0][1:]
                else:
                    value = " ".join([p[1] for p in parts]), " ".join([p[2] for p in parts])
                self[chunk] = value
                return value

        return self.t["chunks"].setdefault("table", Chunks())

    def decode(self, ids: list[int]) -> str:
        """The labels of the arcs, joined by spaces: the vocabulary file has no decoder of its own."""
        labels = self.t["labels"]
        return " ".join([labels[i] for i in ids])


def broadcast_automaton(df: DataFrame, path: str):
    """The tables for all tasks; a vocabulary has a fixed size, about 50,000 entries here."""
    return df.sparkSession.sparkContext.broadcast(compile_automaton(path))


def encode_documents(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, `ids` (space-joined decimal token ids), `n_tokens` and `decoded` of every row.

    One scan without shuffle. A null text is an empty one and gives no tokens; rows with equal keys are encoded one by
    one; other columns are left out, whatever their names.
    """
    tables = broadcast_automaton(docs, path)
    schema = f"`{key}` {docs.schema[key].dataType.simpleString()}, n_tokens long, ids string, decoded string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = Automaton(tables.value).chunks()
        for batch in batches:
            counts, ids, decoded, size = [], [], [], 0
            for raw in batch.column(1):
                raw = raw.as_py()
                parts = [p for p in map(chunks.__getitem__, raw.split()) if p[0]] if raw else []
                ids.append(" ".join([p[0] for p in parts]))
                counts.append(ids[-1].count(" ") + 1 if parts else 0)
                decoded.append(" ".join([p[1] for p in parts]))
                size += len(ids[-1])
                if size > 1 << 22:
                    yield make(batch, len(counts), ids, counts, decoded)
                    batch, counts, ids, decoded, size = batch.slice(len(counts)), [], [], [], 0
            if counts:
                yield make(batch, len(counts), ids, counts, decoded)

    def make(batch, n, ids, counts, decoded):
        return pa.RecordBatch.from_arrays(
            [batch.column(0).slice(0, n), pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())],
            names=[key, "n_tokens", "ids", "decoded"],
        )

    return docs.select(F.col(key), F.col(text).cast("binary").alias("raw")).mapInArrow(run, schema)


def digests(encoded: DataFrame, key: str = "doc_id") -> DataFrame:
    return encoded.select(
        key, "n_tokens", F.sha2(F.col("ids").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def decode_rows(encoded: DataFrame, path: str, key: str = "doc_id") -> DataFrame:
    """Key and `text` from a column of space-joined `ids`."""
    tables = broadcast_automaton(encoded, path)
    schema = f"`{key}` {encoded.schema[key].dataType.simpleString()}, text string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(tables.value)
        for batch in batches:
            texts = [automaton.decode([int(i) for i in (ids or "").split()]) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=[key, "text"])

    return encoded.select(key, "ids").mapInArrow(run, schema)


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
