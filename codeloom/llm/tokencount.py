"""Token counts of a unigram model by dynamic programming over a trie (operator 5).

The model: the pieces of a byte-level vocabulary, each with the probability that Zipf's law gives its rank. A
pre-token is split into the pieces with the largest product of probabilities; of equally good splits the one with the
fewest pieces counts. The best split of a prefix does not depend on what follows, so the pre-tokens go into a trie
whose nodes hold the forward score and count of their prefix: a prefix that many pre-tokens share is scored once.
The count of a pre-token is stored at its end, and a worker keeps its trie from task to task. No shuffle is needed.
"""

from __future__ import annotations

import base64
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Zipf-Mandelbrot: the probability of rank r is proportional to 1 / (r + SHIFT).
SHIFT = 2.7
#: Scores are whole millionths, so that sums are exact and ties are ties.
UNIT = 1_000_000
MOST_NODES = 2_000_000
MOST_WORDS = 1_000_000


def piece_scores(path: str) -> dict[bytes, int]:
    """Log-probabilities of the pieces of a rank file, in millionths."""
    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    total = math.log(sum(1 / (r + SHIFT) for r in ranks.values()))
    return {piece: -round(UNIT * (math.log(r + SHIFT) + total)) for piece, r in ranks.items()}


def model(path: str, pattern: str) -> dict:
    """Plain tables for a broadcast: the pieces as a trie of their reversed bytes, and the pattern of pre-tokens."""
    ends: dict = {}
    for piece, score in piece_scores(path).items():
        node = ends
        for byte in reversed(piece):
            node = node.setdefault(byte, {})
        node[-1] = score
    return {"ends": ends, "pattern": pattern}


class Trie:
    def __init__(self, ends: dict):
        self.ends = ends
        self.clear()

    def clear(self) -> None:
        self.children: list[dict] = [{}]
        self.score, self.count = [0], [0]

    def insert(self, word: bytes) -> int:
        """Pieces of the best split; scores the nodes that are new."""
        if len(self.score) > MOST_NODES:
            self.clear()
        children, score, count, ends = self.children, self.score, self.count, self.ends
        node, path = 0, [0]
        for at, byte in enumerate(word):
            below = children[node].get(byte)
            if below is None:
                best, pieces, piece, begin = None, 0, ends, at
                while begin >= 0:
                    piece = piece.get(word[begin])
                    if piece is None:
                        break
                    own = piece.get(-1)
                    if own is not None:
                        before = path[begin]
                        total = score[before] + own
                        if best is None or total > best or total == best and count[before] < pieces:
                            best, pieces = total, count[before]
                    begin -= 1
                below = children[node][byte] = len(score)
                children.append({})
                score.append(best)
                count.append(pieces + 1)
            node = below
            path.append(node)
        return count[node]


class Counter:
    """Counts of texts; `state` keeps the trie and the counts at its ends for the worker's next task."""

    def __init__(self, state: dict):
        import regex

        self.find = regex.compile(state["pattern"]).findall
        if "trie" not in state:
            trie = state["trie"] = Trie(state["ends"])

            class Ends(dict):
                def __missing__(self, word: str) -> int:
                    if len(self) >= MOST_WORDS:
                        self.clear()
                    value = self[word] = trie.insert(word.encode())
                    return value

            state["counts"] = Ends()
        self.counts = state["counts"]

    def of(self, text: str) -> tuple[int, int]:
        words = self.find(text)
        return len(words), sum(map(self.counts.__getitem__, words))


def count_tokens(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, n_pretokens and n_tokens of every row.

    A null or empty text has none. Rows with equal or null keys are counted one by one; other columns are ignored.
    """
    tables = docs.sparkSession.sparkContext.broadcast(model(path, pattern))
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(tables.value)
        for batch in batches:
            found = [counter.of(text or "") for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64())],
                names=[key, "n_pretokens", "n_tokens"],
            )

    return docs.select(F.col(key), F.col(text)).mapInArrow(run, f"`{key}` {kind}, n_pretokens long, n_tokens long")
