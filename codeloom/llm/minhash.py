"""Near-duplicate documents by bottom-k sketches from one hash function (operator 3).

1. One scan makes the set of 5-word shingles of each text, as 64-bit hashes, and keeps its size, a 128-bit
   fingerprint and the k smallest hashes, the sketch. Documents with equal sets become one representative.
2. The retained values form inverted lists. Two sets over the threshold share nearly their part of the sketch, so
   they share one of the rarest |S| - |S|/2 + 1 values of each; the lists of frequent values, such as those of a
   passage in many documents, are not needed. Lists that meet in a document form a group.
3. The texts of a group meet in tasks of bounded size: a small group in one task, a large one in blocks by the size
   of the set, since sets over the threshold differ little in size. There the inverted lists give the overlaps,
   the sketch of the union estimates the similarity, and the full sets confirm it. A task returns a spanning
   forest of the links it found, never the pairs.
4. The components of the forests are those of all links.

An estimate may lose a link only if it lies six deviations below its mean, and step 2 one that shares less than half of
a sketch; sets that fit a sketch are compared whole. Both are binomial: see the README for their probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codeloom.llm.shared import components, saved
from codeloom.llm.substring import mixed, runs_hash, word_hashes

SHINGLE = 5
RETAINED = 64
PERCENT = 85
#: Shingles in one block of a group; a set counts as SET_SHINGLES more, so a block has about 1,000 sets at most and the
#: matrices of two blocks take about 250 MB.
BLOCK_SHINGLES = 400_000
SET_SHINGLES = 400
COLUMNS = 4096


def shingles(raw: bytes, width: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes; a text with fewer words has its whole sequence as one shingle."""
    words = raw.lower().split()  # bytes: A-Z only
    if not words:
        return np.empty(0, np.uint64)
    hashes = word_hashes(words)
    own = runs_hash(hashes, width) if len(words) >= width else runs_hash(hashes, len(words)) + np.uint64(len(words))
    return np.unique(mixed(own, np.full(len(own), 7, np.uint64)))


def fingerprint(values: np.ndarray) -> tuple[int, int]:
    one = values.sum(dtype=np.uint64)
    two = mixed(values, values).sum(dtype=np.uint64)
    return tuple(np.array([one, two], np.uint64).view(np.int64).tolist())


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the pairwise intersections, from the lists of the values that occur more than once."""
    n = len(sets)
    out = np.zeros((n, n), np.float32)
    values = np.concatenate(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    new = np.r_[True, values[1:] != values[:-1]]
    number = np.cumsum(new) - 1
    shared = np.bincount(number)[number] > 1
    column = np.cumsum(new[shared]) - 1 if shared.any() else np.empty(0, np.int64)
    owner = owner[shared]
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        i, j = np.searchsorted(column, [low, low + COLUMNS])
        part = np.zeros((n, COLUMNS), np.float32)
        part[owner[i:j], column[i:j] - low] = 1
        out += part @ part.T
    np.fill_diagonal(out, [len(s) for s in sets])
    return out


def likely(sets: list[np.ndarray], retained: int, share: float) -> np.ndarray:
    """Pairs whose estimated similarity is not six deviations below the threshold.

    Of the union of two sketches, the values up to the smaller of their largest values are a sample of the union of
    the sets; those in both are a sample of the intersection.
    """
    sketches = [s[:retained] for s in sets]
    both = overlaps(sketches)
    top = np.array([s[-1] if len(f) > retained else np.iinfo(np.uint64).max for s, f in zip(sketches, sets)], np.uint64)
    below = np.stack([np.searchsorted(s, top, "right").astype(np.float32) for s in sketches])
    union = below + below.T - both
    del below
    least = np.sqrt(share * (1 - share) * union)
    least *= -6
    least += share * union
    return (both > 0) & (both >= least)


def forest(links: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest of a symmetric matrix."""
    left = np.ones(len(links), bool)
    out = []
    for root in range(len(links)):
        if not left[root]:
            continue
        left[root] = False
        queue = [root]
        while queue:
            at = queue.pop()
            reached = np.flatnonzero(links[at] & left)
            left[reached] = False
            out += [(at, int(r)) for r in reached]
            queue += reached.tolist()
    return out


def links_of(sets: list[np.ndarray], sides: np.ndarray, retained: int, percent: int) -> list[tuple[int, int]]:
    """Forest of the links between the sides, or within if there is one side; sets are not empty."""
    pairs = likely(sets, retained, percent / 100)
    if sides.any() and not sides.all():
        pairs &= sides[:, None] != sides[None, :]
    np.fill_diagonal(pairs, False)
    used = np.flatnonzero(pairs.any(1))
    if not len(used):
        return []
    kept = [sets[i] for i in used]
    both = overlaps(kept).astype(np.float64)
    sizes = np.diag(both)
    links = pairs[np.ix_(used, used)] & (100 * both >= percent * (sizes[:, None] + sizes[None, :] - both))
    return [(int(used[a]), int(used[b])) for a, b in forest(links)]


def sketches_of(docs: DataFrame, key: str, text: str, retained: int) -> DataFrame:
    """doc, n, f1, f2, sketch of every row; null keys keep null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(raw) if raw else np.empty(0, np.uint64) for raw in batch.column(1).to_pylist()]
            marks = [fingerprint(s) for s in sets]
            kept = [s[:retained].view(np.int64) for s in sets]
            offsets = np.r_[0, np.cumsum([len(s) for s in kept])].astype(np.int32)
            flat = np.concatenate(kept) if kept else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([m[0] for m in marks], pa.int64()),
                    pa.array([m[1] for m in marks], pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                ],
                names=["doc", "n", "f1", "f2", "sketch"],
            )

    return docs.select(F.col(key).cast("long").alias("doc"), F.col(text).cast("binary").alias("raw")).mapInArrow(
        run, "doc long, n long, f1 long, f2 long, sketch array<long>"
    )


def groups_of(reps: DataFrame) -> DataFrame:
    """id and component_id of representatives whose short inverted lists meet."""
    lists = reps.select("rep", F.size("sketch").alias("k"), F.explode("sketch").alias("v"))
    often = lists.groupBy("v").agg(F.count(F.lit(1)).alias("often")).where("often > 1")
    # Rarest first; values that no other sketch holds come before all others. Half of a sketch must be shared.
    shared = lists.join(often, "v").groupBy("rep", "k").agg(F.sort_array(F.collect_list(F.struct("often", "v"))).alias("vs"))
    take = F.greatest(F.col("k") - F.ceil(F.col("k") / 2) + 1 - (F.col("k") - F.size("vs")), F.lit(0)).cast("int")
    short = saved(shared.select("rep", F.explode(F.slice("vs", F.lit(1), take)).alias("e")).select("rep", F.col("e.v").alias("v")), "lists")
    heads = short.groupBy("v").agg(F.min("rep").alias("head"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return components(short.join(heads, "v").select(F.col("rep").alias("a"), F.col("head").alias("b")))


def group_links(groups: DataFrame, reps: DataFrame, docs: DataFrame, key: str, text: str, retained: int, percent: int, block: int) -> DataFrame:
    """Edges (a, b) of spanning forests of the links within the groups."""
    step = float(np.log(100 / percent))
    members = groups.select(F.col("id").alias("rep"), F.col("component_id").alias("g")).join(reps.select("rep", "n", "f1", "f2"), "rep")
    # A group that fits a task is one block; else size classes, of which neighbours are compared, and blocks of each.
    whole = members.groupBy("g").agg(F.sum(F.col("n") + SET_SHINGLES).alias("total"))
    members = members.join(whole, "g").withColumn(
        "size", F.when(F.col("total") <= block, F.lit(-9)).otherwise(F.floor(F.log("n") / step)).cast("int")
    )
    blocks = members.groupBy("g", "size").agg(F.ceil(F.sum(F.col("n") + SET_SHINGLES) / block).cast("int").alias("blocks"))
    own = members.join(blocks, ["g", "size"]).withColumn("i", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    other = blocks.where("size >= 0")
    own = own.join(other.select("g", (F.col("size") - 1).alias("size"), F.col("blocks").alias("above")), ["g", "size"], "left")
    own = own.join(other.select("g", (F.col("size") + 1).alias("size"), F.col("blocks").alias("below")), ["g", "size"], "left")
    numbers = lambda n: F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.expr("cast(array() as array<int>)"))
    meet = F.flatten(
        F.array(
            F.transform(numbers(F.col("blocks")), lambda j: F.struct(
                F.col("size").alias("s"), F.least("i", j).alias("i"), F.greatest("i", j).alias("j"), F.lit(False).alias("up"), (F.col("i") > j).alias("side"))),
            F.transform(numbers(F.coalesce("above", F.lit(0))), lambda j: F.struct(
                F.col("size").alias("s"), F.col("i").alias("i"), j.alias("j"), F.lit(True).alias("up"), F.lit(False).alias("side"))),
            F.transform(numbers(F.coalesce("below", F.lit(0))), lambda j: F.struct(
                (F.col("size") - 1).alias("s"), j.alias("i"), F.col("i").alias("j"), F.lit(True).alias("up"), F.lit(True).alias("side"))),
        )
    )
    tasks = own.select("rep", "f1", "g", meet.alias("meet"))
    texts = docs.select(F.col(key).cast("long").alias("rep"), F.col(text).cast("binary").alias("raw"))
    rows = tasks.join(texts, "rep").select("rep", "f1", "raw", "g", F.explode("meet").alias("m")).select("g", "m.*", "rep", "f1", "raw")
    where = ["g", "s", "i", "j", "up"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, held = None, {}

        def done() -> pa.RecordBatch:
            ids = list(held)
            pairs = links_of([held[i][0] for i in ids], np.array([held[i][1] for i in ids]), retained, percent) if len(ids) > 1 else []
            return pa.RecordBatch.from_arrays(
                [pa.array([ids[x[e]] for x in pairs], pa.int64()) for e in (0, 1)], names=["a", "b"]
            )

        for batch in batches:
            for row in batch.to_pylist():
                this = tuple(row[c] for c in where)
                if this != task:
                    yield done()
                    task, held = this, {}
                values = shingles(row["raw"] or b"")
                if fingerprint(values)[0] == row["f1"]:  # not another row with the same key
                    held[row["rep"]] = (values, row["side"])
        yield done()

    return rows.repartition(*where).sortWithinPartitions(*where, "rep").mapInArrow(compare, "a long, b long")


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", retained: int = RETAINED, percent: int = PERCENT,
    block: int = BLOCK_SHINGLES,
) -> DataFrame:
    """Key, n_shingles, component_id (smallest key reachable by links) and kept (is it the document's own).

    Two documents are linked if 100 |A & B| >= percent |A | B| for their shingle sets. A text that is null or without
    words has an empty set and no links. Documents with a null key have no links and are kept, with a null component.
    Rows with equal keys must be told apart by their texts and get the component of either. Other columns are ignored.
    """
    made = saved(sketches_of(docs, key, text, retained), "sketches")
    full = made.where("n > 0 and doc is not null")
    reps = saved(
        full.groupBy("n", "f1", "f2").agg(F.min("doc").alias("rep"), F.first("sketch").alias("sketch")), "representatives"
    )
    groups = groups_of(reps)
    links = group_links(groups, reps, docs, key, text, retained, percent, block)
    classes = components(links)
    named = reps.select("n", "f1", "f2", "rep").join(classes, F.col("rep") == F.col("id"), "left").select(
        "n", "f1", "f2", F.coalesce("component_id", "rep").alias("component_id")
    )
    out = made.select("doc", "n", "f1", "f2").join(named, ["n", "f1", "f2"], "left")
    component = F.when(F.col("doc").isNull(), F.lit(None)).otherwise(F.coalesce("component_id", "doc")).cast("long")
    return out.select(F.col("doc").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("component_id") == F.col(key), F.lit(True))
    )


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """The rows of docs that represent their component of links of at least percent."""
    gone = near_duplicates(docs, key, text, percent=percent).where(~F.col("kept")).select(F.col(key).alias("_gone")).distinct()
    rows = docs.select(F.col(key).alias("_key"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    left = rows.join(gone, F.col("_key") == F.col("_gone"), "left_anti")
    return left.select(*[F.col("_row")[c].alias(c) for c in docs.columns])
