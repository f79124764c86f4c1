"""Documents that hold test passages, found by greedy string tiling.

Tiles are non-overlapping runs of words that a document and a test item share, longest first, each
of ``LEAST`` words or more. The part of the item that tiles cover does not depend on the order in
which its pieces stand in the document, so passages with moved sentences are found as well.

Documents are cut down to the runs around words that a fixed-size bit table of the test items' seeds
(runs of ``LEAST`` words) lets through; seeds are then joined exactly, so only pairs of a document
and an item that share a seed are tiled. A larger test set fills the bit table and makes the join
larger, with the same result.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opsgauge.llm.words import shingle_hashes, text_blocks
from opsgauge.llm.workspace import Workspace

LEAST = 5
COVERAGE = 0.5
FIRST_LENGTH = 20
TABLE_BITS = 24
BREAK = 0
MODULUS, BASE = (1 << 61) - 1, 1_000_003


# ---------------------------------------------------------------- tiling of one pair


def running_hashes(words: Sequence[int], used: list[bool], length: int) -> Iterator[tuple[int, int]]:
    """(start, Karp-Rabin hash) of each run of that many unused words."""
    lead = pow(BASE, length - 1, MODULUS)
    value, size = 0, 0
    for end, word in enumerate(words):
        if used[end]:
            value, size = 0, 0
            continue
        if size == length:
            value = (value - words[end - length] * lead) % MODULUS
            size -= 1
        value = (value * BASE + word) % MODULUS
        size += 1
        if size == length:
            yield end - length + 1, value


def longest_matches(item, text, item_used, text_used, length):
    """Maximal matches of at least that length as (length, item start, text start); or, as soon as
    one is longer than twice the length, just its length, to search for such ones first."""
    at = defaultdict(list)
    for start, value in running_hashes(text, text_used, length):
        at[value].append(start)
    found = []
    for i, value in running_hashes(item, item_used, length):
        for j in at.get(value, ()):
            # matches that begin earlier have been seen from there
            if i and j and item[i - 1] == text[j - 1] and not item_used[i - 1] and not text_used[j - 1]:
                continue
            size = 0
            while (
                i + size < len(item) and j + size < len(text)
                and item[i + size] == text[j + size] and not item_used[i + size] and not text_used[j + size]
            ):
                size += 1
            if size > 2 * length:
                return found, size
            if size >= length:
                found.append((size, i, j))
    return found, 0


def tiles(item: Sequence[int], text: Sequence[int], least: int = LEAST) -> list[tuple[int, int, int]]:
    """Tiles (length, item start, text start), longest first, ties by their place in the item and then
    in the text. ``BREAK`` in the text matches nothing."""
    item_used, text_used = [False] * len(item), [w == BREAK for w in text]
    out, length = [], max(least, FIRST_LENGTH)
    while True:
        found, longer = longest_matches(item, text, item_used, text_used, length)
        if longer:
            length = longer
            continue
        waiting = [(-size, i, j) for size, i, j in found]
        heapq.heapify(waiting)
        while waiting:
            size, i, j = heapq.heappop(waiting)
            size = -size
            cut = [k for k in range(size) if item_used[i + k] or text_used[j + k]]
            if not cut:
                out.append((size, i, j))
                item_used[i : i + size] = text_used[j : j + size] = [True] * size
            else:
                # what is left of a match that a tile cuts into may still be long enough
                for begin, end in zip([0, *(k + 1 for k in cut)], [*cut, size]):
                    if end - begin >= length:
                        heapq.heappush(waiting, (begin - end, i + begin, j + begin))
        if length > 2 * least:
            length //= 2
        elif length > least:
            length = least
        else:
            return out


def coverage(item: Sequence[int], text: Sequence[int], least: int = LEAST) -> float:
    """The part of the item's words that tiles cover."""
    return sum(t[0] for t in tiles(item, text, least)) / len(item) if len(item) else 0.0


# ---------------------------------------------------------------- tables


def plain(text: str) -> Column:
    """Lower case, and only letters, digits and white space, so that case and marks hide nothing."""
    return F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}\s]+", "").alias("text")


def item_words(benchmark: DataFrame, least: int) -> DataFrame:
    """(item_id, words, seeds) of the items of ``least`` words or more."""

    def words(batches):
        for batch in batches:
            ids = batch.column("item_id").to_pylist()
            rows = []
            for row, hashes, bounds in text_blocks(batch.column("text")):
                for k in range(len(bounds) - 1):
                    own = hashes[bounds[k] : bounds[k + 1]]
                    if len(own) >= least and ids[row + k] is not None:
                        seeds = np.unique(shingle_hashes(own, least))
                        rows.append({"item_id": ids[row + k], "words": own.view(np.int64), "seeds": seeds.view(np.int64)})
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema)

    numbers = pa.list_(pa.int64())
    schema = pa.schema([("item_id", pa.int64()), ("words", numbers), ("seeds", numbers)])
    return benchmark.select("item_id", plain("text")).mapInArrow(words, "item_id long, words array<long>, seeds array<long>")


def bit_table(seeds: DataFrame) -> np.ndarray:
    """2**TABLE_BITS bits, those of the seeds set; its size is fixed."""
    word = F.shiftrightunsigned("seed", 64 - TABLE_BITS + 6)
    bit = F.expr(f"shiftleft(1L, cast(shiftrightunsigned(seed, {64 - TABLE_BITS}) & 63 as int))")
    rows = seeds.groupBy(word.alias("w")).agg(F.bit_or(bit).alias("bits")).toPandas()
    table = np.zeros(1 << (TABLE_BITS - 6), np.uint64)
    table[rows["w"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64).view(np.uint64)
    return table


def passes(table: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    place = seeds >> np.uint64(64 - TABLE_BITS)
    return (table[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1


def document_runs(docs: DataFrame, table: np.ndarray, least: int) -> DataFrame:
    """(id, words, seeds) of the documents with a seed that the table lets through: the words of all
    runs that such seeds make, with a break between runs, and the seeds."""

    def runs(batches):
        for batch in batches:
            ids = batch.column("id").to_pylist()
            rows = []
            for row, hashes, bounds in text_blocks(batch.column("text")):
                if len(hashes) < least:
                    continue
                seeds = shingle_hashes(hashes, least)
                at = np.flatnonzero(passes(table, seeds))
                # a run may not reach into the next text
                text = np.searchsorted(bounds, at, "right") - 1
                inside = at + least <= bounds[text + 1]
                at, text = at[inside], text[inside]
                for k in np.unique(text).tolist():
                    mine = at[text == k]
                    parts = np.split(mine, np.flatnonzero(np.diff(mine) > least) + 1)
                    words = []
                    for part in parts:
                        words += [*hashes[part[0] : part[-1] + least].view(np.int64).tolist(), BREAK]
                    rows.append({"id": ids[row + k], "words": words, "seeds": np.unique(seeds[mine]).view(np.int64)})
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema)

    numbers = pa.list_(pa.int64())
    schema = pa.schema([("id", pa.int64()), ("words", numbers), ("seeds", numbers)])
    return docs.select("id", "text").mapInArrow(runs, "id long, words array<long>, seeds array<long>")


def tiled(pairs: DataFrame, least: int) -> DataFrame:
    """(id, item_id, coverage, tiles) of pairs (id, item_id, words, item)."""

    def tile(batches):
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                found = tiles(row["item"], row["words"], least)
                covered = sum(t[0] for t in found) / len(row["item"])
                rows.append({"id": row["id"], "item_id": row["item_id"], "coverage": covered, "tiles": len(found)})
            yield pa.RecordBatch.from_pylist(rows, schema)

    schema = pa.schema([("id", pa.int64()), ("item_id", pa.int64()), ("coverage", pa.float64()), ("tiles", pa.int64())])
    return pairs.mapInArrow(tile, "id long, item_id long, coverage double, tiles long")


def contaminations(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, least: int = LEAST) -> DataFrame:
    """(id, item_id, coverage, tiles) of all documents (doc_id, text) and test items (item_id, text)
    that share a run of ``least`` words.

    Words are what blanks divide, in lower case, with letters and digits only. Items with fewer words than
    ``least`` or without an id are not tested for; null texts have no words. Rows that repeat an id
    are one document or item, with the largest coverage of its texts; so are rows without doc_id.
    """
    work = Workspace(spark, "tiling")
    items = work.table(item_words(benchmark, least), "items")
    seeds = work.table(items.select("item_id", F.explode("seeds").alias("seed")), "seeds")
    runs = document_runs(docs.select(F.col("doc_id").alias("id"), plain("text")), bit_table(seeds), least)
    # a key of its own for each row: ids may be null or repeated
    runs = work.table(runs.withColumn("row", F.xxhash64("id", "words")), "runs")
    pairs = runs.select("row", F.explode("seeds").alias("seed")).join(seeds, "seed").select("row", "item_id").distinct()
    pairs = work.table(pairs, "pairs")
    once = runs.dropDuplicates(["row"]).select("row", "id", "words")
    texts = pairs.join(work.table(once, "once"), "row")
    both = texts.join(items.select("item_id", F.col("words").alias("item")), "item_id")
    found = work.table(tiled(both.select("id", "item_id", "words", "item"), least), "tiled")
    best = F.max(F.struct("coverage", "tiles"))
    return found.groupBy("id", "item_id").agg(best.alias("m")).select("id", "item_id", "m.coverage", "m.tiles")


def judged(
    spark: SparkSession, docs: DataFrame, benchmark: DataFrame, threshold: float = COVERAGE, least: int = LEAST
) -> DataFrame:
    """(doc_id, item_id, coverage, contaminated), one row for each row of ``docs``: the item most of
    which the document covers (of equal ones the smallest item_id; null and 0 where it shares no run
    of words with any), and whether that reaches the threshold."""
    found = contaminations(spark, docs, benchmark, least)
    top = found.groupBy("id").agg(F.max(F.struct("coverage", (-F.col("item_id")).alias("i"))).alias("m"))
    top = top.select("id", (-F.col("m.i")).alias("item_id"), "m.coverage")
    rows = docs.select("doc_id")
    joined = rows.join(Workspace(spark, "tiling").table(top, "top"), F.col("doc_id").eqNullSafe(F.col("id")), "left")
    share = F.coalesce("coverage", F.lit(0.0))
    return joined.select("doc_id", "item_id", share.alias("coverage"), (share >= threshold).alias("contaminated"))


def contaminated_ids(
    spark: SparkSession, docs: DataFrame, benchmark: DataFrame, threshold: float = COVERAGE, least: int = LEAST
) -> DataFrame:
    """(id) of the documents that cover ``threshold`` or more of some test item."""
    found = contaminations(spark, docs, benchmark, least).where(F.col("coverage") >= threshold)
    return Workspace(spark, "tiling").table(found.select("id").distinct(), "contaminated")
