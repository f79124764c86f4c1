"""Ranked lexical search through hashed max-sketches.

The index has one row a document: its number of terms and a sketch. A term belongs to one of 65,536
coordinates; a coordinate holds the largest number of occurrences of the document's terms in it, and
only coordinates that hold something are stored, three bytes each. A term's impact grows with its
occurrences, so a coordinate bounds the impact of every term in it, and the sum over an item's terms
of weight times bound is never below the document's score.

A search takes the items in blocks. A task looks all terms of a block up in the sketches of a batch
of documents at once, which gives a bound for each document and item. Going down the bounds, it
computes exact scores from the texts until the bound falls below the item's k-th best score so far.
Each task returns at most k documents an item; Spark ranks these.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from opsgauge.llm.words import hash_words, text_blocks
from opsgauge.llm.workspace import Workspace, filesystem

TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
BETWEEN = np.ones(256, dtype=bool)
BETWEEN[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False

COORDINATES = 1 << 16
#: A coordinate with this many occurrences or more is read as endless ones.
MANY = 255
SCALE = 1_000_000_000
CELL = np.dtype([("at", "<u2"), ("tf", "u1")])
#: Items searched in one pass over the index; entries of a table of bounds; distinct terms held before they are handed on.
BLOCK_ITEMS = 256
TABLE_ENTRIES = 1 << 19
HELD_TERMS = 1 << 20

INDEX = "doc_id long, n long, sketch binary, text string, terms array<long>, counts array<long>"
POSTING = "block int, item_id long, mark string, term binary, hash long"
FOUND = "item_id long, mark string, doc_id long, score long"


def tokens(text: str) -> list[bytes]:
    """All terms in order. A-Z are lower-cased; no other letter is."""
    return TERM.findall(text.encode().lower())


def hashes_of(terms: list[bytes]) -> np.ndarray:
    return hash_words(np.frombuffer(b" ".join(terms), np.uint8), BETWEEN)[2]


def sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Index rows, and rows with numbers of documents by term, without a text."""
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("sketch", pa.binary()), ("text", pa.string()),
                        ("terms", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64()))])
    held: list[np.ndarray] = []
    size = 0

    def documents_by_term() -> pa.RecordBatch:
        terms, counts = np.unique(np.concatenate(held), return_counts=True)
        lists = [pa.array([x.view(np.int64)], pa.list_(pa.int64())) for x in (terms, counts)]
        return pa.record_batch([pa.nulls(1, f.type) for f in schema][:4] + lists, schema=schema)

    for batch in batches:
        texts = batch.column("text").fill_null("")
        n = np.zeros(batch.num_rows, np.int64)
        cells: list[bytes] = []
        for row, hashes, bounds in text_blocks(texts, BETWEEN):
            n[row : row + len(bounds) - 1] = np.diff(bounds)
            doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
            order = np.lexsort((hashes, doc))
            h, d = hashes[order], doc[order]
            first = np.flatnonzero(np.concatenate(([True], (h[1:] != h[:-1]) | (d[1:] != d[:-1])))) if len(h) else np.zeros(0, np.int64)
            tf = np.minimum(np.diff(np.append(first, len(h))), MANY).astype(np.uint8)
            h, d = h[first], d[first]
            held.append(h)
            size += len(h)
            at = (h >> np.uint64(48)).astype(np.uint16)  # hashes are in order, so coordinates are too
            new = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1]) | (d[1:] != d[:-1])))) if len(h) else first
            cell = np.empty(len(new), CELL)
            cell["at"] = at[new]
            cell["tf"] = np.maximum.reduceat(tf, new) if len(new) else 0
            ends = np.searchsorted(d[new], np.arange(len(bounds)))
            cells += [cell[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)]
        nothing = [pa.nulls(batch.num_rows, f.type) for f in schema][4:]
        yield pa.record_batch([batch.column("doc_id"), pa.array(n), pa.array(cells, pa.binary()), texts.cast(pa.string()), *nothing], schema=schema)
        if size >= HELD_TERMS:
            yield documents_by_term()
            held, size = [], 0
    if size:
        yield documents_by_term()


def build_index(docs: DataFrame, work: Workspace) -> DataFrame:
    """The index of all rows of ``docs`` (doc_id, text; further columns are not used), as a table."""
    return work.table(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(sketches, INDEX), "index")


def postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each distinct term of each item."""
    for batch in batches:
        out = defaultdict(list)
        for block, item_id, mark, text in zip(*(batch.column(c).to_pylist() for c in ("block", "item_id", "mark", "text")), strict=True):
            if terms := sorted(set(tokens(text))):
                for name, values in (("block", [block] * len(terms)), ("item_id", [item_id] * len(terms)), ("mark", [mark] * len(terms)), ("term", terms), ("hash", hashes_of(terms).view(np.int64).tolist())):
                    out[name] += values
        if out:
            yield pa.record_batch(dict(out), schema=pa.schema([("block", pa.int32()), ("item_id", pa.int64()), ("mark", pa.string()), ("term", pa.binary()), ("hash", pa.int64())]))


def weight(n: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


class Items:
    """A block of items, as a task reads it."""

    def __init__(self, path: str, block: int, n: int):
        fs, root = filesystem(path)
        rows = pq.read_table(f"{root}/block={block}", filesystem=fs, partitioning=None).to_pydict()
        keys = list(zip(rows["item_id"], rows["mark"], strict=True))
        self.keys = sorted(set(keys), key=repr)
        number = {k: i for i, k in enumerate(self.keys)}
        self.weights: list[dict[bytes, int]] = [{} for _ in self.keys]
        at, item, w = [], [], []
        for key, term, hashed, df in zip(keys, rows["term"], rows["hash"], rows["df"], strict=True):
            if df:
                self.weights[number[key]][term] = weight(n, df)
                at.append((hashed & (1 << 64) - 1) >> 48)
                item.append(number[key])
                w.append(weight(n, df))
        self.terms = set().union(*self.weights)
        order = np.argsort(at, kind="stable")
        self.item, self.weight = np.array(item, np.int64)[order], np.array(w, np.float64)[order]
        self.start = np.searchsorted(np.array(at, np.int64)[order], np.arange(COORDINATES + 1))


@lru_cache(maxsize=1)
def items_of(path: str, block: int, n: int) -> Items:
    return Items(path, block, n)


def bounds(items: Items, cells: np.ndarray, starts: np.ndarray, m: np.ndarray) -> np.ndarray:
    """A table of documents by items: no score is above its entry. Entries are whole numbers below
    2**53, so doubles hold them exactly."""
    doc = np.repeat(np.arange(len(m)), np.diff(starts))
    many = items.start[cells["at"].astype(np.int64) + 1] - items.start[cells["at"]]
    hit = np.flatnonzero(many)
    many, doc = many[hit], doc[hit]
    tf = cells["tf"][hit].astype(np.int64)
    impact = np.where(tf == MANY, SCALE // 1000, SCALE * tf // (1000 * tf + 20 * m[doc]))
    place = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(items.start[cells["at"][hit]], many)
    entry = np.repeat(doc, many) * len(items.keys) + items.item[place]
    size = len(m) * len(items.keys)
    return np.bincount(entry, np.repeat(impact, many) * items.weight[place], size).reshape(len(m), -1)


def searching(path: str, block: int, n: int, total: int, k: int):
    """The search of one block over the rows of the index. n: documents with terms; total: their terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = items_of(path, block, n)
        best: list[list[tuple]] = [[] for _ in items.keys]  # heaps of (score, -doc_id), a missing id after all others

        def worst(i: int) -> tuple:
            return best[i][0] if len(best[i]) == k else (1, -math.inf)

        for batch in batches:
            if not items.keys:
                continue
            size, ids, texts = batch.column("n").to_numpy(), batch.column("doc_id"), batch.column("text")
            m = 50 + 50 * size * n // total
            names = np.array([math.inf if x is None else x for x in ids.to_pylist()], object)
            sketch = batch.column("sketch").cast(pa.large_binary())
            ends = np.frombuffer(sketch.buffers()[1], np.int64)[sketch.offset : sketch.offset + len(sketch) + 1] // CELL.itemsize
            data = sketch.buffers()[2]
            cells = np.frombuffer(data, CELL, count=ends[-1]) if data is not None else np.zeros(0, CELL)
            rows = max(1, TABLE_ENTRIES // len(items.keys))
            for a in range(0, len(m), rows):
                b = min(a + rows, len(m))
                table = bounds(items, cells[ends[a] : ends[b]], ends[a : b + 1] - ends[a], m[a:b])
                counts: dict[int, Counter] = {}
                for i in range(len(items.keys)):
                    bound = table[:, i]
                    near = np.flatnonzero(bound >= worst(i)[0])
                    for d in near[np.argsort(-bound[near], kind="stable")]:
                        if bound[d] < worst(i)[0]:
                            break
                        name = -names[a + d]
                        if (bound[d], name) <= worst(i):
                            continue
                        if d not in counts:
                            counts[d] = Counter(w for w in tokens(texts[a + d].as_py()) if w in items.terms)
                        own, length = items.weights[i], int(m[a + d])
                        score = sum(own[w] * (SCALE * tf // (1000 * tf + 20 * length)) for w, tf in counts[d].items() if w in own)
                        if score > 0 and (len(best[i]) < k or (score, name) > best[i][0]):
                            (heapq.heappush if len(best[i]) < k else heapq.heapreplace)(best[i], (score, name))
        found = [(*key, None if name == -math.inf else -name, score) for key, heap in zip(items.keys, best, strict=True) for score, name in heap]
        columns = zip(*found, strict=True) if found else [()] * 4
        schema = pa.schema([("item_id", pa.int64()), ("mark", pa.string()), ("doc_id", pa.int64()), ("score", pa.int64())])
        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return run


def search(spark: SparkSession, docs: DataFrame, items: DataFrame, k: int = 50) -> DataFrame:
    """The ``k`` documents with the highest scores above 0 for each item: (item_id, mark, rank, doc_id,
    score). ``docs`` has doc_id and text, ``items`` item_id and text; further columns are not used.

    Terms are runs of 0-9, A-Z (lower-cased), a-z and all characters from U+0080 on. With N documents
    that have terms and L terms in all, n in the document, df documents with the term and tf
    occurrences in this one: w = floor(1000 ln((2N+2) / (2df+1))), m = 50 + (50 n N) div L, and the
    score sums w * (10**9 tf div (1000 tf + 20 m)) over the item's distinct terms. Equal scores are
    ranked by doc_id. Null and empty texts have no terms. Every row of ``docs`` is a document of its
    own; missing doc_ids come after all others. Equal rows of ``items`` are one item; rows with one
    item_id and different texts are items of their own, told apart by ``mark``, a digest of the text.
    A term is known by a 64-bit hash where documents are counted and bounds are made, by itself in the
    scores. Items without terms and empty tables give no rows.
    """
    work = Workspace(spark, "lexical")
    index = build_index(docs, work)
    n, total = index.where("n > 0").agg(F.count(F.lit(1)), F.sum("n")).first()
    asked = items.select(F.col("item_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")).distinct()
    asked = asked.withColumn("mark", F.md5("text"))
    asked = work.table(asked, "items")
    blocks = -(-asked.count() // BLOCK_ITEMS)
    if not n or not blocks:
        return spark.createDataFrame([], "item_id long, mark string, rank int, doc_id long, score long")
    asked = asked.withColumn("block", F.pmod(F.xxhash64("mark", "item_id"), F.lit(blocks)).cast("int"))
    terms = work.table(asked.mapInArrow(postings, POSTING), "terms")
    pairs = index.where("terms IS NOT NULL").select(F.explode(F.arrays_zip("terms", "counts")).alias("p"))
    pairs = pairs.select(F.col("p.terms").alias("hash"), F.col("p.counts").alias("df"))
    pairs = pairs.join(terms.select("hash").distinct(), "hash", "left_semi").groupBy("hash").agg(F.sum("df").alias("df"))
    weighed = terms.join(pairs, "hash", "left").withColumn("df", F.coalesce("df", F.lit(0)))
    weighed.repartition("block").write.partitionBy("block").parquet(f"{work.path}/weighed")
    rows = index.where("sketch IS NOT NULL").select("doc_id", "n", "sketch", "text")
    there = [r.block for r in terms.select("block").distinct().collect()]  # numbers of blocks
    found = None
    for block in sorted(there):
        part = rows.mapInArrow(searching(f"{work.path}/weighed", block, n, total, k), FOUND)
        part = work.table(part, f"found-{block}")
        found = part if found is None else found.union(part)
    if found is None:
        return spark.createDataFrame([], "item_id long, mark string, rank int, doc_id long, score long")
    best = W.partitionBy("item_id", "mark").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("item_id", "mark", "rank", "doc_id", "score")
