"""Near-duplicate vectors by hierarchical navigable small-world graphs, one for each shard.

A graph is built by inserting batches of vectors: each batch searches the graph of the earlier ones,
takes neighbours that are not nearer to each other than to it, and is linked back from them. Searches
run for many queries at once, with NumPy. Every query visits every shard. The beam of a shard is
widened until audit queries (members moved away to just over the threshold, held against brute force)
find their links; a query whose beam holds only links is widened on its own until it holds others too.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsgauge.llm.arrays import cached_array, map_array, save_array
from opsgauge.llm.components import connected_components
from opsgauge.llm.words import mix
from opsgauge.llm.workspace import Workspace

THRESHOLD = 0.95
DEGREE = 16
BUILD_BEAM = 48
FIRST_BEAM = 16
AT_ONCE = 4
BATCH = 256
AUDITS, AUDIT_RECALL = 128, 0.99
#: A shard that finds less of its links, however wide its beam, is an error. Tasks of the search, at most.
LEAST_RECALL = 0.9
MOST_TASKS = 1 << 16
SHARDS, PER_SHARD, PER_BLOCK = 8, 50_000, 1024
SLACK = 1e-5


class Graph:
    """Layers of neighbour lists over unit vectors. Layer 0 has all nodes."""

    def __init__(self, vectors: np.ndarray, levels: np.ndarray):
        self.vectors, self.levels = vectors, levels
        self.layers: list[np.ndarray] = []
        self.slots: list[np.ndarray] = []
        for layer in range(int(levels.max(initial=0)) + 1):
            members = np.flatnonzero(levels >= layer)
            slot = np.full(len(levels), -1, np.int32)
            slot[members] = np.arange(len(members))
            self.slots.append(slot)
            self.layers.append(np.full((len(members), DEGREE * (1 if layer else 2)), -1, np.int32))
        self.entry, self.top = 0, 0

    # ------------------------------------------------------------ search

    def search_layer(self, queries: np.ndarray, entries: np.ndarray, beam: int, layer: int) -> tuple[np.ndarray, np.ndarray]:
        """Nodes and similarities of the beam's best for each query, best first; -1 where there are
        fewer. ``entries`` has some nodes for each query, -1 for none."""
        count = len(queries)
        seen = np.zeros((count, len(self.vectors)), bool)
        rows = np.arange(count)
        nodes = np.full((count, beam), -1, np.int32)
        near = np.full((count, beam), -np.inf, np.float32)
        done = np.ones((count, beam), bool)
        fresh = self._unseen(seen, rows, entries)
        self._merge(rows, queries, fresh, nodes, near, done)
        while True:
            rows = np.flatnonzero((~done).any(1))
            if not len(rows):
                return nodes, near
            best = np.argsort(done[rows], axis=1, kind="stable")[:, :AT_ONCE]
            taken = np.take_along_axis(nodes[rows], best, 1)
            taken = np.where(np.take_along_axis(done[rows], best, 1), -1, taken)
            done[rows[:, None], best] = True
            lists = self.layers[layer][self.slots[layer][taken]]
            lists = np.where((taken < 0)[:, :, None], -1, lists).reshape(len(rows), -1)
            self._merge(rows, queries, self._unseen(seen, rows, lists), nodes, near, done)

    @staticmethod
    def _unseen(seen: np.ndarray, rows: np.ndarray, found: np.ndarray) -> np.ndarray:
        """The nodes that a query meets for the first time, each once; -1 for the others."""
        found = np.sort(found, axis=1)
        old = seen[rows[:, None], found]
        old[:, 1:] |= found[:, 1:] == found[:, :-1]
        found = np.where(old | (found < 0), -1, found)
        r, c = np.nonzero(found >= 0)
        seen[rows[r], found[r, c]] = True
        return found

    def _merge(self, rows, queries, found, nodes, near, done) -> None:
        width = int((found >= 0).sum(1).max(initial=0))
        if not width:
            return
        found = -np.sort(-found, axis=1)[:, :width]
        close = np.matmul(self.vectors[found], queries[rows][:, :, None])[:, :, 0]
        close = np.where(found < 0, -np.inf, close)
        beam = nodes.shape[1]
        all_near = np.concatenate((near[rows], close), 1)
        order = np.argsort(-all_near, axis=1, kind="stable")[:, :beam]
        near[rows] = np.take_along_axis(all_near, order, 1)
        nodes[rows] = np.take_along_axis(np.concatenate((nodes[rows], found), 1), order, 1)
        done[rows] = np.take_along_axis(np.concatenate((done[rows], found < 0), 1), order, 1)

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        entries = np.full((len(queries), 1), self.entry, np.int32)
        for layer in range(self.top, 0, -1):
            entries = self.search_layer(queries, entries, 1, layer)[0]
        return self.search_layer(queries, entries, min(beam, len(self.vectors)), 0)

    # ------------------------------------------------------------ building

    def choose(self, found: np.ndarray, near: np.ndarray, most: int) -> np.ndarray:
        """Of nodes sorted by nearness, those that no chosen one is nearer to, then the nearest of the
        rest, up to ``most``."""
        own = self.vectors[found]
        between = np.matmul(own, own.transpose(0, 2, 1))
        valid = found >= 0
        chosen = np.zeros(found.shape, bool)
        for c in range(found.shape[1]):
            nearest = np.where(chosen, between[:, c], -np.inf).max(1)
            chosen[:, c] = valid[:, c] & (nearest < near[:, c]) & (chosen.sum(1) < most)
        order = np.argsort(np.where(chosen, 0, np.where(valid, 1, 2)), axis=1, kind="stable")[:, :most]
        return np.take_along_axis(np.where(valid, found, -1), order, 1)

    def insert(self, low: int, high: int) -> None:
        """Insert nodes low to high - 1; all before have been."""
        new = np.arange(low, high)
        queries, levels = self.vectors[new], self.levels[new]
        entries = np.full((len(new), 1), self.entry, np.int32)
        among = queries @ queries.T
        among[np.triu_indices(len(new))] = -np.inf
        links: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for layer in range(len(self.layers) - 1, -1, -1):
            into = levels >= layer
            found = np.full((len(new), BUILD_BEAM), -1, np.int32)
            near = np.full((len(new), BUILD_BEAM), -np.inf, np.float32)
            if low and layer <= self.top:
                passing = np.flatnonzero(~into)
                if len(passing):
                    entries[passing] = self.search_layer(queries[passing], entries[passing], 1, layer)[0]
                placed = np.flatnonzero(into)
                if len(placed):
                    found[placed], near[placed] = self.search_layer(queries[placed], entries[placed], BUILD_BEAM, layer)
                    entries[placed] = found[placed, :1]
            rows = np.flatnonzero(into)
            if not len(rows):
                continue
            # earlier nodes of the same batch are candidates too
            peers = np.where(into[None, :], among[rows], -np.inf)
            order = np.argsort(-peers, axis=1, kind="stable")[:, :DEGREE]
            close = np.take_along_axis(peers, order, 1)
            peer_nodes = np.where(np.isfinite(close), new[order], -1)
            every, all_near = np.concatenate((found[rows], peer_nodes), 1), np.concatenate((near[rows], close), 1)
            order = np.argsort(-all_near, axis=1, kind="stable")
            links[layer] = new[rows], self.choose(np.take_along_axis(every, order, 1), np.take_along_axis(all_near, order, 1), DEGREE)
        for layer, (nodes, chosen) in links.items():
            table, slot = self.layers[layer], self.slots[layer]
            table[slot[nodes], :DEGREE] = chosen
            r, c = np.nonzero(chosen >= 0)
            self._link_back(layer, chosen[r, c], nodes[r])
        if levels.max() > self.top or low == 0:
            self.entry, self.top = int(new[levels.argmax()]), int(levels.max())

    def _link_back(self, layer: int, targets: np.ndarray, sources: np.ndarray) -> None:
        """Add sources to the targets' lists; lists that grow too long keep the best choice."""
        table, slot = self.layers[layer], self.slots[layer]
        order = np.argsort(targets, kind="stable")
        targets, sources = targets[order], sources[order]
        unique, first, number = np.unique(targets, return_index=True, return_counts=True)
        width = int(number.max(initial=0))
        for begin in range(0, len(unique), 1024):
            mine = slice(begin, begin + 1024)
            extra = np.full((len(unique[mine]), width), -1, np.int32)
            for k in range(width):
                has = number[mine] > k
                extra[has, k] = sources[first[mine][has] + k]
            every = np.concatenate((table[slot[unique[mine]]], extra), 1)
            near = np.matmul(self.vectors[every], self.vectors[unique[mine]][:, :, None])[:, :, 0]
            near = np.where(every < 0, -np.inf, near)
            order = np.argsort(-near, axis=1, kind="stable")[:, : table.shape[1] + 2 * DEGREE]
            every, near = np.take_along_axis(every, order, 1), np.take_along_axis(near, order, 1)
            table[slot[unique[mine]]] = self.choose(every, near, table.shape[1])

    @classmethod
    def build(cls, vectors: np.ndarray, keys: np.ndarray) -> Graph:
        """A graph over unit vectors. ``keys`` are random numbers that set the nodes' levels."""
        chance = (mix(keys.astype(np.uint64)) >> np.uint64(11)).astype(np.float64) / 2.0**53
        levels = np.floor(-np.log(np.maximum(chance, 1e-12)) / math.log(DEGREE)).astype(np.int8)
        graph = cls(vectors, levels)
        low = 0
        while low < len(vectors):
            high = min(len(vectors), low + max(1, min(BATCH, low)))
            graph.insert(low, high)
            low = high
        return graph

    # ------------------------------------------------------------ storing

    def save(self, folder: str, name: str) -> None:
        save_array(folder, f"{name}-levels", self.levels)
        for layer, table in enumerate(self.layers):
            save_array(folder, f"{name}-layer-{layer}", table)
        save_array(folder, f"{name}-entry", np.array([self.entry, self.top], np.int64))

    @classmethod
    def load(cls, folder: str, name: str, vectors: np.ndarray) -> Graph:
        graph = cls(vectors, cached_array(folder, f"{name}-levels"))
        graph.layers = [cached_array(folder, f"{name}-layer-{k}") for k in range(len(graph.layers))]
        graph.entry, graph.top = cached_array(folder, f"{name}-entry").tolist()
        return graph


def links_in(graph: Graph, queries: np.ndarray, beam: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(query, node) of all found pairs from the threshold on. Queries whose beam is full of links
    search again with a beam twice as wide."""
    todo, out = np.arange(len(queries)), []
    while len(todo):
        again = []
        # what is seen is kept for each query and node
        step = max(1, min(len(todo), 32_000_000 // max(1, len(graph.vectors))))
        for begin in range(0, len(todo), step):
            mine = todo[begin : begin + step]
            nodes, near = graph.search(queries[mine], beam)
            linked = near >= threshold
            full = linked.all(1) & (nodes.shape[1] < len(graph.vectors))
            r, c = np.nonzero(linked & ~full[:, None])
            out.append((mine[r], nodes[r, c]))
            again.append(mine[full])
        todo, beam = np.concatenate(again), beam * 2
    return tuple(np.concatenate(x) if out else np.zeros(0, np.int64) for x in zip(*out)) if out else (np.zeros(0, np.int64),) * 2


def brute_links(vectors: np.ndarray, queries: np.ndarray, threshold: float) -> set[tuple[int, int]]:
    return set(zip(*(x.tolist() for x in np.nonzero(queries @ vectors.T >= threshold))))


def audited_beam(graph: Graph, threshold: float) -> tuple[int, float]:
    """The first beam, doubling from ``FIRST_BEAM``, with which audit queries find their links; and
    the recall that was measured."""
    count = len(graph.vectors)
    draw = np.random.default_rng(count)
    chosen = draw.choice(count, min(AUDITS, count), replace=False)
    base = graph.vectors[chosen]
    away = draw.standard_normal(base.shape).astype(np.float32)
    away -= (away * base).sum(1, keepdims=True) * base
    away /= np.maximum(np.linalg.norm(away, axis=1, keepdims=True), 1e-12)
    cosine = np.float32(threshold + (1 - threshold) * 0.1)
    queries = cosine * base + math.sqrt(1 - cosine * cosine) * away
    wanted, beam = brute_links(graph.vectors, queries, threshold), FIRST_BEAM
    while True:
        q, node = links_in(graph, queries, beam, threshold)
        recall = len(wanted & set(zip(q.tolist(), node.tolist()))) / max(1, len(wanted))
        if recall >= AUDIT_RECALL or beam >= count:
            return beam, recall
        beam *= 2


# ---------------------------------------------------------------- tables


def unit(raw: np.ndarray) -> np.ndarray:
    return (raw / np.linalg.norm(raw, axis=1, keepdims=True)).astype(np.float32)


def usable_vectors(embeddings: DataFrame) -> DataFrame:
    """(vec_id, key, dim, raw): a digest of the vector and its numbers as bytes; null where it links
    with nothing (null, empty, zero, or with components that are null or not finite)."""

    def pack(batches):
        for batch in batches:
            key, dim, raw = [], [], []
            for value in batch.column("embedding"):
                numbers = None if not value.is_valid else value.values.to_numpy(zero_copy_only=False)
                # a null component is NaN here; adding 0.0 makes -0.0 and 0.0 one
                good = numbers is not None and len(numbers) and np.isfinite(numbers).all() and numbers.any()
                if good:
                    peak = np.abs(numbers).max()
                    good = np.isfinite(np.linalg.norm(numbers)) or np.isfinite(peak)
                    # extreme lengths would overflow or vanish when squared; a power of two changes no angle
                    numbers = np.ldexp(numbers, -int(np.frexp(peak)[1])) if not 1e-100 < peak < 1e100 else numbers
                data = (numbers.astype(np.float64) + 0.0).tobytes() if good else None
                raw.append(data)
                dim.append(len(numbers) if good else None)
                key.append(hashlib.blake2b(data, digest_size=16).digest() if good else None)
            columns = [batch.column("vec_id"), pa.array(key, pa.binary()), pa.array(dim, pa.int64()), pa.array(raw, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "key", "dim", "raw"])

    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    return rows.mapInArrow(pack, "vec_id long, key binary, dim long, raw binary")


def store_shards(classes: DataFrame, folder: str, threshold: float) -> DataFrame:
    """Build and store the graph of each shard; returns (dim, shard, beam, recall)."""

    def build(frame):
        dim, shard = int(frame["dim"].iloc[0]), int(frame["part"].iloc[0])
        frame = frame.sort_values(["place", "rep"])
        raw = np.frombuffer(b"".join(frame["raw"]), np.float64).reshape(len(frame), dim)
        vectors = unit(raw)
        graph = Graph.build(vectors, frame["place"].to_numpy(np.int64))
        beam, recall = audited_beam(graph, threshold - SLACK)
        name = f"shard-{dim}-{shard}"
        graph.save(folder, name)
        save_array(folder, f"{name}-vectors", vectors)
        save_array(folder, f"{name}-raw", raw)
        save_array(folder, f"{name}-ids", frame["rep"].to_numpy(np.int64))
        save_array(folder, f"{name}-weights", frame["weight"].to_numpy(np.int64))
        return type(frame)({"dim": [dim], "shard": [shard], "beam": [beam], "recall": [recall]})

    return classes.groupBy("dim", "part").applyInPandas(build, "dim long, shard long, beam long, recall double")


def store_blocks(classes: DataFrame, folder: str) -> DataFrame:
    """Store the queries in blocks; returns (dim, block)."""

    def store(frame):
        dim, block = int(frame["dim"].iloc[0]), int(frame["block"].iloc[0])
        raw = np.frombuffer(b"".join(frame["raw"]), np.float64).reshape(len(frame), dim)
        save_array(folder, f"block-{dim}-{block}-raw", raw)
        save_array(folder, f"block-{dim}-{block}-ids", frame["rep"].to_numpy(np.int64))
        return type(frame)({"dim": [dim], "block": [block]})

    return classes.groupBy("dim", "block").applyInPandas(store, "dim long, block long")


def spanning_links(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that join the same nodes as the given ones, at most one for each node."""
    ids, where = np.unique(np.concatenate((a, b)), return_inverse=True)
    left, right = where[: len(a)], where[len(a) :]
    label = np.arange(len(ids))
    while True:
        least = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, left, least)
        np.minimum.at(new, right, least)
        new = new[new]
        if (new == label).all():
            break
        label = new
    other = label != np.arange(len(ids))
    return ids[other], ids[label[other]]


def query_shards(asked: DataFrame, folder: str, threshold: float) -> DataFrame:
    """(a, b, n): for b null the number n of vectors that a links with in one shard (copies count);
    else a link that spans components."""

    def ask(batches):
        for batch in batches:
            for row in batch.to_pylist():
                name = f"shard-{row['dim']}-{row['shard']}"
                part = {x: cached_array(folder, f"{name}-{x}") for x in ("vectors", "raw", "ids", "weights")}
                graph = Graph.load(folder, name, part["vectors"])
                block = f"block-{row['dim']}-{row['block']}"
                raw, ids = map_array(folder, f"{block}-raw"), map_array(folder, f"{block}-ids")
                q, node = links_in(graph, unit(raw), row["beam"], threshold - SLACK)
                other = ids[q] != part["ids"][node]
                q, node = q[other], node[other]
                keep = np.zeros(len(q), bool)
                for begin in range(0, len(q), 1 << 15):
                    some = slice(begin, begin + (1 << 15))
                    x, y = raw[q[some]], part["raw"][node[some]]
                    lengths = np.linalg.norm(x, axis=1) * np.linalg.norm(y, axis=1)
                    keep[some] = (x * y).sum(1) / lengths >= threshold
                q, node = q[keep], node[keep]
                counts = np.bincount(q, part["weights"][node], len(ids)).astype(np.int64)
                a, b = spanning_links(ids[q], part["ids"][node])
                has = counts > 0
                size = int(has.sum())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate((ids[has], a))),
                        pa.array([*[None] * size, *b.tolist()], pa.int64()),
                        pa.array(np.concatenate((counts[has], np.zeros(len(a), np.int64)))),
                    ],
                    ["a", "b", "n"],
                )

    return asked.mapInArrow(ask, "a long, b long, n long")


def near_vectors(
    spark: SparkSession, embeddings: DataFrame, threshold: float = THRESHOLD, per_shard: int = PER_SHARD
) -> tuple[DataFrame, DataFrame]:
    """Links of all vectors (vec_id, embedding; more columns are ignored) whose cosine, in double
    precision, is ``threshold`` or more.

    Returns (vec_id, n_links, component_id, kept), one row for each row, and (dim, shard, beam,
    recall) with the audits. Vectors that are null, empty or zero, or have null or non-finite
    components, link with nothing; so do rows without vec_id (their component_id is null and they are
    kept). Vectors of different length never link. Rows that repeat a vec_id and its vector are one
    vector; copies under other ids are found before the search and counted as links.
    """
    work = Workspace(spark, "hnsw")
    folder = f"{work.path}/arrays"
    rows = work.table(usable_vectors(embeddings), "vectors")
    good = rows.where("key IS NOT NULL AND vec_id IS NOT NULL")
    classes = good.groupBy("key", "vec_id").agg(F.first("dim").alias("dim"), F.first("raw").alias("raw"))
    classes = classes.groupBy("key").agg(
        F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("weight"), F.first("dim").alias("dim"), F.first("raw").alias("raw")
    )
    classes = work.table(classes.withColumn("place", F.xxhash64("key")), "classes")
    size = classes.count()
    shards, blocks = max(SHARDS, -(-size // per_shard)), max(1, -(-size // PER_BLOCK))
    parts = classes.withColumn("part", F.pmod("place", F.lit(shards)))
    audits = work.table(store_shards(parts, folder, threshold), "audits")
    poor = audits.where(F.col("recall") < LEAST_RECALL).orderBy("recall").first()
    if poor is not None:
        raise RuntimeError(f"shard {poor['shard']} of vectors of length {poor['dim']} finds only {poor['recall']:.3f} of its links")
    queries = classes.withColumn("block", F.pmod(F.xxhash64("place"), F.lit(blocks)))
    stored = work.table(store_blocks(queries, folder), "blocks")
    # a row for each block of queries and each shard; a task takes one, or where there are very many,
    # several of one shard, which it maps once
    tasks = min(max(1, shards * blocks), MOST_TASKS)
    share = F.pmod("block", F.lit(max(1, tasks // shards)))
    asked = audits.join(stored, "dim").repartition(tasks, "dim", "shard", share).sortWithinPartitions("dim", "shard", "block")
    found = work.table(query_shards(asked, folder, threshold), "found")
    counts = found.where("b IS NULL").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("links"))
    comps = connected_components(found.where("b IS NOT NULL").select("a", "b"), work)
    about = classes.select("key", "rep", "weight").join(counts, "rep", "left")
    about = about.join(comps.select(F.col("id").alias("rep"), "component"), "rep", "left")
    about = work.table(about, "about")
    out = rows.select("vec_id", F.when(F.col("vec_id").isNotNull(), F.col("key")).alias("key")).join(about, "key", "left")
    links = F.coalesce(F.col("links"), F.lit(0)) + F.coalesce(F.col("weight"), F.lit(1)) - 1
    component = F.coalesce("component", "rep", "vec_id")
    kept = F.coalesce(F.col("vec_id") == component, F.lit(True))
    return out.select("vec_id", links.alias("n_links"), component.alias("component_id"), kept.alias("kept")), audits
