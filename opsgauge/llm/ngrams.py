"""An interpolated modified Kneser-Ney model of any order, counted in Spark.

The model is a set of arrays in the shared folder. Words are sorted 64-bit hashes in blocks by their
leading bits; a word's place among all of them is its id. N-grams of each length lie in shards by their
contexts: the sorted contexts with their numbers, and for each the sorted ids of the words after it with
their counts. A further array holds one number for each word id. Workers map the arrays into memory.

The longest n-grams have the counts of the texts, shorter ones the number of distinct words before
them. Tasks add up the n-grams of many texts and send each shard one packed row of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsgauge.llm.arrays import cached_array, cached_pack, pack, save_array, unpack
from opsgauge.llm.words import SHINGLE, mix, text_blocks
from opsgauge.llm.workspace import Workspace

END_HASH = np.uint64(0x5BD1E995A7C3F10D)
ORDER = 3
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
TOKENS_PER_SHARD = 1 << 22
WORDS_PER_BLOCK = 1 << 20
BLOCK_BYTES = 1 << 22
GATHER = 1 << 20
FOLDS, HELD_OUT = 7, 2
LOW = np.uint64(2**32 - 1)
HALF = np.uint64(32)


def held_out(doc_id: Column) -> Column:
    """Whether a document is left out of training; one without an id is not."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == HELD_OUT, F.lit(False))


def token_blocks(batch: pa.RecordBatch, column: str) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of about four megabytes of whole texts: the hashes of their distinct words, for each token
    its place among those, and where each text's tokens begin (one entry more than texts). An end token
    follows each text's words. Null is empty."""
    texts = batch.column(batch.schema.get_field_index(column)).cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    row = 0
    while row < len(texts):
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + BLOCK_BYTES, "right")) - 1)
        # the library's white space is that of the words; it leaves empty strings at the ends of texts
        split = pc.ascii_split_whitespace(pc.ascii_lower(texts.slice(row, stop - row)))
        coded = split.flatten().dictionary_encode()
        known = pc.binary_length(coded.dictionary).to_numpy(zero_copy_only=False) > 0
        hashes = np.append(np.zeros(len(known), np.uint64), END_HASH)
        hashes[:-1][known] = np.concatenate([np.zeros(0, np.uint64), *(h for _, h, _ in text_blocks(coded.dictionary))])
        codes = coded.indices.to_numpy(zero_copy_only=False)
        words = known[codes]
        ends = np.concatenate(([0], np.cumsum(words)))[np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False))]
        bounds = np.concatenate(([0], ends)) + np.arange(stop - row + 1)
        tokens = np.full(bounds[-1], len(known), np.int64)
        tokens[np.arange(ends[-1]) + np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))] = codes[words]
        # the empty string is no word
        places = np.append(np.cumsum(known) - 1, known.sum())
        yield hashes[np.append(known, True)], places[tokens], bounds
        row = stop


def rows_of(batches: Iterator[pa.RecordBatch], *names: str) -> list[np.ndarray]:
    """All values of a task's columns, as arrays."""
    parts = [[b.column(b.schema.get_field_index(n)).to_numpy(zero_copy_only=False) for n in names] for b in batches]
    return [np.concatenate(x) if parts else np.zeros(0, np.int64) for x in zip(*parts)] or [np.zeros(0, np.int64)] * len(names)


def slices_by(key: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each value of a key and the places that have it."""
    if not len(key):
        return
    order = np.argsort(key.astype(np.min_scalar_type(int(key.max()))), kind="stable")
    first = np.flatnonzero(starts(key[order]))
    for value, places in zip(key[order[first]].tolist(), np.split(order, first[1:])):
        yield value, places


def starts(values: np.ndarray) -> np.ndarray:
    """Whether each of some sorted values is the first of its kind."""
    out = np.ones(len(values), bool)
    np.not_equal(values[1:], values[:-1], out=out[1:])
    return out


def search(values: np.ndarray, low: np.ndarray, high: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The place of each wanted number in its own sorted range of the values; -1 if it is not there."""
    out = np.full(len(wanted), -1, np.int64)
    at = np.flatnonzero(low < high)
    low, high, wanted = low[at], high[at], wanted[at]
    while len(at):
        middle = (low + high) >> 1
        value = values[middle]
        out[at[value == wanted]] = middle[value == wanted]
        less = value < wanted
        low, high = np.where(less, middle + 1, low), np.where(less, high, middle)
        on = (value != wanted) & (low < high)
        if not on.all():
            at, low, high, wanted = at[on], low[on], high[on], wanted[on]
    return out


# ---------------------------------------------------------------- the stored model


@dataclass(frozen=True)
class Level:
    """The n-grams of one length: their discounts, and the shards that hold any."""

    discounts: tuple[float, float, float]
    filled: frozenset[int]


@dataclass(frozen=True)
class Model:
    """Where the arrays are, and the numbers that hold for the whole model."""

    folder: str
    bits: int
    offsets: tuple[int, ...]
    shards: int
    per_block: int
    tokens: int
    order: int
    levels: tuple[Level, ...] = ()
    lower_discounts: tuple[float, ...] = (0.0, 0.0, 0.0)
    types: int = 0
    lower_rest: float = 1.0
    frequent: tuple[int, ...] = ()

    @property
    def words(self) -> int:
        return self.offsets[-1]

    def word_ids(self, hashes: np.ndarray) -> np.ndarray:
        """Ids of sorted distinct hashes; -1 for unknown words."""
        ids = np.full(len(hashes), -1, np.int64)
        blocks = len(self.offsets) - 1
        edges = [np.uint64(b << (64 - self.bits)) for b in range(1, blocks)]
        cuts = [0, *np.searchsorted(hashes, np.array(edges, np.uint64)), len(hashes)]
        for b in range(blocks):
            mine, size = hashes[cuts[b] : cuts[b + 1]], self.offsets[b + 1] - self.offsets[b]
            if len(mine) and size:
                known = cached_array(self.folder, f"words-{b}")
                at = np.searchsorted(known, mine)
                hit = known[np.minimum(at, size - 1)] == mine
                ids[cuts[b] : cuts[b + 1]] = np.where(hit, at + self.offsets[b], -1)
        return ids

    def word_counts(self, ids: np.ndarray) -> np.ndarray:
        """Training counts of sorted ids; 0 for -1."""
        out = np.zeros(len(ids), np.int64)
        cuts = np.searchsorted(ids, self.offsets)
        for b in range(len(self.offsets) - 1):
            if cuts[b + 1] > cuts[b]:
                counts = cached_array(self.folder, f"counts-{b}")
                out[cuts[b] : cuts[b + 1]] = counts[ids[cuts[b] : cuts[b + 1]] - self.offsets[b]]
        return out

    def predecessors(self, ids: np.ndarray) -> np.ndarray:
        """Numbers of distinct predecessors of sorted ids; 0 for -1."""
        out = np.zeros(len(ids), np.int64)
        for block, places in slices_by(ids // self.per_block):
            if block >= 0 and self.types:
                out[places] = cached_array(self.folder, f"predecessors-{block}")[ids[places] % self.per_block]
        return out

    def shard_of(self, contexts: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Shard of contexts by their last words; those that end in a frequent word are dealt singly."""
        last = contexts[:, -1].astype(np.uint64)
        by = np.where(np.isin(last, np.array(self.frequent, np.uint64)), mix(keys), mix(last))
        return (by % np.uint64(self.shards)).astype(np.int64)

    def look_up(self, grams: np.ndarray, filled: frozenset[int]) -> tuple[np.ndarray, np.ndarray]:
        """For each row of ids the count of the n-gram, and the four numbers of its context; zeros where
        there are none."""
        width = grams.shape[1]
        keys = context_keys(grams[:, :-1])
        order = np.argsort(keys)
        new = starts(keys[order])
        where = np.empty(len(keys), np.int64)
        where[order] = np.cumsum(new) - 1
        keys, contexts = keys[order[new]], grams[order[new], :-1]
        shards = self.shard_of(contexts, keys)
        numbers, low, high = np.zeros((len(keys), 4), np.int64), np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        for shard, places in slices_by(shards):
            if shard in filled:
                own = Shard(*cached_pack(self.folder, f"grams{width}-{shard}"))
                at = own.contexts(keys[places])
                places, at = places[at >= 0], at[at >= 0]
                numbers[places] = own.numbers.reshape(-1, 4)[own.kinds[at]]
                low[places], high[places] = own.first[at], own.first[at + 1]
        counts, low, high = np.zeros(len(where), np.int64), low[where], high[where]
        for shard, places in slices_by(shards[where]):
            if shard in filled:
                own = Shard(*cached_pack(self.folder, f"grams{width}-{shard}"))
                at = search(own.lasts, low[places], high[places], grams[places, -1])
                counts[places[at >= 0]] = own.counts_at(at[at >= 0])
        return counts, numbers[where]

    def lower(self, predecessors: np.ndarray) -> np.ndarray:
        """Probabilities of words by their numbers of distinct predecessors."""
        unseen = self.lower_rest / (self.words + 1)
        if not self.types:
            return np.full(len(predecessors), unseen)
        return np.maximum(predecessors - discount(self.lower_discounts, predecessors), 0) / self.types + unseen


@dataclass(frozen=True)
class Shard:
    """The n-grams of one shard. Contexts are sorted by their keys, of which ``lows`` has the lower halves
    and ``tops`` the distinct upper ones, whose contexts begin at ``top_first``. A context's words begin at
    ``first`` in ``lasts``; ``kinds`` points to its four numbers. Counts of 255 and more are in ``many``
    at the places ``many_at``."""

    tops: np.ndarray
    top_first: np.ndarray
    lows: np.ndarray
    first: np.ndarray
    kinds: np.ndarray
    numbers: np.ndarray
    lasts: np.ndarray
    counts: np.ndarray
    many_at: np.ndarray
    many: np.ndarray

    def contexts(self, keys: np.ndarray) -> np.ndarray:
        """Places of contexts; -1 for unknown ones."""
        top = (keys >> HALF).astype(np.uint32)
        at = np.minimum(np.searchsorted(self.tops, top), len(self.tops) - 1)
        low = self.top_first[at].astype(np.int64)
        high = np.where(self.tops[at] == top, self.top_first[at + 1].astype(np.int64), low)
        return search(self.lows, low, high, (keys & LOW).astype(np.uint32))

    def counts_at(self, places: np.ndarray) -> np.ndarray:
        out = self.counts[places].astype(np.int64)
        many = out == 255
        out[many] = self.many[np.searchsorted(self.many_at, places[many])]
        return out


def discount(discounts: tuple[float, ...], counts: np.ndarray) -> np.ndarray:
    return np.array([0.0, *discounts])[np.minimum(counts, 3)]


def discounts_of(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """The three discounts from the numbers of items counted once to four times. A number of 0 leaves
    a discount open: it is then half the count it is taken from."""
    if not n1 or not n2:
        return (0.5, 1.0, 1.5)
    y = n1 / (n1 + 2 * n2)
    found = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.5)
    return tuple(float(min(max(d, 0.0), k)) for k, d in enumerate(found, 1))


def powers_of_two(n: int) -> int:
    return max(0, (max(1, n) - 1).bit_length())


# ---------------------------------------------------------------- counting


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What a query shuffles meanwhile is dropped when it ends."""
    before = spark.conf.get(DROP_SHUFFLES, "false")
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(DROP_SHUFFLES, before)


def count_words(train: DataFrame, work: Workspace, text: str) -> tuple[DataFrame, int, int]:
    """(word hash, count) of all training tokens, the number of words and of tokens."""

    def count(batches):
        held, size = [], 0

        def sent():
            hashes, n = (np.concatenate(x) for x in zip(*held))
            order = np.argsort(hashes)
            first = np.flatnonzero(starts(hashes[order]))
            return pa.RecordBatch.from_arrays([pa.array(hashes[order[first]].view(np.int64)), pa.array(np.add.reduceat(n[order], first))], ["word", "n"])

        for batch in batches:
            for hashes, tokens, _ in token_blocks(batch, text):
                held.append((hashes, np.bincount(tokens, minlength=len(hashes))))
                size += len(hashes)
                if size >= GATHER:
                    yield sent()
                    held, size = [], 0
        if size:
            yield sent()

    words = train.select(text).mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    words = work.table(words, "words")
    size = words.agg(F.count(F.lit(1)).alias("words"), F.coalesce(F.sum("n"), F.lit(0)).alias("tokens")).first()
    return words, size["words"], size["tokens"]


def store_words(words: DataFrame, size: int, folder: str) -> tuple[int, tuple[int, ...]]:
    """Write the sorted words and their counts in blocks; the leading bits that name a block, and the
    id of each block's first word."""
    bits = max(6, powers_of_two(-(-size // WORDS_PER_BLOCK)))

    def store(batches):
        hashes, counts = rows_of(batches, "word", "n")
        hashes = hashes.view(np.uint64)
        sizes = []
        for block, places in slices_by(hashes >> np.uint64(64 - bits)):
            order = places[np.argsort(hashes[places])]
            save_array(folder, f"words-{block}", hashes[order])
            save_array(folder, f"counts-{block}", counts[order])
            sizes.append((block, len(order)))
        if sizes:
            yield pa.RecordBatch.from_arrays([pa.array([s[i] for s in sizes], pa.int64()) for i in (0, 1)], ["block", "n"])

    block = F.shiftrightunsigned("word", 64 - bits)
    stored = words.repartition(2**bits, block).mapInArrow(store, "block long, n long").collect()
    sizes = np.zeros(2**bits + 1, np.int64)
    for row in stored:
        sizes[row["block"] + 1] = row["n"]
    return bits, tuple(np.cumsum(sizes).tolist())


def ids_of(model: Model, hashes: np.ndarray) -> np.ndarray:
    """Ids of distinct hashes; -1 for unknown words."""
    order = np.argsort(hashes)
    ids = np.empty(len(hashes), np.int64)
    ids[order] = model.word_ids(hashes[order])
    return ids


def windows(ids: np.ndarray, bounds: np.ndarray, order: int, begin: int) -> np.ndarray:
    """For each token the ids of the n-gram that it ends; texts follow ``order`` - 1 begin marks."""
    place = np.arange(len(ids)) - np.repeat(bounds[:-1], np.diff(bounds))
    out = np.empty((len(ids), order), np.uint32)
    for back in range(order):
        column = ids if not back else np.concatenate((ids[:back], ids[:-back]))[: len(ids)]
        out[:, order - 1 - back] = np.where(place >= back, column, begin).astype(np.uint32)
    return out


def gram_keys(grams: np.ndarray) -> np.ndarray:
    """64-bit hashes of the rows."""
    total = np.full(len(grams), grams.shape[1], np.uint64)
    for k in range(grams.shape[1]):
        total += (grams[:, k].astype(np.uint64) + np.uint64(1)) * SHINGLE[k]
    return mix(total)


def context_keys(contexts: np.ndarray) -> np.ndarray:
    """64-bit keys of contexts: one or two ids themselves, the later one first, or else a hash of all."""
    if contexts.shape[1] > 2:
        return gram_keys(contexts)
    keys = contexts[:, 0].astype(np.uint64)
    return keys if contexts.shape[1] == 1 else keys | contexts[:, 1].astype(np.uint64) << HALF


def small(values: np.ndarray) -> np.ndarray:
    """The same numbers in the smallest type that holds them."""
    return values.astype(np.min_scalar_type(int(values.max())))


@dataclass(frozen=True)
class Grams:
    """Distinct n-grams: sorted contexts with their keys, how many words follow each, those words and the
    counts of the n-grams."""

    keys: np.ndarray
    contexts: np.ndarray
    lengths: np.ndarray
    lasts: np.ndarray
    counts: np.ndarray

    def rows(self) -> np.ndarray:
        return np.column_stack((np.repeat(self.contexts, self.lengths, axis=0), self.lasts))


def grouped(grams: np.ndarray, counts: np.ndarray | None = None) -> Grams:
    """The distinct rows and the sums of their counts (None: each row counts one)."""
    keys = context_keys(grams[:, :-1])
    order = np.argsort(keys)
    keys = keys[order]
    new = starts(keys)
    pairs = (np.cumsum(new, dtype=np.uint64) - np.uint64(1)) << HALF | grams[order, -1].astype(np.uint64)
    contexts, keys = grams[order[new], :-1], keys[new]
    if counts is None:
        pairs.sort()
    else:
        again = np.argsort(pairs)
        pairs, counts = pairs[again], counts[order[again]]
    first = np.flatnonzero(starts(pairs))
    sums = np.diff(first, append=len(pairs)) if counts is None else np.add.reduceat(counts.astype(np.int64), first)
    pairs = pairs[first]
    return Grams(keys, contexts, np.bincount((pairs >> HALF).astype(np.int64)), pairs.astype(np.uint32), sums)


def planes(values: np.ndarray) -> np.ndarray:
    """Numbers below 2**32 with all their first bytes first: the shuffle's compression finds the zeros."""
    return np.ascontiguousarray(values.astype(np.uint32).view(np.uint8).reshape(-1, 4).T).ravel()


def from_planes(found: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(found.reshape(4, -1).T).view(np.uint32).ravel()


ROW = "shard int, ones long, twos long, threes long, fours long, packed binary"


def row_batch(shards: list[int], packed: list[bytes], numbers: tuple[int, ...] | None = None) -> pa.RecordBatch:
    """Packed n-grams for some shards, or the numbers of n-grams counted once to four times in one."""
    n = len(shards)
    columns = [pa.array([None if numbers is None else numbers[k]] * n, pa.int64()) for k in range(4)]
    return pa.RecordBatch.from_arrays([pa.array(shards, pa.int32()), *columns, pa.array(packed, pa.binary())], ROW.replace(",", "").split()[::2])


def dealt(model: Model, grams: Grams) -> Iterator[pa.RecordBatch]:
    """One row for each shard that has any of the n-grams."""
    shards = model.shard_of(grams.contexts, grams.keys)
    lasts = dict(slices_by(np.repeat(shards, grams.lengths)))
    for shard, places in slices_by(shards):
        columns = [*grams.contexts[places].T]
        # the last words of sorted contexts differ little
        columns[-1] = np.diff(columns[-1], prepend=np.uint32(0))
        columns += [grams.lengths[places], grams.lasts[lasts[shard]], grams.counts[lasts[shard]]]
        yield row_batch([shard], [pack(*map(planes, columns)).tobytes()])


def from_rows(rows: list[bytes], width: int) -> Iterator[Grams]:
    """The n-grams that rows hold, added up, in parts by ranges of the contexts' keys."""
    held, size = [], 0
    while rows:
        *columns, lengths, lasts, n = map(from_planes, unpack(np.frombuffer(rows.pop(), np.uint8)))
        columns[-1] = np.cumsum(columns[-1], dtype=np.uint32)
        contexts = np.column_stack(columns)
        held.append((context_keys(contexts), contexts, np.append(0, np.cumsum(lengths, dtype=np.int64)), lasts, n))
        size += len(lasts)
    parts = -(-size // GATHER)
    keys = np.sort(np.concatenate([h[0][::8] for h in held]))
    edges = np.unique(keys[len(keys) * np.arange(1, parts) // parts])
    cuts = [[0, *np.searchsorted(h[0], edges).tolist(), len(h[0])] for h in held]
    for k in range(len(edges) + 1):
        grams, counts = [], []
        for (_, contexts, first, lasts, n), cut in zip(held, cuts):
            low, high = cut[k], cut[k + 1]
            own = slice(first[low], first[high])
            grams.append(np.column_stack((np.repeat(contexts[low:high], np.diff(first[low : high + 1]), axis=0), lasts[own])))
            counts.append(n[own])
        grams, counts = np.concatenate(grams), np.concatenate(counts)
        if len(grams):
            yield grouped(grams, counts)


def joined(parts: list[Grams]) -> Grams:
    """N-grams of several parts, in order of the contexts' keys."""
    out = Grams(*(np.concatenate([getattr(p, name) for p in parts]) for name in Grams.__dataclass_fields__))
    return out if (out.keys[:-1] <= out.keys[1:]).all() else grouped(out.rows(), out.counts)


def by_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[bytes]]]:
    """The packed rows of each shard of a task; they are let go as they are used."""
    held: dict[int, list[bytes]] = {}
    for batch in batches:
        for shard, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            held.setdefault(shard, []).append(packed)
        del batch
    while held:
        yield held.popitem()


def texts_dealt(train: DataFrame, model: Model, text: str) -> DataFrame:
    """The n-grams of the texts with their counts, added up over many texts."""

    def deal(batches):
        held, size = [], 0
        for batch in batches:
            for hashes, tokens, bounds in token_blocks(batch, text):
                held.append(windows(ids_of(model, hashes)[tokens], bounds, model.order, model.words))
                size += len(tokens)
                if size >= GATHER:
                    grams, held, size = np.concatenate(held), [], 0
                    yield from dealt(model, grouped(grams))
        if size:
            grams, held = np.concatenate(held), []
            yield from dealt(model, grouped(grams))

    return train.select(text).mapInArrow(deal, ROW)


def distinct_rows(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows, and for each row its place among them."""
    _, of, where = np.unique(gram_keys(numbers), return_index=True, return_inverse=True)
    return numbers[of], where


def numbers_of(grams: Grams) -> tuple[np.ndarray, np.ndarray]:
    """For each context: the total, and how many words follow once, twice, more often; as ``distinct_rows``."""
    c, size = grams.counts, len(grams.keys)
    place = np.repeat(np.arange(size), grams.lengths)
    ones, twos = (np.bincount(place[c == k], minlength=size) for k in (1, 2))
    totals = np.add.reduceat(c, np.cumsum(grams.lengths) - grams.lengths)
    return distinct_rows(np.stack([totals, ones, twos, grams.lengths - ones - twos], 1))


class Written:
    """One shard of n-grams, gathered part by part and written as ``Shard`` reads it."""

    def __init__(self):
        self.parts, self.numbers, self.of = [], [], np.zeros(4, np.int64)

    def add(self, grams: Grams) -> None:
        numbers, kinds = numbers_of(grams)
        kinds = kinds.astype(np.uint32) + np.uint32(sum(map(len, self.numbers)))
        self.numbers.append(numbers)
        many = np.flatnonzero(grams.counts >= 255)
        self.parts.append((
            grams.keys, grams.lengths.astype(np.uint32), kinds, grams.lasts,
            np.minimum(grams.counts, 255).astype(np.uint8), many + sum(len(p[3]) for p in self.parts), grams.counts[many],
        ))
        self.of += np.bincount(np.minimum(grams.counts, 5), minlength=6)[1:5]

    def save(self, folder: str, name: str) -> None:
        keys, lengths, kinds, lasts, counts, many_at, many = map(np.concatenate, zip(*self.parts))
        numbers, again = distinct_rows(np.concatenate(self.numbers))
        top = (keys >> HALF).astype(np.uint32)
        top_first = np.flatnonzero(starts(top))
        fields = (
            top[top_first], np.append(top_first, len(keys)).astype(np.uint32), keys.astype(np.uint32),
            np.append(0, np.cumsum(lengths, dtype=np.int64)).astype(np.uint32), small(again[kinds]), numbers.ravel(), lasts, counts,
            many_at.astype(np.uint32), many,
        )
        save_array(folder, name, pack(*fields))


def store_shards(rows: DataFrame, model: Model, width: int) -> DataFrame:
    """Write n-grams shard by shard. Returns how many of each shard have the counts one to four, and the
    n-grams without their first word with the number of distinct words before them; single words are
    dealt by blocks of ids."""

    def store(batches):
        for shard, packed in by_shard(batches):
            written, below = Written(), []
            for grams in from_rows(packed, width):
                written.add(grams)
                below.append(grouped(grams.rows()[:, 1:]) if width > 2 else np.unique(grams.lasts, return_counts=True))
            written.save(model.folder, f"grams{width}-{shard}")
            yield row_batch([shard], [None], tuple(written.of.tolist()))
            del written
            if width > 2:
                yield from dealt(model, joined(below))
                continue
            for ids, n in below:
                for block, places in slices_by(ids // np.uint32(model.per_block)):
                    yield row_batch([block], [pack(planes(ids[places]), planes(n[places])).tobytes()])

    # more tasks than shards, so that few tasks hold the rows of several shards
    return rows.select("shard", "packed").repartition(4 * model.shards, "shard").mapInArrow(store, ROW)


def store_predecessors(rows: DataFrame, model: Model) -> list[int]:
    """Write the numbers of distinct predecessors of all word ids in blocks; how many words have one
    to four and how many more than two, and the sum."""
    folder, per_block, words = model.folder, model.per_block, model.words

    def store(batches):
        for block, packed in by_shard(batches):
            own = np.zeros(min(per_block, words - block * per_block), np.int64)
            for row in packed:
                ids, n = map(from_planes, unpack(np.frombuffer(row, np.uint8)))
                own[ids % np.uint32(per_block)] += n
            save_array(folder, f"predecessors-{block}", small(own))
            found = [*(int((own == k).sum()) for k in (1, 2, 3, 4)), int((own > 2).sum()), int(own.sum())]
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in found], list("abcdef"))

    # every word of the texts ends an n-gram, so each block has rows
    rows = rows.select("shard", "packed").repartition(-(-words // per_block), "shard")
    stored = rows.mapInArrow(store, ", ".join(f"{c} long" for c in "abcdef"))
    return list(stored.agg(*(F.sum(c) for c in "abcdef")).first())


def store_levels(train: DataFrame, model: Model, work: Workspace, text: str) -> tuple[tuple[Level, ...], DataFrame]:
    """Count n-grams from the longest down to pairs. The levels from pairs up, and the rows that pairs
    leave."""
    levels, rows = [], texts_dealt(train, model, text)
    for width in range(model.order, 1, -1):
        left = work.table(store_shards(rows, model, width), f"left{width}")
        # one row for each shard
        found = left.where("packed is null").drop("packed").collect()
        of = [sum(r[name] for r in found) for name in ("ones", "twos", "threes", "fours")]
        levels.append(Level(discounts_of(*of), frozenset(r["shard"] for r in found)))
        rows = left.where("packed is not null")
    return tuple(levels[::-1]), rows


def train_model(spark: SparkSession, train: DataFrame, text: str = "text", order: int = ORDER) -> Model:
    """Count the texts of ``train`` and store the model, of n-grams of up to ``order`` words, in a new
    shared folder."""
    if not 2 <= order <= len(SHINGLE):
        raise ValueError(f"order {order} is not between 2 and {len(SHINGLE)}")
    work = Workspace(spark, "ngrams")
    folder = f"{work.path}/model"
    with shuffles_dropped(spark):
        words, size, tokens = count_words(train, work, text)
        bits, offsets = store_words(words, size, folder)
        shards = max(32, -(-tokens // TOKENS_PER_SHARD))
        per_block = min(WORDS_PER_BLOCK, max(1 << 13, 1 << powers_of_two(-(-size // 64))))
        model = Model(folder, bits, offsets, shards, per_block, tokens, order)
        if not tokens:
            return model
        # four a shard at most
        frequent = [r["word"] for r in words.where(F.col("n") > tokens // (4 * shards)).select("word").collect()]
        ids = ids_of(model, np.array(frequent, np.int64).view(np.uint64))
        model = replace(model, frequent=(*ids.tolist(), size))
        levels, rows = store_levels(train, model, work, text)
        *lower, more, types = store_predecessors(rows, model)
    low = discounts_of(*lower)
    rest = (low[0] * lower[0] + low[1] * lower[1] + low[2] * more) / types
    return replace(model, levels=levels, lower_discounts=low, types=types, lower_rest=rest)


# ---------------------------------------------------------------- scoring

SCORES = ("n_tokens", "n_known", "train_tokens", "base_score", "score")
SCORE_TYPES = (T.LongType(), T.LongType(), T.LongType(), T.DoubleType(), T.DoubleType())


def score_block(model: Model, hashes: np.ndarray, tokens: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    """For each text of a block: tokens, known tokens, and the two scores (base-10 logarithms)."""
    ids = ids_of(model, hashes)
    order = np.argsort(ids)
    counts, before = np.empty(len(ids), np.int64), np.empty(len(ids), np.int64)
    counts[order], before[order] = model.word_counts(ids[order]), model.predecessors(ids[order])
    base = np.log10((counts + 1) / (model.tokens + model.words + 1))
    chance = model.lower(before)[tokens]
    # an unknown word's id becomes the largest one, which no stored n-gram has
    grams = windows(ids[tokens], bounds, model.order, model.words)
    for width, level in enumerate(model.levels, 2):
        n, context = model.look_up(grams[:, -width:], level.filled)
        total, rest = context[:, 0], context[:, 1:] @ np.array(level.discounts)
        with np.errstate(divide="ignore", invalid="ignore"):
            upper = (np.maximum(n - discount(level.discounts, n), 0) + rest * chance) / total
        chance = np.where(total > 0, upper, chance)
    first = bounds[:-1]
    return [
        np.diff(bounds),
        np.add.reduceat((counts > 0)[tokens].astype(np.int64), first),
        np.add.reduceat(base[tokens], first),
        np.add.reduceat(np.log10(chance), first),
    ]


def score_texts(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """All rows and columns, with n_tokens, n_known, train_tokens, base_score and score.

    A null text is an empty one: its only token is the end. A word that training has not seen has the
    probability that is left for one unknown word; after a context that training has not seen, the next
    lower order is used alone. Columns
    named like the new ones are replaced.
    """
    docs = docs.drop(*(c for c in docs.columns if c.lower() in SCORES))
    schema = T.StructType([*docs.schema.fields, *(T.StructField(n, t) for n, t in zip(SCORES, SCORE_TYPES))])

    def score(batches):
        for batch in batches:
            found = [score_block(model, *block) for block in token_blocks(batch, text)]
            if found:
                n, known, base, own = (np.concatenate(x) for x in zip(*found))
                new = [n.astype(np.int64), known, np.full(len(n), model.tokens, np.int64), base, own]
                yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, new)], names=[*batch.schema.names, *SCORES])

    return docs.mapInArrow(score, schema)


def perplexity(score: Column, n_tokens: Column) -> Column:
    """Perplexity per token from a base-10 score."""
    return F.pow(F.lit(10.0), -score / n_tokens)


def score_held_out(spark: SparkSession, docs: DataFrame, text: str = "text", order: int = 2) -> DataFrame:
    """Learn from the documents that are not held out and score all of them."""
    docs = docs.drop(*(c for c in docs.columns if c.lower() == "held_out")).withColumn("held_out", held_out(F.col("doc_id")))
    model = train_model(spark, docs.where(~F.col("held_out")), text, order)
    return score_texts(docs, model, text)
