"""Documents joined by the Jaccard similarity of their word shingles, through a token-group matrix.

1. Equal shingle sets are one class; one text of each goes on.
2. Two sets of similarity t share k tokens among the first n - ceil(t n) + k tokens of each, in any
   one order of all tokens; k is about a tenth of the size. Tokens that occur in many texts come last
   in that order. Texts of whose beginning fewer than k tokens occur in another text's go no further.
3. Each token's texts are compared with one centre: the one whose tokens are shared most, then the
   ones that have most links. That joins most of a group of near copies with a few comparisons a text.
4. Texts are partitioned into groups of similar ones (of one component so far, or with one token that
   many share), of about ``GROUP_TOKENS`` tokens at most. The matrix says which groups have a token; with it each text finds
   groups of other components that share k tokens of its beginning. A group's token union bounds the
   overlap with any of its members; a group is opened, and its members compared, only if the bound
   reaches what the text needs.
5. Components of all links.

No pair of texts that could be linked is skipped but those that are in one component already.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opsgauge.llm.components import connected_components
from opsgauge.llm.words import shingle_hashes, text_blocks
from opsgauge.llm.workspace import Workspace

WIDTH = 5
PERCENT = 80
GROUP_TOKENS = 1 << 15
ASKED_AT_ONCE = 1 << 8
STAR_TURNS = 3
FREQUENT = 1 << 16
LEAST_FREQUENT = 16
GATHER = 1 << 21


def needed(n: np.ndarray | int, percent: int = PERCENT):
    """The overlap with a set of n tokens without which no similarity reaches the threshold."""
    return (percent * n + 99) // 100


def extra(n):
    """k: how many shared tokens the beginning of a set of n tokens is made to hold."""
    return 1 + n // 10


def least_shared(n: Column, percent: int) -> Column:
    """The smallest k of all sets that a set of n tokens can be similar to."""
    return 1 + F.floor(F.floor((percent * n + 99) / 100) / 10)


def similar(overlap: Column, n: Column, m: Column, percent: int = PERCENT) -> Column:
    # the overlap stands here once, as Spark computes it wherever it stands
    return (100 + percent) * overlap.cast("long") >= percent * (n.cast("long") + m)


def sizes_fit(n: Column, m: Column, percent: int = PERCENT) -> Column:
    return 100 * F.least(n, m) >= percent * F.greatest(n, m)


def token_sets(batch: pa.RecordBatch, text: str, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """Row and sorted distinct shingle hashes of each text of a batch."""
    for row, words, bounds in text_blocks(batch.column(batch.schema.get_field_index(text))):
        for k in range(len(bounds) - 1):
            yield row + k, np.unique(shingle_hashes(words[bounds[k] : bounds[k + 1]], width))


KEYS = "id long, n long, key binary, tokens array<long>, counts array<long>"


def set_keys(docs: DataFrame, width: int) -> DataFrame:
    """(id, n, key): size of each text's set and a 128-bit digest of it (null where it is empty). In
    rows of their own (n is null), tokens that several texts of a task have, and how many: counted
    over all texts, about two million tokens at a time."""
    lists = pa.list_(pa.int64())
    schema = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("key", pa.binary()), ("tokens", lists), ("counts", lists)])

    def keys(batches):
        held, size = [], 0
        for batch in batches:
            n, key = [], []
            for _, tokens in token_sets(batch, "text", width):
                n.append(len(tokens))
                key.append(hashlib.blake2b(tokens.tobytes(), digest_size=16).digest() if len(tokens) else None)
                held.append(tokens)
                size += len(tokens)
                if size >= GATHER:
                    yield repeated(held)
                    held, size = [], 0
            none = pa.nulls(len(n), lists)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(n, pa.int64()), pa.array(key, pa.binary()), none, none], schema=schema)
        if held:
            yield repeated(held)

    def repeated(held):
        tokens, counts = np.unique(np.concatenate(held), return_counts=True)
        often = counts > 1
        found = [pa.array([tokens[often].view(np.int64)], lists), pa.array([counts[often].astype(np.int64)], lists)]
        return pa.RecordBatch.from_arrays([pa.nulls(1, f.type) for f in schema][:3] + found, schema=schema)

    return docs.select("id", "text").mapInArrow(keys, KEYS)


def frequent_tokens(keys: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Tokens that come last in the order, and their places: at most ``FREQUENT`` of those that most
    texts have. The choice bears on the work to do, never on what is found."""
    counted = keys.where("n IS NULL").select(F.explode(F.arrays_zip("tokens", "counts")).alias("t"))
    counted = counted.groupBy(F.col("t.tokens").alias("token")).agg(F.sum("t.counts").alias("n"))
    top = counted.where(F.col("n") >= LEAST_FREQUENT).orderBy(F.desc("n"), "token").limit(FREQUENT).collect()
    tokens = np.array([r["token"] for r in top], np.int64).view(np.uint64)
    order = np.argsort(tokens)
    # the most frequent one is last of all
    return tokens[order], (len(top) - np.arange(len(top)))[order].astype(np.int64)


def prefix_postings(docs: DataFrame, width: int, percent: int, frequent: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """(token, id): the beginning of each text's set. A set that repeats in a task is given once."""
    common, places = frequent

    def postings(batches):
        seen = set()
        for batch in batches:
            ids = batch.column("id").to_numpy(zero_copy_only=False)
            out, owner, size = [], [], 0
            for row, tokens in token_sets(batch, "text", width):
                if not len(tokens) or (key := hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()) in seen:
                    continue
                seen.add(key)
                take = min(len(tokens), len(tokens) - needed(len(tokens), percent) + extra(len(tokens)))
                if len(common):
                    at = np.minimum(np.searchsorted(common, tokens), len(common) - 1)
                    late = np.where(common[at] == tokens, places[at], 0)
                    tokens = tokens[np.argsort(late, kind="stable")]
                out.append(tokens[:take])
                owner.append(np.full(take, ids[row], np.int64))
                size += take
                if size >= GATHER:
                    yield rows(out, owner)
                    out, owner, size = [], [], 0
            if out:
                yield rows(out, owner)

    def rows(out, owner):
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(out).view(np.int64)), pa.array(np.concatenate(owner))], ["token", "id"]
        )

    return docs.select("id", "text").mapInArrow(postings, "token long, id long")


def stored_sets(docs: DataFrame, width: int) -> DataFrame:
    """(id, tokens): the whole sets, as signed numbers."""

    def sets(batches):
        for batch in batches:
            found = [tokens for _, tokens in token_sets(batch, "text", width)]
            ends = np.cumsum([0, *map(len, found)])
            values = np.concatenate(found).view(np.int64) if found else np.zeros(0, np.int64)
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))
            yield pa.RecordBatch.from_arrays([batch.column("id"), lists], ["id", "tokens"])

    return docs.select("id", "text").mapInArrow(sets, "id long, tokens array<long>")


def overlap(a: str, b: str) -> Column:
    return F.size(F.array_intersect(a, b))


def compared(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (a, b) that are similar."""
    one = sets.select(F.col("id").alias("a"), F.col("tokens").alias("ta"))
    two = sets.select(F.col("id").alias("b"), F.col("tokens").alias("tb"))
    both = pairs.join(one, "a").join(two, "b")
    return both.where(similar(overlap("ta", "tb"), F.size("ta"), F.size("tb"), percent)).select("a", "b")


def star_pairs(postings: DataFrame, weights: DataFrame, percent: int, work: Workspace, turn: int) -> DataFrame:
    """(a, b): each token's texts with its centre, the text of the largest weight (id, w)."""
    weighted = postings.join(weights, "id", "left")
    centres = weighted.groupBy("token").agg(F.max(F.struct("w", "id", "n")).alias("c"))
    centres = work.table(centres.select("token", F.col("c.id").alias("b"), F.col("c.n").alias("m")), f"centres-{turn}")
    pairs = postings.join(centres, "token").where((F.col("id") != F.col("b")) & sizes_fit(F.col("n"), F.col("m"), percent))
    return pairs.select(F.least("id", "b").alias("a"), F.greatest("id", "b").alias("b")).distinct()


def star_links(postings: DataFrame, sets: DataFrame, percent: int, work: Workspace) -> DataFrame:
    """Links (a, b) that comparisons with centres find: first with texts whose tokens most others have,
    then twice with those that have most links so far."""
    lists = work.table(postings.groupBy("token").agg(F.count(F.lit(1)).alias("k")), "lists")
    weights = postings.join(lists, "token").groupBy("id").agg(F.avg("k").alias("w"))
    done = links = None
    for turn in range(STAR_TURNS):
        pairs = star_pairs(postings, weights, percent, work, turn)
        if done is not None:
            pairs = pairs.join(done, ["a", "b"], "left_anti")
        pairs = work.table(pairs, f"star-pairs-{turn}")
        found = work.table(compared(pairs, sets, percent), f"star-links-{turn}")
        done, links = (pairs, found) if done is None else (done.union(pairs), links.union(found))
        ends = links.select(F.col("a").alias("id")).union(links.select(F.col("b").alias("id")))
        weights = ends.groupBy("id").agg(F.count(F.lit(1)).cast("double").alias("w"))
    return links


def grouped(postings: DataFrame, sizes: DataFrame, work: Workspace) -> DataFrame:
    """(token, id, n, comp, size, g): postings of tokens that more than one component has, with the
    component's size and the text's group."""
    spread = postings.groupBy("token").agg(F.count(F.lit(1)).alias("k"), F.min("comp").alias("x"), F.max("comp").alias("y"))
    mixed = work.table(spread.where("x <> y").select("token", "k"), "mixed")
    open_ = work.table(postings.join(mixed, "token").join(sizes, "comp"), "open")
    # components are split evenly; single texts are grouped by the token they share with most others
    keys = open_.groupBy("id", "comp", "size").agg(F.max(F.struct("k", "token")).alias("r"), F.max("n").alias("n"))
    key = F.when(F.col("size") > 1, F.col("comp")).otherwise(F.col("r.token"))
    keys = work.table(keys.select("id", "n", (F.col("size") > 1).alias("joined"), key.alias("key")), "keys")
    parts = keys.groupBy("joined", "key").agg(F.ceil(F.sum("n") / GROUP_TOKENS).alias("parts"))
    group = F.xxhash64("joined", "key", F.pmod(F.xxhash64("id"), F.col("parts")))
    groups = work.table(keys.join(parts, ["joined", "key"]).select("id", group.alias("g")), "groups")
    return work.table(open_.join(groups, "id").select("token", "id", "n", "comp", "size", "g"), "grouped")


def asked_groups(queries: DataFrame, sets: DataFrame, groups: DataFrame, work: Workspace) -> DataFrame:
    """Queries (q, qc, h) with their tokens ``tq`` and the groups ``h`` that they ask.

    Both sides are shuffled: sets of similar texts are small as files and large in memory, so a table of
    them is not broadcast for its size. The queries of a group are dealt in parts of about
    ``ASKED_AT_ONCE``, so that a group that many ask is opened by many tasks.
    """
    parts = queries.groupBy("h").agg(F.ceil(F.count(F.lit(1)) / ASKED_AT_ONCE).alias("parts"))
    parts = work.table(parts, "parts-of-groups")
    asking = queries.join(sets.hint("merge"), "q").join(parts, "h")
    asking = asking.withColumn("part", F.pmod(F.xxhash64("q"), F.col("parts"))).drop("parts")
    copies = groups.join(parts, "h").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    return asking.join(copies.drop("parts").hint("merge"), ["h", "part"])


def opened_links(postings: DataFrame, sets: DataFrame, percent: int, work: Workspace) -> DataFrame:
    """Links (a, b) between components that the groups give."""
    members = postings.select("g", "id", "n", "comp", "size").distinct().join(sets, "id")
    matrix = postings.groupBy("token", F.col("g").alias("h")).agg(F.min("comp").alias("gc"), F.max("size").alias("gs"))
    matrix = work.table(matrix, "tokens-of-groups")
    # the smaller component asks; single texts ask single texts both ways
    single = F.col("size") == 1
    smaller = (F.col("size") < F.col("gs")) | ((F.col("size") == F.col("gs")) & (single | (F.col("comp") < F.col("gc"))))
    queries = postings.join(matrix, "token").where(F.when(F.col("g") == F.col("h"), single).otherwise(smaller))
    queries = queries.groupBy(F.col("id").alias("q"), F.col("comp").alias("qc"), "n", "h").agg(F.count(F.lit(1)).alias("k"))
    queries = work.table(queries.where(F.col("k") >= least_shared(F.col("n"), percent)).select("q", "qc", "h"), "queries")
    groups = members.groupBy(F.col("g").alias("h")).agg(
        F.array_distinct(F.flatten(F.collect_list("tokens"))).alias("union"),
        F.collect_list(F.struct("id", "comp", "tokens")).alias("members"),
    )
    groups = work.table(groups, "unions")
    asked = asked_groups(queries, sets.select(F.col("id").alias("q"), F.col("tokens").alias("tq")), groups, work)
    qualifies = 100 * overlap("tq", "union") >= percent * F.size("tq")
    found = F.filter(
        "members",
        lambda m: (m["comp"] != F.col("qc"))
        & sizes_fit(F.size("tq"), F.size(m["tokens"]), percent)
        & similar(F.size(F.array_intersect("tq", m["tokens"])), F.size("tq"), F.size(m["tokens"]), percent),
    )
    found = F.transform(found, lambda m: m["id"])
    return asked.where(qualifies).select(F.col("q").alias("a"), F.explode(found).alias("b"))


def components(spark: SparkSession, docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, name: str = "jaccard") -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row of ``docs`` (doc_id, text; more are ignored).

    Words are runs of bytes other than blanks, with A-Z lower-cased; a text's set has its distinct
    runs of ``width`` words, or the whole sequence where it has fewer. Texts without words have an
    empty set and link with nothing. Documents link if their Jaccard similarity is ``percent`` or
    more. Rows with one doc_id are one document; a row without one links with nothing, and its
    component_id is null.
    """
    work = Workspace(spark, name)
    docs = docs.select(F.col("doc_id").cast("long").alias("id"), "text")
    counted = work.table(set_keys(docs, width), "keys-of-sets")
    keys = counted.where("n IS NOT NULL").select("id", "n", "key")
    linkable = keys.where("key IS NOT NULL AND id IS NOT NULL")
    classes = work.table(linkable.groupBy("key").agg(F.min("id").alias("rep")), "classes")
    members = work.table(linkable.join(classes, "key").select("id", "n", "rep").distinct(), "members")

    identified = docs.where("id IS NOT NULL")
    all_postings = work.table(prefix_postings(identified, width, percent, frequent_tokens(counted)), "all-postings")
    shared = all_postings.groupBy("token").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("token")
    shared = work.table(shared, "shared")
    of_docs = work.table(all_postings.join(shared, "token", "left_semi"), "of-docs")
    # an id with several texts has several sets; the class of each is that of its size and id
    postings = of_docs.join(members, "id").select("token", F.col("rep").alias("id"), "n").distinct()
    postings = work.table(postings, "of-classes")
    for turn in range(3):
        several = postings.groupBy("token").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("token")
        postings = postings.join(work.table(several, f"several-{turn}"), "token", "left_semi")
        enough = postings.groupBy("id").agg(F.count(F.lit(1)).alias("k"), F.min("n").alias("n"))
        enough = enough.where(F.col("k") >= least_shared(F.col("n"), percent)).select("id")
        postings = work.table(postings.join(work.table(enough, f"enough-{turn}"), "id", "left_semi"), f"postings-{turn}")

    wanted = work.table(postings.select("id").distinct(), "wanted")
    sets = work.table(stored_sets(identified.join(wanted, "id", "left_semi"), width), "sets")
    links = star_links(postings, sets, percent, work)
    comps = connected_components(links, work, "first")
    in_comps = wanted.join(comps, "id", "left").select("id", F.coalesce("component", "id").alias("comp"))
    in_comps = work.table(in_comps, "comps")
    sizes = work.table(in_comps.groupBy("comp").agg(F.count(F.lit(1)).alias("size")), "sizes")
    tagged = work.table(postings.join(in_comps, "id"), "tagged")
    more = work.table(opened_links(grouped(tagged, sizes, work), sets, percent, work), "opened-links")
    final = connected_components(links.union(more), work, "all")
    # ids of one document's several texts are linked through the document
    of_class = members.join(final.select(F.col("id").alias("rep"), "component"), "rep", "left")
    of_class = of_class.select("id", F.coalesce("component", "rep").alias("component"))
    lowest = work.table(of_class.groupBy("id").agg(F.min("component").alias("component")), "of-documents")
    out = keys.select("id", "n").join(lowest, "id", "left")
    return out.select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id")
    )
