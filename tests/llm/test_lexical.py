"""Lexical search against a plain ranking of every document; the query is compared with SQL in test_queries."""

import math
import random
import re
from collections import Counter

import pyarrow as pa
import pytest

from opsgauge.llm import lexical

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOW = {i: i + 32 for i in range(65, 91)}


def plain(docs, items, k):
    """Sorted rows (item_id, text, rank, doc_id, score)."""
    words = [(i, Counter(WORD.findall((t or "").translate(LOW)))) for i, t in docs]
    counted = [(i, c, sum(c.values())) for i, c in words if c]
    n, total = len(counted), sum(size for _, _, size in counted)
    df = Counter(w for _, c, _ in counted for w in c)
    out = []
    for item_id, text in set(items):
        asked, scores = set(WORD.findall((text or "").translate(LOW))), []
        for doc_id, c, size in counted:
            m = 50 + 50 * size * n // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * (10**9 * c[w] // (1000 * c[w] + 20 * m)) for w in asked if w in c)
            scores.append((-score, doc_id is None, doc_id or 0))
        found = sorted(s for s in scores if s[0] < 0)[:k]
        out += [(item_id, text or "", r + 1, None if missing else d, -s) for r, (s, missing, d) in enumerate(found)]
    return sorted(out, key=repr)


def ranked(spark, docs, items, k):
    d = spark.createDataFrame([(*x, 1, "y") for x in docs], "doc_id long, text string, n int, Terms string").repartition(5)
    q = spark.createDataFrame([(*x, 2) for x in items], "item_id long, text string, Block int")
    marks = {hash_of(t): t or "" for _, t in items}
    return sorted(((r.item_id, marks[r.mark], r.rank, r.doc_id, r.score) for r in lexical.search(spark, d, q, k).collect()), key=repr)


def hash_of(text):
    import hashlib

    return hashlib.md5((text or "").encode()).hexdigest()


@pytest.fixture(scope="module")
def tables():
    rng = random.Random(5)
    vocabulary = [f"w{k}" for k in range(300)] + ["Été", "日本", "x" * 90, "B2b"]
    some = lambda n: " ".join(rng.choice(vocabulary[: rng.choice((20, 304))]) for _ in range(n))
    docs = [(k, some(rng.randrange(0, 60))) for k in range(400)] + [(None, None), (3, ""), (7, "--- !"), (None, "w1 w2 w3 w3"), (None, "w1 w2 w3 w3")]
    docs += [(500 + k, "same text w5, w6; W7.") for k in range(40)] + [(7, docs[7][1]), (900, "w1 " * 50_000), (901, some(30_000))]
    rng.shuffle(docs)
    items = [(k, some(rng.randrange(1, 25))) for k in range(30)] + [(1, "w5 w6 w7"), (1, "w5 w6 w7"), (None, "W1 w3"), (50, None), (51, "nowhere"), (52, "w1")]
    return docs, items


@pytest.mark.parametrize("k", [1, 50])
@pytest.mark.parametrize("block_items", [256, 5])
def test_equals_plain_ranking(spark, tables, k, block_items, monkeypatch):
    """Also with items in many blocks."""
    monkeypatch.setattr(lexical, "BLOCK_ITEMS", block_items)
    assert ranked(spark, *tables, k) == plain(*tables, k)


def test_bounds_hold_where_terms_share_coordinates(tables, monkeypatch):
    docs, items = tables
    batch = pa.record_batch({"doc_id": pa.array([d for d, _ in docs], pa.int64()), "text": pa.array([t for _, t in docs], pa.string())})
    real = lexical.text_blocks
    squeezed = lambda *a: ((r, h & lexical.np.uint64(7 << 48 | 0xFFFF), b) for r, h, b in real(*a))
    monkeypatch.setattr(lexical, "text_blocks", squeezed)
    index = next(lexical.sketches(iter([batch])))
    for sketch, (_, text) in zip(index.column("sketch").to_pylist(), docs, strict=True):
        cells = {int(c["at"]): int(c["tf"]) for c in lexical.np.frombuffer(sketch, lexical.CELL)}
        counts = Counter(lexical.tokens(text or ""))
        for term, tf in counts.items():
            at = int(lexical.hashes_of([term])[0] >> lexical.np.uint64(48)) & 7
            assert cells[at] >= min(tf, lexical.MANY)


def test_empty_tables(spark, tables):
    docs, items = tables
    assert ranked(spark, [], items, 50) == [] and ranked(spark, docs, [], 50) == [] and ranked(spark, [(1, None)], [(1, "a")], 5) == []
    assert ranked(spark, docs[:3], [(1, "!"), (2, None)], 5) == []
