"""Conversation repair against an exhaustive search; the query is compared with SQL in test_queries."""

import hashlib
import heapq
import random
import re

import pytest

from opsgauge.llm import repair

SHAPE = re.compile(r"(s?(ua)+)?")
SCHEMA = "conv_id long, turn long, role string, text string, KEY int, audit string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)


def cheapest(rows):
    """Edits by a search over (cost, audit, output) in order of cost: rows are (role, text, fault)."""
    heap, seen = [(0, "", 0, ())], set()
    while heap:
        cost, audit, at, out = heapq.heappop(heap)
        initials = "".join(r[:1] for r, _ in out)
        if at == len(rows) and SHAPE.fullmatch(initials):
            return cost, audit, out
        if (at, initials) in seen or not SHAPE.fullmatch(initials + "ua") and not SHAPE.fullmatch(initials + "a"):
            continue
        seen.add((at, initials))
        for role in ("user", "assistant"):
            if len(out) < 2 * len(rows) + 3:
                heapq.heappush(heap, (cost + 5, audit + "I", at, (*out, (role, ""))))
        if at < len(rows):
            role, text, fault = rows[at]
            heapq.heappush(heap, (cost + 2, audit + "D", at + 1, out))
            if fault not in ("blank", "duplicate"):
                more = 5 if fault else 0
                if role[:1] in ("s", "u", "a"):
                    heapq.heappush(heap, (cost + more, audit + "K", at + 1, (*out, (role, text))))
                for new in ("user", "assistant"):
                    heapq.heappush(heap, (cost + more + 1, audit + "R", at + 1, (*out, (new, text))))
    raise AssertionError


def plain(rows):
    """The summary of one conversation's rows (turn, role, text), all there."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
    seen, judged = set(), []
    for _, role, text in rows:
        bare = text.rstrip(" \t\n\x0b\x0c\r")
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
        seen.add((role, text))
        judged.append((role, text, fault))
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:], strict=False)]
    cost, audit, out = cheapest(judged)
    digest = hashlib.sha256("\n".join(f"{r}:{x}" for r, x in out).encode()).hexdigest()
    counts = [sum(f == name for _, _, f in judged) for name in repair.FAULTS]
    return (gaps, *counts, sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, digest), out


def random_rows(seed):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", None, "", "User"]
    texts = ["Yes.", "No!", "cut", "", " \n", None, "What?", "a.", "b. ", "Eh?\x0b", "é", "x" * 3000 + "."]
    return [(rng.choice([None, *range(9)]), rng.choice(roles), rng.choice(texts)) for _ in range(rng.randrange(0, 8))]


@pytest.mark.parametrize("block_rows", [repair.BLOCK_ROWS, 2])
def test_equals_search(spark, block_rows):
    """Also with numbers that go to files after every second row."""
    convs = {k: random_rows(k) for k in range(150)}
    convs[150] = [(0, "system", "Go."), (1, "user", "Hi."), (2, "assistant", "Ho."), (2, "assistant", "Ho."), (7, "user", "end.")]
    rows = [(k, *r) for k, rs in convs.items() for r in rs]
    df = frame(spark, rows).repartition(7)
    found = {int(r.key): r for r in repair.audits(spark, df, block_rows).collect()}
    for k, rs in convs.items():
        if rs:
            want = plain(rs)[0]
            got = found[k]
            assert (got.gaps, got.blank, got.duplicate, got.truncated, got.illegal, got.cost, got.audit) == want[:-1], (k, rs)
    if block_rows > 2:
        got = {r.conv_id: tuple(r)[1:] for r in repair.repair_summary(spark, df).collect()}
        assert got == {k: plain(rs)[0] for k, rs in convs.items() if rs}
        turns = sorted((r.conv_id, r.place, r.role, r.text) for r in repair.repair_turns(spark, df).collect())
        assert turns == sorted((k, p, *x) for k, rs in convs.items() if rs for p, x in enumerate(plain(rs)[1]))


def test_long_conversation(spark):
    """Rows of one conversation over many Arrow batches and files."""
    rows = [(5, t, ("user", "assistant")[t % 2], f"{t}.") for t in range(30_000) if t % 1000]
    rows += [(None, t, "user", "x" * 100_000 + ("." if t else "")) for t in range(2)]
    got = {r.conv_id: r for r in repair.repair_summary(spark, frame(spark, rows)).collect()}
    assert repair.audits(spark, frame(spark, rows), 1000).where("known").first().audit == got[5].audit
    # without turn 0 the first row is an assistant's, and each missing turn leaves two in a row
    assert (got[5].gaps, got[5].illegal, got[5].cost, len(got[5].audit)) == (29, 29, 60, 29_970)
    assert (got[None].truncated, got[None].illegal, got[None].cost, got[None].audit) == (1, 1, 4, "DD")


def test_damage(spark):
    import zlib

    rows = [(c, t, "assistant", "One. Two! Three?") for c in (1, 2, None) for t in (*range(60), None)]
    got = {}
    for r in repair.damage(frame(spark, rows)).collect():
        got.setdefault((r.conv_id, r.turn), []).append((r.role, r.text, r.gone))
    text = lambda v: " " if v is None else str(v)
    whole = ("assistant", "One. Two! Three?", False)
    kinds = {
        0: [(*whole[:2], True)], 1: [("assistant", "", False)], 2: [("assistant", "One Two Three", False)],
        3: [whole, whole], 4: [("user", "One. Two! Three?", False)],
    }
    assert got == {(c, t): kinds.get(zlib.crc32(f"{text(c)}:{text(t)}".encode()) % 20, [whole]) for c, t, _, _ in rows}


def test_nothing_left_and_no_rows(spark):
    empty = frame(spark, []).limit(0)
    assert repair.repair_summary(spark, empty).count() == 0 and repair.repair_turns(spark, empty).count() == 0
    rows = frame(spark, [(1, 0, "user", "Hi."), (2, 0, None, None)]).selectExpr("*", "conv_id = 1 AS gone")
    got = {r.conv_id: tuple(r)[1:] for r in repair.repair_summary(spark, rows).collect()}
    none = hashlib.sha256(b"").hexdigest()
    assert got == {1: (0, 0, 0, 0, 0, 0, "", none), 2: (0, 1, 0, 0, 0, 2, "D", none)}
