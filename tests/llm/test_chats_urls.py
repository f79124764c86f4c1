"""Snapshot collapse and url filter on odd rows; the rest is compared with SQL in test_queries."""

import math
from collections import defaultdict

import pytest

from opsgauge.llm import chats, urls
from opsgauge.llm.workspace import Workspace


def collapse(spark, rows, extra=True):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, slot int, h string")
    return sorted(tuple(r) for r in chats.collapse_snapshots(df).collect())


def turn(role, text):
    return f"<|im_start|>{role}\n{text}<|im_end|>\n"


def test_prefixes_and_copies_go(spark):
    full = [("user", "a"), ("assistant", "b"), ("user", None), ("assistant", "")]
    rows = [(c, t, *full[t]) for c, n in ((1, 2), (2, 4), (3, 4), (4, 1)) for t in range(n)]
    rows += [(5, 0, "user", "a"), (5, 1, "assistant", "c"), (6, 0, "assistant", "a"), (7, 7, "user", "a")]
    # turns are compared by their place; null and empty texts differ
    rows += [(8, t + 3, *full[t]) for t in range(3)] + [(9, 0, "user", "a"), (9, 1, "assistant", "b"), (9, 2, "user", "")]
    rows += [(None, 0, "user", "a"), (10, None, "user", "a"), (2, 0, "user", "a")]
    got = collapse(spark, rows)
    assert [g[0] for g in got] == [2, 5, 6, 9]
    assert got[0][2:] == (4, "".join(turn(r, t or "") for r, t in full))


def test_long_conversations_are_rendered_in_parts(spark):
    rows = [(c, t, "user", f"{t}") for c, n in ((1, 700), (2, 699), (3, 701)) for t in range(n)] + [(2, 699, "user", "other")]
    got = collapse(spark, rows)
    assert [(g[0], g[1], g[2]) for g in got] == [(2, 0, 700), (2, 1, 700), (2, 2, 700), (3, 0, 701), (3, 1, 701), (3, 2, 701)]
    assert "".join(g[3] for g in got if g[0] == 3) == "".join(turn("user", t) for t in range(701))


def test_no_conversations(spark):
    assert chats.collapse_snapshots(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


RULES = (urls.Rule("allow", "org", "/"), urls.Rule("block", "a.org", "/es/"), urls.Rule("allow", "com", "/fr/"), urls.Rule("block", "com", "/de/"))


def judge(spark, listed, rules=RULES):
    df = spark.createDataFrame([(k, u, "x", 1) for k, u in enumerate(listed)], "page_id long, url string, Host string, gram int")
    return {r.page_id: r for r in urls.filter_urls(df, rules, Workspace(spark, "t")).collect()}


@pytest.mark.parametrize(
    "url, host, path, rule",
    [
        ("http://A.org/es/1?x#y", "a.org", "/es/1", "a.org/es/"),
        ("x://sub.a.ORG/es", "sub.a.org", "/es", "org/"),
        ("http://ba.org/es/", "ba.org", "/es/", "org/"),
        ("http://org", "org", "", None),
        ("http://org?/", "org", "", None),
        ("http://É.org#/es/", "É.org", "", None),
        ("http:///de/", "", "/de/", None),
        ("a://b://c", "b:", "//c", None),
        ("nothing", "", "", None), ("", "", "", None), (None, "", "", None), ("://", "", "", None),
        ("http://x.com/fr/\n?", "x.com", "/fr/\n", "com/fr/"),
    ],
)
def test_host_path_and_rule(spark, url, host, path, rule):
    row = judge(spark, [url])[0]
    assert (row.host, row.path, row.rule) == (host, path, rule)
    assert row.verdict == {"a.org/es/": "block", "org/": "allow", "com/fr/": "allow"}.get(rule, row.verdict)
    assert row.verdict in ("allow", "block") and row.gram == 1


def plain_scores(listed):
    """The models the plain way, over (url, class)."""
    padded = [("\2\2\2" + u.lower() + "\3", c) for u, c in listed]
    counts = {c: defaultdict(lambda: defaultdict(int)) for c in ("allow", "block")}
    for text, c in padded:
        for end in range(4, len(text) + 1):
            for k in range(1, 5):
                if c:
                    counts[c][text[end - k : end - 1]][text[end - 1]] += 1

    def chance(c, gram):
        p = 1 / 256
        for k in range(1, 5):
            seen = counts[c][gram[4 - k : 3]]
            n, kinds = sum(seen.values()), len(seen)
            p = (seen.get(gram[3], 0) + kinds * p) / (n + kinds) if n else p
        return p

    raw = []
    for text, _ in padded:
        grams = [text[i : i + 4] for i in range(len(text) - 3)]
        raw.append(sum(math.log(chance("allow", g)) - math.log(chance("block", g)) for g in grams) / len(grams))
    mean = {c: [r for r, (_, k) in zip(raw, listed) if k == c] for c in ("allow", "block")}
    middle = sum(sum(x) / len(x) for x in mean.values()) / 2
    return [r - middle for r in raw]


def test_scores_equal_plain_models(spark):
    listed = [f"http://h{k % 3}.com/{('fr', 'de', 'en')[k % 3]}/{k * 7919 % 97}" for k in range(60)] + ["http://q/fr", "", "http://q/de"]
    listed += listed[:5]
    kind = lambda u: "allow" if ".com/fr/" in u else "block" if ".com/de/" in u else None
    want = plain_scores([(u, kind(u)) for u in listed])
    for k, row in judge(spark, listed, RULES[2:]).items():
        assert row.score == pytest.approx(want[k], abs=1e-8)
        assert row.verdict == (kind(listed[k]) or ("allow" if want[k] >= 0 else "block"))


def test_no_pages_and_no_rules(spark):
    empty = spark.createDataFrame([], "page_id long, url string")
    assert urls.filter_urls(empty, RULES, Workspace(spark, "t")).count() == 0
    assert {r.verdict for r in judge(spark, ["http://a/b", None], ()).values()} == {"allow"}


def test_main_path_is_native(spark):
    df = spark.createDataFrame([(1, 0, "user", "a")], "conv_id long, turn long, role string, text string")
    plan = chats.collapse_snapshots(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
