"""Each stage of the pipeline against a plain version over its own input."""

import collections
import math

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from opsgauge.llm import lines, quality, tiling
from opsgauge.llm.workspace import Workspace

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """The rows before the first stage and after each."""
    work, docs = Workspace(spark, "test"), spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [("documents", docs.collect())]
    for name, stage in corpus_pipeline.STAGES:
        docs = work.table(stage(spark, docs, sf_dir), name)
        out.append((name, docs.collect()))
    return out


def test_columns_and_run(spark, sf_dir, stages):
    assert all(list(rows[0].asDict()) == COLUMNS for _, rows in stages[:-1])
    assert list(stages[-1][1][0].asDict()) == [*COLUMNS, "ids", "decoded"]
    assert sorted(corpus_pipeline.run(spark, sf_dir).collect()) == sorted(stages[-1][1])


def test_quality_stage(spark, sf_dir, stages):
    before, after = stages[0][1], stages[1][1]
    docs, labels = (spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("documents", "labels"))
    model = quality.fit(quality.training_sample(docs, labels))
    assert sorted(after) == sorted(r for r in before if model.score(r.text) >= 0.3)
    quality_of = {r.doc_id: r.quality for r in labels.collect()}
    kept = {r.doc_id for r in after}
    good = [i for i, q in quality_of.items() if q == 1]
    assert sum(i in kept for i in good) > 0.95 * len(good)


def test_line_stage(stages):
    before, after = stages[1][1], stages[2][1]
    distinct = {(r.source, frozenset(x.strip(" \t\r") for x in r.text.split("\n")) - {""}) for r in before}
    pages, on = collections.Counter(source for source, _ in distinct), collections.Counter()
    for source, keys in distinct:
        on.update((source, x) for x in keys)
    bad = {k for k, n in on.items() if n > 1 and n > lines.RATIO * pages[k[0]]}
    clean = {r.doc_id: "\n".join(x for x in r.text.split("\n") if (r.source, x.strip(" \t\r")) not in bad) for r in before}
    assert {r.doc_id: (r.text, r.n_chars) for r in after} == {i: (t, len(t)) for i, t in clean.items()}


def test_line_stage_counts_copies_once(spark):
    texts = [f"own {k}\nmore {k}\n" + ("Home" if k < 20 else "end") for k in range(40)] + ["first\nsecond"] * 15 + ["second\nfirst"] * 5
    docs = spark.createDataFrame([(k, t, "en", "a", len(t)) for k, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r.text for r in corpus_pipeline.drop_line_boilerplate(spark, docs, "").collect()}
    assert got == {k: t.rpartition("\n")[0] if k < 40 else t for k, t in enumerate(texts)}


def test_near_duplicate_stage(stages, words, reach):
    before, after = stages[2][1], stages[3][1]
    sets = {}
    for r in before:
        w = words(r.text)
        sets[r.doc_id] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    ids = sorted(sets)
    links = [(a, b) for a in ids for b in ids if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    lowest = reach(ids, links)
    assert sorted(after) == sorted(r for r in before if lowest[r.doc_id] == r.doc_id)


def test_decontamination_stage(spark, sf_dir, stages):
    before, after = stages[3][1], stages[4][1]
    plain = lambda text: ["".join(c for c in w if c.isalnum()) for w in text.lower().split()]
    items = [[w for w in plain(r.text) if w] for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    numbers = collections.defaultdict(lambda: len(numbers) + 1)
    seeds = collections.defaultdict(set)
    coded = [[numbers[w] for w in item] for item in items]
    for k, item in enumerate(coded):
        for i in range(len(item) - 4):
            seeds[tuple(item[i : i + 5])].add(k)
    kept = []
    for r in before:
        text = [numbers[w] for w in plain(r.text) if w]
        near = {k for i in range(len(text) - 4) for k in seeds.get(tuple(text[i : i + 5]), ())}
        if all(tiling.coverage(coded[k], text) < tiling.COVERAGE for k in near):
            kept.append(r)
    assert sorted(after) == sorted(kept) and len(kept) < len(before)


def test_encoding_stage(stages):
    before, after = stages[4][1], stages[5][1]
    library = Tokenizer.from_file(corpus_pipeline.VOCABULARY)
    assert sorted(r[:5] for r in after) == sorted(tuple(r) for r in before)
    for r in after:
        assert r.ids == library.encode(r.text, add_special_tokens=False).ids and r.decoded == library.decode(r.ids, skip_special_tokens=False)


def test_stages_on_odd_rows(spark, sf_dir):
    rows = [
        (None, None, None, None, None), (1, None, "en", "a", 0), (2, "", None, "a", 0), (3, "one", "en", None, 3), (3, "one", "en", None, 3),
        (4, "x y " * 30_000, "en", "a", 120_000), (None, "one two", "en", "b", 7),
    ]
    docs = spark.createDataFrame([(*r, 1, "k") for r in rows], "doc_id long, text string, lang string, source string, n_chars long, id int, KEY string")
    for name, stage in corpus_pipeline.STAGES:
        for some in (docs, docs.limit(0)):
            out = stage(spark, some, sf_dir)
            assert out.columns[:7] == docs.columns, name
            got = out.collect()
            if name in ("line_dedup", "bpe_encoding"):
                assert len(got) == some.count()
            if name == "ngram_jaccard_join" and some is docs:
                assert sorted(((r.doc_id is None, r.doc_id or 0) for r in got)) == [(False, 1), (False, 2), (False, 3), (False, 4), (True, 0), (True, 0)]


def test_rows_without_id_are_judged_one_by_one(spark, sf_dir):
    """One contaminated row takes no other row with it; different texts of a kept id all stay."""
    passage = spark.read.parquet(f"{sf_dir}/benchmark.parquet").first()["text"]
    texts = [(None, f"before {passage} after"), (None, "a clean text of a few plain words"), (5, f"x {passage}"), (5, "another clean text with words of its own")]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in texts], schema)
    left = corpus_pipeline.drop_contaminated(spark, docs, sf_dir).collect()
    assert sorted(r.text for r in left) == sorted(t for _, t in texts[1::2])
    kept = corpus_pipeline.keep_one_of_each_group(spark, docs.union(docs.where("doc_id = 5")), sf_dir).collect()
    assert sorted(r.text for r in kept) == sorted(t for _, t in texts)


def test_scores_are_finite_for_any_text():
    model = quality.fit([("good text here " * 9, 1), ("bad!! text!! " * 9, 0)] * 40)
    assert all(0 <= model.score(t) <= 1 and math.isfinite(model.score(t)) for t in ("", "x", "\ud800"[:0], "y" * 10**6))
    assert np.isfinite(model.weights).all()
