import numpy as np
import pytest

from opsgauge.llm import hnsw


def sample(seed=0, count=600, dim=16):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((count // 6, dim))
    near = np.repeat(centres[:40], 8, 0) + 0.08 * rng.standard_normal((320, dim))
    far = rng.standard_normal((count - 320, dim))
    return np.concatenate((near, far)).astype(np.float32)


def test_graph_finds_what_brute_force_finds():
    vectors = hnsw.unit(sample(1, 3000).astype(np.float64))
    graph = hnsw.Graph.build(vectors, np.arange(1, len(vectors) + 1))
    beam, recall = hnsw.audited_beam(graph, 0.95)
    q, node = hnsw.links_in(graph, vectors, beam, 0.95)
    wanted = hnsw.brute_links(vectors, vectors, 0.95)
    assert recall >= 0.99 and len(wanted & set(zip(q.tolist(), node.tolist()))) >= 0.99 * len(wanted)


def test_beams_widen_over_a_group_larger_than_the_beam():
    rng = np.random.default_rng(2)
    vectors = hnsw.unit(np.concatenate((np.ones((500, 8)) + 0.02 * rng.standard_normal((500, 8)), rng.standard_normal((300, 8)))))
    graph = hnsw.Graph.build(vectors, rng.integers(1, 2**60, 800))
    q, node = hnsw.links_in(graph, vectors, 16, 0.95)
    wanted = hnsw.brute_links(vectors, vectors, 0.95)
    assert len(wanted & set(zip(q.tolist(), node.tolist()))) >= 0.99 * len(wanted)


@pytest.mark.parametrize("per_shard", [hnsw.PER_SHARD, 40])
def test_links_equal_brute_force_with_odd_rows(spark, reach, per_shard):
    vectors = sample()
    rows = [(k, v.tolist()) for k, v in enumerate(vectors)]
    odd = [None, [], [0.0] * 16, [float("nan")] * 16, [None, *[1.0] * 15], [float("inf"), *[1.0] * 15], [-0.0] * 16]
    rows += [(1000 + k, v) for k, v in enumerate(odd)] + [(2000, vectors[3].tolist()), (2001, vectors[599].tolist()), (2002, [1.0, 2.0]), (2003, [2.0, 4.0])]
    rows += [(3, vectors[3].tolist()), (None, vectors[3].tolist())]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, key string, n int")
    out, audits = hnsw.near_vectors(spark, df, per_shard=per_shard)
    got = out.collect()
    assert len(got) == len(rows) and all(a.recall >= 0.99 for a in audits.collect())
    good = {i: np.array(v, np.float64) for i, v in rows if i is not None and (i < 1000 or i >= 2000)}
    ids, links = sorted(good), []
    for a in ids:
        for b in ids:
            x, y = good[a], good[b]
            if a < b and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.95:
                links.append((a, b))
    want, count = reach(ids, links), dict.fromkeys(ids, 0)
    for pair in links:
        for i in pair:
            count[i] += 1
    found = total = 0
    for r in got:
        if r.vec_id in good:
            found, total = found + r.n_links, total + count[r.vec_id]
            assert r.n_links <= count[r.vec_id] and r.component_id >= want[r.vec_id] and r.kept == (r.vec_id == r.component_id)
        else:
            assert (r.n_links, r.component_id, r.kept) == (0, r.vec_id, True)
    assert found >= 0.99 * total and sum(r.component_id == want.get(r.vec_id, r.vec_id) for r in got) >= 0.99 * len(got)


def test_no_vectors(spark):
    df = spark.createDataFrame([(1, None), (2, [])], "vec_id long, embedding array<float>")
    assert sorted(tuple(r) for r in hnsw.near_vectors(spark, df)[0].collect()) == [(1, 0, 1, True), (2, 0, 2, True)]
    assert hnsw.near_vectors(spark, df.limit(0))[0].count() == 0
