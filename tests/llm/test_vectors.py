"""Vector searches against brute force."""

import numpy as np

from tidepanel.llm import pivot_topk, rp_forest, vectors

SCHEMA = "vec_id long, embedding array<float>, score int, rank int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, 0) for i, v in rows], SCHEMA)


def odd_rows(rng, n, dim):
    rows = [(i, rng.standard_normal(dim).astype(float).tolist()) for i in range(n)]
    rows[7] = (7, rows[3][1])  # equal vectors: ties
    rows[11] = (11, rows[3][1])
    rows += [(n, None), (n + 1, [None] * dim), (n + 2, [float("nan")] * dim), (n + 3, [float("inf")] * dim), (n + 4, [0.0] * dim)]
    return [*rows, (n + 5, []), (n + 6, [1.0]), (None, [1.0] * dim), (5, rows[6][1])]  # another row of id 5


def test_pivot_search_is_exact(spark):
    rng = np.random.default_rng(4)
    rows = odd_rows(rng, 400, 6)
    q = pivot_topk.quantised(table(spark, rows))
    good = [(i, np.floor(1024 * np.float32(v).astype(float)).astype(int)) for i, v in rows if i is not None and v and len(v) == 6 and None not in v and np.isfinite(v).all()]
    got = pivot_topk.top_k(q, q.where("vec_id % 20 = 0"), k=10).collect()
    for query in {i for i, _ in good if i % 20 == 0}:
        v = next(v for i, v in good if i == query)
        want = sorted((-int(v @ w), i) for i, w in good if i != query)[:10]
        own = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == query)
        assert [(-s, i) for _, i, s in own] == want and [r for r, _, _ in own] == list(range(1, 11))
    few = pivot_topk.quantised(table(spark, rows[:4]))
    assert pivot_topk.top_k(few, few.where("vec_id = 0")).count() == 3
    assert pivot_topk.top_k(few.limit(0), few.limit(0)).count() == 0


def test_pivot_bounds_stop_early_and_hold():
    rng = np.random.default_rng(5)
    centres = rng.integers(-900, 900, (8, 16)).astype(float)
    rows = np.concatenate([c + rng.integers(-20, 20, (200, 16)) for c in centres])
    pivots = rows[rng.permutation(len(rows))[:16]]
    far = lambda x: np.sqrt(((x[:, None] - pivots[None]) ** 2).sum(2))
    squares, query = (rows**2).sum(1), rows[3]
    bounds = pivot_topk.upper_bounds(query, far(query[None])[0], squares, far(rows))
    assert (bounds >= rows @ query).all()
    ids = np.arange(len(rows))
    found, scores, seen = pivot_topk.best_of_block(ids, rows, squares, far(rows), 3, query, far(query[None])[0], 10)
    want = sorted((-int(s), int(i)) for i, s in zip(ids, rows @ query) if i != 3)[:10]
    assert [(-s, i) for i, s in zip(found.tolist(), scores.tolist())] == want
    assert seen < len(rows) / 2


def test_pivot_search_over_many_blocks(spark):
    rng = np.random.default_rng(9)
    centres = rng.integers(-900, 900, (8, 16))
    x = np.concatenate([c + rng.integers(-20, 20, (150, 16)) for c in centres])
    x[37] = x[31]  # ties across blocks
    rows = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(x)], "vec_id long, v array<double>")
    got = pivot_topk.top_k(rows, rows.where("vec_id % 20 = 0"), counts=True, rows_per_block=40).collect()
    evaluated = {r["query_id"]: r["evaluated"] for r in got}
    for q in range(0, len(x), 20):
        want = sorted((-int(s), i) for i, s in enumerate(x @ x[q]) if i != q)[:10]
        own = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q)
        assert [(-s, i) for _, i, s in own] == want and [r for r, _, _ in own] == list(range(1, 11))
    assert len(evaluated) == 60 and np.mean(list(evaluated.values())) < len(x) / 3


def test_blocks_hold_about_as_many_rows_as_asked(spark):
    sizes = [3, 0, 250, 40, 50, 20, 1]
    rows = spark.createDataFrame([(100 * c + i, c) for c, n in enumerate(sizes) for i in range(n)], "vec_id long, cell int")
    for shared, blocks in ((False, 8), (True, 6)):
        got = pivot_topk.in_blocks(rows, "block", 100, shared).groupBy("block").count().collect()
        assert sum(r["count"] for r in got) == sum(sizes) and max(r["count"] for r in got) < 150 and len(got) == blocks
    assert pivot_topk.in_blocks(rows.limit(0), "block", 100).count() == 0


def test_block_bounds_hold():
    rng = np.random.default_rng(10)
    for scale in (1, 300):
        x = rng.integers(-1000, 1000, (20, 1, 6)) + rng.integers(-scale, scale + 1, (20, 30, 6))
        flat = x.reshape(-1, 6).astype(float)
        pivots = pivot_topk.choose_pivots(flat, 5)
        far = lambda v: np.sqrt(((v[:, None] - pivots[None]) ** 2).sum(2))
        d = far(flat).reshape(20, 30, -1)
        for q in flat[::50]:
            assert (pivot_topk.block_bounds(q, far(q[None])[0], d.min(1), d.max(1)) >= (x @ q).max(1)).all()
    same = np.ones((5, 3))
    assert len(pivot_topk.choose_pivots(same, 4)) == 2 and len(pivot_topk.choose_pivots(same * 0, 4)) == 1


def test_large_components():
    big = np.array([[2.0**40, 1.0], [2.0**20, 3.0]])
    assert pivot_topk.products(big, np.array([2.0**20, 1.0])).tolist() == [2**60 + 1, 2**40 + 3]
    try:
        pivot_topk.products(big, np.array([2.0**40, 1.0]))
        raise AssertionError("no error")
    except OverflowError:
        pass


def test_forest_recall_and_order(spark):
    rng = np.random.default_rng(6)
    rows = odd_rows(rng, 1200, 16)
    used = vectors.usable(table(spark, rows), "vec_id", "embedding", zero=False)
    good = [(i, np.float32(v).astype(float)) for i, v in rows if i is not None and v and len(v) == 16 and None not in v and np.isfinite(v).all() and any(v)]
    assert used.count() == len(good)
    asked = {i for i, _ in good if i % 20 == 0}

    def run(share):
        out = {}
        for r in rp_forest.nearest(used, used.where("vec_id % 20 = 0"), k=20, share=share).collect():
            out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
        return {q: sorted(x) for q, x in out.items()}

    def want(query):
        v = next(v for i, v in good if i == query)
        return sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in good if i != query)[:20]

    part, full = run(rp_forest.SHARE), run(1.0)
    hits = [len({i for _, i in want(q)} & {i for _, i, _ in part[q]}) / 20 for q in asked]
    assert set(part) == asked and np.mean(hits) >= 0.9
    for q in asked:  # all leaves: exact, ties included
        assert [(i, round(s, 12)) for _, i, s in full[q]] == [(i, round(-s, 12)) for s, i in want(q)]
    assert rp_forest.nearest(used.limit(0), used.limit(0)).count() == 0
    one = used.where("vec_id in (1, 2)")
    assert rp_forest.nearest(one, one.where("vec_id = 1"), share=1.0).count() == 1


def test_forest_on_small_and_clustered_tables(spark):
    rng = np.random.default_rng(8)
    for n in (2, 5, 15, 25, 61, 121):
        x = rng.standard_normal((n, 64))
        df = vectors.usable(table(spark, [(i, v.tolist()) for i, v in enumerate(x)]), "vec_id", "embedding", zero=False)
        got = {}
        for r in rp_forest.nearest(df, df, k=20).orderBy("query_id", "rank").collect():
            got.setdefault(r["query_id"], []).append(r["vec_id"])
        s = np.float32(x).astype(float) @ np.float32(x).astype(float).T
        np.fill_diagonal(s, -np.inf)
        assert got == {i: list(np.argsort(-s[i], kind="stable")[: min(20, n - 1)]) for i in range(n)}, n
    # far-apart clusters: much less than all rows is scored, and the nearest are found
    centres = rng.standard_normal((40, 16)) * 10
    x = np.concatenate([c + rng.standard_normal((200, 16)) for c in centres])
    df = vectors.usable(table(spark, [(i, v.tolist()) for i, v in enumerate(x)]), "vec_id", "embedding", zero=False)
    forest = rp_forest.fit(df)
    leaf, scored, hits = forest.leaf_of(x), [], []
    counts = np.array([np.bincount(leaf[:, t], minlength=forest.leaves) for t in range(leaf.shape[1])])
    for i in range(0, len(x), 400):
        seen = forest.visit(x[i], 0.03, counts, 400)
        near = seen[np.arange(leaf.shape[1]), leaf].any(1)
        s = x @ x[i]
        s[i] = -np.inf
        scored.append(near.mean())
        hits.append(near[np.argsort(-s)[:20]].mean())
    assert np.mean(scored) < 0.3 and np.mean(hits) >= 0.9, (np.mean(scored), np.mean(hits))
