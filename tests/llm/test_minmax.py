"""Near duplicates against all pairs."""

import random
import re

import numpy as np
import pytest

from tidepanel.llm import minmax
from tidepanel.llm.components import components


def shingles(text, k):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def brute(rows, k, percent=80):
    sets = {}
    for i, t in rows:
        if i is not None:
            sets.setdefault(i, []).append(shingles(t, k))
    label = {i: i for i in sets}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            if any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]):
                x, y = sorted((find(a), find(b)))
                label[y] = x
    return {i: find(i) for i in ids}


def corpus(rng):
    words = [f"{a}{b}" for a in ("Ka", "lo", "mi", "É", "ñu") for b in ("ra", "te", "zu", "ï", "so", "pe")]
    rows = []
    for size in (3, 12, 40, 40, 120):
        base = rng.choices(words, k=size)
        rows.append(base)
        for _ in range(14):
            rows.append([w if rng.random() > 0.05 else rng.choice(words) + str(rng.random())[:5] for w in base])
        # a chain: each differs a little from the one before
        link = base
        for _ in range(6):
            at = rng.randrange(size)
            link = link[:at] + [f"new{rng.random()}"] + link[at + 1 :]
            rows.append(link)
    return [(i, " ".join(r)) for i, r in enumerate(rows)]


@pytest.mark.parametrize("k", [2, 5])
def test_components_equal_all_pairs(spark, k):
    rng = random.Random(8)
    rows = corpus(rng)
    n = len(rows)
    rows += [(n, None), (n + 1, ""), (n + 2, " \t\n"), (n + 3, "One"), (n + 4, "one"), (n + 5, "one two"), (n + 6, rows[3][1].upper()), (n + 7, rows[3][1] + " \n ")]
    rng.shuffle(rows)
    df = spark.createDataFrame([(i, t, 1, [1], 0) for i, t in rows], "doc_id long, text string, n_shingles int, bands array<int>, component_id int")
    got = {r["doc_id"]: r for r in minmax.near_duplicates(df, words=k).collect()}
    want = brute(rows, k)
    assert {i: r["component_id"] for i, r in got.items()} == want
    for i, t in rows:
        assert got[i]["n_shingles"] == len(shingles(t, k)) and got[i]["kept"] == (want[i] == i)


def test_odd_ids(spark):
    df = spark.createDataFrame(
        [(None, "a b c d"), (None, "a b c d"), (3, "a b c d"), (5, "a b c d"), (5, "a b c d"), (9, "x y"), (5, "x y"), (-2, "q r")], "doc_id long, text string"
    )
    rows = [(r["doc_id"], r["component_id"], r["kept"]) for r in minmax.near_duplicates(df, words=2).collect()]
    assert sorted(rows, key=str) == sorted(
        [(None, None, True), (None, None, True), (3, 3, True), (5, 3, False), (5, 3, False), (5, 5, True), (9, 5, False), (-2, -2, True)], key=str
    )
    assert minmax.near_duplicates(df.limit(0)).count() == 0


def test_signature_is_unbiased():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 62, 800, dtype=np.uint64)
    b = np.concatenate([a[:600], rng.integers(0, 1 << 62, 200, dtype=np.uint64)])
    (la, ha), (lb, hb) = minmax.signature(a), minmax.signature(b)
    assert abs((np.mean(la == lb) + np.mean(ha == hb)) / 2 - 0.6) < 0.13
    long = rng.integers(0, 1 << 62, 40000, dtype=np.uint64)  # more than a block
    low, high = minmax.signature(long)
    values = minmax.MULTIPLY[0] * long + minmax.ADD[0]
    assert (low[0], high[0]) == (values.min(), values.max())


def test_bound_never_loses_a_pair():
    rng = np.random.default_rng(2)
    for size in (5, 60, 900, 200_000):
        a = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64) * np.uint64(2))
        b = np.unique(np.concatenate([a[: int(0.9 * len(a))], rng.integers(0, 1 << 63, max(1, size // 20), dtype=np.uint64)]))
        sides = []
        for n, x in enumerate((a, b)):
            c = minmax.cells(x)
            table = np.frombuffer(c or bytes(minmax.CELLS), np.uint8).reshape(1, -1)
            sides.append([np.array([n]), np.array([len(x)]), np.array([bool(c)]), table])
        found = list(minmax.possible(*sides, 80))
        assert found or not minmax.similar(a, b, 80)


def test_long_chains(spark):
    n = 120
    links = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(500, 501), (501, 500), (7, 7)], "a long, b long")
    got = {r["id"]: r["component"] for r in components(links).collect()}
    assert got == {i: 0 for i in range(n + 1)} | {500: 500, 501: 500}
    assert components(links.limit(0)).count() == 0


def test_a_worker_keeps_few_words_and_little_at_once():
    shingler, widest = minmax.Shingler(2), 5_000
    sets = [shingler(" ".join(f"w{i}" for i in range(at, at + widest))) for at in range(0, 300_000, widest)]
    assert sum(map(len, sets)) == 300_000 - len(sets) and len(shingler.known) <= 110_000
    low, high = minmax.signature(np.concatenate(sets))
    parts = [minmax.signature(s) for s in sets]
    assert (low == np.min([x for x, _ in parts], 0)).all() and (high == np.max([x for _, x in parts], 0)).all()
    assert minmax.PERMUTATIONS * minmax.BLOCK * 8 <= 1 << 21  # bytes of one table of permuted values
