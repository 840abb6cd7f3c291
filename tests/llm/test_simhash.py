"""SimHash components against all pairs."""

import random

import numpy as np
import pytest
import xxhash

from tidepanel.llm import simhash
from tidepanel.llm.catalog import QUERIES


def plain_fingerprint(text):
    words = [w.decode() for w in (text or "").encode().lower().split()]
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    counts = [sum(xxhash.xxh64_intdigest(s.encode(), 42) >> j & 1 for s in shingles) for j in range(64)]
    return sum(1 << j for j in range(64) if 2 * counts[j] > len(shingles))


def brute(rows, bits=3):
    """Component of each (id, fingerprint), from all pairs."""
    ids = sorted({i for i, _ in rows if i is not None})
    parent = {i: i for i in ids}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    known = [(i, f) for i, f in rows if i is not None]
    for n, (i, f) in enumerate(known):
        for j, g in known[:n]:
            if (f ^ g).bit_count() <= bits:
                a, b = sorted((top(i), top(j)))
                parent[b] = a
    return {i: top(i) for i in ids}


def test_fingerprints():
    rng = random.Random(1)
    texts = [None, "", " \n", "One", "one TWO", "a b c a b c a b c", "É Ü\xa0x\x1cy é", "w " * 70000 + "x"]
    texts += [" ".join(rng.choices("aBcdEf", k=rng.randint(1, 60))) for _ in range(40)]
    for t in texts[:7] + texts[8:]:
        assert simhash.fingerprint(t) == plain_fingerprint(t)
    cut, simhash.SLICE = simhash.SLICE, 100
    try:
        assert simhash.fingerprint(texts[7]) == plain_fingerprint(texts[7])
    finally:
        simhash.SLICE = cut


def near_values(rng, n, groups):
    """Random numbers and groups of numbers a few bits from each other."""
    out = {0, (1 << 64) - 1}
    for _ in range(n):
        out.add(rng.getrandbits(64))
    for _ in range(groups):
        value = rng.getrandbits(64)
        for _ in range(rng.randint(1, 30)):
            out.add(value)
            for _ in range(rng.randint(1, 4)):
                value ^= 1 << rng.randrange(64)
    return sorted(out)


@pytest.mark.parametrize("bits", [0, 1, 2, 3, 5])
def test_every_close_pair_meets(bits):
    rng = random.Random(bits)
    values = np.array(near_values(rng, 3000, 200), np.uint64)
    met = set()
    reach = bits // 2
    for mask in simhash.HALVES:
        tree, leaves = simhash.grow(values[::2], mask, 64, reach)
        assert leaves > 20
        home, all_in = {}, {}
        for leaf, at, is_home in simhash.route(tree, values & np.uint64(mask), reach):
            all_in.setdefault(leaf, []).append(at)
            if is_home:
                home.setdefault(leaf, []).append(at)
        assert sorted(np.concatenate([x for v in home.values() for x in v]).tolist()) == list(range(len(values)))
        for leaf, own in home.items():
            own, everyone = np.concatenate(own), np.concatenate(all_in[leaf])
            for i in own:
                met |= {(min(i, j), max(i, j)) for j in everyone[np.bitwise_count(values[everyone] ^ values[i]) <= bits] if i != j}
    want = {(i, j) for i in range(len(values)) for j in np.flatnonzero(np.bitwise_count(values ^ values[i]) <= bits) if i < j}
    assert met == want and (bits == 0 or len(want) > 100)


def test_links_keep_components(spark, monkeypatch):
    monkeypatch.setattr(simhash, "SHARD_ROWS", 40)
    monkeypatch.setattr(simhash, "BLOCK_ROWS", 16)
    monkeypatch.setattr(simhash, "ROUTED", 64)
    rng = random.Random(9)
    values = near_values(rng, 400, 60)
    centre = rng.getrandbits(64)  # a crowd no tree can part
    values = sorted({*values, *(centre ^ (1 << a) ^ (1 << b) for a in range(64) for b in range(a, 12))})
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    classes = spark.createDataFrame([(v,) for v in signed], "fp long").repartition(5)
    found = simhash.links(classes).collect()
    numbers = {v: i for i, v in enumerate(signed)}
    mask = (1 << 64) - 1
    parent = list(range(len(signed)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for r in found:
        assert ((r["a"] & mask) ^ (r["b"] & mask)).bit_count() <= 3
        a, b = sorted((top(numbers[r["a"]]), top(numbers[r["b"]])))
        parent[b] = a
    want = brute([(i, v) for i, v in enumerate(values)])
    assert {i: top(i) for i in range(len(values))} == want
    assert simhash.links(classes.limit(0)).count() == 0


def test_components_of_documents(spark):
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefg", k=rng.randint(2, 7))) for _ in range(400)]
    rows = [(None, "a b c"), (None, "a b c"), (1, None), (2, ""), (2, " \t"), (3, "a b c"), (3, "zz yy xx ww"), (4, "A B c"), (0, "zz yy xx ww")]
    for i in range(10, 200):
        if i % 3 and len(rows) > 20:
            text = rng.choice(rows[10:])[1].split()
            for _ in range(rng.choice([0, 1, 1, 2])):
                text[rng.randrange(len(text))] = rng.choice(words)
        else:
            text = rng.choices(words, k=rng.choice([2, 40, 150]))
        rows.append((i, " ".join(text)))
    rng.shuffle(rows)
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, fp int, component_id string")
    out = simhash.near_duplicates(df).collect()
    # a repeated key is placed by each row's own text
    known = [(i, plain_fingerprint(t)) for i, t in rows if i is not None]
    group = brute([(n, f) for n, (_, f) in enumerate(known)])
    least = {}
    for n, (i, _) in enumerate(known):
        least[group[n]] = min(least.get(group[n], i), i)
    want = {(i, f): least[group[n]] for n, (i, f) in enumerate(known)}
    mask = (1 << 64) - 1
    assert sorted(((r["doc_id"] is None, r["doc_id"], r["fp"] & mask) for r in out), key=str) == sorted(((i is None, i, plain_fingerprint(t)) for i, t in rows), key=str)
    assert all(r["component_id"] == want.get((r["doc_id"], r["fp"] & mask)) for r in out)
    assert simhash.near_duplicates(df.limit(0)).count() == 0


def test_query(spark):
    root = "/root/testdata/sf0.01"
    out = QUERIES["op13_simhash"](spark, root).collect()
    rows = [(r["doc_id"], plain_fingerprint(r["text"])) for r in spark.read.parquet(f"{root}/documents.parquet").where("doc_id < 300").collect()]
    prints = {r["doc_id"]: r["fingerprint"] for r in out}
    assert all(prints[i] == f"{f:016x}" for i, f in rows)
    assert {r["doc_id"]: r["component_id"] for r in out} == brute([(i, int(f, 16)) for i, f in prints.items()])
