"""The trie of conversation prefixes against plain Python."""

import hashlib
import random
import zlib
from collections import defaultdict

from tidepanel.llm import prefix_trie


def brute(rows):
    """All nodes of the trie of the rebuilt conversations."""
    known = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}:{text}".encode()).hexdigest()
            known[c].append((turn is not None, turn or 0, role, digest, text))
    known = {c: [(t[2], t[4]) for t in sorted(v)] for c, v in known.items()}
    full = {}
    for c, own in known.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        full[c] = known.get(base, [])[:h] + own[h:]
    members, ends, parent = defaultdict(list), defaultdict(list), {}
    for c, turns in full.items():
        for d in range(len(turns) + 1):
            key = tuple(turns[:d])
            members[key].append(c)
            parent[key] = key[:-1] if d else None
        ends[tuple(turns)].append(c)
    kids = defaultdict(int)
    for key in members:
        kids[parent[key]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for key in sorted(members, key=len, reverse=True):
        leaves[key] += kids[key] == 0
        saved[key] += (len(members[key]) - 1) * (len(key[-1][1]) if key else 0)
        if key:
            leaves[parent[key]] += leaves[key]
            saved[parent[key]] += saved[key]
    return sorted(
        (min(m), len(key), min(members[key[:-1]]) if key else None, len(m), kids[key], leaves[key], saved[key],
         hashlib.sha256(",".join(map(str, sorted(ends[key]))).encode()).hexdigest())
        for key, m in members.items()
    )


def found(df):
    out = prefix_trie.prefix_trie(df)
    assert out.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(tuple(r) for r in out.collect())


SCHEMA = "conv_id long, turn long, role string, text string, digest int, place string, node double"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 0.5) for r in rows], SCHEMA)


def test_trie(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "SPAN", 4)
    monkeypatch.setattr(prefix_trie, "PIECE", 3)
    rng = random.Random(3)
    rows = []
    for c in [*range(0, 12), *range(195, 330), -5, -100, -101]:
        for turn in range(rng.choice([1, 2, 5, 6, 9])):
            rows.append((c, turn, rng.choice(["user", None, ""]), rng.choice(["a", "bé", None, "日本 c"])))
    rows += [(777, None, "user", "first"), (777, 3, "u", "x"), (777, 3, "u", "x"), (777, 3, "u", "w"), (None, 0, "u", "lost"), (None, None, None, None)]
    rows += [(400, 0, "user", "long " * 40000), (401, 0, "user", "one turn"), (500, -1, "a:1", "b"), (501, 0, "a", "1:b")]
    rng.shuffle(rows)
    assert found(frame(spark, rows)) == brute(rows)


def test_empty_and_turnless(spark):
    assert found(frame(spark, [(None, 1, "u", "x")]).limit(0)) == []
    assert found(frame(spark, [(None, 1, "u", "x")])) == []
    alone = next(c for c in range(1, 50) if zlib.crc32(str(c).encode()) % 6 >= 2)
    rows = [(alone, 0, "u", "x"), (alone, 1, "u", "y")]  # all its turns fall away, and there is no first conversation
    assert found(frame(spark, rows)) == brute(rows) == [(alone, 0, None, 1, 0, 1, 0, hashlib.sha256(str(alone).encode()).hexdigest())]


def test_totals_of_chains_and_stars(spark):
    """Chains of 200 nodes, stars, and chains of stars; few rounds for a long chain."""
    rng = random.Random(8)
    parent = {0: (None, 0)}
    for i in range(1, 200):
        parent[i] = (i - 1, i)
    for i in range(200, 500):
        p = rng.choice([rng.randrange(i), i - 1, i - 1, i - 1, 7])
        parent[i] = (p, parent[p][1] + 1)
    own = {i: rng.randint(0, 9) for i in parent}
    kids = {p for p, _ in parent.values()}
    want = {i: [int(i not in kids), own[i]] for i in parent}
    for i in sorted(parent, key=lambda n: -parent[n][1]):
        if (p := parent[i][0]) is not None:
            want[p] = [a + b for a, b in zip(want[p], want[i])]
    tree = spark.createDataFrame([(i, p, d, own[i]) for i, (p, d) in parent.items()], "node long, parent long, depth long, own long")
    rounds = []
    real = prefix_trie.materialize
    prefix_trie.materialize = lambda df, label: rounds.append(label) or real(df, label)
    try:
        got = {r["node"]: [r["leaves"], r["total"]] for r in prefix_trie.subtree_totals(tree).collect()}
    finally:
        prefix_trie.materialize = real
    assert got == want and rounds.count("raked") < 25
    assert prefix_trie.subtree_totals(tree.limit(0)).count() == 0
