"""The filter audit: list operations, and whole results against counting row by row."""

import itertools
import random

from tidepanel.llm import filter_audit

LETTERS = "ABCDE"


def test_list_operations():
    rng = random.Random(4)
    for _ in range(500):
        lists = [sorted(rng.sample(range(60), rng.randint(0, 60 if rng.random() < 0.3 else 6))) for _ in range(rng.randint(0, 5))]
        assert filter_audit.union(lists) == sorted(set().union(*lists))
        a, b = (sorted(rng.sample(range(80), rng.randint(0, 40))) for _ in range(2))
        assert filter_audit.difference(a, b) == sorted({*a} - {*b})
        assert filter_audit.common(a, b) == len({*a} & {*b})
        at = rng.randint(0, len(a))
        x = rng.randint(-1, 90)
        assert filter_audit.gallop(a, x, at) == next((i for i in range(at, len(a)) if a[i] >= x), len(a))


def brute(docs, labels):
    """Rows of the audit, document by document."""
    first = {}
    for i, text, _ in docs:
        if i is not None:
            first[text or ""] = min(first.get(text or "", i), i)
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    bad = {i for i, _, t in labels if t == 1 and i is not None}
    parts = {}
    for i, text, lang in docs:
        t = text or ""
        words = [w.decode() for w in t.encode().split()]
        fails = "".join(
            c for c, f in zip(LETTERS, (
                len(words) < 100, 100 * len(set(words)) < 80 * len(words), 100 * sum("A" <= c <= "Z" for c in t) > 10 * len(t),
                any(c in "#$%&*|" for c in t), i is not None and i > first[t],
            )) if f
        )
        parts.setdefault(lang or "", []).append((fails, i in good, i in bad))
    out = {}
    for part, rows in parts.items():
        shapley = dict.fromkeys(LETTERS, 0)
        for order in itertools.permutations(LETTERS):
            for at, own in enumerate(order):
                left = [r for r in rows if not {*r[0]} & {*order[:at]}]
                gone = [r for r in left if own in r[0]]
                shapley[own] += len(gone)
                out[part, "".join(order), at + 1] = [
                    len(left) - len(gone), len(gone), sum(own in r[0] for r in rows) - len(gone),
                    sum(r[0] == own for r in rows), sum(r[1] for r in gone), sum(r[2] for r in gone),
                ]
        for key in out:
            if key[0] == part:
                out[key].append(shapley[key[1][key[2] - 1]])
    return out


def test_audit_against_counting(spark):
    rng = random.Random(7)
    words = ["".join(rng.choices("abcdeXYZ", k=rng.randint(1, 4))) for _ in range(300)]
    docs = [(None, None, None), (None, "#", "en"), (None, "#", "en"), (3, "", ""), (4, "", "en"), (4, "", "en"), (5, "word " * 50000, "en"), (6, "A\x0bB\x1cC\xa0D", None)]
    docs += [(i, " ".join(rng.choices(words, k=rng.choice([20, 99, 100, 140]))) + rng.choice(["", " 5 %", "\n"]), rng.choice(["en", "de", None])) for i in range(10, 150)]
    docs += [(i + 200, docs[10 + i % 50][1], "fr") for i in range(60)]
    docs += [(i, "x y", "en") for i in (7, 7, 7, 8, 8)]  # rows of one id, some of them alike
    docs += [(9, "x & y", "en"), (9, "x y", "en")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in [*range(0, 260, 2), 4, 4, 7, None]]
    rng.shuffle(docs)
    df = spark.createDataFrame([(*d, "x", True, 1) for d in docs], "doc_id long, text string, lang string, part string, A boolean, digest int")
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    want = brute(docs, labels)
    cut, filter_audit.RANGE_ROWS = filter_audit.RANGE_ROWS, 10
    try:
        out = filter_audit.audit(df, known).collect()
    finally:
        filter_audit.RANGE_ROWS = cut
    names = ("kept", "removed", "redundant", "unique_fails", "lost_quality", "lost_toxic", "shapley")
    got = {(r["part"], r["filter_order"], r["step"]): [r[n] for n in names] for r in out}
    assert len(out) == len(got) == len(want) and got == want
    assert filter_audit.audit(df.limit(0), known).count() == 0
    assert filter_audit.audit(df, known.limit(0)).where("lost_quality + lost_toxic <> 0").isEmpty()
