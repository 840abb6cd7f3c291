"""Classifiers: held-out accuracy, restored words, odd rows."""

import random
import textwrap
import zlib

import pytest
from pyspark.sql import functions as F

from tidepanel.llm import licenses, quality, toxicity
from tidepanel.llm.catalog import QUERIES
from tidepanel.llm.common import held_out

ROOT = "/root/testdata/sf0.1"
ODD = [(None, "text", 1), (1, None, 1), (2, "", 1), (3, "   ", 1), (4, "word " * 60000, 1), (4, "word " * 60000, 1)]


def odd(spark):
    return spark.createDataFrame([(*r, 0.5, [1]) for r in ODD], "doc_id long, text string, sum int, Score double, hits array<int>")


def test_held_out(spark):
    df = spark.range(200).withColumn("h", held_out(F.col("id")))
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 4 == 2) for r in df.collect())


@pytest.mark.parametrize("name, label, least", [("op1_toxicity", "toxic", 0.96), ("op7_quality", "quality", 0.96)])
def test_held_out_accuracy(spark, name, label, least):
    out = QUERIES[name](spark, ROOT)
    assert out.columns[:4] == ["doc_id", "held_out", "score", "predicted"] and out.where("score is null or score < 0 or score > 1").isEmpty()
    seen = out.where("held_out").join(spark.read.parquet(f"{ROOT}/labels.parquet"), "doc_id")
    right, n = seen.agg(F.avg((F.col("predicted") == F.col(label)).cast("int")), F.count("*")).first()
    assert n > 500 and right >= least
    recall = seen.where(F.col(label) == 1).agg(F.avg("predicted")).first()[0]
    assert recall >= 0.9


@pytest.mark.parametrize("module", [toxicity, quality])
def test_odd_rows_and_labels(spark, module):
    docs = odd(spark)
    for labels in ([], [(1, 1)], [(1, 1), (1, 0), (2, 0), (3, 0), (None, 1), (4, None), (4, 7)]):
        known = spark.createDataFrame(labels, "doc_id long, mark int")
        model = module.fit(docs.select("doc_id", "text"), known, "mark")
        rows = module.score(docs, model).collect()
        assert len(rows) == len(ODD) and all(0 <= r["score"] <= 1 for r in rows)
        assert module.score(docs.limit(0), model).count() == 0
    empty = module.fit(docs.limit(0).select("doc_id", "text"), known, "mark")
    assert module.score(docs, empty).count() == len(ODD)


@pytest.fixture(scope="module")
def decoder(spark):
    rng = random.Random(1)
    words = "you are an idiot a moron so stupid and worthless the loser is pathetic some scum here trash and good people".split()
    texts = [" ".join(rng.choices(words, k=40)) for _ in range(50)]
    grams = toxicity.trigram_counts(spark.createDataFrame([(t,) for t in [*texts, None, ""]], "text string")).collect()
    import numpy as np

    return toxicity.Decoder(np.array([r["gram"] for r in grams]), np.array([r["n"] for r in grams], float))


def test_disguised_words(spark, decoder):
    r = toxicity.Restorer(decoder)
    pairs = {
        "1d10t": "idiot", "m0r0n": "moron", "iiidiooot": "idiot", "$tup1d": "stupid", "w0rth|ess": "worthless", "p@thet1c": "pathetic",
        "sc*m": "scum", "t-r-a-s-h": "trash", "good": "good", "people!!": "people", "the***": "the", "2023": "2023",
    }
    assert {w: r.word(w) for w in pairs} == pairs
    assert r.text("You are an i d i o t, and a M0R0N!") == "You are an idiot, and a moron!"
    assert r.text("nothing to do here.\n Left as it is") == "nothing to do here.\n Left as it is"
    df = spark.createDataFrame([("m 0 r o n", "x"), (None, "x"), ("", "x")], "text string, restored string")
    assert [x["restored"] for x in toxicity.restore(df, decoder).collect()] == ["moron", None, ""]


def test_probes(decoder):
    r = toxicity.Restorer(decoder)
    pairs = {
        "idi07": "idiot", "stuupid": "stupid", "traash": "trash", "1d10t!!": "idiot", "tra5h": "trash", "stu.pid": "stupid", "l-o-s-e-r": "loser",
        "5cum": "scum", "good": "good", "a-good-idiot": "a good idiot", "": "", "***": "", "12.30": "12.30",
    }
    assert {w: r.word(w) for w in pairs} == pairs
    spelt = {"i  d i o t": "idiot", "you a s t u p i d one": "you a stupid one", "m o r o n s t u p i d": "moron stupid", "t.r.a.s.h": "trash"}
    assert {t: r.text(t) for t in spelt} == spelt
    assert r.text("a-good idiot") == "a-good idiot"  # joined words stay joined
    long = "stup1d" * 2000
    assert len(r.word(long)) > 9000


def test_decoder_against_all_readings(decoder):
    """The likeliest of all ways to read a short span."""
    import itertools

    def price(span, choice):
        a = b = total = 0
        for c, p in choice:
            total += p
            if c is not None and not (c == b == 0):
                total += decoder.cost[a, b, c]
                a, b = b, c
        return total + (decoder.cost[a, b, 0] if b else 0.0)

    rng = random.Random(4)
    for _ in range(60):
        span = "".join(rng.choices("idtosup10$* .-", k=rng.randint(1, 7)))
        cut = toxicity.SEPARATORS.sub(" ", span)
        options = [decoder._options(c, before) for before, c in zip(["", *cut], cut)]
        best = min(itertools.product(*options), key=lambda ch: price(cut, ch))
        got = decoder.decode(span)
        prices = [price(cut, ch) for ch in itertools.product(*options) if "".join(toxicity.LETTERS[c - 1] if c else " " for c, _ in ch if c is not None).split() == got.split()]
        assert prices and min(prices) == pytest.approx(price(cut, best))


def test_rare_toxic_words_and_copies(spark):
    """A word of 1 in 100 toxic texts counts; near copies teach once; the lexicon does not depend on the layout."""
    rng = random.Random(8)
    plain = [f"{a}{b}{c}" for a in ("ta", "ko", "li", "ve") for b in ("ne", "ru", "mo", "pa") for c in ("s", "d", "va", "lin")]
    rows, labels = [], []
    for i in range(1500):
        text = rng.choices(plain, k=30)
        if toxic := i % 3 == 0:
            text.insert(9, "grumpfel" if i % 75 else "snorkwit")
        rows.append((i, " ".join(text)))
        labels.append((i, int(toxic)))
    rows += [(2000 + i, "zubbel " + rows[0][1]) for i in range(40)] + [(3000, None), (3001, ""), (3002, "tanes " * 50000)]
    labels += [(2000 + i, 1) for i in range(40)] + [(3000, 0), (3001, 1), (3002, 0)]
    docs, known = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    models = [toxicity.fit(d, known) for d in (docs, docs.orderBy(F.desc("doc_id")).repartition(3))]
    assert models[0].lexicon == models[1].lexicon and "snorkwit" in models[0].lexicon and "zubbel" not in models[0].lexicon


def test_quality_learns_from_long_texts_only(spark):
    rng = random.Random(9)
    words = {c: ["".join(rng.choices("abcdefgh" if c else "rstuvwxy", k=rng.randint(3, 8))) for _ in range(400)] for c in (0, 1)}
    rows = [(i, " ".join(rng.choices(words[i % 2], k=9000 if i % 2 else 60))) for i in range(300)]
    docs = spark.createDataFrame([*rows, (1, "another text of the id"), (None, "x")], "doc_id long, text string")
    known = spark.createDataFrame([(i, i % 2) for i in range(300)], "doc_id long, quality int")
    model = quality.fit(docs, known)
    assert model.chance is not None
    new = spark.createDataFrame([(c, " ".join(rng.choices(words[c], k=n))) for c in (0, 1) for n in (50, 400, 9000)], "c int, text string")
    assert all((r["score"] >= 0.7) == r["c"] for r in quality.score(new, model).collect())


def test_disguised_words_score_as_plain_ones(spark):
    rng = random.Random(2)
    plain = [f"{a}{b}{c}" for a in ("ta", "ko", "li") for b in ("ne", "ru", "mo") for c in ("s", "d", "va")]
    rows, labels = [], []
    for i in range(400):
        text = rng.choices(plain, k=30)
        if toxic := i % 4 == 0:
            text.insert(rng.randrange(30), rng.choice(["grumpfel", "snorkwit"]))
        rows.append((i, " ".join(text)))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    new = [("tanes kolid grumpfel", 1), ("tanes gr0mpfel gru mpfel", 0), ("kones 6rumpfe1 lirud", 1), ("a s n o r k w i t komod", 1), ("tanes kolid lirud", 0), ("snoooorkwit", 1)]
    scored = toxicity.score(spark.createDataFrame([(t,) for t, _ in new], "text string"), model).collect()
    assert {r["text"]: int(r["score"] >= 0.3) for r in scored} == dict(new)


def test_licences(spark):
    rng = random.Random(3)
    plain = lambda n: " ".join("".join(rng.choices("abcdefgh", k=rng.randint(2, 8))) for _ in range(n))
    notices = {
        "MIT": "Released under the MIT License.",
        "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
        "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
        "CC-BY-4.0": "Licensed under CC BY 4.0.",
        "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
        "GPL-2.0": "Licensed under the GNU General Public License, version 2.",
    }
    rows = [(i, f"{plain(30)}\n{plain(4)} {t}\n{plain(9)}", f) for i, (f, t) in enumerate(notices.items())]
    rows += [(100 + i, t, "") for i, t in enumerate(["", None, plain(50), "The driving license was released under pressure in the general version.", "MIT students work in public."])]
    rows.append((200, "\r\n".join([notices["MIT"], plain(5), notices["GPL-3.0"], notices["MIT"]]), "GPL-3.0,MIT"))
    docs = spark.createDataFrame([(i, t, [0], "x") for i, t, _ in rows], "doc_id long, text string, hits array<int>, licenses string")
    model = licenses.fit(docs)
    out = {r["doc_id"]: r for r in licenses.scan(docs, model).collect()}
    for i, text, want in rows:
        assert ",".join(out[i]["licenses"]) == want, (i, out[i])
        for h in out[i]["hits"]:
            assert 0 < h["probability"] <= 1 and text[h["start"] : h["start"] + h["length"]] in text.splitlines()
    assert [h["family"] for h in out[200]["hits"]] == ["MIT", "GPL-3.0", "MIT"] and out[200]["n_paragraphs"] == 1
    assert licenses.scan(docs.limit(0), licenses.fit(docs.limit(0))).count() == 0
    wrapped_notices(model, plain)


def wrapped_notices(model, plain):
    """Notices in their usual form: hard-wrapped, in comments, among other paragraphs."""
    full = {
        "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction",
        "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "GPL-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "GPL-2.0": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
        "LGPL-3.0": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 3 of the License, or (at your option) any later version.",
        "Apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at",
        "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at",
    }
    for family, notice in full.items():
        for width in (30, 50, 76):
            for lead, end in (("", "\n"), (" * ", "\n"), ("# ", "\r\n")):
                body = end.join(lead + line for line in textwrap.wrap(notice, width))
                text = f"{plain(20)}{end}{end}{plain(6)}{end}{body}{end}{plain(8)}{end}{end}{plain(9)}"
                n, hits = licenses.hits_of(model, text)
                sure = [h for h in hits if h["confirmed"]]
                assert n == 3 and {h["family"] for h in sure} == {family} and {h["paragraph"] for h in sure} == {1}, (family, width, hits)
    # runs against all runs of lines, by brute force
    rng = random.Random(5)
    wanted = [licenses.words_of(t) for ts in licenses.TEMPLATES.values() for t in ts]
    for _ in range(60):
        words = [w for _ in range(rng.randint(1, 3)) for w in [*plain(rng.randint(0, 6)).split(), *rng.choice(wanted)]]
        lines = [words[i : i + 5] for i in range(0, len(words), 5)]
        enough = set()
        for i in range(len(lines)):
            for j in range(i + 1, len(lines)):
                have = licenses._grams([w for line in lines[i : j + 1] for w in line], (2,))
                if any(len(p & have) >= licenses.CONFIRM * len(p) for p in model.vocabulary.pairs):
                    enough.add((i, j))
        runs = licenses.wrapped_runs(model.vocabulary, lines)
        assert set(runs) <= enough and all(any(i <= b and a <= j for a, b in runs) for i, j in enough)
    long = plain(20000).replace(" ", "\n") + "\n" + "Released under\nthe MIT License." + "\n" * 5000
    assert [h["family"] for h in licenses.hits_of(model, long)[1] if h["confirmed"]] == ["MIT"]
