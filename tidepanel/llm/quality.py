"""Text quality from compression: how much better a text compresses with a dictionary built from
good texts than with one built from bad texts.

Two zstandard dictionaries are trained on labelled texts. A text is compressed with both, in blocks of one
kilobyte, so that the dictionaries tell as much about the end of a long text as about its beginning. The
difference of the two compressed sizes, normalised by the larger of them and by the text's own size, is
calibrated to a probability by logistic regression on other labelled texts. Nothing else enters the score.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField

from tidepanel.llm.common import fit_logistic, labelled_sample, with_arrow_columns

DICTIONARY_BYTES = 1 << 17
LEVEL = 3

#: bytes compressed at once; the sizes of all blocks are added up
BLOCK_BYTES = 1024

#: labelled texts of each class that build a dictionary, and those that calibrate
BUILD, CALIBRATE = 2500, 2500

#: characters of a text that may build a dictionary: of a longer one two pieces, so that the driver holds at most
#: ``2 * BUILD * BUILD_CHARS`` characters. Scores and calibration always see whole texts.
BUILD_CHARS = 1 << 13


@dataclass
class Model:
    good: bytes
    bad: bytes
    prior: float
    chance: object = None  #: from rows of measures to probabilities


def _dictionary(texts: list[bytes]) -> bytes:
    """A trained dictionary, or, of too few texts to train on, their own bytes."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, texts, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"\n".join(texts)[-DICTIONARY_BYTES:]


class Meter:
    """How much smaller a text gets with the good dictionary than with the bad one."""

    def __init__(self, model: Model):
        books = [zstandard.ZstdCompressionDict(b) for b in (model.good, model.bad)]
        self.coders = [zstandard.ZstdCompressor(level=LEVEL, dict_data=b) for b in books]

    def measures(self, text: str) -> list[float]:
        raw = text.encode()
        blocks = [raw[at : at + BLOCK_BYTES] for at in range(0, len(raw), BLOCK_BYTES)] or [raw]
        good, bad = (sum(len(c.compress(b)) for b in blocks) for c in self.coders)
        return [(bad - good) / max(bad, good), (bad - good) / (len(raw) + 1)]


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality") -> Model:
    """A model from at most ``BUILD + CALIBRATE`` labelled rows of each class.

    Without labelled rows of both classes the model has no measures, and every score is the share of
    class 1 among the labelled rows (one half if there are none). Of an id with several texts the least teaches;
    NULL and empty texts don't. A text longer than ``BUILD_CHARS`` builds with two pieces, from its first and its third quarter on.
    """
    sample, counts = labelled_sample(docs, labels, label, BUILD + CALIBRATE)
    total = counts[0] + counts[1]
    model = Model(b"", b"", (counts[1] + 1) / (total + 2))
    if not min(counts.values()):
        return model
    # by hash: which rows build and which calibrate does not depend on their order
    builds = F.pmod(F.xxhash64("doc_id", F.lit("build")), F.lit(BUILD + CALIBRATE)) < BUILD
    # one row for each id, so never more than the sample's two limits
    sample = sample.where("text <> ''").groupBy("doc_id", "label").agg(F.min("text").alias("text")).withColumn("builds", builds)
    texts: dict[int, list[bytes]] = {0: [], 1: []}
    half = BUILD_CHARS // 2
    parts = [F.substring("text", (F.length("text") * k / 4).cast("int") + 1, F.lit(half)) for k in (1, 3)]
    pieces = F.when(F.length("text") <= BUILD_CHARS, F.array("text")).otherwise(F.array(*parts))
    for row in sample.where("builds").select("doc_id", "label", F.posexplode(pieces).alias("part", "text")).toLocalIterator():
        texts[row["label"]].append((row["doc_id"], row["part"], row["text"].encode()))
    if not (texts[0] and texts[1]):
        return model
    model.bad, model.good = (_dictionary([t for *_, t in sorted(texts[c])]) for c in (0, 1))
    rest = with_measures(sample.where(~F.col("builds")), model).select("label", "measures").collect()
    if len({r["label"] for r in rest}) < 2:
        return model
    y = np.array([r["label"] for r in rest], float)
    # each class was sampled by itself: weights bring back its share
    share = np.where(y == 1, counts[1] / y.sum(), counts[0] / (len(y) - y.sum()))
    model.chance = fit_logistic(np.array([list(r["measures"]) for r in rest]), y, share)
    return model


def with_measures(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The differences that a score is made of."""

    def make():
        meter = Meter(model)

        def compute(texts: list) -> list[pa.Array]:
            return [pa.array([meter.measures(t or "") for t in texts], pa.list_(pa.float64()))]

        return compute

    return with_arrow_columns(df, text, [StructField("measures", ArrayType(DoubleType()))], make)


def score(df: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """All rows of ``df`` with the probability that a text is of class 1, from its whole text.

    NULL and empty texts get the share of class 1 among the labelled rows. Rows may repeat; each
    is scored. A column named ``out`` is replaced, others are kept.
    """

    def make():
        meter = Meter(model) if model.chance else None

        def compute(texts: list) -> list[pa.Array]:
            scores = np.full(len(texts), model.prior)
            full = [i for i, t in enumerate(texts) if t]
            if meter and full:
                scores[full] = model.chance(np.array([meter.measures(texts[i]) for i in full]))
            return [pa.array(scores, pa.float64())]

        return compute

    return with_arrow_columns(df, text, [StructField(out, DoubleType())], make)
