"""Toxicity of texts whose words may be disguised.

A noisy channel turns a word into what is read: letters become look-alike digits and signs
(leetspeak), separators stand between letters, letters are repeated. Every stretch with a look-alike next
to a letter, a doubled letter or a separator spans a lattice of what it may stand for, word boundaries
included; Viterbi decoding under a character trigram model of the whole corpus picks the likeliest.
The restored words are then looked up in a lexicon of words and word beginnings that labelled texts
have taught, and the sum of their weights is calibrated to a probability.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from tidepanel.llm.common import SLICE, fit_logistic, labelled_sample, small_batches, with_arrow_columns
from tidepanel.llm.minmax import near_duplicates
from tidepanel.session import materialize

#: letters of the character model; anything else ends a word
LETTERS = "abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿœ"
SIZE = len(LETTERS) + 1

#: signs and the letters they may stand for
LOOKALIKE = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "gpq",
    "*": "aeiou", "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "€": "e", "£": "l", "¢": "c", "¡": "i",
}

#: negative log probabilities of the channel
SUBSTITUTE, REPEAT, SEPARATE, BOUNDARY, DROP, STAR = 1.0, 0.7, 0.3, 0.3, 7.0, 2.0

SIGNS = re.escape("".join(LOOKALIKE))
LETTER, EITHER, BETWEEN = f"[{LETTERS}]", f"[{LETTERS}{SIGNS}]", r"[.\-_/·]"
SUSPECT = re.compile(rf"(?=[^{LETTERS}]*{LETTER})(?:.*?)(?:{LETTER}[{SIGNS}]|[{SIGNS}]{LETTER}|({LETTER})\1|{EITHER}{BETWEEN}+{EITHER})", re.DOTALL)
SPACED = re.compile(rf"(?<![\w{SIGNS}]){EITHER}(?:[ .\-_*/·]{{1,3}}{EITHER}){{2,}}(?![\w{SIGNS}])")
SEPARATORS = re.compile(r"[ .\-_/·]+")
EDGES = "\t\n\r \"'.,;:!?()[]{}<>*#%&~^_-=/\\«»“”„¿¡…"

#: labelled rows of each class that a lexicon is learnt from
SAMPLE = 6000

#: a lexicon entry stands in so many toxic texts at least
LEAST = 5

#: ... and is so much likelier in toxic texts: the natural logarithm of the ratio, less so many standard errors
EVIDENCE, DOUBT = 2.0, 1.0

#: characters that are decoded at once; a longer stretch without white space is decoded part by part
LONGEST = 256

BEGINNINGS = (4, 5, 6, 7, 8)

#: chunks a worker keeps
CACHE = 400_000


def _code_table() -> np.ndarray:
    table = np.zeros(0x200, np.int64)
    for i, c in enumerate(LETTERS, 1):
        table[ord(c)] = i
    return table


def _codes(text: str) -> np.ndarray:
    points = np.frombuffer(f"  {text.lower()} ".encode("utf-32-le", "replace"), np.uint32)
    return _code_table()[np.minimum(points, 0x1FF)]


def trigram_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """``gram, n`` over the whole texts of all rows. A gram is a number: three letters, 0 for what is
    no letter. Each task adds up its own rows; there are at most ``SIZE ** 3`` grams."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SIZE**3, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                c = _codes("  ".join(t for t in batch.slice(at, SLICE).column(0).to_pylist() if t))
                counts += np.bincount((c[:-2] * SIZE + c[1:-1]) * SIZE + c[2:], minlength=len(counts))
        full = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(full), pa.array(counts[full])], names=["gram", "n"])

    schema = StructType([StructField("gram", LongType()), StructField("n", LongType())])
    parts = small_batches(df).select(F.col(f"`{text}`").alias("text")).mapInArrow(run, schema)
    return parts.groupBy("gram").agg(F.sum("n").alias("n"))


class Decoder:
    """Viterbi decoding under an interpolated trigram model."""

    def __init__(self, grams: np.ndarray, n: np.ndarray):
        three = np.zeros(SIZE**3)
        three[grams] = n
        three = three.reshape(SIZE, SIZE, SIZE)
        two, one = three.sum(0), three.sum((0, 1))
        p1 = (one + 1) / (one.sum() + SIZE)
        p2 = (two + 50 * p1) / (two.sum(1, keepdims=True) + 50)
        p3 = (three + 20 * p2) / (three.sum(2, keepdims=True) + 20)
        self.cost = -np.log(p3)
        self.code = {c: i for i, c in enumerate(LETTERS, 1)}

    def _options(self, char: str, before: str) -> list[tuple[int | None, float]]:
        """Codes of what a sign may stand for (None for nothing, 0 for a word boundary), and what each costs."""
        if char in self.code:
            out: list[tuple[int | None, float]] = [(self.code[char], 0.0)]
            return [*out, (None, REPEAT)] if char == before else out
        if char in LOOKALIKE:
            nothing = REPEAT if char == before else STAR if char == "*" else DROP
            return [*((self.code[x], SUBSTITUTE) for x in LOOKALIKE[char]), (None, nothing)]
        return [(None, SEPARATE), (0, BOUNDARY)]

    def decode(self, span: str) -> str:
        """The likeliest words for ``span``, with single spaces between them."""
        span = SEPARATORS.sub(" ", span)
        return "".join(self._part(span[at : at + LONGEST]) for at in range(0, len(span), LONGEST))

    def _part(self, span: str) -> str:
        best: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
        before = ""
        for char in span:
            after: dict[tuple[int, int], tuple[float, tuple | None]] = {}
            for c, price in self._options(char, before):
                for (a, b), (cost, path) in best.items():
                    if c is None or c == b == 0:
                        state, total, way = (a, b), cost + price, path
                    else:
                        state, total, way = (b, c), cost + price + self.cost[a, b, c], (path, c)
                    if state not in after or total < after[state][0]:
                        after[state] = (total, way)
            best, before = after, char

        def whole(entry: tuple) -> float:
            (a, b), (cost, _) = entry
            return cost + (self.cost[a, b, 0] if b else 0.0)

        _, (_, path) = min(best.items(), key=whole)
        out = []
        while path:
            path, c = path
            out.append(LETTERS[c - 1] if c else " ")
        return "".join(reversed(out)).strip()


class Restorer:
    """Restored words of texts."""

    def __init__(self, decoder: Decoder):
        self.decoder = decoder

    def word(self, chunk: str) -> str:
        """What a stretch without white space, in lower case, stands for: a word, or several with spaces. What has no
        look-alike next to a letter, no doubled letter and no separator stands for itself."""
        core = chunk.strip(EDGES)
        return self.decoder.decode(core) if SUSPECT.match(core) else core

    def spaced(self, text: str) -> Iterator[tuple[int, int, str]]:
        """Spelt-out words: begin, end and what they stand for."""
        for m in SPACED.finditer(text):
            if any(c in self.decoder.code for c in m[0]):
                yield m.start(), m.end(), self.decoder.decode(m[0])

    def text(self, text: str) -> str:
        """The text with every disguised word restored; all else is left as it is."""
        low, out, at = text.lower(), [], 0
        if len(low) != len(text):  # a few letters change their length
            text = low
        for begin, end, word in [*self.spaced(low)]:
            out += [self._chunks(text[at:begin]), word]
            at = end
        return "".join([*out, self._chunks(text[at:])])

    def _chunks(self, text: str) -> str:
        def restored(m: re.Match) -> str:
            low = m[0].lower()
            core = low.strip(EDGES)
            if not SUSPECT.match(core):
                return m[0]
            meant, at = self.decoder.decode(core), low.index(core)
            # words that were only joined by separators stay joined
            return m[0] if meant == SEPARATORS.sub(" ", core) else m[0][:at] + meant + m[0][at + len(core) :]

        return re.sub(r"\S+", restored, text)


def features(word: str) -> list[str]:
    """A word, and its beginnings with a mark."""
    return [word, *(word[:n] + "~" for n in BEGINNINGS if len(word) >= n)]


@dataclass
class Model:
    decoder: Decoder
    lexicon: dict[str, float] = field(default_factory=dict)
    prior: float = 0.5
    chance: object = None  #: from sums of weights to probabilities


class Scorer:
    """Sums of lexicon weights over the distinct restored words of a text."""

    def __init__(self, model: Model):
        self.lexicon = model.lexicon
        self.restorer = Restorer(model.decoder)
        self.known: dict[str, list[tuple[str, float]]] = {}

    def _look(self, words: str) -> list[tuple[str, float]]:
        """Those of the words that the lexicon has, with their weights."""
        weights = ((w, max(self.lexicon.get(f, 0.0) for f in features(w))) for w in words.split())
        return [(w, weight) for w, weight in weights if weight > 0]

    def sum(self, text: str) -> float:
        low = text.lower()
        if len(self.known) > CACHE:
            self.known.clear()
        found: dict[str, float] = {}
        known = self.known
        for chunk in set(low.split()):
            if chunk not in known:
                known[chunk] = self._look(self.restorer.word(chunk))
            found.update(known[chunk])
        for _, _, words in self.restorer.spaced(low):
            found.update(self._look(words))
        return sum(sorted(found.values()))


def _learning_rows(sample: DataFrame, decoder: Decoder) -> DataFrame:
    """The sample with each text's features."""

    def make():
        restorer = Restorer(decoder)

        def compute(texts: list) -> list[pa.Array]:
            lists = []
            for t in texts:
                low = (t or "").lower()
                found = [*(restorer.word(c) for c in set(low.split())), *(w for _, _, w in restorer.spaced(low))]
                lists.append(sorted({f for words in found for w in words.split() for f in features(w)}))
            return [pa.array(lists, pa.list_(pa.string()))]

        return compute

    return with_arrow_columns(sample, "text", [StructField("features", ArrayType(StringType()))], make)


def _specific(entries: dict[str, tuple[float, int]]) -> dict[str, float]:
    """Weights without the beginnings that owe nearly all their toxic texts to one longer entry which
    is clearly stronger: the beginning alone then says little."""
    owed = set()
    for entry, (weight, toxic) in entries.items():
        stem = entry.rstrip("~")
        for n in BEGINNINGS:
            short = entries.get(stem[:n] + "~") if n <= len(stem) and stem[:n] + "~" != entry else None
            if short and short[1] <= 1.15 * toxic and short[0] < weight - 0.5:
                owed.add(stem[:n] + "~")
    return {e: w for e, (w, _) in entries.items() if e not in owed}


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample: int = SAMPLE) -> Model:
    """Character model of all ``docs``, lexicon and calibration from at most ``sample`` labelled ids of
    each class. Of labelled texts that are near copies of each other (five-word shingles, 0.8) the smallest id of each
    class teaches. NULL and empty texts teach nothing; of an id with several texts each teaches.

    Without labelled rows of both classes every score is the share of class 1 among the labelled
    rows (one half if there are none).
    """
    grams = trigram_counts(docs).collect()  # at most SIZE ** 3 numbers
    decoder = Decoder(np.array([r["gram"] for r in grams], np.int64), np.array([r["n"] for r in grams], np.float64))
    rows, counts = labelled_sample(docs, labels, label, sample)
    total = counts[0] + counts[1]
    model = Model(decoder, prior=(counts[1] + 1) / (total + 2))
    if not min(counts.values()):
        return model
    rows = materialize(rows.where("text <> ''"), "toxicity-sample")
    groups = near_duplicates(rows.select("doc_id", "text"), words=5).select("doc_id", "component_id").distinct()
    teaching = rows.select("doc_id", "label").join(groups, "doc_id").groupBy("component_id", "label").agg(F.min("doc_id").alias("doc_id"))
    taught = _learning_rows(rows.join(teaching.select("doc_id", "label"), ["doc_id", "label"], "left_semi"), decoder)
    learnt = materialize(taught.drop("text"), "toxicity-features")
    n = {0: 0, 1: 0} | {r["label"]: r["count"] for r in learnt.groupBy("label").count().collect()}
    if not min(n.values()):
        return model
    seen = learnt.select("label", F.explode("features").alias("feature")).groupBy("feature").agg(
        F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("clean")
    )
    error = F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("clean") + 0.5))
    weight = F.log((F.col("toxic") + 0.5) / (n[1] + 1)) - F.log((F.col("clean") + 0.5) / (n[0] + 1)) - DOUBT * error
    entries = (
        seen.where(F.col("toxic") >= LEAST)
        .withColumn("weight", weight)
        .where(F.col("weight") >= EVIDENCE)
        .collect()  # words of the bounded sample that stand in few clean texts or none
    )
    model.lexicon = _specific({r["feature"]: (r["weight"], r["toxic"]) for r in entries})
    sums = with_sums(rows, model).groupBy("label", F.round("sum", 1).alias("sum")).count().collect()
    y = np.array([r["label"] for r in sums], float)
    if len(set(y)) < 2:
        return model
    times = np.array([r["count"] for r in sums], float)
    share = np.where(y == 1, counts[1] / times[y == 1].sum(), counts[0] / times[y == 0].sum())
    x = np.array([r["sum"] for r in sums], float)
    model.chance = fit_logistic(np.c_[np.log1p(x)], y, times * share)
    return model


def with_sums(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    def make():
        scorer = Scorer(model)
        return lambda texts: [pa.array([scorer.sum(t or "") for t in texts], pa.float64())]

    return with_arrow_columns(df, text, [StructField("sum", DoubleType())], make)


def score(df: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """All rows of ``df`` with the probability that a text is of class 1, from its whole text.

    NULL and empty texts count as texts without a lexicon word. Rows may repeat; each is scored. A
    column named ``out`` is replaced, others are kept.
    """

    def make():
        scorer = Scorer(model)

        def compute(texts: list) -> list[pa.Array]:
            if model.chance is None:
                return [pa.array([model.prior] * len(texts), pa.float64())]
            sums = np.array([scorer.sum(t or "") for t in texts], float)
            return [pa.array(model.chance(np.c_[np.log1p(sums)]), pa.float64())]

        return compute

    return with_arrow_columns(df, text, [StructField(out, DoubleType())], make)


def restore(df: DataFrame, decoder: Decoder, text: str = "text", out: str = "restored") -> DataFrame:
    """All rows of ``df`` with the text as it reads without disguises; NULL stays NULL."""

    def make():
        restorer = Restorer(decoder)
        return lambda texts: [pa.array([None if t is None else restorer.text(t) for t in texts], pa.string())]

    return with_arrow_columns(df, text, [StructField(out, StringType())], make)
