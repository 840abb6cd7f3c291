"""Order-preserving packing of tokenised documents into training sequences.

The documents of a task form one token stream. A dynamic programme picks where windows end:
at the end of a document, at the end of a sentence or, in very long sentences, at a step
inside. It minimises padding plus a penalty for each document that is cut. The best start of
the window that ends at a given place is the minimum over a sliding range of places, so a
monotone queue makes the whole programme linear.
"""

from __future__ import annotations

import codecs
import re
from array import array
from collections.abc import Iterable, Iterator
from itertools import accumulate, chain, repeat
from operator import attrgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType
from tokenizers import Tokenizer

from tidepanel.llm.common import small_batches

WINDOW = 2048

#: what ending a window costs besides its padding, in tokens
DOCUMENT_END, SENTENCE_END, INSIDE = 0, 4, 12

#: a sentence of more tokens than this gets places to cut inside, one after so many tokens
LONG_SENTENCE = 64

#: tokens that a task gathers before it chooses cuts; all but the last windows are then final
STRETCH = 1 << 18

#: words that a worker keeps, about 250 bytes each; beyond that it forgets the rarest
CACHE = 200_000

#: words that are left when it forgets
KEPT = 100_000

#: bytes of texts that are encoded together
GROUP = 1 << 21

#: Texts of these characters only are normalised and split here, all others by the library. For them
#: the vocabulary's normaliser is lower-casing and its splitter is WORDS (fixed values of the file).
PLAIN = re.compile(r"[\t\n\r\x20-\x7eÀ-ÿ]*")
WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\s0-9a-zß-öø-ÿ]+")
SENTENCE = re.compile(r"(?<=[.!?])[ \n]+")


class WordTokens:
    """Ids of whole texts, with the ids of frequent words kept.

    White space separates words for good in this vocabulary, so a text's ids are those of the chunks
    between white space, one after another, and a chunk's are those of its words. Each different chunk
    of a group of texts is looked at once, and the library is asked for words that are not kept only.
    """

    def __init__(self, vocabulary: str):
        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        split = self.tokenizer.pre_tokenizer.pre_tokenize_str
        letters = list(map(chr, range(256)))
        for x in map(chr, range(0xC0, 0x100)):
            for byte, letter in zip(x.encode(), "".join(p for p, _ in split(x))):
                letters[byte] = letter
        self.letters = "".join(letters)  # what the model reads for each byte of the characters of PLAIN
        self.chunks: dict[str, int] = {}
        self.flat, self.first, self.size, self.uses = array("I"), array("q"), array("q"), array("q")

    def _forget(self) -> None:
        """Keeps the most used words, and halves the counts, so that old use fades."""
        uses, size, first = (np.array(x, np.int64) for x in (self.uses, self.size, self.first))
        keep = np.sort(np.argsort(-uses, kind="stable")[:KEPT])
        names, size = list(self.chunks), size[keep]
        self.chunks = {names[i]: n for n, i in enumerate(keep.tolist())}
        self.flat = array("I", np.frombuffer(self.flat, np.uint32)[_runs(first[keep], size)].tobytes())
        self.first, self.size, self.uses = (array("q", x.tobytes()) for x in (np.cumsum(size) - size, size, uses[keep] // 2))

    def _learn(self, words: Iterable[str]) -> None:
        names = list(dict.fromkeys(words))
        read, _ = codecs.charmap_decode(" ".join(names).encode(), "strict", self.letters)
        tokenize, number = self.model.tokenize, attrgetter("id")
        ids = [array("I", map(number, tokenize(w))) for w in read.split(" ")]
        size = list(map(len, ids))
        self.chunks.update(zip(names, range(len(self.first), len(self.first) + len(names))))
        self.first.extend(accumulate(size[:-1], initial=len(self.flat)))
        self.flat.extend(chain.from_iterable(ids))
        self.size.extend(size)
        self.uses.extend(repeat(0, len(size)))

    def _find(self, words: list[str]) -> np.ndarray:
        """Numbers of words that are kept, -1 for others."""
        return np.fromiter(map(self.chunks.get, words, repeat(-1)), np.int64, len(words))

    def _chunk_ids(self, chunks: list[str], times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of different chunks one after another, and how many ids each chunk has."""
        if len(self.chunks) > CACHE:
            self._forget()
        parts = [[c] if c.isalpha() else WORDS.findall(c) for c in chunks]
        count = np.fromiter(map(len, parts), np.int64, len(parts))
        words = list(chain.from_iterable(parts))
        at = self._find(words)
        lost = np.flatnonzero(at < 0)
        if len(lost):
            new = [words[i] for i in lost.tolist()]
            self._learn(new)
            at[lost] = self._find(new)
        np.add.at(np.frombuffer(self.uses, np.int64), at, np.repeat(times, count))
        size = np.frombuffer(self.size, np.int64)[at]
        ids = np.frombuffer(self.flat, np.uint32)[_runs(np.frombuffer(self.first, np.int64)[at], size)]
        return ids, np.diff(_upto(size)[_upto(count)])

    def encode_all(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each text its ids, and the numbers of ids up to each end of a sentence."""
        plain = [PLAIN.fullmatch(t) is not None for t in texts]
        known = self._encode_plain([t for t, p in zip(texts, plain) if p])
        for text, is_plain in zip(texts, plain):
            if is_plain:
                yield next(known)
            else:
                parts = [self.tokenizer.encode(s, add_special_tokens=False).ids for s in SENTENCE.split(text)]
                yield np.array([i for p in parts for i in p], np.uint32), np.cumsum([len(p) for p in parts])

    def _encode_plain(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        lists = pc.utf8_split_whitespace(pc.utf8_lower(pa.array(texts, pa.large_string())))
        bounds, coded = lists.offsets.to_numpy(), lists.values.dictionary_encode()
        which, chunks = coded.indices.to_numpy(), coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        if not chunks:
            yield from repeat((np.empty(0, np.uint32), np.empty(0, np.int64)), len(texts))
            return
        flat, size = self._chunk_ids(chunks, np.bincount(which, minlength=len(chunks)))
        first, closing = np.cumsum(size) - size, np.fromiter(map(str.endswith, chunks, repeat((".", "!", "?"))), bool, len(chunks))
        upto = _upto(size[which])
        ids = flat[_runs(first[which], size[which])]
        ends = np.flatnonzero(closing[which])
        cuts, parts, sentences = upto[bounds], np.searchsorted(ends, bounds), upto[ends + 1]
        for a, b, c, d in zip(cuts, cuts[1:], parts, parts[1:]):
            yield ids[a:b], sentences[c:d] - a

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        return next(self.encode_all([text]))


def _upto(size: np.ndarray) -> np.ndarray:
    """Sums of the first 0, 1, 2 ... numbers."""
    return np.concatenate([[0], np.cumsum(size)])


def _runs(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """``first[0] .. first[0] + size[0] - 1, first[1] ..`` and so on."""
    upto = np.cumsum(size)
    return np.repeat(first - upto + size, size) + np.arange(upto[-1] if len(upto) else 0)


def groups(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Start and number of neighbouring texts of about ``GROUP`` bytes together, one text at least."""
    upto = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(upto):
        to = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + GROUP, "right")))
        yield at, to - at
        at = to


def places(length: int, sentences: np.ndarray) -> tuple[list[int], list[int]]:
    """Places of a document of ``length`` tokens where a window may end, and what that costs."""
    at: list[int] = []
    costs: list[int] = []
    last = 0
    for end in [*sentences.tolist(), length]:
        if end - last > LONG_SENTENCE:
            inside = range(last + LONG_SENTENCE, end, LONG_SENTENCE)
            at += inside
            costs += repeat(INSIDE, len(inside))
        if last < end < length:
            at.append(end)
            costs.append(SENTENCE_END)
        last = max(last, end)
    if length:
        at.append(length)
        costs.append(DOCUMENT_END)
    return at, costs


def choose_cuts(at: list[int], costs: list[int], window: int) -> list[int]:
    """Ends of windows that cover ``0 .. at[-1]``: the least sum of padding and costs.

    ``at`` rises by at most ``window``. The queue holds, from ``head`` on, the starts that can
    still be best for the current end, their values (cost so far plus position) rising.
    """
    starts, values = [0, *at], [0]
    queue, head = [0], 0  # numbers of starts
    before = []
    for j, (end, cost) in enumerate(zip(at, costs), 1):
        while end - starts[queue[head]] > window:
            head += 1
        i = queue[head]
        before.append(i)
        value = values[i] + window + cost  # = cost of the best plan up to here + position
        while values[queue[-1]] >= value:  # never the start at the head, whose value is less
            queue.pop()
        queue.append(j)
        values.append(value)
    cuts, j = [], len(at)
    while j:
        cuts.append(at[j - 1])
        j = before[j - 1]
    return cuts[::-1]


def _sequences(documents: Iterable[tuple[object, np.ndarray, tuple[list[int], list[int]]]], window: int, stretch: int) -> Iterator[tuple]:
    """Pieces ``(key, start, ids, document's tokens, sequence, offset)`` in order."""
    waiting: list[tuple[object, int, np.ndarray, int]] = []  # key, start, ids, tokens of the document
    at: list[int] = []
    costs: list[int] = []
    held, number = 0, 0

    def close(cuts: list[int]) -> Iterator[tuple]:
        """Gives out what lies before the last of ``cuts`` and keeps the rest waiting."""
        nonlocal waiting, at, costs, held, number
        cut, offset, pos, rest = iter(cuts), 0, 0, []
        end = next(cut, None)
        for key, start, ids, total in waiting:
            taken = 0
            while end is not None and taken < len(ids):
                take = min(len(ids) - taken, end - pos)
                yield key, start + taken, ids[taken : taken + take], total, number, offset
                taken, pos, offset = taken + take, pos + take, offset + take
                if pos == end:
                    end, offset, number = next(cut, None), 0, number + 1
            if taken < len(ids):
                rest.append((key, start + taken, ids[taken:], total))
        done = cuts[-1] if cuts else 0
        keep = [k for k, p in enumerate(at) if p > done]
        waiting, at, costs, held = rest, [at[k] - done for k in keep], [costs[k] for k in keep], held - done

    for key, ids, (ends, prices) in documents:
        waiting.append((key, 0, ids, len(ids)))
        at += [held + p for p in ends]
        costs += prices
        held += len(ids)
        if held >= stretch:
            yield from close(choose_cuts(at, costs, window)[:-2])
    if held:
        yield from close(choose_cuts(at, costs, window))


def pack(
    df: DataFrame,
    vocabulary: str,
    key: str = "doc_id",
    text: str = "text",
    end_id: int = 1,
    window: int = WINDOW,
    stretch: int = STRETCH,
) -> DataFrame:
    """Pieces of all documents: ``key, start, length, doc_tokens, sequence_id, offset, ids``.

    A document is its ids and then ``end_id``; ``start`` counts its ids before the piece, and
    ``ids`` holds the piece as little-endian unsigned 32-bit numbers. Each id lies in exactly one
    piece and each window holds at most ``window`` ids, documents in the order they are read. A
    NULL or empty text is the end id alone; a NULL key stays NULL; repeated rows are documents
    of their own; extra columns are not carried; an empty table gives no pieces.

    Nothing is shuffled: each task packs its own input as a stream and holds about ``stretch``
    tokens and one document, so only the last window of a task is left short. The number of a
    sequence is made of the task's number and a counter; a task that runs again reads the same
    rows and gives the same numbers, and a repeated plan over the same files does too.
    """
    schema = StructType(
        [StructField(key, df.schema[key].dataType)]
        + [StructField(c, LongType(), False) for c in ("start", "length", "doc_tokens", "sequence_id", "offset")]
        + [StructField("ids", BinaryType(), False)]
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(vocabulary)
        base = TaskContext.get().partitionId() << 40
        kind = None

        def documents():
            nonlocal kind
            for batch in batches:
                kind = batch.schema.field(0).type
                for at, n in groups(batch.column(1)):
                    keys, texts = (batch.column(c).slice(at, n).to_pylist() for c in (0, 1))
                    for k, (ids, ends) in zip(keys, coder.encode_all([t or "" for t in texts])):
                        yield k, np.append(ids, np.uint32(end_id)).astype("<u4"), places(len(ids) + 1, ends)

        def out(rows: list[tuple]) -> pa.RecordBatch:
            keys, starts, ids, totals, numbers, offsets = zip(*rows)
            numeric = (starts, [len(i) for i in ids], totals, [base + n for n in numbers], offsets)
            return pa.RecordBatch.from_arrays(
                [pa.array(keys, kind), *(pa.array(x, pa.int64()) for x in numeric), pa.array([i.tobytes() for i in ids], pa.binary())],
                names=schema.names,
            )

        rows: list[tuple] = []
        for piece in _sequences(documents(), window, stretch):
            rows.append(piece)
            if len(rows) == 2048:
                yield out(rows)
                rows = []
        if rows:
            yield out(rows)

    return small_batches(df).select(F.col(f"`{key}`"), F.col(f"`{text}`")).mapInArrow(run, schema)


_CODERS: dict[str, WordTokens] = {}


def _coder(vocabulary: str) -> WordTokens:
    """One for each worker, so that what it has learnt serves later tasks too."""
    if vocabulary not in _CODERS:
        _CODERS[vocabulary] = WordTokens(vocabulary)
    return _CODERS[vocabulary]
