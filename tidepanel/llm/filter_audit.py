"""What each filter of a chain removes in every order of the chain, from sorted posting lists.

For each part of the table and each range of ids, the ids that fail a filter are one sorted list.
What a filter removes after some others is its list without the union of theirs. Unions are
merged and differences taken list by list: the list with the smallest head is followed by
galloping (doubling steps, then bisection) up to the next list's head, and the whole run is taken
at once. Sizes are summed over ranges, so no list of a whole part ever exists. An order of the
chain needs only sums for (filters before, filter), of which there are ``k * 2^(k-1)``.
"""

from __future__ import annotations

import itertools
import math
from bisect import bisect_left
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepanel.session import materialize

#: ids in one range of a part
RANGE_ROWS = 16384

#: stands for rows without an id, which fail no comparison with other ids and have no labels
NO_ID = -(1 << 63)

SPACE = "[ \\x09-\\x0D]+"


def gallop(ids: list[int], target: int, at: int) -> int:
    """The first position from ``at`` on whose id is ``target`` or more."""
    low, high, step = at, at, 1
    while high < len(ids) and ids[high] < target:
        low, high, step = high + 1, high + step, step * 2
    return bisect_left(ids, target, low, min(high, len(ids)))


def union(lists: Sequence[list[int]]) -> list[int]:
    """Merge of any number of sorted lists without repeats, run by run."""
    out: list[int] = []
    heads = [[ids[0], 0, ids] for ids in lists if ids]
    while len(heads) > 1:
        heads.sort(key=lambda h: h[0])
        value, at, ids = heads[0]
        # all that lies before the next head is one run of this list
        end = gallop(ids, heads[1][0], at)
        out += ids[at:end]
        if end < len(ids) and ids[end] == heads[1][0]:
            end += 1
        heads[0][1] = end
        if end == len(ids):
            heads.pop(0)
        else:
            heads[0][0] = ids[end]
    for _, at, ids in heads:
        out += ids[at:]
    return out


def difference(ids: list[int], without: list[int]) -> list[int]:
    """``ids`` that aren't in ``without``, run by run."""
    out: list[int] = []
    i = j = 0
    while i < len(ids):
        j = gallop(without, ids[i], j)
        if j == len(without):
            out += ids[i:]
            break
        end = gallop(ids, without[j], i)
        out += ids[i:end]
        i = end + (end < len(ids) and ids[end] == without[j])
    return out


def common(a: list[int], b: list[int]) -> int:
    """How many ids two lists share; the shorter one leads."""
    if len(a) > len(b):
        a, b = b, a
    n = j = 0
    for x in a:
        j = gallop(b, x, j)
        if j == len(b):
            break
        n += b[j] == x
    return n


def posting_lists(rows: DataFrame, filters: Sequence[str], marks: Sequence[str] = ()) -> DataFrame:
    """``part, weight, n_rows`` and one sorted id list for each filter and mark, a row for each range of ids.

    ``rows``: ``part``, ``id`` and a Boolean for each of the names. Rows that repeat an id with the same
    flags are one entry with a weight; ids of one weight share a range, and further flags of one
    id go to a list of their own, so a list never repeats an id. Ranges of a part are cut by count, so
    a hot part is spread over tasks.
    """
    names = [*filters, *marks]
    mask = sum((F.when(F.col(c), F.lit(1 << i)).otherwise(0) for i, c in enumerate(names)), F.lit(0))
    counted = rows.groupBy("part", F.coalesce("id", F.lit(NO_ID)).alias("id"), mask.alias("mask")).agg(F.count("*").alias("weight"))
    ordered = counted.repartitionByRange("part", "id").sortWithinPartitions("part", "id", "mask")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], tuple[list, list]] = {}
        part, last, layer, size = None, None, 0, 0

        def flush() -> pa.RecordBatch:
            lists: list[list] = [[] for _ in names]
            for ids, masks in held.values():
                ids, masks = np.array(ids, np.int64), np.array(masks)
                for i, column in enumerate(lists):
                    column.append(ids[(masks >> i) & 1 == 1])
            return pa.RecordBatch.from_arrays(
                [pa.array([part] * len(held)), pa.array([w for w, _ in held], pa.int64()), pa.array([len(x) for x, _ in held.values()], pa.int64()),
                 *(pa.array(c, pa.list_(pa.int64())) for c in lists)],
                names=["part", "weight", "n_rows", *names],
            )

        for batch in batches:
            for p, i, m, w in zip(*(c.to_pylist() for c in batch.columns)):
                layer = layer + 1 if (p, i) == last else 0
                if held and (p != part or size >= RANGE_ROWS and layer == 0):
                    yield flush()
                    held, size = {}, 0
                part, last = p, (p, i)
                ids, masks = held.setdefault((w, layer), ([], []))
                ids.append(i)
                masks.append(m)
                size += 1
        if held:
            yield flush()

    schema = "part string, weight long, n_rows long, " + ", ".join(f"`{c}` array<long>" for c in names)
    return ordered.select("part", "id", "mask", "weight").mapInArrow(run, schema)


def removals(lists: DataFrame, filters: Sequence[str], marks: Sequence[str] = ()) -> DataFrame:
    """``part, before, filter, n_rows, together, removed`` and ``lost_<mark>``: sizes of each filter's list without the
    union of the lists ``before`` (a bit for each filter), and of that union with it, summed over ranges.

    ``filter`` counts from 0; ``n_rows`` is the part's size."""
    k = len(filters)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for row in batch.to_pylist():
                own = [row[c] for c in filters]
                good = [row[c] for c in marks]
                merged = [union([own[i] for i in range(k) if s >> i & 1]) for s in range(1 << k)]
                for s in range(1 << k):
                    for i in range(k):
                        if not s >> i & 1:
                            gone = difference(own[i], merged[s])
                            sizes = [row["n_rows"], len(merged[s | 1 << i]), len(gone), *(common(gone, g) for g in good)]
                            out.append((row["part"], s, i, *(x * row["weight"] for x in sizes)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=names)

    names = ["part", "before", "filter", *(sizes := ["n_rows", "together", "removed", *(f"lost_{m}" for m in marks)])]
    schema = "part string, before long, filter long, " + ", ".join(f"{c} long" for c in sizes)
    return lists.mapInArrow(run, schema).groupBy("part", "before", "filter").agg(*[F.sum(c).alias(c) for c in sizes])


def all_orders(sums: DataFrame, filters: Sequence[str], marks: Sequence[str] = ()) -> DataFrame:
    """``part, filter_order, step, kept, removed, redundant, unique_fails, lost_<mark>, shapley`` of every order."""
    k = len(filters)
    steps = [
        ("".join(filters[i] for i in order), at + 1, sum(1 << i for i in order[:at]), order[at])
        for order in itertools.permutations(range(k))
        for at in range(k)
    ]
    # k * k! rows, fixed by the number of filters
    chain = F.broadcast(sums.sparkSession.createDataFrame(steps, "filter_order string, step int, before long, filter long"))
    n_before = F.bit_count("before")
    # how many orders put just these filters before and the others behind
    ways = F.get(F.array(*[F.lit(math.factorial(j) * math.factorial(k - 1 - j)) for j in range(k)]), n_before)
    whole = sums.groupBy("part", "filter").agg(
        F.sum(F.col("removed") * ways).alias("shapley"),
        F.sum(F.when(n_before == 0, F.col("removed"))).alias("fails"),
        F.sum(F.when(n_before == k - 1, F.col("removed"))).alias("unique_fails"),
    )
    lost = [f"lost_{m}" for m in marks]
    return sums.join(whole, ["part", "filter"]).join(chain, ["before", "filter"]).select(
        "part", "filter_order", "step", (F.col("n_rows") - F.col("together")).alias("kept"), "removed",
        (F.col("fails") - F.col("removed")).alias("redundant"), "unique_fails", *lost, "shapley",
    )


def repeats(rows: DataFrame) -> DataFrame:
    """``rows`` (with ``id`` and ``digest``) and ``repeat``: whether a smaller id has the same digest.

    Only a digest's smallest id doesn't repeat another's, so rows look up their own (digest, id) among these, and a
    digest with very many rows is nowhere one group. A NULL id repeats nothing.
    """
    least = rows.where("id IS NOT NULL").groupBy("digest").agg(F.min("id").alias("id")).withColumn("repeat", F.lit(False))
    known = rows.where("id IS NOT NULL").join(least, ["id", "digest"], "left").withColumn("repeat", F.coalesce("repeat", F.lit(True)))
    return known.unionByName(rows.where("id IS NULL").withColumn("repeat", F.lit(False)))


def word_flags(text: Column) -> dict[str, Column]:
    """Failures that a text alone decides. Words are what stands between spaces and the characters 9 to 13."""
    words = F.filter(F.split(text, SPACE), lambda w: w != "")
    return {
        "A": F.size(words) < 100,
        "B": 100 * F.size(F.array_distinct(words)) < 80 * F.size(words),
        "C": 100 * (F.length(text) - F.length(F.regexp_replace(text, "[A-Z]", ""))) > 10 * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def audit(docs: DataFrame, labels: DataFrame, part: str = "lang", key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every order of the filters A (under 100 words), B (under 80 % distinct words), C (over 10 % of the characters in
    A-Z), D (holds one of ``#$%&*|``) and E (same text as a smaller key, table-wide) over each part.

    One row for each part, order and step with the counts of ``all_orders``; marks are ``quality`` and ``toxic`` (1 in
    any label row of the key). A NULL text is empty, a NULL part is the empty string, each row counts as one
    document. A NULL key repeats nothing and has no labels. An empty table has no parts and gives no rows. Extra columns are not read.
    """
    filters, marks = list("ABCDE"), ["quality", "toxic"]
    text_or_empty = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    facts = docs.select(F.col(f"`{key}`").cast("long").alias("id"), F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"), text_or_empty.alias("text"))
    facts = facts.select("id", "part", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"), *[c.alias(n) for n, c in word_flags(F.col("text")).items()])
    flagged = repeats(materialize(facts, "facts")).withColumnRenamed("repeat", "E")
    known = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("id"))
    known = known.agg(*[F.coalesce(F.bool_or(F.col(m) == 1), F.lit(False)).alias(m) for m in marks])
    lists = materialize(posting_lists(flagged.join(known, "id", "left"), filters, marks), "postings")
    return all_orders(materialize(removals(lists, filters, marks), "removals"), filters, marks)
