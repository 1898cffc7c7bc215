"""Best-fit packing of documents after Martello and Toth's dominance reduction.

Only the lengths of pieces matter to a packing, and there are at most ``capacity`` of them, so
the packing is made for counts of lengths: sets of up to three lengths that dominate every other
set with their largest length are fixed, as often as their counts allow, the instance shrinks,
and best-fit (longest first) packs what is left. The plan is a table of slots whose size is
bounded by the number of lengths, whatever the number of documents; Spark numbers the pieces of
each length and joins them with the slots.
"""

from __future__ import annotations

import json
import re
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from roadpulse.llm.common import prepare, stored, texts
from roadpulse.llm.token_counts import _byte_letters

CAPACITY = 1024
END_ID = 2

# How the vocabulary's tokenizer cuts a text before merging bytes (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# A text with an unbroken run so long goes to the library whose merging takes n log n steps.
LONG_RUN = re.compile(r"\S{500}|\s{500}")


class Encoder:
    """Token ids of a text by a byte-level vocabulary file.

    Two libraries give the same ids: ``tokenizers`` reads the file itself, ``tiktoken`` takes
    its pieces as ranks and is four times as fast.
    """

    def __init__(self, path: str):
        self.slow = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        special = {t["content"]: t["id"] for t in content["added_tokens"]}
        letters = _byte_letters()
        ranks = {
            bytes(letters[c] for c in piece): i
            for piece, i in content["model"]["vocab"].items()
            if piece not in special
        }
        self.fast = tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def __call__(self, text: str) -> list[int]:
        if LONG_RUN.search(text):
            return self.slow.encode(text, add_special_tokens=False).ids
        return self.fast.encode(text, allowed_special="all")


@lru_cache(maxsize=2)
def load_encoder(path: str) -> Encoder:
    """Built once per Python process; its size is that of the vocabulary file."""
    return Encoder(path)


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of the pieces of ``n`` tokens: the first may be shorter."""
    first = n % capacity or capacity
    return [(0, first)] + [(at, capacity) for at in range(first, n, capacity)] if n else []


def pieces(
    docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = True
) -> DataFrame:
    """Every document's pieces: doc_id, piece, start, length, ids_crc32 and, if wanted, ids.

    ``task`` and ``nth`` say which task cut the piece and how many of its length that task had
    cut before; they number pieces only once the result is written.
    """
    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, task bigint, nth bigint"
    kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 5]
    if with_ids:
        schema, kinds = f"{schema}, ids array<int>", [*kinds, pa.list_(pa.int32())]
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = load_encoder(vocabulary)
        task = TaskContext.get().partitionId()
        seen: Counter = Counter()
        for batch in batches:
            rows = []
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                ids = np.array([*encode(text), end_id], "<u4")
                for piece, (start, length) in enumerate(cut(len(ids), capacity)):
                    part = ids[start : start + length]
                    row = (doc_id, piece, start, length, zlib.crc32(part.tobytes()), task, seen[length])
                    rows.append((*row, part.astype(np.int32)) if with_ids else row)
                    seen[length] += 1
            columns = list(zip(*rows)) if rows else [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return texts(docs).mapInArrow(run, schema)


class Group(NamedTuple):
    """``bins`` sequences, each of ``times`` pieces of each ``length`` listed in ``filling``."""

    bins: int
    filling: tuple[tuple[int, int], ...]

    def used(self) -> int:
        return sum(length * times for length, times in self.filling)


class _Lengths:
    """A multiset of lengths, ascending."""

    def __init__(self, counts: dict[int, int]):
        self.n = {length: n for length, n in counts.items() if n}
        self.order = sorted(self.n)

    def take(self, filling: Counter, times: int) -> None:
        for length, each in filling.items():
            self.n[length] -= each * times
            if not self.n[length]:
                del self.n[length], self.order[bisect_left(self.order, length)]

    def smallest(self, k: int, above: int, below: int, without: int | None) -> list[int]:
        """The k smallest lengths between two bounds, themselves excluded, copies counted."""
        found: list[int] = []
        at = bisect_left(self.order, above + 1)
        while len(found) < k and at < len(self.order) and self.order[at] < below:
            length = self.order[at]
            found += [length] * min(k - len(found), self.n[length] - (length == without))
            at += 1
        return found

    def largest(self, room: int, without: int) -> int:
        """The greatest length of at most ``room`` besides one of ``without``; 0 if none."""
        at = bisect_left(self.order, room + 1) - 1
        while at >= 0 and self.n[self.order[at]] == (self.order[at] == without):
            at -= 1
        return self.order[at] if at >= 0 else 0

    def best_pair(self, room: int, without: int) -> tuple[int, int]:
        """Two lengths, the greater first, whose sum is the greatest of at most ``room``."""
        held = lambda x: self.n[x] - (x == without)
        usable = [x for x in self.order[: bisect_left(self.order, room)] if held(x)]
        best, low, high = (0, 0), 0, len(usable) - 1
        while low <= high:
            total = usable[low] + usable[high]
            fits = total <= room and (low < high or held(usable[low]) > 1)
            if fits and total > sum(best):
                best = (usable[high], usable[low])
            low, high = (low + 1, high) if total <= room else (low, high - 1)
        return best


def dominating(lengths: _Lengths, longest: int, capacity: int) -> tuple[int, ...] | None:
    """A set with ``longest`` that dominates all feasible sets with it, if a rule proves one.

    A set dominates another if every piece of the other can be dealt into places of pieces of
    the first at least as long; then some best packing has the first as a sequence.
    """
    room = capacity - longest
    small = lengths.smallest(3, 0, room + 1, longest)
    fitting = sum(sum(small[: i + 1]) <= room for i in range(len(small)))
    if not fitting:
        return (longest,)
    partner = lengths.largest(room, longest)
    # one partner at most, or a full sequence: whatever else goes along fits in the partner's place
    if fitting == 1 or partner == room:
        return (longest, partner)
    if fitting > 2:
        return None
    first, second = lengths.best_pair(room, longest)
    if partner >= first + second:
        return (longest, partner)
    if partner == first:
        # any other pair either fits in place of these two or lies between them
        between = lengths.smallest(2, second, first, longest)
        if len(between) < 2 or sum(between) > room:
            return (longest, first, second)
    return None


def reduce(lengths: _Lengths, capacity: int) -> list[Group]:
    """Fix dominating sets, longest pieces first, until no rule applies; shrinks ``lengths``.

    A rule that holds goes on holding while its lengths last, so a set is fixed at once as
    often as they do.
    """
    fixed: list[Group] = []
    changed = True
    while changed:
        changed = False
        for length in lengths.order[::-1]:
            while length in lengths.n and (found := dominating(lengths, length, capacity)):
                filling = Counter(found)
                times = min(lengths.n[x] // each for x, each in filling.items())
                fixed.append(Group(times, tuple(filling.items())))
                lengths.take(filling, times)
                changed = True
    return fixed


def best_fit(lengths: _Lengths, capacity: int) -> list[Group]:
    """Best-fit, longest first: each piece goes where it leaves the least room."""
    groups: dict[int, list[Group]] = {capacity: []}

    def put(group: Group) -> None:
        if group.bins:
            groups.setdefault(capacity - group.used(), []).append(group)

    for length in lengths.order[::-1]:
        left = lengths.n[length]
        for room in sorted(r for r in groups if r >= length):
            times = room // length
            while left and groups[room]:
                bins, filling = groups[room].pop()
                full, rest = min(bins, left // times), 0
                put(Group(full, (*filling, (length, times))))
                left -= full * times
                if full < bins and left:
                    rest, left = left, 0
                    put(Group(1, (*filling, (length, rest))))
                put(Group(bins - full - bool(rest), filling))
        times = capacity // length
        put(Group(left // times, ((length, times),)))
        if left % times:
            put(Group(1, ((length, left % times),)))
    return [g for held in groups.values() for g in held]


def pack_counts(counts: dict[int, int], capacity: int = CAPACITY) -> list[Group]:
    """Sequences for so many pieces of each length, dominating sets first."""
    lengths = _Lengths(counts)
    return reduce(lengths, capacity) + best_fit(lengths, capacity)


def slots(groups: list[Group]) -> list[tuple[int, int, int, int, int, int]]:
    """Places of the groups' pieces: length, first and last number, times, sequence, offset."""
    used: Counter = Counter()
    sequence, made = 0, []
    for bins, filling in groups:
        offset = 0
        for length, times in filling:
            first = used[length]
            used[length] += bins * times
            made.append((length, first, used[length] - 1, times, sequence, offset))
            offset += length * times
        sequence += bins
    return made


SLOT = "slot_length bigint, first bigint, last bigint, times bigint, sequence bigint, place bigint"


def pack(
    docs: DataFrame,
    vocabulary: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    with_ids: bool = True,
) -> DataFrame:
    """Pack all documents into as few sequences of at most ``capacity`` tokens as it can.

    Returns one row per piece: doc_id, piece, start, length, ids_crc32, (ids,) sequence_id and
    offset. Every row of ``docs`` is packed, repeated rows and null ids included; null and empty
    texts are the end id alone; an empty table gives an empty result. Only documents longer
    than a sequence are cut. Other columns are left out, whatever their names. The vocabulary
    file must lie at this path on every machine, as a Python package does.

    The driver sees one count per length and a plan bounded by them (at most 44 different
    lengths fit in 1024 tokens, in at most a few thousand kinds of sequences).
    """
    spark = prepare(docs.sparkSession)
    made = stored(pieces(docs, vocabulary, capacity, end_id, with_ids), "pieces")
    by_task = made.groupBy("length", "task").agg(F.count("*").alias("n"))
    counts = by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()
    plan = spark.createDataFrame(slots(pack_counts({r["length"]: r["n"] for r in counts}, capacity)), SLOT)

    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = by_task.select("length", "task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    numbered = made.join(before, ["length", "task"]).withColumn("number", F.col("before") + F.col("nth"))

    here = (F.col("length") == F.col("slot_length")) & F.col("number").between(F.col("first"), F.col("last"))
    nth = F.col("number") - F.col("first")
    return numbered.join(F.broadcast(plan), here).select(
        "doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else []),
        (F.col("sequence") + F.floor(nth / F.col("times"))).alias("sequence_id"),
        (F.col("place") + F.col("length") * (nth % F.col("times"))).alias("offset"),
    )


def sequences(packed: DataFrame) -> DataFrame:
    """The token ids of every sequence, pieces in place; a sequence is bounded by its capacity."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "piece", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id",
        F.flatten(F.transform("parts", lambda p: p["ids"])).alias("ids"),
        F.transform("parts", lambda p: p["offset"]).alias("offsets"),
        F.transform("parts", lambda p: p["doc_id"]).alias("doc_ids"),
    )
