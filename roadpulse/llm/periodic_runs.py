"""Periodic runs of words as maximal pairs of a bottom-up LCP-interval tree.

A pair of places whose texts agree for ``l`` words and no further to either side is a maximal
pair. If its distance ``p`` is at most ``l``, the stretch from the first place to the end of the
second copy repeats with period ``p`` and cannot be extended: it is a run as it stands. The
suffixes of a batch of texts are sorted by doubling, and the tree of their common beginnings is
walked from the leaves up. Every node holds its places in order, cut into classes of the word to
their left, so that a place meets only partners of other classes within its distance.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left, bisect_right, insort

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.common import map_texts, prepare, texts

MIN_LENGTH = 12


def suffix_order(symbols: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Places that share about ``least`` symbols with another, in suffix order.

    Also returns how many symbols each shares with the one before it. The last symbol must be
    unique. Only places whose beginnings are not yet told apart are sorted on.
    """
    n = len(symbols)
    kind = np.int32 if n < 2**31 else np.int64
    order = np.argsort(symbols, kind="stable")
    new = np.ones(n, bool)
    new[1:] = symbols[order[1:]] != symbols[order[:-1]]
    heads = np.flatnonzero(new)
    rank = np.empty(n, kind)
    rank[order] = np.repeat(heads, np.diff(heads, append=n))
    live = order[~(new & np.append(new[1:], True))]
    width, steps, shared = 1, [], live
    while len(live):
        steps.append((width, rank.copy()))
        if width <= least:
            shared = live
        key = rank[live].astype(np.int64) * n + rank[live + width]
        by_key = np.argsort(key, kind="stable")
        live, key = live[by_key], key[by_key]
        new = np.append(True, key[1:] != key[:-1])
        group = np.append(True, key[1:] // n != key[:-1] // n)
        at = np.arange(len(live))
        offset = np.maximum.accumulate(np.where(new, at, 0)) - np.maximum.accumulate(np.where(group, at, 0))
        rank[live] += offset.astype(kind)
        live = live[~(new & np.append(new[1:], True))]
        width *= 2
    shared = shared[np.argsort(rank[shared], kind="stable")]
    common = np.zeros(len(shared), np.int64)
    a, b = shared[:-1], shared[1:]
    for width, ranks in reversed(steps):
        common[1:] += np.where(ranks[a + common[1:]] == ranks[b + common[1:]], width, 0)
    return shared, common


class Node:
    """Places below a node in order, and those of them that begin a class of one left word."""

    __slots__ = ("common", "heads", "places")

    def __init__(self, common: int, place: int):
        self.common, self.places, self.heads = common, [place], [place]

    def pairs(self, place: int, left: dict[int, int]):
        """Partners of ``place`` within the common length and with another word to the left."""
        mine, places = left[place], self.places
        at, end = bisect_left(places, place - self.common), place + self.common
        while at < len(places) and places[at] <= end:
            if left[places[at]] == mine:
                # over the whole class at once
                head = bisect_right(self.heads, places[at])
                if head == len(self.heads):
                    return
                at = bisect_left(places, self.heads[head])
            else:
                yield places[at]
                at += 1

    def add(self, place: int, left: dict[int, int]) -> None:
        at = bisect_left(self.places, place)
        self.places.insert(at, place)
        if at == 0 or left[self.places[at - 1]] != left[place]:
            insort(self.heads, place)
        if at + 1 < len(self.places):
            after = self.places[at + 1]
            head = bisect_left(self.heads, after)
            begins = head < len(self.heads) and self.heads[head] == after
            if begins and left[after] == left[place]:
                del self.heads[head]
            elif not begins and left[after] != left[place]:
                self.heads.insert(head, after)


def close_pairs(places: list[int], common: list[int], left: dict[int, int]) -> list[tuple[int, int, int]]:
    """Maximal pairs of one subtree no farther apart than they agree: first place, distance, length.

    ``common[k]`` is what ``places[k]`` shares with the place before it, for k from 1 on.
    """
    found = []

    def join(parent: Node, child: Node) -> Node:
        big, little = (parent, child) if len(parent.places) >= len(child.places) else (child, parent)
        big.common = shared = parent.common
        for place in little.places:
            for other in big.pairs(place, left):
                found.append((min(place, other), abs(place - other), shared))
        for place in little.places:
            big.add(place, left)
        return big

    open_nodes: list[Node] = []
    child = Node(0, places[0])
    for place, shared in zip(places[1:], common[1:]):
        while open_nodes and open_nodes[-1].common > shared:
            child = join(open_nodes.pop(), child)
        if open_nodes and open_nodes[-1].common == shared:
            open_nodes[-1] = join(open_nodes[-1], child)
        else:
            child.common = shared
            open_nodes.append(child)
        child = Node(0, place)
    while open_nodes:
        child = join(open_nodes.pop(), child)
    return found


def runs(symbols: np.ndarray, min_length: int = MIN_LENGTH) -> np.ndarray:
    """Rows (start, length, smallest period) of all runs, by start and period.

    A run has at least two periods and ``min_length`` symbols. Texts in ``symbols`` must have
    symbols of their own, and each ends with a unique one.
    """
    none = np.empty((0, 3), np.int64)
    # a run of two periods and min_length symbols has a pair that agrees for half of them
    least = max(1, (min_length + 1) // 2)
    if len(symbols) < 2:
        return none
    places, common = suffix_order(symbols, least)
    if len(places) < 2:
        return none
    left = np.append(-1, symbols[:-1])
    # subtrees of nodes with at least `least` symbols, without those that cannot hold a pair
    tree = np.cumsum(common < least)
    first = np.flatnonzero(np.append(True, tree[1:] != tree[:-1]))
    by_place = np.lexsort((places, tree))
    gap = np.diff(places[by_place], prepend=0)
    gap[first] = len(symbols)
    inside = np.where(common >= least, common, 0)
    near = np.minimum.reduceat(gap, first) <= np.maximum.reduceat(inside, first)
    lefts = left[places]
    mixed = np.maximum.reduceat(lefts, first) != np.minimum.reduceat(lefts, first)
    size = np.diff(first, append=len(places))
    keep = near & mixed
    # two leaves: one pair, no tree to walk
    two = first[keep & (size == 2)]
    start, distance = np.minimum(places[two], places[two + 1]), np.abs(places[two + 1] - places[two])
    pairs = [np.column_stack((start, distance, common[two + 1]))]
    for at, n in zip(first[keep & (size > 2)].tolist(), size[keep & (size > 2)].tolist()):
        mine = places[at : at + n]
        left_of = dict(zip(mine.tolist(), left[mine].tolist()))
        found = close_pairs(mine.tolist(), common[at : at + n].tolist(), left_of)
        if found:
            pairs.append(np.array(found, np.int64))
    found = np.concatenate(pairs)
    start, period, length = found[:, 0], found[:, 1], found[:, 1] + found[:, 2]
    whole = length >= np.maximum(2 * period, min_length)
    start, period, length = start[whole], period[whole], length[whole]
    # a stretch also repeats with multiples of its smallest period
    order = np.lexsort((period, length, start))
    start, period, length = start[order], period[order], length[order]
    smallest = np.append(True, (start[1:] != start[:-1]) | (length[1:] != length[:-1]))[: len(start)]
    start, period, length = start[smallest], period[smallest], length[smallest]
    order = np.lexsort((period, start))
    return np.column_stack((start[order], length[order], period[order]))


def kept_words(n: int, found: np.ndarray) -> np.ndarray:
    """Which of ``n`` words no run covers after its first period."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, found[:, 0] + found[:, 2], 1)
    np.add.at(change, found[:, 0] + found[:, 1], -1)
    return np.cumsum(change[:n]) == 0


def planted(key: bytes, n: int) -> np.ndarray | None:
    """Word numbers of a text of ``n`` words that is made periodic, for one id in ten."""
    h = zlib.crc32(key)
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    return np.where(at < a, at, a + (at - a) % p)


SCHEMA = (
    "n_words bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, "
    "runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"
)
DIGEST = (
    "n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, "
    "runs_sha256 string, collapsed_sha256 string"
)
# Words whose suffixes are sorted at once; a longer text goes by itself.
BLOCK_WORDS = 1 << 19


def _scan(ids: list, blobs: list[bytes], min_length: int, plant: bool):
    """Words and runs of each text; runs count words from the text's start."""
    block: list[list[bytes]] = []
    symbols: list[np.ndarray] = []
    size = base = 0

    def solve():
        found = runs(np.concatenate(symbols), min_length)
        ends = np.cumsum([len(s) for s in symbols])
        cuts = np.searchsorted(found[:, 0], ends)
        for k, words in enumerate(block):
            mine = found[cuts[k - 1] if k else 0 : cuts[k]].copy()
            mine[:, 0] -= ends[k - 1] if k else 0
            yield words, mine

    for doc_id, blob in zip(ids, blobs):
        # bytes.split parts at exactly the six white space signs of the word rule
        words = blob.split()
        numbers = planted(b"" if doc_id is None else str(doc_id).encode(), len(words)) if plant else None
        if numbers is not None:
            words = [words[i] for i in numbers.tolist()]
        known: dict[bytes, int] = {}
        own = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
        if block and size + len(words) > BLOCK_WORDS:
            yield from solve()
            block, symbols, size, base = [], [], 0, 0
        symbols.append(np.append(own, len(known)) + base)
        base += len(known) + 1
        size += len(words) + 1
        block.append(words)
    if block:
        yield from solve()


def _longest(found: np.ndarray) -> tuple:
    if not len(found):
        return (None,) * 4
    start, length, period = found[np.lexsort((found[:, 2], found[:, 0], -found[:, 1]))[0]].tolist()
    return start, length, period, 1000 * length // period


def find_runs(docs: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """All periodic runs of each row's words, its longest run, and its text without repeats.

    One row per input row: doc_id, n_words, n_runs, start, length, period and exponent_milli of
    the longest run (ties: smallest start, then period; null without runs), runs by start and
    period, and ``collapsed``, the words no run covers after its first period. Null and empty
    texts have no words, no runs and an empty collapsed text; an empty table gives an empty
    result; other columns are left out, whatever their names. Nothing is shuffled; memory goes
    with a batch of texts or one longer text, repeated rows are scanned as they come.
    """
    prepare(docs.sparkSession)

    def scan(ids, blobs: list[bytes]) -> dict[str, list]:
        names = ["n_words", "n_runs", "start", "length", "period", "exponent_milli"]
        made: dict[str, list] = {n: [] for n in [*names, "runs", "collapsed"]}
        for words, found in _scan(ids.to_pylist(), blobs, min_length, False):
            kept = kept_words(len(words), found).tolist()
            row = (len(words), len(found), *_longest(found))
            for name, value in zip(names, row):
                made[name].append(value)
            made["runs"].append([dict(zip(("start", "length", "period"), r)) for r in found.tolist()])
            made["collapsed"].append(b" ".join(w for w, k in zip(words, kept) if k).decode())
        return made

    return map_texts(texts(docs).withColumn("text", F.col("text").cast("binary")), SCHEMA, scan)


def digest(docs: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """The longest run and hashes of all runs and of the text without repeats, per row.

    One id in ten has its words from a place on made periodic first (``planted``; null ids
    count as the empty text). Edge cases are those of ``find_runs``.
    """
    prepare(docs.sparkSession)

    def scan(ids, blobs: list[bytes]) -> dict[str, list]:
        rows = []
        for words, found in _scan(ids.to_pylist(), blobs, min_length, True):
            if len(found):
                lines = "".join(f"{s},{n},{p}\n" for s, n, p in found.tolist()).encode()
                kept = kept_words(len(words), found).tolist()
                words = [w for w, k in zip(words, kept) if k]
            else:
                lines = b""
            hashes = (hashlib.sha256(lines).hexdigest(), hashlib.sha256(b" ".join(words)).hexdigest())
            rows.append((len(found), *_longest(found), *hashes))
        names = [part.split()[0] for part in DIGEST.split(", ")]
        return dict(zip(names, map(list, zip(*rows)))) if rows else {n: [] for n in names}

    return map_texts(texts(docs).withColumn("text", F.col("text").cast("binary")), DIGEST, scan)
