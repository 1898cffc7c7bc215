"""Language-model scoring by online logistic context mixing.

A text is a sequence of bytes and an end, each written as binary decisions by a prefix code that
the two bytes before pick. For
every decision several predictors, one for each kind of context, look up how often either
answer followed in the training texts, in tables of counts that contexts are hashed into. Their
log odds are combined by weights that a gate picks, by whether the longest context (the word so
far) was ever seen, which a table of its own says that grows with the distinct words; the weights adapt after every symbol. The result is refined by a table of its own,
which adapts as well. The sum over all decisions is the log probability of the text.

Texts advance together, one symbol a step, each with weights and a refining table of its own
from its first symbol to its last, so a text has the same score wherever and with whatever it is
scored. All decisions of a symbol are made with what was learnt before it. Tasks get texts of like
length, so that those that advance together end together, and slots are looked up a window of
symbols at a time: memory goes with the bytes of a block of texts,
or of one longer text, by some two dozen bytes a byte.
"""

from __future__ import annotations

import heapq
import math
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.common import crc_mod, stored, texts

END = 256
# Contexts: so many last bytes, and (0) the word so far in lower case; the last is the longest.
ORDERS = (2, 4, 0)
SLOT_BITS = 20
SLOTS = 1 << SLOT_BITS
# Counts travel in rows of so many slots, and so many tables are added up by one task.
CHUNK = 1 << 15
FAN_IN = 64
# Bytes that are counted and that are scored at a time; symbols that are looked up at a time, in
# counting and in scoring.
BLOCK = 3 << 19
SCORE_BLOCK = 9 << 20
PIECE = 1 << 14
WINDOW = 1 << 15
START_WEIGHT = np.float32(0.4)
RATE = np.float32(0.015)
REFINE_BUCKETS = 24
REFINE_RATE = np.float32(0.02)
# Bits for each beginning of a word that the gate tells from unseen ones, and the least and most
# bits in all, as powers of two (the most are 32 MB).
SEEN_SPARE = 16
SEEN_BITS = (16, 28)
# Prefix codes at most, for the commonest pairs of bytes before a symbol and one for the others.
CODES = 512
# Commonest tokens whose counts go to all tasks; the others are joined.
COMMON_TOKENS = 200_000


SYMBOLS = 257
# Blanks are one class of bytes, and so are a letter of A-Z and its small one: the word so far
# tells classes, so one context never meets two codes.
_BLANK = np.isin(np.arange(SYMBOLS), [9, 10, 11, 12, 13, 32, END])
_CLASS = np.where(_BLANK, 32, np.arange(SYMBOLS)).astype(np.uint16)
_CLASS[65:91] += 32


def _paths(weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes, from one on, and answers (lowest bit) on the way to each symbol, and how many, in the tree
    with the fewest of them."""
    heap = [(float(w), s, s) for s, w in enumerate(weights)]
    heapq.heapify(heap)
    children: dict[int, tuple[int, int]] = {}
    name = len(weights)
    while len(heap) > 1:
        (a, _, left), (b, _, right) = heapq.heappop(heap), heapq.heappop(heap)
        children[name] = (left, right)
        heapq.heappush(heap, (a + b, name, name))
        name += 1
    paths: list[list[tuple[int, int]]] = [[] for _ in weights]
    stack = [(heap[0][2], [])]
    while stack:
        node, path = stack.pop()
        if node < len(weights):
            paths[node] = path
            continue
        for bit, child in enumerate(children[node]):
            stack.append((child, [*path, (node - len(weights), bit)]))
    sizes = np.array([len(path) for path in paths])
    return np.array([2 * n + 2 + b for path in paths for n, b in path], np.uint16), sizes


class Code:
    """Prefix codes for 256 bytes and the end: the decisions of each symbol, and a salt for each node.

    There may be several, picked by the classes of the two bytes before (``rows`` says which);
    symbol s of code r goes by the number r * SYMBOLS + s.
    """

    def __init__(self, weights: np.ndarray, rows: np.ndarray | None = None) -> None:
        self.decided, self.sizes = (np.concatenate(c) for c in zip(*map(_paths, np.atleast_2d(weights))))
        self.rows = rows
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)[:-1]])

    def decisions(self, entry: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Answers of some decisions, and the salts of their nodes."""
        decided = self.decided.take(entry)
        salt = (decided >> np.uint16(1)).astype(np.uint32)
        salt *= np.uint32(0x9E3779B1)
        decided &= np.uint16(1)
        return decided.astype(np.uint8), salt

    def numbers(self, symbols: np.ndarray) -> np.ndarray:
        """The numbers of the symbols of texts, each of which ends by END."""
        if self.rows is None:
            return symbols.astype(np.uint32)
        made = np.empty(len(symbols), np.uint32)
        before = np.full(PIECE + 2, 32, np.uint16)
        for low in range(0, len(symbols), PIECE):
            piece = symbols[low : low + PIECE]
            m = len(piece)
            before[2 : m + 2] = _CLASS.take(piece)
            pair = before[:m] << np.uint16(8)
            pair |= before[1 : m + 1]
            number = self.rows.take(pair)
            number *= np.uint32(SYMBOLS)
            number += piece
            made[low : low + m] = number
            before[:2] = before[m : m + 2]
        return made

    @classmethod
    def of_tokens(cls, counts: Iterable[tuple[bytes, int]], total: int) -> Code:
        """Codes for texts of such tokens; they decide the number of decisions, not the model."""
        counts = list(counts)
        plain = _with_blanks(_spread(counts), total)
        # each byte of each token, and the blank behind it, by the two before
        joined = np.frombuffer(b"".join(b"  " + t + b" " for t, _ in counts if t), np.uint8)
        times = np.repeat([n for t, n in counts if t], [len(t) + 3 for t, _ in counts if t])
        blank = joined == 32
        at = np.flatnonzero(~blank | np.append(False, ~blank[:-1]))
        pairs = (_CLASS[joined[at - 2]].astype(np.int64) << 8) | _CLASS[joined[at - 1]]
        pairs[pairs & 255 == 32] = 32 << 8 | 32
        met = np.bincount(pairs, times[at], 1 << 16)
        chosen = np.argsort(-met, kind="stable")[: CODES - 1]
        chosen = chosen[met[chosen] > 0]
        rows = np.zeros(1 << 16, np.uint32)
        rows[chosen] = np.arange(1, len(chosen) + 1)
        rows[np.arange(256) << 8 | 32] = rows[32 << 8 | 32]
        weights = np.zeros((len(chosen) + 1, SYMBOLS))
        np.add.at(weights, (rows[pairs], joined[at]), times[at])
        weights[:, 10] += weights[:, 32] / 50
        weights[:, 65:91] += weights[:, 97:123] / 20
        # what a pair was never seen to be followed by goes by what is common at all
        weights += plain / plain.sum() * (1 + weights.sum(axis=1, keepdims=True) / 1000)
        weights[0] = plain
        return cls(weights, rows)


def _spread(counts: list[tuple[bytes, int]]) -> np.ndarray:
    weights = np.ones(SYMBOLS)
    symbols = np.frombuffer(b"".join(t for t, _ in counts), np.uint8)
    weights[:256] += np.bincount(symbols, np.repeat([n for _, n in counts], [len(t) for t, _ in counts]), 256)
    weights[END] += sum(n for t, n in counts if not t)
    return weights


def _with_blanks(weights: np.ndarray, total: int) -> np.ndarray:
    weights[32] += total
    weights[10] += total / 50
    weights[65:91] += weights[97:123] / 20
    return weights


def _last_bytes(symbols: np.ndarray, text_begins: np.ndarray) -> np.ndarray:
    """The four bytes before each symbol in the same text, the last one lowest."""
    last = np.zeros(len(symbols), np.uint32)
    last[1:] = symbols[:-1]
    last &= np.uint32(255)
    for back in (1, 2):  # two bytes from one, four from two
        last[back:] |= last[:-back] << np.uint32(8 * back)
    for j in range(4):  # near its beginning a text has fewer bytes than that
        at = text_begins[:-1] + j
        at = at[at < text_begins[1:]]
        last[at] &= np.uint32((1 << (8 * j)) - 1)
    return last


def _contexts(last: np.ndarray, words: np.ndarray) -> Iterator[np.ndarray]:
    """Hash of some symbols' contexts, for each order, from their last bytes and words so far."""
    for order in ORDERS:
        if order:
            h = last & np.uint32((1 << (8 * order)) - 1)
            h *= np.uint32(0x85EBCA6B)
            h += np.uint32(order * 7919)
            h ^= h >> np.uint32(15)
            h *= np.uint32(0x9E3779B1)
            yield h
        else:
            yield words


_LOWERED = np.arange(1, 258, dtype=np.uint64)
_LOWERED[65:91] += np.uint64(32)
_BASE = 0x9E3779B97F4A7C15


def _powers(base: int) -> np.ndarray:
    powers = np.full(PIECE, base, np.uint64)
    powers[0] = 1
    return np.cumprod(powers)


_UP, _DOWN = _powers(_BASE), _powers(pow(_BASE, -1, 1 << 64))


def _words_so_far(symbols: np.ndarray, text_begins: np.ndarray) -> np.ndarray:
    """Hash of the lower-case bytes between the last white space and each symbol."""
    n = len(symbols)
    made = np.empty(n, np.uint32)
    fresh = np.zeros(n, bool)
    fresh[text_begins[:-1]] = True
    # of the word that a piece begins within: its hash and, to its length, the base
    carried, power = np.uint64(0), np.uint64(1)
    for low in range(0, n, PIECE):
        piece, new = symbols[low : low + PIECE], fresh[low : low + PIECE]
        m = len(piece)
        before = symbols[max(low - 1, 0) : low + m - 1]
        new[m - len(before) :] |= _BLANK[before]
        sums = np.zeros(m + 1, np.uint64)
        np.cumsum(_LOWERED[piece] * _UP[:m], out=sums[1:])
        begins = np.flatnonzero(new)
        whole = int(begins[0]) if len(begins) else m
        if whole:
            begins = np.concatenate([[0], begins])
        many = np.diff(begins, append=m)
        raw = sums[:-1] - sums[begins].repeat(many)
        raw *= _DOWN[begins].repeat(many)
        raw[:whole] = carried + raw[:whole] * power
        with np.errstate(over="ignore"):
            length = many[-1] - 1
            grown = (power if whole == m else np.uint64(1)) * _UP[length]
            carried = raw[-1] + _LOWERED[piece[-1]] * grown
            power = grown * np.uint64(_BASE)
        raw ^= raw >> np.uint64(29)
        raw *= np.uint64(0xBF58476D1CE4E5B9)
        made[low : low + m] = raw >> np.uint64(32)
    return made


Stretches = tuple[np.ndarray, Iterable[np.ndarray]]


def owners(wanted: np.ndarray) -> np.ndarray:
    """The symbol of each decision, where symbols have ``wanted`` many."""
    return np.repeat(np.arange(len(wanted)), wanted)


def entries(code: Code, symbols: np.ndarray, wanted: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Where the code has each decision of some symbols."""
    entry = (code.starts.take(symbols) - (np.cumsum(wanted) - wanted)).take(owner)
    entry += np.arange(len(entry))
    return entry


def _slots(contexts: np.ndarray, owner: np.ndarray, salt: np.ndarray) -> np.ndarray:
    h = contexts.take(owner)
    h ^= salt
    h *= np.uint32(0xC2B2AE35)
    h >>= np.uint32(32 - SLOT_BITS)
    return h


@dataclass
class Decisions:
    """All decisions of some texts: slots of each predictor, answers, and where symbols begin."""

    slots: list[np.ndarray]
    bits: np.ndarray
    begins: np.ndarray  # first decision of each symbol, one more at the end
    text_begins: np.ndarray  # first symbol of each text, one more at the end


class TextDecisions:
    """The decisions of some texts, whose slots are made for a stretch of them at a time."""

    def __init__(self, encoded: list[bytes], code: Code) -> None:
        sizes = np.array([len(e) + 1 for e in encoded], np.int64)
        text_begins = np.concatenate([[0], np.cumsum(sizes)])
        symbols = np.empty(text_begins[-1], np.uint16)
        symbols[:] = np.frombuffer(b"\0".join(encoded) + b"\0" * bool(encoded), np.uint8)
        symbols[text_begins[1:] - 1] = END
        self.code = code
        self.text_begins = text_begins
        # what contexts are made of lies together with a symbol's number, as both are looked up together
        self.packed = np.empty((len(symbols), 3), np.uint32)
        self.packed[:, 0] = code.numbers(symbols)
        self.packed[:, 1] = _last_bytes(symbols, text_begins)
        self.packed[:, 2] = _words_so_far(symbols, text_begins)
        self.symbols = self.packed[:, 0]

    @property
    def contexts(self) -> list[np.ndarray]:
        """Hash of each symbol's context, for each order."""
        return list(self.contexts_of(self.packed))

    @staticmethod
    def contexts_of(packed: np.ndarray) -> Iterator[np.ndarray]:
        return _contexts(packed[:, 1], packed[:, 2])

    @cached_property
    def begins(self) -> np.ndarray:
        """The first decision of each symbol, one more at the end; scoring and counting do without."""
        begins = np.zeros(len(self.symbols) + 1, np.int64)
        np.cumsum(self.code.sizes[self.symbols], out=begins[1:])
        return begins

    def of_symbols(self, at: np.ndarray, wanted: np.ndarray) -> Stretches:
        """Answers, and the slots of each predictor, of all decisions (``wanted`` many) of some symbols."""
        owner = owners(wanted)
        packed = self.packed.take(at, axis=0)
        return self.of_contexts(packed[:, 0], self.contexts_of(packed), wanted, owner)

    def of_contexts(
        self, numbers: np.ndarray, contexts: Iterable[np.ndarray], wanted: np.ndarray, owner: np.ndarray
    ) -> Stretches:
        entry = entries(self.code, numbers, wanted, owner)
        bits, salt = self.code.decisions(entry)
        return bits, (_slots(context, owner, salt) for context in contexts)

    def whole(self) -> Decisions:
        """All of them at once."""
        n = self.begins[-1]
        bits, slots = np.empty(n, np.uint8), [np.empty(n, np.int32) for _ in ORDERS]
        for low in range(0, len(self.symbols), PIECE):  # pieces that fit into the cache
            high = min(low + PIECE, len(self.symbols))
            first, last = self.begins[low], self.begins[high]
            bits[first:last], made = self.of_symbols(np.arange(low, high), np.diff(self.begins[low : high + 1]))
            for slot, piece in zip(slots, made):
                slot[first:last] = piece
        return Decisions(slots, bits, self.begins, self.text_begins)


def _ranges(first: np.ndarray, many: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ..., many[0] numbers of them, then those of the next range."""
    ends = np.cumsum(many)
    return np.repeat(first - (ends - many), many) + np.arange(ends[-1] if len(ends) else 0)


def decisions(encoded: list[bytes], code: Code) -> Decisions:
    return TextDecisions(encoded, code).whole()


def count(made: Decisions, counts: np.ndarray) -> None:
    """Adds the answers to counts (order, slot, answer)."""
    for order, slot in enumerate(made.slots):
        both = np.bincount(slot * 2 + made.bits, minlength=2 * SLOTS)
        counts[order] += both.reshape(SLOTS, 2).astype(counts.dtype)


def count_symbols(made: TextDecisions, counts: np.ndarray) -> None:
    """The same for all decisions of the texts: those of equal symbols in equal contexts at once."""
    symbols = made.symbols.astype(np.uint64)
    for order, context in enumerate(made.contexts_of(made.packed)):
        pairs = context.astype(np.uint64)
        pairs <<= np.uint64(32)
        pairs |= symbols
        pairs.sort()
        first = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]])) if len(pairs) else np.empty(0, np.int64)
        times = np.diff(first, append=len(pairs)).astype(counts.dtype)
        pairs = pairs[first]
        symbol = pairs.astype(np.uint32).astype(np.int64)
        wanted = made.code.sizes[symbol]
        owner = owners(wanted)
        entry = entries(made.code, symbol, wanted, owner)
        bits, salt = made.code.decisions(entry)
        place = _slots((pairs >> np.uint64(32)).astype(np.uint32), owner, salt).astype(np.int64)
        place *= 2
        place += bits
        np.add.at(counts[order].reshape(-1), place, times.take(owner))


def log_odds(counts: np.ndarray) -> np.ndarray:
    """Log odds of answer one for each slot; exactly 0 means that the slot was never seen."""
    seen = counts.sum(axis=-1) > 0
    odds = np.log((counts[..., 1] + 0.4) / (counts[..., 0] + 0.4)).astype(np.float32)
    odds[seen & (odds == 0)] = np.float32(1e-6)
    return odds


class Seen:
    """The longest contexts, beginnings of words, of the training texts: one bit for each hash value."""

    def __init__(self, power: int, places: np.ndarray, words: np.ndarray) -> None:
        self.shift = np.uint32(32 - power)
        self.words = np.zeros((1 << power) // 64, np.uint64)
        self.words[places] = words

    @classmethod
    def of_tokens(cls, tokens: Iterable[bytes], power: int = 20) -> Seen:
        made = np.unique(beginnings(list(tokens)) >> np.uint32(32 - power)).astype(np.uint64)
        places, first = np.unique(made >> np.uint64(6), return_index=True)
        bits = np.uint64(1) << (made & np.uint64(63))
        return cls(power, places.astype(np.int64), np.bitwise_or.reduceat(bits, first) if len(bits) else bits)

    def __getstate__(self) -> tuple[np.uint32, bytes]:
        return self.shift, zlib.compress(self.words, 1)

    def __setstate__(self, state: tuple[np.uint32, bytes]) -> None:
        self.shift, words = state
        self.words = np.frombuffer(zlib.decompress(words), np.uint64)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        place = hashes >> self.shift
        words = self.words.take(place >> np.uint32(6))
        words >>= place & np.uint32(63)
        words &= np.uint64(1)
        return words != 0


def beginnings(tokens: list[bytes]) -> np.ndarray:
    """The hash of every beginning of every token, the empty one and the whole token included."""
    begins = np.concatenate([[0], np.cumsum([len(t) + 1 for t in tokens])]).astype(np.int64)
    symbols = np.frombuffer(b"".join(t + b" " for t in tokens), np.uint8).astype(np.uint32)
    return _words_so_far(symbols, begins)


def seen_contexts(counts: DataFrame) -> Seen:
    """The longest contexts of the training texts, from their distinct tokens.

    There are SEEN_SPARE bits for every beginning of a token, so the table grows with the tokens;
    the bits are set in Spark, 64 of them a row.
    """
    n = counts.agg(F.sum(F.octet_length("token").cast("long") + 1).alias("n")).first()["n"] or 0
    power = min(max((SEEN_SPARE * n).bit_length(), SEEN_BITS[0]), SEEN_BITS[1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = [t.encode() for t in batch.column(0).to_pylist()]
            made = np.unique(beginnings(tokens) >> np.uint32(32 - power)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(made)], ["bit"])

    bits = counts.select("token").mapInArrow(run, "bit bigint")
    words = bits.groupBy(F.expr("bit DIV 64").alias("place")).agg(
        F.expr("bit_or(shiftleft(CAST(1 AS BIGINT), CAST(bit % 64 AS INT)))").alias("word")
    )
    found = words.toArrow()
    return Seen(power, found.column("place").to_numpy(), found.column("word").to_numpy().view(np.uint64))


def score(made: TextDecisions, odds: np.ndarray, seen: Seen) -> np.ndarray:
    """log10 probability of each text."""
    orders = len(ORDERS)
    length = np.diff(made.text_begins)
    rank = np.argsort(-length, kind="stable")
    first, length = made.text_begins[:-1][rank], length[rank]
    lanes = len(first)
    # Answers are 1 and -1, and so are chances: tanh(dot) is twice the chance of one less one, and
    # dot half its log odds. With inputs and weights to this scale, an update needs no rate.
    scale = math.sqrt(float(RATE)) / 2
    # weights of each text where the gate is shut, then those where it is open
    weights = np.full((orders, 2 * lanes), np.float32(float(START_WEIGHT) / (2 * scale)))
    flat, shift = weights.reshape(-1), 2 * lanes * np.arange(orders)[:, None]
    middle = (np.arange(REFINE_BUCKETS, dtype=np.float32) - REFINE_BUCKETS / 2 + 0.5) / 2
    refined = np.tile(np.tanh(middle / 2), lanes)
    half, top = np.float32(REFINE_BUCKETS / 2), np.float32(REFINE_BUCKETS - 1)
    none, four = np.float32(0), np.float32(4)
    total = np.zeros(lanes)
    begin, longest = 0, int(length[0]) if lanes else 0
    while begin < longest:
        # symbols of a window, step by step: those of all texts that are not at their end yet
        n = int(np.searchsorted(-length, -begin, side="left"))
        steps = min(max(WINDOW // n, 1), longest - begin)
        active = np.searchsorted(-length, -np.arange(begin, begin + steps), side="left")
        lane = _ranges(np.zeros(steps, np.int64), active)
        at = first.take(lane)
        at += np.repeat(np.arange(begin, begin + steps), active)
        packed = np.asfortranarray(made.packed.take(at, axis=0))
        numbers, contexts = packed[:, 0], list(made.contexts_of(packed))
        wanted = made.code.sizes.take(numbers)
        owner = owners(wanted)
        bits, slots = made.of_contexts(numbers, contexts, wanted, owner)
        answers = bits.astype(np.float32)
        answers += answers
        answers -= np.float32(1)
        inputs = np.empty((orders, len(bits)), np.float32)
        for o, slot in enumerate(slots):
            odds[o].take(slot, out=inputs[o], mode="clip")
        inputs *= np.float32(scale)
        column = (lane + lanes * seen.has(contexts[-1])).take(owner)
        places = column + shift
        lane = lane.take(owner)
        cuts = np.append(0, np.cumsum(wanted))[np.append(0, np.cumsum(active))].tolist()
        dots, said, known = np.empty((3, len(bits)), np.float32)
        for a, b in zip(cuts, cuts[1:]):
            x = inputs[:, a:b]
            w = weights.take(column[a:b], axis=1)
            w *= x
            error = answers[a:b] - np.tanh(np.add.reduce(w, 0, out=dots[a:b]), out=said[a:b])
            np.multiply(x, error, out=w)
            np.add.at(flat, places[:, a:b].reshape(-1), w.reshape(-1))
        # what is refined does not act on the weights, so it follows, step by step as well
        dots *= four
        dots += half
        np.maximum(dots, none, out=dots)
        np.minimum(dots, top, out=dots)
        bucket = dots.astype(np.int64)
        bucket += lane * REFINE_BUCKETS
        for a, b in zip(cuts, cuts[1:]):
            change = answers[a:b] - refined.take(bucket[a:b], out=known[a:b], mode="clip")
            change *= REFINE_RATE
            np.add.at(refined, bucket[a:b], change)
        # the chance of what came, three parts mixed and one part refined
        said *= np.float32(3)
        said += known
        said *= answers
        said *= np.float32(0.125)
        said += np.float32(0.5)
        np.maximum(said, np.float32(1e-12), out=said)
        total += np.bincount(lane, np.log(said), lanes)
        begin += steps
    scores = np.empty(lanes)
    scores[rank] = total / np.log(10)
    return scores


def blocks(encoded: list[bytes], most: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``most`` bytes together; a longer text stands alone."""
    begin, held = 0, 0
    for i, e in enumerate(encoded):
        if held and held + len(e) > most:
            yield begin, i
            begin, held = i, 0
        held += len(e) + 1
    if encoded:
        yield begin, len(encoded)


def texts_of(column: pa.Array) -> list[bytes]:
    return column.cast(pa.binary()).to_pylist()


def gathered(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[list[pa.RecordBatch]]:
    """Batches with about ``most`` bytes together: many short texts advance together as well."""
    held, size = [], 0
    for batch in batches:
        if held and size + batch.nbytes > most:
            yield held
            held, size = [], 0
        held.append(batch)
        size += batch.nbytes
    if held:
        yield held


def tokens_of(text: bytes) -> list[bytes]:
    """A-Z in lower case, cut at ASCII white space."""
    return text.lower().split()


def _pack(counts: np.ndarray, part: int) -> pa.RecordBatch:
    """Counts as rows of CHUNK slots, only the slots that were seen."""
    flat = counts.reshape(-1, 2)
    rows = []
    for chunk in range(len(flat) // CHUNK):
        these = flat[chunk * CHUNK : (chunk + 1) * CHUNK]
        seen = np.flatnonzero(these.any(axis=1))
        if len(seen):
            # two or four bytes a count as long as they suffice
            width = next(w for w in (2, 4, 8) if w == 8 or these.max() < 1 << 8 * w)
            values = np.ascontiguousarray(these[seen].T).astype(f"<u{width}").tobytes()
            rows.append((chunk, part, seen.astype("<u2").tobytes(), values))
    columns = list(zip(*rows)) if rows else [()] * 4
    kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["chunk", "part", "seen", "counts"])


def _unpack(counts: np.ndarray, seen: bytes, packed: bytes) -> None:
    at = np.frombuffer(seen, "<u2").astype(np.int64)
    width = len(packed) // (2 * len(at))
    counts[at] += np.frombuffer(packed, f"<u{width}").reshape(2, -1).T


_PACKED = "chunk int, part int, seen binary, counts binary"


def _count_all(training: DataFrame, code: Code) -> np.ndarray:
    """Counts (order, slot, answer) over all training texts.

    Every task counts into tables of fixed size; tables are added up FAN_IN at a time until one
    is left, so no task reads more than FAN_IN of them.
    """
    sent = training.sparkSession.sparkContext.broadcast(code)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(ORDERS), SLOTS, 2), np.uint64)
        part = 0
        for batch in batches:
            part = batch.column(1)[0].as_py() if batch.num_rows else part
            encoded = texts_of(batch.column(0))
            for begin, end in blocks(encoded):
                count_symbols(TextDecisions(encoded[begin:end], sent.value), counts)
        packed = _pack(counts, part)
        for i in range(0, packed.num_rows, 8):
            yield packed.slice(i, 8)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[int, int] | None = None
        counts = np.zeros((CHUNK, 2), np.uint64)

        def packed(key: tuple[int, int]) -> pa.RecordBatch:
            made = _pack(counts, key[1])
            return made.set_column(0, "chunk", pa.array([key[0]] * made.num_rows, pa.int32()))

        for batch in batches:
            for chunk, part, seen, values in zip(*(c.to_pylist() for c in batch.columns)):
                if held != (chunk, part):
                    if held:
                        yield packed(held)
                    held = (chunk, part)
                    counts[:] = 0
                _unpack(counts, seen, values)
        if held:
            yield packed(held)

    tables = training.select("text", F.spark_partition_id().alias("part")).mapInArrow(run, _PACKED)
    tables = stored(tables, "counts")
    while (tables.agg(F.max("part")).first()[0] or 0) > 0:
        tables = tables.withColumn("part", F.expr(f"cast(part DIV {FAN_IN} AS int)"))
        tables = tables.repartition("chunk", "part").sortWithinPartitions("chunk", "part")
        tables = stored(tables.mapInArrow(add, _PACKED), "counts")
    counts = np.zeros((len(ORDERS) * SLOTS, 2), np.uint64)
    for r in tables.collect():
        _unpack(counts[r["chunk"] * CHUNK : (r["chunk"] + 1) * CHUNK], r["seen"], r["counts"])
    return counts.reshape(len(ORDERS), SLOTS, 2)


# A task's counts are handed on when it holds so many distinct tokens.
HELD_TOKENS = 1 << 17


def token_counts(training: DataFrame) -> DataFrame:
    """token and its count over all texts; the end of a text is the empty token."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def rows() -> Iterator[pa.RecordBatch]:
            tokens = pa.array(held.keys(), pa.binary()).cast(pa.string())
            made = pa.RecordBatch.from_arrays([tokens, pa.array(held.values(), pa.int64())], ["token", "c"])
            for i in range(0, made.num_rows, 1 << 15):
                yield made.slice(i, 1 << 15)
            held.clear()

        for batch in batches:
            for text in texts_of(batch.column(0)):
                held.update(tokens_of(text))
                if len(held) > HELD_TOKENS:
                    yield from rows()
            held[b""] += batch.num_rows
        yield from rows()

    pieces = training.select("text").mapInArrow(run, "token string, c bigint")
    return pieces.groupBy("token").agg(F.sum("c").alias("c"))


def common_tokens(counts: DataFrame) -> list[tuple[bytes, int]]:
    """The commonest tokens and their counts, COMMON_TOKENS at most.

    Tokens of like counts stay together: a histogram over counts (eighths of a doubling) says
    from which count on there are not too many, so no task or driver sorts the tokens.
    """
    step = F.floor(F.log2(F.col("c").cast("double")) * 8).cast("int")
    sizes = sorted(((r["step"], r["count"]) for r in counts.groupBy(step.alias("step")).count().collect()), reverse=True)
    least, held = None, 0
    for s, n in sizes:
        held += n
        if held > COMMON_TOKENS:
            break
        least = s
    if least is None:
        return []
    return sorted((r["token"].encode(), r["c"]) for r in counts.filter(step >= least).select("token", "c").collect())


# A task scores about so many bytes, and there are about so many tasks at most.
TASK_BYTES = 5 * SCORE_BLOCK // 6
TASKS = 20_000


def by_length(rows: DataFrame) -> DataFrame:
    """The rows dealt out so that a task has about TASK_BYTES of texts of like length, longest first.

    Texts advance together, so one long text among short ones would take its steps alone. A
    histogram of lengths (sixteenths of a doubling) is cut into parts of like bytes; a class
    of more bytes is spread row by row, so copies of one text do not meet in one task.
    """
    size = F.octet_length("text").cast("long") + 1
    kind = F.floor(F.log2(size.cast("double")) * 16).cast("int")
    counted = rows.groupBy(kind.alias("kind")).agg(F.sum(size).alias("bytes")).collect()
    held = {r["kind"]: r["bytes"] for r in counted}
    if not held:
        return rows
    most = max(TASK_BYTES, sum(held.values()) // TASKS)
    first, parts, total, filled = {}, {}, 0, 0
    for k in sorted(held, reverse=True):
        if filled and filled + held[k] > most:
            total, filled = total + 1, 0
        first[k], parts[k] = total, -(-held[k] // most)
        if parts[k] > 1:
            total += parts[k]
        else:
            filled += held[k]
    total += bool(filled)
    lookup = lambda known: F.create_map(*[F.lit(x) for pair in known.items() for x in pair])[kind]
    nth = F.pmod(F.xxhash64(F.monotonically_increasing_id()), lookup(parts).cast("long"))
    placed = rows.withColumn("_part", (lookup(first) + nth).cast("int"))
    dealt = placed.repartitionById(total, "_part").sortWithinPartitions(F.octet_length("text").desc())
    return dealt.drop("_part")


def score_texts(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte.

    Learns from the rows whose crc32(doc_id as text) mod 5 is not 1; held_out marks the others.
    base_score is the smoothed unigram model over white-space tokens and an end, score the
    mixed model's log10 probability of the whole text and its end; bits_per_byte is that over
    the text's bytes and the end. Null texts are empty: they have the end only. Repeated rows
    and null ids (which hash as the empty text) come out as they are. Without training texts
    all counts are zero and every decision starts even.
    """
    spark = docs.sparkSession
    rows = texts(docs).withColumn("held_out", crc_mod(5) == 1)
    training = rows.filter("NOT held_out").select("text")
    counts = stored(token_counts(training), "tokens")
    sums = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    total, distinct = int(sums["n"]), int(sums["v"])
    common = common_tokens(counts)
    code = Code.of_tokens(common, total)
    odds = log_odds(_count_all(training, code))
    logs = np.log10(np.array([n for _, n in common], np.float64) + 0.5).tolist()
    frequent = dict(zip((t for t, _ in common), logs))
    known = spark.sparkContext.broadcast((frequent, code, odds, seen_contexts(counts)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        logs, code, odds, seen = known.value
        names = ["doc_id", "held_out", "n_bytes", "n_tokens", "n_common", "common_score", "score", "rare"]
        for held in gathered(batches, SCORE_BLOCK):
            encoded = [t for batch in held for t in texts_of(batch.column(1))]
            n_tokens, n_common, said, rare, scores = [], [], [], [], []
            for e in encoded:
                tokens = tokens_of(e)
                tokens.append(b"")
                each = list(map(logs.get, tokens))
                found = [x for x in each if x is not None]
                n_tokens.append(len(tokens))
                n_common.append(len(found))
                said.append(sum(found))
                rare.append([t for t, x in zip(tokens, each) if x is None] if len(found) < len(tokens) else [])
            # blocks of like size, as a narrow one takes as many steps
            size = sum(len(e) + 1 for e in encoded)
            for begin, end in blocks(encoded, -(-size // max(1, -(-size // SCORE_BLOCK)))):
                scores.append(score(TextDecisions(encoded[begin:end], code), odds, seen))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays([batch.column(0) for batch in held]),
                    pa.concat_arrays([batch.column(2) for batch in held]),
                    pa.array([len(e) for e in encoded], pa.int64()),
                    pa.array(n_tokens, pa.int64()), pa.array(n_common, pa.int64()),
                    pa.array(said, pa.float64()),
                    pa.array(np.concatenate(scores) if scores else [], pa.float64()),
                    pa.array(rare, pa.list_(pa.binary())).cast(pa.list_(pa.string())),
                ],
                names,
            )

    schema = (
        "doc_id bigint, held_out boolean, n_bytes bigint, n_tokens bigint, n_common bigint, "
        "common_score double, score double, rare array<string>"
    )
    scored = by_length(rows.select("doc_id", "text", "held_out")).mapInArrow(run, schema)
    scored = stored(scored.withColumn("row", F.monotonically_increasing_id()), "scores")
    # the tokens that are not among the commonest: each text's are counted, then joined by token
    rest = scored.select("row", F.explode("rare").alias("token")).join(counts, "token")
    rest = rest.groupBy("row").agg(
        F.count("*").alias("n_rest"), F.sum(F.log10(F.col("c") + 0.5) - F.log10(F.lit(0.5))).alias("rest_score")
    )
    nothing = float(np.log10(0.5))
    whole = float(np.log10(total + 0.5 * (distinct + 1)))
    met = scored.drop("rare").join(rest, "row", "left")
    unknown = F.col("n_tokens") - F.col("n_common")
    return met.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_common") + F.coalesce("n_rest", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (
            F.col("common_score") + F.coalesce("rest_score", F.lit(0.0))
            + unknown * F.lit(nothing) - F.col("n_tokens") * F.lit(whole)
        ).alias("base_score"),
        "score",
        (-F.col("score") * F.lit(float(np.log2(10))) / (F.col("n_bytes") + 1)).alias("bits_per_byte"),
    )
