"""Token counts by a linear longest-match automaton.

Greedy word-piece takes the longest piece of the vocabulary that starts where the last one
ended. The pieces lie in a trie. Every node has a failure link: the node to go on from after
the pieces that greedy matching is bound to take have been popped off, and the number of those
pieces. So each symbol of a word is read once, and the counts come out without any piece being
built.

A word that greedy matching cannot cut counts as one unknown token, as does a longer one than
``longest`` where that is set.
"""

from __future__ import annotations

import json
import re
from collections import deque
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame

from roadpulse.llm.common import map_texts, texts

# Ends a word, so that pieces for word ends lie in the same trie as the others; no text holds it
# as a symbol of its own because symbols of texts are bytes.
END = 256
_WORD = re.compile(r"[^\W\d_]+|\d|(?:[^\w\s]|_)+")


class Automaton:
    """Trie, failure links and popped counts of a vocabulary of symbol sequences."""

    def __init__(self, pieces: list[tuple[int, ...]]) -> None:
        children: list[dict[int, int]] = [{}]
        is_piece = [False]
        for piece in pieces:
            node = 0
            for symbol in piece:
                step = children[node].get(symbol)
                if step is None:
                    step = len(children)
                    children[node][symbol] = step
                    children.append({})
                    is_piece.append(False)
                node = step
            if node:
                is_piece[node] = True
        size = len(children)
        self.fail = np.full(size, -1, np.int64)
        self.pops = np.zeros(size, np.int64)
        queue = deque([0])
        while queue:
            parent = queue.popleft()
            for symbol, node in children[parent].items():
                queue.append(node)
                if is_piece[node]:
                    self.fail[node], self.pops[node] = 0, 1
                    continue
                at, popped = int(self.fail[parent]), int(self.pops[parent])
                while at >= 0 and symbol not in children[at]:
                    popped += int(self.pops[at])
                    at = int(self.fail[at])
                if at >= 0:
                    self.fail[node], self.pops[node] = children[at][symbol], popped
        edges = sorted((n * 257 + s, c) for n, kids in enumerate(children) for s, c in kids.items())
        self.keys = np.array([k for k, _ in edges], np.int64)
        self.targets = np.array([c for _, c in edges], np.int64)

    def _step(self, nodes: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """Child of each node by its symbol, or -1."""
        if not len(self.keys):
            return np.full(len(nodes), -1, np.int64)
        want = nodes * 257 + symbols
        at = np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)
        return np.where(self.keys[at] == want, self.targets[at], -1)

    def lengths(self, words: list[bytes]) -> np.ndarray:
        """Number of pieces of each word (1 for unknown ones, 0 for empty ones).

        All words advance together, one symbol a step; a word leaves when it is done or stuck.
        """
        count = np.zeros(len(words), np.int64)
        if not words:
            return count
        sizes = np.array([len(w) for w in words])
        order = np.argsort(-sizes, kind="stable")
        data = np.frombuffer(b"".join(words), np.uint8)
        begins = np.concatenate([[0], np.cumsum(sizes)[:-1]])[order]
        ranked = sizes[order]
        node = np.zeros(len(words), np.int64)
        pieces = np.zeros(len(words), np.int64)
        stuck = np.zeros(len(words), bool)
        for step in range(int(ranked[0]) + 1):
            # words of at least `step` symbols read one more: a byte, or their end
            live = np.flatnonzero(~stuck[: np.searchsorted(-ranked, -step, side="right")])
            ended = ranked[live] == step
            symbol = np.full(len(live), END, np.int64)
            symbol[~ended] = data[begins[live[~ended]] + step]
            wait = np.arange(len(live))
            while len(wait):
                rows = live[wait]
                target = self._step(node[rows], symbol[wait])
                moved = target >= 0
                node[rows[moved]] = target[moved]
                wait, rows = wait[~moved], rows[~moved]
                pieces[rows] += self.pops[node[rows]]
                node[rows] = self.fail[node[rows]]
                lost = node[rows] < 0
                stuck[rows[lost]] = True
                node[rows[lost]] = 0
                wait = wait[~lost]
        # what is read but not popped yet falls apart along the failure links, down to the root
        rest = np.flatnonzero(~stuck & (node > 0))
        while len(rest):
            pieces[rest] += self.pops[node[rest]]
            node[rest] = self.fail[node[rest]]
            stuck[rest[node[rest] < 0]] = True
            rest = rest[node[rest] > 0]
        count[order] = np.where(stuck, 1, pieces)
        count[sizes == 0] = 0
        return count


def _byte_letters() -> dict[str, int]:
    """The letters byte-level vocabularies write bytes with."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


@lru_cache(maxsize=2)
def load_pieces(path: str) -> tuple[tuple[int, ...], ...]:
    """Pieces of a byte-level vocabulary file whose word-end pieces end in ``</w>``."""
    with open(path, encoding="utf-8") as file:
        vocabulary = json.load(file)["model"]["vocab"]
    letters = _byte_letters()
    pieces = []
    for piece in vocabulary:
        body = piece.removesuffix("</w>")
        if body and all(c in letters for c in body):
            end = (END,) if piece.endswith("</w>") else ()
            pieces.append(tuple(letters[c] for c in body) + end)
    return tuple(pieces)


@lru_cache(maxsize=2)
def load_automaton(path: str) -> Automaton:
    """Built once per Python process; its size is that of the vocabulary file."""
    return Automaton(list(load_pieces(path)))


def words_of(text: str) -> list[str]:
    """Lower-case runs of letters, single digits, and runs of other signs."""
    return _WORD.findall(text.lower())


# Words whose length a process keeps at most.
REMEMBERED = 500_000


def count_tokens(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, n_words and n_tokens of each row's whole text, by the vocabulary file.

    One row per input row, repeated rows and null ids included; null, empty and blank texts
    have no words and no tokens. The file must lie at this path on every machine, as a Python
    package does. Nothing is shuffled; a process remembers a bounded number of words.
    """

    known: dict[str, int] = {}

    def count(_, block: list[str]) -> dict[str, list]:
        automaton = load_automaton(vocabulary)
        cut = [words_of(t) for t in block]
        if len(known) > REMEMBERED:
            known.clear()
        new = list({w for words in cut for w in words if w not in known})
        known.update(zip(new, automaton.lengths([w.encode() for w in new]).tolist()))
        return {
            "n_words": [len(words) for words in cut],
            "n_tokens": [sum(map(known.__getitem__, words)) for words in cut],
        }

    return map_texts(texts(docs), "n_words bigint, n_tokens bigint", count)
