"""Benchmark decontamination by a BM25 index of test items.

The items are indexed by word; the impact of a word in an item is its BM25 weight as a part of
the least score the item must reach, so that one is the threshold for every item. Training
texts are cut into overlapping passages, long enough to hold any item whole, and every passage
is a query. Pairs are thrown out in three steps, none of which loses an item above the
threshold: by what the item's rarer words in the passage and all its commoner ones come to, by
the largest impacts in the item's block, and by the exact scores of the blocks that are left.
What is retrieved is verified word by word against the item: its question and its answer, or the
whole of it, or a long question alone, whose answer a text may leave out.

The index of a block of items goes to all tasks; its size is bounded by ``block_items`` and
``block_bytes``, and more items than that are searched block after block. What scores depend on
(document frequencies, number and mean length of the items, the passages' length) is counted
once over all items, so that blocks do not change them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.common import stored, texts
from roadpulse.llm.words import distinct, word_hashes

K1, B = 1.2, 0.75
# Items that are bounded and scored together.
LANE = 32
# Impacts of the commoner words of an item that may come without postings; the least score of
# every item is one, less what rounding may take.
OTHERS = 0.35
SURE = 1 - 1e-4
# A question of so many words is a leak without its answer.
LONG_QUESTION = 8
_SENTENCE = re.compile(r"(?<=[.?!])\s+|\n+")


def question_and_answer(text: str) -> tuple[str, str]:
    """The last sentence or line is the answer, what stands before it the question.

    An item of one sentence is all question.
    """
    parts = [p for p in _SENTENCE.split(text) if p.strip()]
    if len(parts) < 2:
        return text, ""
    return " ".join(parts[:-1]), parts[-1]


@dataclass
class Whole:
    """What an index needs to know of all items, not only of its own."""

    items: int  # items that have words
    mean: float  # their mean number of words
    longest: int  # words of the longest
    words: np.ndarray  # sorted hashes of words, those of the index's items at least,
    df: np.ndarray  # and in how many items each occurs

    @classmethod
    def of(cls, items: list[tuple[int, str]]) -> Whole:
        hashes, begins = word_hashes([t for _, t in items])
        sizes = np.diff(begins)
        each = [distinct(hashes[a:b]) for a, b in zip(begins[:-1], begins[1:])]
        words, df = np.unique(np.concatenate([*each, hashes[:0]]), return_counts=True)
        held = sizes[sizes > 0]
        return cls(len(held), float(held.mean()) if len(held) else 0.0, int(sizes.max(initial=0)), words, df)


@dataclass
class Index:
    """Items of one block: vocabulary, impacts, bounds, and the words to verify."""

    ids: list[int]
    item_at: np.ndarray  # words of each item: where they begin,
    item_words: np.ndarray  # their sorted hashes
    item_worth: np.ndarray  # and their impacts, as parts of the item's least score
    lane_words: np.ndarray  # sorted hashes of all words, once for each lane they occur in,
    lane_most: np.ndarray  # and their largest impact there
    lane_at: np.ndarray  # where each lane begins
    key_words: np.ndarray  # sorted hashes of the words that are rare for some item
    gate: np.ndarray  # whether a key word begins with these bits
    cuts: np.ndarray  # postings of the key words: where they begin,
    posted: np.ndarray  # their items
    worth: np.ndarray  # and impacts
    rest: np.ndarray  # sum of the impacts of each item's other words
    part: np.ndarray  # the least score as a part of that of the whole item; below one for long questions
    texts: list[np.ndarray]
    questions: list[np.ndarray]
    answers: list[np.ndarray]
    passage: int  # words of the longest of all items

    @classmethod
    def build(cls, items: list[tuple[int, str]], least: float, whole: Whole | None = None) -> Index | None:
        """Index of the items that have words; None if there are none.

        ``whole`` tells of all items where these are a block of them.
        """
        whole = whole or Whole.of(items)
        hashes, begins = word_hashes([t for _, t in items])
        split = [question_and_answer(t) for _, t in items]
        asked, asked_at = word_hashes([q for q, _ in split])
        said, said_at = word_hashes([a for _, a in split])
        sizes = np.diff(begins)
        # items of like length share a lane, which keeps the lane's bounds close
        order = [i for i in np.argsort(sizes, kind="stable").tolist() if sizes[i]]
        if not order:
            return None
        vocabulary, word = np.unique(hashes, return_inverse=True)
        column_of = np.full(len(items), -1)
        column_of[order] = np.arange(len(order))
        column = column_of[np.repeat(np.arange(len(items)), sizes)]
        code, counts = np.unique(column * len(vocabulary) + word, return_counts=True)
        column, word = np.divmod(code, len(vocabulary))
        df = whole.df[np.searchsorted(whole.words, vocabulary)]
        idf = np.log(1 + (whole.items - df + 0.5) / (df + 0.5))
        lengths = sizes[order]
        damp = K1 * (1 - B + B * lengths / whole.mean)
        weight = idf[word] * counts * (K1 + 1) / (counts + damp[column])
        # a long question is looked for by what its own words come to
        asking = [asked[asked_at[i] : asked_at[i + 1]] for i in order]
        alone = np.array([len(q) >= LONG_QUESTION for q in asking])
        inside = np.repeat(np.arange(len(order)), [len(q) for q in asking])
        pairs = inside * len(vocabulary) + np.searchsorted(vocabulary, np.concatenate(asking))
        full = np.bincount(column, weight)
        part = np.where(alone, np.bincount(column, weight * np.isin(code, pairs)) / full, 1.0)
        impact = weight / (least * part * full)[column]
        # from the commonest word of each item on, words are left out of the postings for as
        # long as their impacts come to no more than OTHERS
        falling = np.lexsort((-df[word], column))
        sums = np.cumsum(impact[falling])
        item_at = np.searchsorted(column, np.arange(len(order) + 1))
        before = np.concatenate([[0], sums])[item_at[:-1]]
        key = np.zeros(len(code), bool)
        key[falling] = sums - before[column] > OTHERS
        rows, place = np.unique(word[key], return_inverse=True)
        by_word = np.argsort(place, kind="stable")
        gate = np.zeros(1 << 16, bool)
        gate[(vocabulary[rows] >> np.uint64(48)).astype(np.int64)] = True
        lane_code, where = np.unique((column // LANE) * len(vocabulary) + word, return_inverse=True)
        lane_most = np.zeros(len(lane_code))
        np.maximum.at(lane_most, where, impact)
        lane, lane_word = np.divmod(lane_code, len(vocabulary))
        return cls(
            [items[i][0] for i in order], item_at, vocabulary[word], impact,
            vocabulary[lane_word], lane_most, np.searchsorted(lane, np.arange(lane[-1] + 2)),
            vocabulary[rows], gate, np.searchsorted(place[by_word], np.arange(len(rows) + 1)),
            column[key][by_word], impact[key][by_word],
            np.bincount(column, np.where(key, 0, impact)),
            part,
            [hashes[begins[i] : begins[i + 1]] for i in order],
            asking,
            [said[said_at[i] : said_at[i + 1]] for i in order],
            whole.longest,
        )

    def search(self, hashes: np.ndarray, begins: np.ndarray) -> list[tuple[int, int, float]]:
        """(first word of the passage, item, score) of all passages and items above the threshold.

        Passages of a text start every ``passage`` words and are twice as long, so every run of
        words as long as an item lies whole inside one of them.
        """
        at = np.flatnonzero(self.gate[(hashes >> np.uint64(48)).astype(np.int64)])
        place = np.minimum(np.searchsorted(self.key_words, hashes[at]), len(self.key_words) - 1)
        right = self.key_words[place] == hashes[at]
        at, place = at[right], place[right]
        if not len(at):
            return []
        text = np.searchsorted(begins, at, side="right") - 1
        step = (at - begins[text]) // self.passage
        # passages are numbered through; a word lies in that of its step and in the one before
        base = np.concatenate([[0], np.cumsum(np.diff(begins) // self.passage + 1)])
        number = base[text] + step
        later = step > 0
        pairs = np.concatenate([number, number[later] - 1]) * len(self.key_words) + np.concatenate([place, place[later]])
        number, place = np.divmod(distinct(pairs), len(self.key_words))
        many = self.cuts[place + 1] - self.cuts[place]
        each = np.repeat(self.cuts[place] - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(many.sum())
        code, row = np.unique(np.repeat(number, many) * len(self.rest) + self.posted[each], return_inverse=True)
        held = np.bincount(row, self.worth[each])
        hopeful = code[held + self.rest[code % len(self.rest)] >= SURE]
        found = []
        for number, item in zip(*(x.tolist() for x in np.divmod(hopeful, len(self.rest)))):
            text = int(np.searchsorted(base, number, side="right") - 1)
            start = int(begins[text] + (number - base[text]) * self.passage)
            words = distinct(hashes[start : min(start + 2 * self.passage, int(begins[text + 1]))])
            lane = slice(*self.lane_at[item // LANE : item // LANE + 2].tolist())
            if _sum_of(words, self.lane_words[lane], self.lane_most[lane]) < SURE:
                continue
            one = slice(*self.item_at[item : item + 2].tolist())
            score = _sum_of(words, self.item_words[one], self.item_worth[one])
            if score >= SURE:
                found.append((start, item, score))
        return found

    def overlap(self, words: np.ndarray, item: int) -> tuple[float, float]:
        """Shares of the question's and the answer's runs of words that stand in the passage."""
        return _held(words, self.questions[item], 5), _held(words, self.answers[item], 3)

    def leaked(self, words: np.ndarray, item: int, score: float, asked: float, said: float, overlap: float) -> bool:
        """Whether the passage holds the item, or its question if that is long."""
        if len(self.questions[item]) >= LONG_QUESTION and asked >= overlap:
            return True
        if score < SURE:
            return False
        return min(asked, said) >= overlap or _held(words, self.texts[item], 5) >= overlap


def _sum_of(words: np.ndarray, listed: np.ndarray, worth: np.ndarray) -> float:
    """Sum over the listed words that are among the sorted words."""
    at = np.minimum(np.searchsorted(words, listed), len(words) - 1)
    return float(worth[words[at] == listed].sum())


def _held(passage: np.ndarray, part: np.ndarray, n: int) -> float:
    n = min(n, len(part))
    if not n:
        return 1.0
    there, wanted = passage.tolist(), part.tolist()
    runs = {tuple(there[i : i + n]) for i in range(len(there) - n + 1)}
    grams = [tuple(wanted[i : i + n]) for i in range(len(wanted) - n + 1)]
    return sum(g in runs for g in grams) / len(grams)


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    least: float = 0.6,
    overlap: float = 0.6,
    block_items: int = 20_000,
    block_bytes: int = 64 << 20,
) -> DataFrame:
    """doc_id, text_key, item_id, score, question_overlap, answer_overlap, first_word.

    One row per text and item that it leaks: BM25 of a passage is at least ``least`` of the
    item's score against itself, and at least ``overlap`` of the question's 5-grams and of the
    answer's 3-grams, or of the whole item's 5-grams, stand in that passage (shorter parts are
    compared whole). A question of LONG_QUESTION words also counts alone, by its own score and
    5-grams; score is then below one where the answer is missed. The passage with
    the best overlap counts, the first one on ties; first_word is where it begins. Null and
    empty texts, items without words and null items match nothing; null ids and repeated rows
    of documents come out as they are; items that share an id are items of their own, unless
    their texts are equal too: these are one item.
    """
    spark = docs.sparkSession
    parts = items.select(items["item_id"].cast("long").alias("item_id"), items["text"].cast("string").alias("text"))
    parts = parts.filter("text IS NOT NULL").distinct()
    size = parts.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()
    blocks = max(-(-size["n"] // block_items), -(-size["bytes"] // block_bytes))
    numbered = parts.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(max(blocks, 1))))
    numbered = stored(numbered, "items")
    facts, counted = _count_words(numbered)
    schema = (
        "doc_id bigint, text_key bigint, item_id bigint, score double, "
        "question_overlap double, answer_overlap double, first_word bigint"
    )
    rows = texts(docs).select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    found = []
    for block in range(blocks):
        listed = [tuple(r) for r in numbered.filter(F.col("block") == block).select("item_id", "text").collect()]
        known = counted.filter(F.col("block") == block).select("word", "df").toArrow()
        words = known.column("word").to_numpy().view(np.uint64)
        rank = np.argsort(words)
        whole = Whole(*facts, words[rank], known.column("df").to_numpy()[rank])
        index = Index.build(sorted(listed, key=lambda r: (r[0] is None, r)), least, whole)
        if index is None:
            continue
        sent = spark.sparkContext.broadcast(index)
        found.append(rows.mapInArrow(_matcher(sent, overlap), schema))
    if not found:
        return spark.createDataFrame([], schema)
    return reduce(DataFrame.unionAll, found)


def _count_words(numbered: DataFrame) -> tuple[tuple[int, float, int], DataFrame]:
    """Number, mean and greatest length of the items that have words; and block, word and df.

    df counts the items of all blocks; there is a row for each block and word that it holds.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, begins = word_hashes(batch.column(1).to_pylist())
            each = [distinct(hashes[a:b]).view(np.int64) for a, b in zip(begins[:-1], begins[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(begins), pa.int64()), pa.array(each, pa.list_(pa.int64()))],
                ["block", "size", "words"],
            )

    cut = numbered.select("block", "text").mapInArrow(run, "block bigint, size bigint, words array<bigint>")
    cut = stored(cut.filter("size > 0"), "item-words")
    sums = cut.agg(F.count("*").alias("n"), F.sum("size").alias("all"), F.max("size").alias("most")).first()
    facts = (sums["n"], sums["all"] / sums["n"], sums["most"]) if sums["n"] else (0, 0.0, 0)
    held = cut.select("block", F.explode("words").alias("word")).groupBy("block", "word").agg(F.count("*").alias("c"))
    held = stored(held, "block-words")
    df = held.groupBy("word").agg(F.sum("c").alias("df"))
    return facts, stored(held.join(df, "word").select("block", "word", "df"), "word-counts")


def _matcher(sent, overlap: float):
    names = ["doc_id", "text_key", "item_id", "score", "question_overlap", "answer_overlap", "first_word"]
    kinds = [pa.int64()] * 3 + [pa.float64()] * 3 + [pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = sent.value
        for batch in batches:
            ids, keys = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            hashes, begins = word_hashes(batch.column(2).to_pylist())
            best: dict[tuple[int, int], tuple] = {}
            for start, item, score in index.search(hashes, begins):
                text = int(np.searchsorted(begins, start, side="right") - 1)
                stop = min(start + 2 * index.passage, int(begins[text + 1]))
                asked, said = index.overlap(hashes[start:stop], item)
                score *= float(index.part[item])
                if index.leaked(hashes[start:stop], item, score, asked, said, overlap):
                    made = (asked + said, -start, score, asked, said)
                    best[text, item] = max(best.get((text, item), made), made)
            out = [
                (ids[t], keys[t], index.ids[i], s, q, a, -start - int(begins[t]))
                for (t, i), (_, start, s, q, a) in sorted(best.items())
            ]
            columns = list(zip(*out)) if out else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return run
