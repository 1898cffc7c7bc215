"""Toxicity by the nearest labelled examples under TF-IDF cosine.

Terms are words and beginnings of words. A bounded sample of labelled training rows decides
which terms tell the classes apart (chi-square); a text is a TF-IDF vector over those terms,
with document frequencies counted over all texts. The sample's vectors form an inverted index
whose postings are cut into blocks of examples with the largest weight each term has there. A
query visits blocks in the order of their bounds and stops when no block can hold a nearer
example, so its neighbours are exact. Neighbours vote by similarity; the votes are calibrated on
the sample, each example without itself. The nearest examples come out as evidence.

The sample is drawn from each class on its own, so every example stands for as many labelled
rows as its class has for each sampled one: in the vote, the calibration and the prior. Scores
thus are chances in the labelled rows, whatever share of a class was sampled.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.common import crc_mod, stored, texts

# Labelled rows of each class that the terms and the examples come from, at most.
SAMPLE = 2000
# Terms that are kept at most, and the chi-square they must reach: one in twenty million terms
# without any relation to the class would.
TERMS = 4096
CHI_SQUARE = 30.0
# Their share in one class is at least so many times that in the other.
LIFT = 2
STEMS = (4, 5, 6)
NEIGHBOURS = 15
LANE = 64
BINS = 20
_WORD = re.compile(r"[^\W_]+")


def _terms(word: str) -> list[str]:
    """A word as a term (" word "), and its beginnings (" wor")."""
    return [f" {word} ", *(f" {word[:n]}" for n in STEMS if len(word) >= n)]


def _strength(a: int, b: int, n_a: int, n_b: int) -> float:
    """Chi-square of a term with counts a of n_a and b of n_b; 0 if the shares are alike."""
    if a * n_b < CHI_SQUARE / 4 * n_a and b * n_a < CHI_SQUARE / 4 * n_b:
        return 0.0  # too rare to matter, as most terms are
    spread = (a + b) * (n_a + n_b - a - b) * n_a * n_b
    if not spread or max(a * n_b, b * n_a) < LIFT * min(a * n_b, b * n_a):
        return 0.0
    return (n_a + n_b) * (a * (n_b - b) - b * (n_a - a)) ** 2 / spread


def choose_terms(toxic: list[str], other: list[str]) -> list[str]:
    """Terms whose shares of all words differ between the classes, strongest first.

    Terms are first tested by the texts they occur in, then by the contexts: the words before
    them. Copies and near copies of a text repeat its contexts, so that a term does not count
    for more by being copied. Of terms with the same counts, as a word and its beginnings often
    have, the shortest stands for all with the same beginning.
    """
    cut = [[_WORD.findall(t.lower()) for t in block] for block in (toxic, other)]
    in_texts, sizes = [], []
    for block in cut:
        words = Counter(w for text in block for w in set(text))
        found = Counter()
        for w, n in words.items():
            for term in _terms(w):
                found[term] += n
        in_texts.append(found)
        sizes.append(sum(words.values()))
    listed = in_texts[0].keys() | in_texts[1].keys()
    likely = {t for t in listed if _strength(in_texts[0][t], in_texts[1][t], *sizes) >= CHI_SQUARE}
    met: list[dict[str, set]] = []
    for block in cut:
        before: dict[str, set] = {t: set() for t in likely}
        known: dict[str, list[str]] = {}
        for text in block:
            last = ""
            for w in text:
                if w not in known:
                    known[w] = [t for t in _terms(w) if t in likely]
                for term in known[w]:
                    before[term].add(last)
                last = w
        met.append(before)
    scored = []
    for term in likely:
        a, b = len(met[0][term]), len(met[1][term])
        chi = _strength(a, b, *sizes)
        if chi >= CHI_SQUARE:
            scored.append((-chi, len(term), term, a, b))
    kept, seen = [], set()
    for _, _, term, a, b in sorted(scored):
        group = (term[: min(STEMS) + 1], a, b)
        if group not in seen:
            seen.add(group)
            kept.append(term)
    return kept[:TERMS]


def automaton(terms: list[str]) -> ahocorasick.Automaton | None:
    """Finds all terms in one pass; a word and a beginning may be the same letters."""
    if not terms:
        return None
    by_letters: dict[str, list[tuple[int, bool]]] = {}
    for i, term in enumerate(terms):
        by_letters.setdefault(term.strip(), []).append((i, term.endswith(" ")))
    made = ahocorasick.Automaton()
    for letters, kinds in by_letters.items():
        made.add_word(letters, (len(letters), kinds))
    made.make_automaton()
    return made


def term_counts(machine, text: str) -> dict[int, int]:
    """Occurrences of each term in a text, by the term's place."""
    counts: dict[int, int] = {}
    if machine is None:
        return counts
    low = text.lower()
    for end, (size, kinds) in machine.iter(low):
        begin = end - size
        if begin >= 0 and low[begin].isalnum():
            continue
        inside = end + 1 < len(low) and low[end + 1].isalnum()
        for i, whole in kinds:
            if not (whole and inside):
                counts[i] = counts.get(i, 0) + 1
    return counts


@dataclass
class Examples:
    """Inverted index of the labelled vectors, in blocks of LANE examples."""

    labels: np.ndarray
    ids: list[int]
    lane_most: np.ndarray  # term x lane: largest weight
    postings: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]  # term: lane cuts, places, weights

    @classmethod
    def build(cls, vectors: list[dict[int, float]], labels: list[int], ids: list[int], terms: int) -> Examples:
        # examples with the same leading term share lanes, which keeps the bounds close
        order = sorted(range(len(vectors)), key=lambda i: (max(vectors[i], key=lambda t: (vectors[i][t], -t), default=-1), i))
        lanes = max(1, -(-len(order) // LANE))
        most = np.zeros((terms, lanes))
        lists: dict[int, list[tuple[int, float]]] = {}
        for place, i in enumerate(order):
            for t, w in vectors[i].items():
                lists.setdefault(t, []).append((place, w))
                most[t, place // LANE] = max(most[t, place // LANE], w)
        postings = {}
        for t, rows in lists.items():
            places = np.array([p for p, _ in rows])
            cuts = np.searchsorted(places, np.arange(lanes + 1) * LANE)
            postings[t] = (cuts, places % LANE, np.array([w for _, w in rows]))
        return cls(np.array([labels[i] for i in order]), [ids[i] for i in order], most, postings)

    def nearest(self, vector: dict[int, float], k: int, but: int = -1) -> list[tuple[float, int]]:
        """The k most similar examples (similarity above 0; the first ones on ties), but one."""
        known = [(t, w) for t, w in vector.items() if t in self.postings]
        if not known:
            return []
        bounds = np.array([w for _, w in known]) @ self.lane_most[[t for t, _ in known]]
        best: list[tuple[float, int]] = []
        for lane in np.argsort(-bounds, kind="stable"):
            if bounds[lane] <= 0 or len(best) == k and bounds[lane] < -best[-1][0] - 1e-9:
                break
            scores = np.zeros(LANE)
            for t, w in known:
                cuts, places, weights = self.postings[t]
                part = slice(cuts[lane], cuts[lane + 1])
                scores[places[part]] += w * weights[part]
            scores = np.round(scores, 12)
            if lane == but // LANE:
                scores[but % LANE] = 0
            at = np.flatnonzero(scores > 0 if len(best) < k else scores >= -best[-1][0])
            best = sorted(best + list(zip((-scores[at]).tolist(), (lane * LANE + at).tolist())))[:k]
        return [(-s, p) for s, p in best]


def vector_of(counts: dict[int, int], idf: np.ndarray) -> dict[int, float]:
    """TF-IDF of unit length: (1 + log of the count) times idf."""
    raw = {t: (1 + math.log(n)) * float(idf[t]) for t, n in counts.items()}
    size = math.sqrt(sum(w * w for w in raw.values()))
    return {t: w / size for t, w in raw.items()} if size else {}


def vote(near: list[tuple[float, int]], labels: np.ndarray, stands_for: tuple[float, float] = (1.0, 1.0)) -> float:
    """Share of the neighbours' similarity that belongs to label 1, an example counting by its label."""
    total = sum(s * stands_for[labels[p]] for s, p in near)
    return sum(s * stands_for[1] for s, p in near if labels[p]) / total


class Calibration:
    """Share of label 1 by vote: pooled so that it never falls as the vote rises."""

    def __init__(
        self, votes: list[float], labels: list[int], prior: float, stands_for: tuple[float, float] = (1.0, 1.0)
    ) -> None:
        edges = np.linspace(0, 1, BINS + 1)
        place = np.minimum((np.array(votes) * BINS).astype(int), BINS - 1) if votes else np.zeros(0, int)
        weights = np.array([stands_for[x] for x in labels], float)
        hits = np.bincount(place, weights * np.array(labels, float), BINS) if votes else np.zeros(BINS)
        sizes = np.bincount(place, weights, BINS) if votes else np.zeros(BINS)
        # one case of doubt in every bin: its own middle
        pools: list[list[float]] = []
        for i in range(BINS):
            pools.append([hits[i] + (edges[i] + edges[i + 1]) / 2, sizes[i] + 1, 1])
            while len(pools) > 1 and pools[-2][0] / pools[-2][1] >= pools[-1][0] / pools[-1][1]:
                h, s, n = pools.pop()
                pools[-1] = [pools[-1][0] + h, pools[-1][1] + s, pools[-1][2] + n]
        self.by_bin = np.repeat([h / s for h, s, _ in pools], [int(n) for *_, n in pools])
        self.prior = prior

    def score(self, said: float | None) -> float:
        """A calibrated score; without neighbours, the prior of texts without any."""
        if said is None:
            return self.prior
        return float(np.interp(said, (np.arange(BINS) + 0.5) / BINS, self.by_bin))


@dataclass
class Model:
    """What tasks need to score a text's term counts; bounded by SAMPLE and TERMS."""

    idf: np.ndarray
    examples: Examples
    calibration: Calibration
    stands_for: tuple[float, float] = (1.0, 1.0)  # labelled rows for each example of label 0 and 1
    evidence: int = 3

    def score(self, counts: dict[int, int]) -> tuple[float, list[int]]:
        near = self.examples.nearest(vector_of(counts, self.idf), NEIGHBOURS)
        said = vote(near, self.examples.labels, self.stands_for) if near else None
        return self.calibration.score(said), [self.examples.ids[p] for _, p in near[: self.evidence]]


def _sample(docs: DataFrame, labels: DataFrame) -> tuple[list[tuple[int, int, str]], dict[int, int]]:
    """(doc_id, label, text) of up to SAMPLE training rows of each class, by a hash of doc_id.

    With it comes the number of training rows of each class.
    """
    marked = (
        labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels["toxic"].cast("int").alias("label"))
        .filter("doc_id IS NOT NULL AND label IN (0, 1)")
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
        .filter(crc_mod(4) != 2)
    )
    # rows whose document is not in the table would waste places of the sample
    present = docs.select(F.col("doc_id").alias("present")).filter("present IS NOT NULL").distinct()
    marked = stored(marked.join(present, F.col("doc_id") == F.col("present"), "left_semi"), "labels")
    sizes = {r["label"]: r["count"] for r in marked.groupBy("label").count().collect()}
    picked = marked.limit(0)
    for label, size in sorted(sizes.items()):
        # a share of the hashes with about twice the sample, so that little is left to order
        share = min(1.0, (2 * SAMPLE + 200) / size)
        drawn = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)) + 1
        part = marked.filter((F.col("label") == label) & drawn)
        part = part.orderBy(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)), "doc_id").limit(SAMPLE)
        picked = picked.unionByName(part)
    rows = docs.join(F.broadcast(picked), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    return sorted((r["doc_id"], r["label"], r["text"]) for r in rows.collect()), sizes


def _features(rows: DataFrame, terms: list[str]) -> DataFrame:
    """Term counts of every text, as places and counts."""
    sent = rows.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton(sent.value)
        for batch in batches:
            counted = [sorted(term_counts(machine, t).items()) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1),
                    pa.array([[t for t, _ in row] for row in counted], pa.list_(pa.int32())),
                    pa.array([[n for _, n in row] for row in counted], pa.list_(pa.int32())),
                ],
                ["doc_id", "text_key", "terms", "counts"],
            )

    return rows.mapInArrow(run, "doc_id bigint, text_key bigint, terms array<int>, counts array<int>")


def fit(docs: DataFrame, labels: DataFrame) -> tuple[Model, DataFrame]:
    """The model, and the term counts of every row of ``docs`` (written to the shared folder)."""
    rows = texts(docs).select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    sample, sizes = _sample(rows.select("doc_id", "text"), labels)
    drawn = Counter(label for _, label, _ in sample)
    stands_for = tuple(sizes[x] / drawn[x] if drawn[x] else 1.0 for x in (0, 1))
    terms = choose_terms([t for _, x, t in sample if x], [t for _, x, t in sample if not x])
    features = stored(_features(rows, terms), "toxicity")
    df = np.zeros(len(terms))
    for r in features.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
        df[r["t"]] = r["count"]
    idf = np.log(1 + features.count() / (1 + df))
    machine = automaton(terms)
    vectors = [vector_of(term_counts(machine, text), idf) for _, _, text in sample]
    marks = [label for _, label, _ in sample]
    examples = Examples.build(vectors, marks, [i for i, _, _ in sample], len(terms))
    place_of = {i: p for p, i in enumerate(examples.ids)}
    votes, known, blank = [], [], [0.0, 0.0]
    for (i, label, _), vector in zip(sample, vectors):
        near = examples.nearest(vector, NEIGHBOURS, but=place_of[i])
        if near:
            votes.append(vote(near, examples.labels, stands_for))
            known.append(label)
        else:
            blank[label] += stands_for[label]
    prior = (blank[1] + 0.1) / (sum(blank) + 1)
    return Model(idf, examples, Calibration(votes, known, prior, stands_for), stands_for), features


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """doc_id, text_key, held_out, score, predicted and evidence of every row.

    Labels are learnt only from rows whose crc32(doc_id as text) mod 4 is not 2; held_out marks
    the others. A doc_id with several labels counts as toxic if any says so; null labels and
    labels of unknown documents count for nothing, and without labels of both classes every
    score is the prior. evidence lists the doc_ids of the nearest examples. Null texts are
    empty; texts without any chosen term, empty ones among them, get the share of label 1 among
    such examples. Repeated rows and null ids come out as they are.
    """
    model, features = fit(docs, labels)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple, tuple[float, list[int]]] = {}
        for batch in batches:
            made = []
            for t, n in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                key = (tuple(t), tuple(n))
                if key not in known:
                    if len(known) > 100_000:
                        known.clear()
                    known[key] = sent.value.score(dict(zip(t, n)))
                made.append(known[key])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1),
                    pa.array([s for s, _ in made], pa.float64()),
                    pa.array([e for _, e in made], pa.list_(pa.int64())),
                ],
                ["doc_id", "text_key", "score", "evidence"],
            )

    schema = "doc_id bigint, text_key bigint, score double, evidence array<bigint>"
    scored = features.mapInArrow(run, schema)
    return scored.select(
        "doc_id",
        "text_key",
        (crc_mod(4) == 2).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
        "evidence",
    )
