"""Packing, periodic runs and clustering against brute force, and on odd rows."""

import hashlib
import itertools
import math
import random
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from roadpulse.llm import catalog, centroids, packing, periodic_runs
from roadpulse.llm.common import table

SF_DIR = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, length string, piece string, start int, ids int, task int, `range` int"
LONG = " ".join(f"word{i % 977} and the rest of a sentence" for i in range(20_000))
ODD = [
    (1, None), (2, ""), (2, ""), (3, "  \n "), (None, "one two three"), (None, "one two three"), (4, "one two three"),
    (5, LONG), (6, "x" * 5000), (7, "a<|endoftext|>b"), (4, "another text under one id"), (8, "a b " * 300), (9, " x " * 40),
]


def _docs(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y", 1, 2, 3, 4) for i, t in rows], DOCS)


# packing


def _filling(group):
    return [length for length, times in group.filling for _ in range(times)]


def _fewest(lengths, capacity):
    """The least number of sequences, by trying all places of the longest piece first."""
    lengths = sorted(lengths, reverse=True)
    best = len(lengths)

    def place(at, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if at == len(lengths):
            best = len(rooms)
            return
        for i, room in enumerate(rooms):
            if room >= lengths[at] and room not in rooms[:i]:
                place(at + 1, rooms[:i] + [room - lengths[at]] + rooms[i + 1 :])
        place(at + 1, rooms + [capacity - lengths[at]])

    place(0, [])
    return best


def _least_sequences(counts, capacity):
    """No packing has fewer: pieces over half a sequence, and what the smaller ones need besides their room."""
    bounds = [math.ceil(sum(length * n for length, n in counts.items()) / capacity)]
    for k in range(1, capacity // 2 + 1):
        alone = sum(n for length, n in counts.items() if length > capacity - k)
        large = {length: n for length, n in counts.items() if capacity - k >= length > capacity / 2}
        room = sum((capacity - length) * n for length, n in large.items())
        small = sum(length * n for length, n in counts.items() if k <= length <= capacity / 2)
        bounds.append(alone + sum(large.values()) + max(0, math.ceil((small - room) / capacity)))
    return max(bounds)


def test_reduction_keeps_a_best_packing():
    rnd = random.Random(5)
    reduced = 0
    for _ in range(400):
        capacity = rnd.choice([10, 20, 30])
        counts = Counter(rnd.randint(1, capacity) for _ in range(rnd.randint(1, 9)))
        left = packing._Lengths(counts)
        fixed = packing.reduce(left, capacity)
        assert sum((Counter(_filling(g) * g.bins) for g in fixed), Counter(left.n)) == counts
        assert all(g.used() <= capacity for g in fixed)
        rest = list(Counter(left.n).elements())
        bins = sum(g.bins for g in fixed)
        assert bins + (_fewest(rest, capacity) if rest else 0) == _fewest(list(counts.elements()), capacity)
        reduced += bins > 0
    assert reduced > 300


def test_best_fit_equals_one_piece_at_a_time():
    rnd = random.Random(6)
    for _ in range(200):
        capacity = rnd.choice([17, 64])
        counts = Counter(rnd.randint(1, capacity) for _ in range(rnd.randint(0, 80)))
        rooms = []
        for length in sorted(counts.elements(), reverse=True):
            fitting = [r for r in rooms if r >= length]
            if fitting:
                rooms.remove(min(fitting))
            rooms.append((min(fitting) if fitting else capacity) - length)
        groups = packing.best_fit(packing._Lengths(counts), capacity)
        assert sorted(rooms) == sorted(capacity - g.used() for g in groups for _ in range(g.bins))
        assert sum((Counter(_filling(g) * g.bins) for g in groups), Counter()) == counts


def test_plan_is_bounded_by_lengths():
    rnd = random.Random(7)
    counts = {length: rnd.randint(1, 10**9) for length in range(1, 1025)}
    groups = packing.pack_counts(counts)
    assert len(groups) < 6 * 1024 and len(packing.slots(groups)) < 50_000
    total = Counter()
    for g in groups:
        for length, times in g.filling:
            total[length] += times * g.bins
        assert g.used() <= 1024
    assert total == counts
    assert sum(g.bins for g in groups) <= 1.005 * _least_sequences(counts, 1024)


def _check_packing(rows, docs, capacity):
    """Every document's ids, cut as asked, each sequence gapless; returns the sequences' fillings."""
    tokenizer = Tokenizer.from_file(catalog.PACKING_VOCABULARY)
    wanted = Counter()
    for doc_id, text in docs:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        first = len(ids) % capacity or capacity
        starts = [0, *range(first, len(ids), capacity)]
        for piece, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)])):
            crc = zlib.crc32(struct.pack(f"<{b - a}I", *ids[a:b]))
            wanted[doc_id, piece, a, b - a, crc] += 1
    assert wanted == Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows)
    held = defaultdict(list)
    for r in rows:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in held.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    return held


def test_packing_of_the_table(spark):
    docs = table(spark, SF_DIR, "documents")
    rows = catalog.queries()["op11_packing"](spark, SF_DIR).collect()
    held = _check_packing(rows, [(d["doc_id"], d["text"]) for d in docs.collect()], 1024)
    assert len(held) <= 1.01 * _least_sequences(Counter(r["length"] for r in rows), 1024)


def test_packing_of_odd_rows(spark):
    docs = _docs(spark, ODD)
    for capacity in (1024, 7):
        packed = packing.pack(docs, catalog.PACKING_VOCABULARY, capacity)
        _check_packing(packed.collect(), ODD, capacity)
        whole = packing.sequences(packed).collect()
        tokens = sum(len(r["ids"]) for r in whole)
        assert tokens == sum(r["length"] for r in packed.collect()) and max(len(r["ids"]) for r in whole) <= capacity
    assert packing.pack(_docs(spark, []), catalog.PACKING_VOCABULARY).count() == 0


def test_copies_of_one_row_get_places_of_their_own(spark):
    docs = spark.range(3000).select(F.lit(None).cast("bigint").alias("doc_id"), F.lit("the same text").alias("text"))
    packed = packing.pack(docs.repartition(7), catalog.PACKING_VOCABULARY, with_ids=False)
    assert packed.count() == 3000 == packed.select("sequence_id", "offset").distinct().count()


def test_both_tokenizers_give_the_same_ids():
    encoder = packing.load_encoder(catalog.PACKING_VOCABULARY)
    signs = [chr(c) for c in range(0x800) if not 0xD800 <= c < 0xE000] + [chr(c) for c in [*range(0x1F600, 0x1F650), *range(0x2000, 0x2070), *range(0x3000, 0x3100)]]
    texts = [f"a{c}b 1{c}2 !{c}! {c} {c}{c}x\n{c}'s" for c in signs] + ["", " ", "\n\n  a", "don't  stop<|endoftext|> it"]
    slow = encoder.slow.encode_batch(texts, add_special_tokens=False)
    assert [e.ids for e in slow] == [encoder.fast.encode(t, allowed_special="all") for t in texts]


# periodic runs


def _all_runs(words, least=12):
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, 2 * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def _expected_digest(doc_id, text):
    words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", text or "") if w]
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = _all_runs(words)
    dropped = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else None
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    first = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(found), *first, sha(lines), sha(kept))


DIGEST = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def test_runs_equal_brute_force():
    rnd = random.Random(1)
    for _ in range(1500):
        letters, texts = rnd.choice([1, 2, 2, 3, 5]), []
        for _ in range(rnd.randint(1, 4)):
            n = rnd.randint(0, 70)
            words = [str(rnd.randrange(letters)) for _ in range(n)]
            if rnd.random() < 0.5 and n:
                p, a = rnd.randint(1, max(1, n // 3)), rnd.randrange(n)
                words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
            texts.append(words)
        least = rnd.choice([12, 12, 2, 5])
        blobs = [" ".join(w).encode() for w in texts]
        got = [[tuple(r) for r in f.tolist()] for _, f in periodic_runs._scan([1] * len(blobs), blobs, least, False)]
        assert got == [_all_runs(w, least) for w in texts]


@pytest.mark.parametrize("kind", ["one word", "fibonacci", "blocks", "far copies"])
def test_long_repetitive_texts(kind):
    a, b = [b"a"], [b"a", b"b"]
    while len(b) < 50_000:
        a, b = b, b + a
    words = {
        "one word": [b"a"] * 100_000, "fibonacci": b,
        "blocks": [w for i in range(500) for w in [*[b"a"] * 100, b"x%d" % i]],
        "far copies": [w for i in range(5_000) for w in [b"x%d" % i, *b"a line that comes again and again".split()]],
    }[kind]
    ((_, found),) = periodic_runs._scan([1], [b" ".join(words)], 12, False)
    assert len(found) == {"one word": 1, "blocks": 500, "far copies": 0}.get(kind, len(found))
    assert len(found) < len(words)


def test_runs_of_the_table(spark):
    docs = [(r["doc_id"], r["text"]) for r in table(spark, SF_DIR, "documents").collect()]
    got = catalog.queries()["op12_runs"](spark, SF_DIR).select(*DIGEST).collect()
    short = {d for d, t in docs if len((t or "").split()) < 1500}
    wanted = sorted(_expected_digest(d, t) for d, t in docs if d in short)
    assert sorted(tuple(r) for r in got if r["doc_id"] in short) == wanted and len(got) == len(docs)
    assert any(r["n_runs"] for r in got)


def test_runs_of_odd_rows(spark):
    odd = [(i, t) for i, t in ODD if t is not LONG]
    docs = _docs(spark, odd)
    got = periodic_runs.digest(docs).select(*DIGEST).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(repr(_expected_digest(i, t)) for i, t in odd)
    whole = {r["doc_id"]: r for r in periodic_runs.find_runs(docs).collect()}
    assert whole[8]["collapsed"] == "a b" and whole[8]["runs"] == [(0, 600, 2)] and whole[8]["n_words"] == 600
    assert whole[1]["n_runs"] == 0 and whole[1]["collapsed"] == "" and whole[1]["start"] is None
    (long,) = periodic_runs.find_runs(_docs(spark, [(5, LONG)])).collect()
    assert long["runs"] == [(0, 140_000, 977 * 7)]
    assert periodic_runs.digest(_docs(spark, [])).count() == 0 == periodic_runs.find_runs(_docs(spark, [])).count()


# clustering

VECTORS = "vec_id bigint, embedding array<float>, label int, cluster string, cells string, point string"


def _vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, "a", "b", "c") for i, v in rows], VECTORS)


def _plain_clusters(rows, k=40, rounds=5):
    """The contract in Python integers, with float32 components taken as doubles."""
    kept = []
    for vec_id, v in rows:
        if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v):
            kept.append((vec_id, [math.floor(256 * float(np.float32(x))) for x in v]))
    points = np.array([p for _, p in kept], np.int64).reshape(-1, 64)
    name = lambda i: hashlib.sha256(f"2:{'' if i is None else i}".encode()).hexdigest()
    centres = np.array([p for _, p in sorted(kept, key=lambda r: (name(r[0]), r[1]))[:k]], np.int64).reshape(-1, 64)
    for step in range(rounds + 1):
        distance = ((points[:, None] - centres[None]) ** 2).sum(2)
        near = distance.argmin(1) if len(kept) else np.array([], int)
        if step < rounds:
            for c in range(len(centres)):
                members = points[near == c]
                if len(members):
                    centres[c] = [int(s) // len(members) for s in members.sum(0)]
    own = distance[np.arange(len(kept)), near] if len(kept) else []
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres.tolist()]
    inertia = Counter()
    for c, d in zip(near, own):
        inertia[c] += int(d)
    return sorted(
        (repr(i), int(c), int(d), inertia[c], sum(inertia.values()), sha[c]) for (i, _), c, d in zip(kept, near, own)
    )


def _got(df):
    columns = ("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    return sorted((repr(r[0]), *r[1:]) for r in df.select(*columns).collect())


def test_clusters_of_the_table(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in table(spark, SF_DIR, "embeddings").collect()]
    assert _got(catalog.queries()["op13_clusters"](spark, SF_DIR)) == _plain_clusters(rows)


def test_clusters_of_odd_rows(spark):
    rnd = random.Random(3)
    flat = [0.25] * 64
    odd = [(1, None), (2, []), (3, [1.0] * 63), (4, [1.0] * 65), (5, [float("nan")] + flat[1:]), (6, [float("inf")] + flat[1:]),
           (7, [None] + flat[1:]), (None, flat), (None, [-0.001] * 64), (8, flat), (8, flat), (9, [-300.5] * 64)]
    many = odd + [(100 + i, flat) for i in range(60)] + [(200 + i, [rnd.gauss(0, 1) for _ in range(64)]) for i in range(90)]
    for rows in (odd, many, odd[:7], []):
        assert _got(centroids.cluster(_vectors(spark, rows))) == _plain_clusters(rows)


def test_far_vectors_keep_exact_distances(spark):
    rnd = random.Random(4)
    rows = [(i, [rnd.choice([-1, 1]) * 4.0 ** rnd.randint(0, 9) for _ in range(64)]) for i in range(120)]
    assert _got(centroids.cluster(_vectors(spark, rows))) == _plain_clusters(rows)
    with pytest.raises(Exception, match="without a long distance"):
        centroids.cluster(_vectors(spark, [(1, [1e30] * 64)])).collect()


def test_intervals_hold_every_distance_and_spare_vectors():
    rng = np.random.default_rng(2)
    centres = rng.integers(-60, 60, (8, 7))
    points = np.concatenate([c + rng.integers(-9, 10, (200, 7)) for c in centres])
    parts = np.arange(1, centroids.CELLS) / centroids.CELLS
    cuts = np.quantile(points, parts, axis=0, method="nearest").T.astype(np.int64)
    cells = np.zeros((len(points), 8), np.uint8)
    for d, bounds in enumerate(cuts):
        cells[:, d] = np.searchsorted(bounds, points[:, d], side="right")
    tables = centroids.Intervals(centres, cuts, points.min(0), points.max(0))
    packed = cells[:, ::2] << 4 | cells[:, 1::2]
    least, most = tables.bounds(packed)
    distance = ((points[:, None] - centres[None]) ** 2).sum(2)
    assert (least <= distance).all() and (distance <= most).all()
    cluster, compared = tables.nearest(packed, points)
    assert (cluster == distance.argmin(1)).all() and compared < len(points) // 2


def test_no_vector_is_shuffled(spark):
    points = centroids.whole_vectors(table(spark, SF_DIR, "embeddings"))
    plan = points._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "ReadSchema: struct<vec_id:bigint,embedding:array<float>>" in plan


def test_reduction_rules_on_known_sets():
    def of(*lengths):
        return packing._Lengths(Counter(lengths))

    assert packing.dominating(of(10, 3), 10, 10) == (10,)
    assert packing.dominating(of(7, 3, 1, 1), 7, 10) == (7, 3)
    assert packing.dominating(of(6, 3, 2), 6, 10) == (6, 3)
    assert packing.dominating(of(6, 2, 2), 6, 10) in ((6, 2, 2), (6, 2))
    assert packing.dominating(of(5, 2, 1, 1), 5, 10) is None
    assert list(itertools.chain(*(g.filling for g in packing.pack_counts({})))) == []
