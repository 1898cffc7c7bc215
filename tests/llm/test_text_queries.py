"""The text operators on tables: against SQL and brute force, and on odd rows."""

import hashlib
import math
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
import corpus_pipeline
import oracle_check
from roadpulse.llm import (
    catalog, decontamination, fingerprints, html_text, licenses, mixing, mixing_model,
    near_duplicates, secrets, token_counts, toxicity, words,
)
from roadpulse.llm.common import table

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, copy int, `range` int, labels string"


def _docs(spark, rows):
    full = [(i, t, "en", s, None if t is None else len(t), "x", 1, 2, "y") for i, t, s in rows]
    return spark.createDataFrame(full, SCHEMA)


LONG = " ".join(f"word{i % 977} under the mit license" for i in range(20_000))
ODD = [
    (1, None, "a"), (2, "", "a"), (2, "", "a"), (3, "  \n ", None), (None, "one two three four five six", "b"),
    (4, "one two three four five six", "b"), (4, "one two three four five six", "b"), (5, LONG, "b"),
    (6, "password=abcdef12 CC BY-NC", "c"), (7, "x", "c"), (4, "a different text under one id", "c"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return _docs(spark, ODD)


@pytest.fixture(scope="module")
def none(spark):
    return _docs(spark, [])


def _labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


def test_queries_with_sql_equal_it(spark):
    con = oracle_check.connect(SF_DIR)
    for name, sql in catalog.oracle_sql().items():
        assert oracle_check.compare(catalog.queries()[name](spark, SF_DIR), con, sql) == []


def test_all_queries_are_registered():
    names = driver.queries()
    assert [n for n in names if n.startswith("op")] == list(catalog.queries()) and "pipeline" in names


def test_extract_odd_pages(spark):
    rows = [(1, "u", None), (None, None, "<p>a</p>"), (1, "u", None), (2, "v", "<p>" + "long, text. " * 20_000)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("text", F.lit(3))
    got = sorted((r["page_id"] or 0, r["text"][:1], r["n_chars"]) for r in html_text.extract(pages).collect())
    assert got == [(0, "a", 1), (1, "", 0), (1, "", 0), (2, "l", 239_999)]


def test_licenses_on_odd_rows(odd, none):
    got = {(r["doc_id"], r["n_words"]): r for r in licenses.scan_licenses(odd).collect()}
    assert licenses.scan_licenses(odd).count() == len(ODD)
    r = got[5, 100_000]
    assert (r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == (20_000, 1, 99_996, "mit")
    assert got[6, 5]["base_labels"] == "cc-by-nc" and got[1, 0]["first_word"] is None
    assert licenses.scan_licenses(none).count() == 0


def test_a_passage_with_an_inserted_word_is_one_span(spark):
    text = licenses.NOTICES[0][1].split()
    docs = _docs(spark, [(1, " ".join([*text[:20], "oddly", *text[20:]]), "a"), (2, " ".join(text[:6]), "a")])
    got = {r["doc_id"]: r for r in licenses.scan_licenses(docs).collect()}
    assert got[1]["labels"] == "mit" and 0.9 < got[1]["score"] < 1
    assert got[2]["labels"] == "" and 0 < got[2]["score"] < 0.2


def test_fingerprints_on_odd_rows(odd, none, spark):
    got = fingerprints.fingerprint(odd).collect()
    order = sorted(((i is not None, i, t or "") for i, t, _ in ODD), key=lambda r: (r[0], r[1] or 0))
    assert len(got) == len(ODD) and Counter(r["n_chars"] for r in got) == Counter(len(t) for _, _, t in order)
    by = {(r["doc_id"], r["n_chars"]): r for r in got}
    last = by[7, 1]  # the next one of the last is the first: the null id
    assert last["edited_sha256"] == hashlib.sha256(b"x").hexdigest()
    assert by[4, 27]["fingerprint"] == by[None, 27]["fingerprint"] != ""
    assert by[1, 0]["fingerprint"] == "" and by[1, 0]["near_next"] == 1.0
    assert fingerprints.fingerprint(none).count() == 0


def test_fingerprints_equal_brute_force(spark):
    docs = table(spark, SF_DIR, "documents")
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    got = {r["doc_id"]: r for r in fingerprints.fingerprint(docs).collect()}
    sets = {}
    for k, (i, text) in enumerate(rows):
        after = rows[(k + 1) % len(rows)]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[1][:half]
        r = got[i]
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        a, e = (set(r[c].split(",")) for c in ("fingerprint", "edited_fingerprint"))
        assert r["near_edited"] == pytest.approx(len(a & e) / len(a | e))
        sets[i] = a
    for k, (i, _) in enumerate(rows):
        a, b = sets[i], sets[rows[(k + 1) % len(rows)][0]]
        assert got[i]["near_next"] == pytest.approx(len(a & b) / len(a | b))


def _brute_classes(rows, threshold=0.8):
    texts = {}
    for i, t in rows:
        texts.setdefault(t, []).append(i)
    names, sets = list(texts), words.shingle_sets(list(texts))
    links, root = Counter(), list(range(len(names)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = {}
    for k, s in enumerate(sets):
        for x in s.tolist():
            holders.setdefault(x, []).append(k)
    met = {(a, b) for ks in holders.values() for a in ks for b in ks if a < b}
    for a, b in met:
        same = len(set(sets[a].tolist()) & set(sets[b].tolist()))
        if same >= threshold * (len(sets[a]) + len(sets[b]) - same):
            links[a] += 1
            links[b] += 1
            root[max(find(a), find(b))] = min(find(a), find(b))
    low = {}
    for k, n in enumerate(names):
        low[find(k)] = min(low.get(find(k), 1 << 60), min(texts[n]))
    return {(i, low[find(k)], min(texts[n]), links[k]) for k, n in enumerate(names) for i in texts[n]}


def test_near_duplicates_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(near_duplicates, "CHUNK", 4)  # so that runs are split into chunks
    rows = [(r["doc_id"], r["text"]) for r in table(spark, SF_DIR, "documents").collect()]
    base = [f"t{i}" for i in range(120)]
    for k in range(30):  # a group of near copies, chains among them
        rows.append((10_000 + k, " ".join([*base[: 3 * k // 2], f"other{k}", *base[3 * k // 2 :]])))
    rows += [(20_000, rows[-1][1]), (20_001, "a b"), (20_002, "A, b!"), (20_003, "...")]
    found = near_duplicates.near_duplicates(_docs(spark, [(i, t, "s") for i, t in rows]))
    got = {(r["doc_id"], r["class_id"], r["text_id"], r["n_links"]) for r in found.collect()}
    assert got == _brute_classes(rows)


def test_near_duplicates_on_odd_rows(odd, none):
    got = near_duplicates.near_duplicates(odd).collect()
    assert len(got) == len(ODD)
    by = {(r["doc_id"], r["text_key"]): r for r in got}
    assert sorted((r["doc_id"] or 0, r["class_id"]) for r in got if r["class_id"] in (1, 4)) == [(0, 4), (1, 1), (2, 1), (2, 1), (4, 4), (4, 4), (4, 4)]
    assert len(by) == 9
    kept = near_duplicates.keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted((r["doc_id"], len(r["text"] or "")) for r in kept.collect()) == [(1, 0), (3, 4), (4, 27), (4, 29), (5, len(LONG)), (6, 26), (7, 1)]
    assert near_duplicates.near_duplicates(none).count() == near_duplicates.keep_one(none).count() == 0


def test_token_counts_on_odd_rows(odd, none):
    got = {(r["doc_id"], r["n_words"]): r["n_tokens"] for r in token_counts.count_tokens(odd, catalog.VOCABULARY).collect()}
    assert got[1, 0] == 0 and got[3, 0] == 0 and got[7, 1] == 1 and got[None, 6] == got[4, 6] >= 6
    assert token_counts.count_tokens(none, catalog.VOCABULARY).count() == 0


def test_unigram_scores_equal_brute_force(spark):
    docs = table(spark, SF_DIR, "documents")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    cut = {i: [*mixing_model.tokens_of(t.encode()), b""] for i, t in rows}
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in rows}
    counts = Counter(t for i, ts in cut.items() if not held[i] for t in ts)
    n, v = sum(counts.values()), len(counts)
    for limit in (100_000, 50):  # few common tokens: most are joined
        mixing_model.COMMON_TOKENS, before = limit, mixing_model.COMMON_TOKENS
        try:
            got = {r["doc_id"]: r for r in mixing_model.score_texts(docs).collect()}
        finally:
            mixing_model.COMMON_TOKENS = before
        for i, ts in cut.items():
            r = got[i]
            want = sum(math.log10((counts[t] + 0.5) / (n + 0.5 * (v + 1))) for t in ts)
            assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[i], len(ts), sum(counts[t] > 0 for t in ts), n)
            assert r["base_score"] == pytest.approx(want, abs=1e-6) and r["score"] < 0


def test_scores_on_odd_rows(odd, none):
    got = mixing_model.score_texts(odd).collect()
    assert len(got) == len(ODD) and all(math.isfinite(r["score"]) and math.isfinite(r["base_score"]) for r in got)
    assert {r["n_tokens"] for r in got if r["doc_id"] in (1, 2, 3)} == {1}
    assert mixing_model.score_texts(none).count() == 0


def test_mixing_on_odd_rows(odd, none, spark):
    got = mixing.poisson_mix(odd, temperature=1.0)
    assert got.columns == [*odd.columns, "_copy", "shuffle_key"]
    assert mixing.poisson_mix(none).count() == 0
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("abc").alias("text"), F.when(F.col("id") % 4 == 0, "s").otherwise("t").alias("source"))
    mixed = mixing.poisson_mix(docs, weights={"s": 3.0, "t": 1.0})
    counts = {r["source"]: r["count"] for r in mixed.groupBy("source").count().collect()}
    assert abs(counts["s"] - 3000) < 250 and abs(counts["t"] - 1000) < 150
    heavy = mixing.poisson_mix(docs.filter("doc_id < 40"), weights={"s": 1000.0, "t": 1.0})
    assert heavy.count() > 0
    mixing.SMALL_SOURCES, before = 0, mixing.SMALL_SOURCES
    try:  # the salted join gives the same copies
        again = mixing.poisson_mix(docs, weights={"s": 3.0, "t": 1.0})
        assert sorted(map(tuple, again.collect())) == sorted(map(tuple, mixed.select(again.columns).collect()))
    finally:
        mixing.SMALL_SOURCES = before


def test_secrets_on_odd_rows(odd, none):
    got = secrets.digest(secrets.find_secrets(odd)).collect()
    assert len(got) == len(ODD)
    (r,) = [r for r in got if r["doc_id"] == 6]
    assert r["spans"] == "assign:0:17" and r["base_sha256"] == secrets.sha256_of([("assign", 0, 17)])
    assert {r["base_sha256"] for r in got if r["doc_id"] == 1} == {secrets.sha256_of([])}
    clean = {(r["doc_id"], r["n_chars"]): r["text"] for r in secrets.redact(odd).collect()}
    assert clean[6, 17] == "[SECRET] CC BY-NC"
    assert clean[1, None] is None and secrets.redact(odd).columns == odd.columns
    assert secrets.redact(none).count() == 0


def test_leaks(spark, odd, none):
    items = spark.createDataFrame([(1, "What is the word for it? The word is bird."), (2, None), (None, "!!")], "item_id bigint, text string")
    docs = _docs(spark, [(1, "x " * 500 + "what is THE word for it?? the word is bird " + "y " * 300, "a"), (2, "The word is bird. " * 9, "a"), (None, None, None)])
    got = decontamination.find_leaks(docs, items).collect()
    assert [(r["doc_id"], r["item_id"], r["question_overlap"], r["answer_overlap"]) for r in got] == [(1, 1, 1.0, 1.0)]
    blocks = decontamination.find_leaks(docs, items, block_items=1).select("doc_id", "item_id").collect()
    assert [tuple(r) for r in blocks] == [(1, 1)]
    assert decontamination.find_leaks(odd, items.limit(0)).count() == decontamination.find_leaks(none, items).count() == 0


def test_leaks_without_the_answer(spark):
    short = "Name the old river of that land? Er."
    asked = "Which of the seven old rivers of that country runs north past the castle?"
    long_answer = " It is the one that " + " ".join(f"answer{i}" for i in range(30)) + "."
    texts_ = [
        (1, "Some one told me, and I quote: name THE old river of that land, and so on.", "a"),
        (2, f"before {asked} " + "after " * 200, "a"),
        (3, "the seven old rivers of another country run south past many a castle", "a"),
        (4, "an old river with a name", "a"),
    ]
    items = spark.createDataFrame([(1, "Who knows? Er."), (2, asked + " Er."), (3, asked + long_answer), (4, short)], "item_id bigint, text string")
    got = decontamination.find_leaks(_docs(spark, texts_), items).collect()
    by = {(r["doc_id"], r["item_id"]): r for r in got}
    assert set(by) == {(1, 4), (2, 2), (2, 3)}
    assert all(by[k]["question_overlap"] == 1 and by[k]["answer_overlap"] == 0 for k in [(2, 2), (2, 3)])


def test_leaks_do_not_depend_on_blocks(spark):
    rows = [(i, f"what is the name of river {'long ' * (i % 4)} number{i % 5} in land{i}? it is called r{i} s{i % 3}") for i in range(12)]
    items = spark.createDataFrame([*rows, rows[0], (0, "another text under one id, which is one more item")], "item_id bigint, text string")
    docs = _docs(spark, [(i, f"before that {t} " + f"and w{i} " * 30, "a") for i, t in rows])
    columns = ["doc_id", "item_id", "score", "question_overlap", "answer_overlap", "first_word"]
    found = [
        sorted(tuple(r) for r in decontamination.find_leaks(docs, items, **bound).select(columns).collect())
        for bound in ({}, {"block_items": 1}, {"block_items": 5}, {"block_bytes": 200})
    ]
    assert len(found[0]) >= 12 and {(i, i) for i in range(12)} <= {r[:2] for r in found[0]}
    assert all(made == found[0] for made in found)
    assert len({r[:2] for r in found[0]}) == len(found[0])


def test_toxicity_learns_and_leaves_clean_texts_alone(spark):
    docs = [(i, f"text {i} has a{i} {['idiot', 'scum'][i % 2] if i % 5 == 0 else 'nice'} word b{i % 7} c{i % 11}", "s") for i in range(600)]
    labels = _labels(spark, [(i, 0, int(i % 5 == 0)) for i in range(600)] + [(3, 0, None), (None, 0, 1), (9999, 0, 1)])
    got = toxicity.toxicity(_docs(spark, docs), labels).collect()
    assert len(got) == 600 and all(r["predicted"] == int(r["doc_id"] % 5 == 0) for r in got)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)


def test_toxicity_on_odd_rows(spark, odd, none):
    labels = _labels(spark, [(1, 1, 1), (5, 1, 0)])
    got = toxicity.toxicity(odd, labels).collect()
    assert len(got) == len(ODD) and all(0 <= r["score"] <= 1 for r in got)
    assert toxicity.toxicity(odd, labels.limit(0)).count() == len(ODD)
    assert toxicity.toxicity(none, labels).count() == 0


def test_toxicity_scores_are_chances_however_much_was_sampled(spark, monkeypatch):
    """Seven clean texts to a toxic one; a word is in all toxic and in a seventh of the clean ones."""
    def said(i):
        word = "scum" if i % 8 < 2 else "nice" if i % 8 < 7 else ""
        return f"text a{i} {word} word b{i % 7}" if word else "..."

    def scores(n, sample):
        monkeypatch.setattr(toxicity, "SAMPLE", sample)
        docs = _docs(spark, [(i, said(i), "s") for i in range(n)])
        got = toxicity.toxicity(docs, _labels(spark, [(i, 0, int(i % 8 == 0)) for i in range(n)])).collect()
        return {k: {r["score"] for r in got if r["doc_id"] % 8 == k} for k in (1, 3, 7)}

    whole, cut, larger = scores(1600, 5000), scores(1600, 60), scores(6400, 240)
    for made in (whole, cut, larger):
        assert all(len(found) == 1 for found in made.values())
        assert 0.35 < max(made[1]) < 0.65  # half of the texts with the word are toxic
        assert max(made[3]) < 0.1 and max(made[7]) < 0.1


def test_pipeline_stages(spark):
    docs = table(spark, SF_DIR, "documents")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_DIR)
        if name != "mixing":
            assert out.columns == docs.columns
            rows = {r["doc_id"]: r for r in out.collect()}
            given = {r["doc_id"]: r for r in docs.collect()}
            assert set(rows) <= set(given) and len(rows) > 0.5 * len(given)
            if name == "secrets":
                assert set(rows) == set(given)
                assert not any(secrets.scan_block([r["text"] for r in rows.values()], secrets.BASE_RULES))
            if name == "near_duplicates":
                assert len(rows) == len({c for _, c, _, _ in _brute_classes([(i, r["text"]) for i, r in given.items()])})
            docs = spark.createDataFrame(list(rows.values()), docs.schema)
    assert set(docs.columns) < set(out.columns)


def test_pipeline_keeps_odd_rows(spark, odd, none):
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, odd, SF_DIR)
        assert set(odd.columns) <= set(out.columns)
        if name in ("toxicity", "decontamination", "secrets"):
            assert out.count() == len(ODD)
        assert stage(spark, none, SF_DIR).count() == 0


def test_blocks_without_secrets_go_beside_blocks_with_some(spark, monkeypatch):
    """Batches of one task have one type, whether or not a batch holds a secret."""
    from roadpulse.llm import common, secrets

    monkeypatch.setattr(common, "BATCH_ROWS", 1)
    common.prepare(spark)
    said = ["plain", "password = hunter2hunter2", "", "AKIA" + "A" * 16, None, "plain"]
    docs = spark.createDataFrame(list(enumerate(said)), "doc_id bigint, text string").coalesce(1)
    found = secrets.digest(secrets.find_secrets(docs)).orderBy("doc_id").collect()
    assert [(r["n_assign"], r["n_access"]) for r in found] == [(0, 0), (1, 0), (0, 0), (0, 1), (0, 0), (0, 0)]
    monkeypatch.undo()
    common.prepare(spark)
