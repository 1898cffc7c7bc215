"""The parts of the text operators that need no session, against brute force."""

import math
import random
import re

import numpy as np
import pytest

from roadpulse.llm import decontamination, mixing_model, near_duplicates, secrets, token_counts, toxicity, words
from roadpulse.llm.html_text import main_text

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body>
<header><h1>Site name</h1></header><nav><ul><li><a href="/">Home</a></li></ul></nav>
<div class="cookie-notice">We use cookies, as everyone does. Please agree to all of them now.</div>
<main><article><h1>Title &amp; more</h1><p>First paragraph, which is long enough, and has signs.
Second&nbsp;line&#33;</p><div class="ad">Buy this thing, now, cheap, today!</div><p><b>Bold<br><p>Be. Erin.
<ul><li>one</li><li>two</li></ul><form><label>Mail</label><input></form></article>
<section id="comments"><p>I am a reader, and I say, at length, that this is, well, nice.</p></section></main>
<aside><p>Other stories, of which there are many, all of them good.</p></aside>
<script>var x = "<p>no</p>";</script><footer>&copy; 2024</footer></body></html>"""


def test_article_of_a_page():
    assert main_text(PAGE) == (
        "Title & more\nFirst paragraph, which is long enough, and has signs. Second line!\n"
        "Bold\nBe. Erin.\none\ntwo"
    )


def test_odd_pages():
    assert main_text(None) == main_text("") == main_text("<p></p>") == main_text("<!-- a") == ""
    assert main_text("plain text, no tags") == "plain text, no tags"
    assert main_text("<p>a < b &lt;i&gt; &amp") == "a < b <i> &"
    assert main_text("<p>cut <a href='x") == "cut"
    deep = "<div>" * 3000 + "<p>deep, very deep.</p>"
    assert main_text(deep) == "deep, very deep."


def test_div_page_without_marks():
    page = "<body><div><a href=1>one</a> <a href=2>two</a></div><h1>Head</h1><div><p>%s</p><p>Short.</p></div></body>"
    long = "A long sentence, with words, and signs. " * 5
    assert main_text(page % long) == f"Head\n{long.strip()}\nShort."


def test_all_content_of_a_page_without_article():
    long = "A long sentence, with words, and signs, of which there are many. " * 45
    short = "A paragraph of its own, with some words and a few signs. " * 5
    parts = [long, short + "One.", short + "Two.", short + "Three."]
    page = "<body><main><section><p>%s</p></section><section><p>%s</p><p>%s</p><p>%s</p></section></main></body>"
    assert main_text(page % tuple(parts)).split("\n") == [" ".join(p.split()) for p in parts]
    items = [f"Item {i}, as long as a paragraph, with signs, and more words, and so on." for i in range(40)]
    listed = "".join(f"<li>{i}</li>" for i in items)
    page = f"<body><div><div><p>{short}Before.</p></div><ul>{listed}</ul><div><p>{short}After.</p></div></div></body>"
    assert main_text(page).split("\n") == [short + "Before.", *items, short + "After."]


def test_linked_blocks_of_an_article_stay():
    long = "A long sentence, with words, and signs. " * 5
    body = f"<p>{long}</p><h2><a href=1>A linked heading</a></h2><ul><li><a href=2>A linked item</a></li></ul><p>{long}</p>"
    want = [long.strip(), "A linked heading", "A linked item", long.strip()]
    assert main_text(f"<body><article>{body}</article></body>").split("\n") == want
    nav = "<div><a href=1>one</a> <a href=2>two</a></div>"
    assert main_text(f"<body>{nav}<div>{nav}{body}{nav}</div>{nav}</body>").split("\n") == want


def test_a_wrapper_named_by_a_mark_word_keeps_its_page():
    long = "A long sentence, with words, and signs. " * 5
    said = f"<p>{long}</p><p>Short.</p>"
    side = "<div class='sidebar'><p>Other stories, of which there are many, all of them good.</p></div>"
    talk = f"<div id='comments'><p>{long}</p><p>{long}</p><p>{long}</p></div>"
    want = f"{long.strip()}\nShort."
    for page in (
        f"<div class='page with-sidebar'><article>{said}</article>{side}{talk}</div>",
        f"<main class='no-sidebar'>{said}{side}</main>{talk}",
        f"<div id='search-results'><div class='hasBanner'><div>{said}</div>{side}</div></div>",
        f"<div class='page with-sidebar'><div>{said}</div>{side}{talk}</div>",
        f"<div><div>{said}</div>{talk}{side}</div>",
    ):
        assert main_text(f"<html><body class='page'><nav><a href=1>Home</a></nav>{page}</body></html>") == want
    assert main_text(f"<body><div class='sidebar' hidden><main>{said}</main></div></body>") == ""


def test_secrets_equal_full_scans():
    rng = random.Random(5)
    parts = ["password=abcdef", "SECRET: 'xyz12345'", "api_key=ab", "AKIA" + "A1" * 8, "AKIA12", "deadbeef" * 3,
             "token=secret=abcdefgh", "ghp_" + "a" * 36, " x ", "\n", "Ⅷ", "é", "https://u:p@h", "pass", "word", "Key"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 12))) for _ in range(300)] + [""]
    want = []
    for text in texts:
        rows = []
        for place, rule in enumerate(secrets.RULES):
            for m in re.finditer(rule.pattern, text):
                if m.end(rule.group) - m.start(rule.group) >= rule.least:
                    rows.append((m.start(), place, m.end()))
        want.append([(s, e, p) for s, p, e in sorted(rows)])
    assert secrets.scan_block(texts) == want
    assert secrets.scan_block([]) == []


def test_trigram_queries():
    assert secrets.trigram_query("[0-9a-f]+") is True
    assert secrets.trigram_query("ab") is True
    assert secrets.trigram_query("abcd") == ("and", frozenset({"abc", "bcd"}))
    assert secrets.trigrams(secrets.trigram_query("(abc|xyz)+q?")) == {"abc", "xyz"}
    assert secrets.trigram_query("(abc|x)") is True


def test_word_pieces_equal_greedy_matching():
    rng = random.Random(3)
    for _ in range(60):
        pieces = {tuple(rng.choices([97, 98, 99], k=rng.randint(1, 4))) for _ in range(rng.randint(1, 9))}
        pieces |= {(*p, token_counts.END) for p in pieces if rng.random() < 0.5}
        made = token_counts.Automaton(sorted(pieces))
        words_ = [bytes(rng.choices(b"abc", k=rng.randint(0, 12))) for _ in range(50)]
        assert made.lengths(words_).tolist() == [_greedy(w, pieces) for w in words_]


def _greedy(word, pieces):
    if not word:
        return 0
    symbols, at, n = (*word, token_counts.END), 0, 0
    while at < len(symbols):
        for end in range(len(symbols), at, -1):
            if symbols[at:end] in pieces:
                break
        else:
            return 1
        at, n = end, n + 1
    return n


def test_word_hashes_do_not_depend_on_place_or_stretch(monkeypatch):
    texts = ["The cat, the CAT", "", "été 12 été", "x" * 50 + " cat"]
    whole, begins = words.word_hashes(texts)
    assert begins.tolist() == [0, 4, 4, 7, 9]
    assert whole[0] == whole[2] and whole[1] == whole[3] == whole[8] and whole[4] == whole[6]
    monkeypatch.setattr(words, "_STRETCH", 8)
    assert (words.word_hashes(texts)[0] == whole).all()
    assert [len(s) for s in words.shingle_sets(["a b c d e f", "a b", "!"])] == [2, 1, 0]


def test_depth_shortens_until_the_recall_is_met():
    assert near_duplicates.prefix_depth(0.8, 0.9999) == 3
    assert near_duplicates.prefix_depth(0.8, 0.5) > 3
    assert near_duplicates.prefix_depth(0.1, 0.999999) == 1


def test_common_shingles_by_blocks(monkeypatch):
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 60, 40).astype(np.uint64)) for _ in range(9)]
    monkeypatch.setattr(near_duplicates, "_COLUMNS", 7)
    want = [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
    assert near_duplicates.common_shingles(sets, sets).tolist() == want


def test_search_loses_no_item_above_the_threshold():
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(1, 14)))) for i in range(40)]
    index = decontamination.Index.build(items, 0.6)
    texts = [" ".join(rng.choices(vocabulary, k=rng.randint(0, 90))) for _ in range(60)] + [t for _, t in items]
    hashes, begins = words.word_hashes(texts)
    got = {(s, i): round(x, 9) for s, i, x in index.search(hashes, begins)}
    want = {}
    for text in range(len(texts)):
        for start in range(int(begins[text]), int(begins[text + 1]), index.passage):
            passage = set(hashes[start : min(start + 2 * index.passage, int(begins[text + 1]))].tolist())
            for item in range(len(index.ids)):
                part = slice(*index.item_at[item : item + 2].tolist())
                score = sum(w for h, w in zip(index.item_words[part].tolist(), index.item_worth[part]) if h in passage)
                if score >= decontamination.SURE:
                    want[start, item] = round(score, 9)
    assert got == want and len(want) > 40
    assert decontamination.Index.build([(1, "!")], 0.6) is None


def test_nearest_examples_equal_all_cosines():
    rng = random.Random(2)
    vectors = []
    for _ in range(300):
        raw = {t: rng.random() for t in rng.sample(range(30), rng.randint(0, 6))}
        size = math.sqrt(sum(w * w for w in raw.values())) or 1
        vectors.append({t: w / size for t, w in raw.items()})
    index = toxicity.Examples.build(vectors, [0] * 300, list(range(300)), 30)
    for query in vectors[:60]:
        want = sorted((sum(w * v.get(t, 0) for t, w in query.items()) for v in vectors), reverse=True)
        got = [s for s, _ in index.nearest(query, 15)]
        assert got == pytest.approx([w for w in want if w > 0][:15], abs=1e-9)


def test_calibration_never_falls():
    made = toxicity.Calibration([0.1, 0.2, 0.2, 0.9, 1.0], [1, 0, 0, 1, 1], 0.07)
    values = [made.score(x / 50) for x in range(51)]
    assert values == sorted(values) and 0 <= values[0] and values[-1] <= 1 and made.score(None) == 0.07


WORDS = [b"ab", b"cd", b"abcdab"]
SEEN = mixing_model.Seen.of_tokens(WORDS)


def test_the_gate_is_shut_for_unseen_contexts():
    """However full the slots are: it goes by the words."""
    begins = {w[:k] for w in WORDS for k in range(len(w) + 1)}
    rng = random.Random(4)
    tried = sorted({bytes(rng.choices(b"abcd", k=rng.randint(0, 6))) for _ in range(2000)} | begins)
    texts = [b"xx " + t for t in tried]
    made = mixing_model.TextDecisions(texts, mixing_model.Code(np.ones(257)))
    open_ = SEEN.has(made.contexts[-1][made.text_begins[1:] - 1])
    assert {t for t, seen in zip(tried, open_) if seen} == begins


def test_a_text_scores_the_same_in_any_company():
    rng = random.Random(9)
    texts = [bytes(rng.choices(b"abc \n\xc3", k=rng.choice([0, 1, 3, 40, 900]))) for _ in range(20)]
    code = mixing_model.Code.of_tokens([(b"abc", 9), (b"", 3)], 9)
    counts = np.zeros((len(mixing_model.ORDERS), mixing_model.SLOTS, 2), np.uint32)
    mixing_model.count(mixing_model.decisions(texts[:10], code), counts)
    odds = mixing_model.log_odds(counts)
    together = mixing_model.score(mixing_model.TextDecisions(texts, code), odds, SEEN)
    alone = [mixing_model.score(mixing_model.TextDecisions([t], code), odds, SEEN)[0] for t in texts]
    assert np.allclose(together, alone, rtol=1e-5) and (together < 0).all()


def test_a_text_is_learnt_symbol_by_symbol_from_its_first_to_its_last():
    rng = random.Random(3)
    texts = [bytes(rng.choices(b"ab cd", k=k)) for k in (2500, 0, 7, 900)]
    code = mixing_model.Code.of_tokens([(b"abc", 9), (b"", 3)], 9)
    counts = np.zeros((len(mixing_model.ORDERS), mixing_model.SLOTS, 2), np.uint32)
    mixing_model.count(mixing_model.decisions([b"ab ab cd abcd" * 9], code), counts)
    odds = mixing_model.log_odds(counts)
    got = mixing_model.score(mixing_model.TextDecisions(texts, code), odds, SEEN)
    buckets = mixing_model.REFINE_BUCKETS
    for text, score in zip(texts, got):
        made = mixing_model.decisions([text], code)
        weights = [[0.4] * len(made.slots) for _ in range(2)]
        refined = [1 / (1 + math.exp(-(i - buckets / 2 + 0.5) / 2)) for i in range(buckets)]
        want = 0.0
        for begin, end in zip(made.begins, made.begins[1:]):
            # the decisions of a symbol are made with what was learnt before it
            so_far = text[: made.begins.tolist().index(begin)].split(b" ")[-1]
            w = weights[int(any(word.startswith(so_far) for word in WORDS))]
            steps, changes = [0.0] * len(w), []
            for d in range(begin, end):
                bit = int(made.bits[d])
                x = [float(odds[o][slot[d]]) for o, slot in enumerate(made.slots)]
                dot = max(-12.0, min(12.0, sum(a * b for a, b in zip(w, x))))
                p = 1 / (1 + math.exp(-dot))
                for o in range(len(x)):
                    steps[o] += (bit - p) * float(mixing_model.RATE) * x[o]
                bucket = int(max(0, min(buckets - 1, dot * 2 + buckets / 2)))
                p = (3 * p + refined[bucket]) / 4
                changes.append((bucket, (bit - refined[bucket]) * float(mixing_model.REFINE_RATE)))
                want += math.log10(max(p if bit else 1 - p, 1e-12))
            for o, step in enumerate(steps):
                w[o] += step
            for bucket, change in changes:
                refined[bucket] += change
        assert score == pytest.approx(want, rel=1e-4)


def test_decisions_give_a_distribution():
    """The chances of all single bytes and of the end alone add up to one."""
    code = mixing_model.Code(np.arange(1, 258))
    odds = np.zeros((len(mixing_model.ORDERS), mixing_model.SLOTS), np.float32)
    odds += np.random.default_rng(4).normal(0, 1, odds.shape).astype(np.float32)
    first = []
    for symbol in range(256):
        made = mixing_model.TextDecisions([bytes([symbol])], code)
        made.text_begins = np.array([0, 1])
        first.append(10 ** mixing_model.score(made, odds, SEEN)[0])
    end = 10 ** mixing_model.score(mixing_model.TextDecisions([b""], code), odds, SEEN)[0]
    assert abs(sum(first) + end - 1) < 1e-3
