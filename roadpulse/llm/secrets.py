"""Secret scans by a trigram inverted index.

Each rule's regular expression is turned into a Boolean query over trigrams that every match
must hold. Blocks of texts are indexed by trigram; a rule's postings are united and intersected
as its query says, and the expression itself runs only on the texts that are left. Rules
without mandatory trigrams run on every text.

The index of a block lives in the task that reads it, so texts are never shuffled and a lost
executor costs one block.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable
from dataclasses import dataclass
from re import _constants as sre
from re import _parser

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.common import map_texts, texts


@dataclass(frozen=True)
class Rule:
    """A kind of secret; matches whose ``group`` is shorter than ``least`` are dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(map(_either_case, ("password", "passwd", "secret", "token")))
_ASSIGN = rf"""(?:{_NAMES}|{_either_case("api")}_?{_either_case("key")})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""

# Formats of well-known credentials.
BASE_RULES = (
    Rule("assign", _ASSIGN, 1, 6),
    # for these two, runs of a least length are the same as runs with the short ones dropped
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
MORE_RULES = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abeprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("stripe", r"[sr]k_live_[0-9A-Za-z]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]*"),
    Rule("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("url_login", r"[a-z][a-z0-9+.-]{1,20}://[^\s/:@]{1,64}:[^\s/:@]{1,64}@"),
    Rule("temporary", r"ASIA[A-Z0-9]{16}"),
)
RULES = BASE_RULES + MORE_RULES

# A query is True (no demand), a trigram, or ("and" | "or", frozenset of queries).
Query = bool | str | tuple[str, frozenset]
_MOST_STRINGS = 64


def _join(kind: str, parts: Iterable[Query]) -> Query:
    parts = set(parts)
    if kind == "or":
        if True in parts or not parts:
            return True
    else:
        parts.discard(True)
        if not parts:
            return True
    return next(iter(parts)) if len(parts) == 1 else (kind, frozenset(parts))


def _of_string(s: str) -> Query:
    # postings are of three bytes, so a trigram with a letter beyond ASCII demands nothing
    return _join("and", (t for t in (s[i : i + 3] for i in range(len(s) - 2)) if t.isascii()))


def _of_strings(strings: set[str]) -> Query:
    return _join("or", (_of_string(s) for s in strings))


def _fold(code: int) -> str:
    return chr(code).lower() if code < 128 else chr(code)


def _read(node) -> tuple[set[str] | None, Query]:
    """Strings a parsed expression can match, if few, and what any match demands."""
    runs, demands = {""}, []

    def end_run() -> None:
        nonlocal runs
        demands.append(_of_strings(runs))
        runs = {""}

    whole = True  # whether runs holds all strings of the sequence so far
    for op, arg in node:
        exact, query = None, True
        if op is sre.LITERAL:
            exact = {_fold(arg)}
        elif op is sre.IN and all(o is sre.LITERAL for o, _ in arg):
            exact = {_fold(a) for _, a in arg}
        elif op is sre.SUBPATTERN:
            exact, query = _read(arg[3])
        elif op is sre.BRANCH:
            read = [_read(b) for b in arg[1]]
            if all(e is not None for e, _ in read):
                exact = set().union(*(e for e, _ in read))
            query = _join("or", (_of_strings(e) if e is not None else q for e, q in read))
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT, sre.POSSESSIVE_REPEAT):
            low, high, body = arg
            inner, inner_query = _read(body)
            if inner is not None and (low, high) == (0, 1):
                exact = inner | {""}
            elif inner is not None and low == high and len(inner) ** low <= _MOST_STRINGS:
                exact = {""}
                for _ in range(low):
                    exact = {a + b for a in exact for b in inner}
            elif low > 0:
                query = _of_strings(inner) if inner is not None else inner_query
        elif op is sre.AT:
            exact = {""}
        if exact is not None and len(runs) * len(exact) <= _MOST_STRINGS:
            runs = {a + b for a in runs for b in exact}
            continue
        whole = False
        end_run()
        if exact is not None and len(exact) <= _MOST_STRINGS:
            runs = exact
        else:
            demands.append(query if exact is None else _of_strings(exact))
    if whole:
        return runs, _of_strings(runs)
    end_run()
    return None, _join("and", demands)


def trigram_query(pattern: str) -> Query:
    """Trigrams, lower case, that every match of ``pattern`` holds; True if there are none."""
    return _read(_parser.parse(pattern))[1]


def trigrams(query: Query) -> set[str]:
    if isinstance(query, bool):
        return set()
    if isinstance(query, str):
        return {query}
    return set().union(*map(trigrams, query[1]))


class TrigramIndex:
    """Postings of the wanted trigrams over one block of texts."""

    def __init__(self, block: list[str], wanted: list[str]) -> None:
        self.size = len(block)
        encoded = [t.lower().encode() for t in block]
        data = np.frombuffer(b"\n".join(encoded) + b"\n\n\n", np.uint8)
        begins = np.cumsum([0, *(len(e) + 1 for e in encoded[:-1])]) if encoded else np.zeros(0, int)
        codes = np.array([int.from_bytes(w.encode(), "big") for w in wanted], np.int64)
        order = np.argsort(codes)
        firsts, seconds, thirds = (np.isin(np.arange(256), (codes >> s) & 255) for s in (16, 8, 0))
        at = np.flatnonzero(firsts[data[:-2]] & seconds[data[1:-1]] & thirds[data[2:]])
        found = (data[at].astype(np.int64) << 16) | (data[at + 1].astype(np.int64) << 8) | data[at + 2]
        place = np.minimum(np.searchsorted(codes[order], found), max(len(codes) - 1, 0))
        right = codes[order][place] == found if len(codes) else np.zeros(0, bool)
        at, place = at[right], place[right]
        texts_ = np.searchsorted(begins, at, side="right") - 1
        pairs = np.unique(place * max(self.size, 1) + texts_)
        names = [wanted[i] for i in order]
        cuts = np.searchsorted(pairs, np.arange(len(names) + 1) * max(self.size, 1))
        self.postings = {
            w: pairs[cuts[i] : cuts[i + 1]] - i * self.size for i, w in enumerate(names)
        }

    def candidates(self, query: Query) -> np.ndarray:
        """Sorted places of the texts that satisfy ``query``."""
        if query is True:
            return np.arange(self.size)
        if isinstance(query, str):
            return self.postings[query]
        lists = sorted((self.candidates(q) for q in query[1]), key=len)
        merged = lists[0]
        for other in lists[1:]:
            if query[0] == "and":
                merged = np.intersect1d(merged, other, assume_unique=True)
            else:
                merged = np.union1d(merged, other)
        return merged


def scan_block(block: list[str], rules: tuple[Rule, ...] = RULES) -> list[list[tuple[int, int, int]]]:
    """(start, end, place of the rule) of each secret of each text, by start, then rule."""
    queries = [trigram_query(r.pattern) for r in rules]
    index = TrigramIndex(block, sorted(set().union(*map(trigrams, queries))))
    found: list[list[tuple[int, int, int]]] = [[] for _ in block]
    for place, (rule, query) in enumerate(zip(rules, queries)):
        regex = re.compile(rule.pattern)
        for i in index.candidates(query):
            for m in regex.finditer(block[i]):
                if m.end(rule.group) - m.start(rule.group) >= rule.least:
                    found[i].append((m.start(), place, m.end()))
    return [[(s, e, p) for s, p, e in sorted(f)] for f in found]


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, text_key and the spans (kind, start, stop; code points) of each row's whole text.

    One row per input row, repeated rows and null ids included; null and empty texts have no
    spans. Kinds may overlap each other; matches of one kind do not. Nothing is shuffled.
    """
    kinds = [r.kind for r in rules]

    def scan(_, block: list[str]) -> dict[str, list]:
        return {
            "spans": [
                [{"kind": kinds[p], "start": s, "stop": e} for s, e, p in row]
                for row in scan_block(block, rules)
            ]
        }

    rows = texts(docs).select(F.struct("doc_id", F.xxhash64("text").alias("text_key")).alias("doc"), "text")
    schema = "spans array<struct<kind:string,start:bigint,stop:bigint>>"
    return map_texts(rows, schema, scan).select("doc.doc_id", "doc.text_key", "spans")


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span replaced by ``mark`` and n_chars counted anew.

    Overlapping and touching spans become one mark. Rows without secrets stay exactly as they
    are, null texts and their n_chars included; all columns stay. Repeated rows stay repeated.
    """
    at = docs.columns.index("text")
    size = docs.columns.index("n_chars") if "n_chars" in docs.columns else -1

    def clean(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        for batch in batches:
            block = batch.column(at).to_pylist()
            said = []
            found = scan_block([t or "" for t in block], rules)
            for text, spans in zip(block, found):
                if not spans:
                    said.append(text)
                    continue
                parts, last = [], 0
                for start, stop, _ in spans:
                    if start > last or not parts:
                        parts += [text[last:start], mark]
                    last = max(last, stop)
                said.append("".join([*parts, text[last:]]))
            columns = list(batch.columns)
            columns[at] = pa.array(said, batch.schema.field(at).type)
            if size >= 0:
                counted = pa.array([len(t or "") for t in said], pa.int64()).cast(batch.schema.field(size).type)
                columns[size] = pc.if_else(pa.array(map(bool, found), pa.bool_()), counted, columns[size])
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(clean, docs.schema)


def _joined(spans: str) -> str:
    return f"concat_ws(',', transform({spans}, s -> concat(s.kind, ':', s.start, ':', s.stop)))"


def digest(found: DataFrame) -> DataFrame:
    """The report of a scan: counts of the base kinds, their digest, and all spans as text."""
    kinds = [r.kind for r in BASE_RULES]
    base = "filter(spans, s -> s.kind IN ({}))".format(", ".join(f"'{k}'" for k in kinds))
    counts = [F.expr(f"cast(size(filter(spans, s -> s.kind = '{k}')) AS bigint)").alias(f"n_{k}") for k in kinds]
    return found.select(
        "doc_id",
        *counts,
        F.expr(f"sha2({_joined(base)}, 256)").alias("base_sha256"),
        F.expr(_joined("spans")).alias("spans"),
    )


def sha256_of(spans: list[tuple[str, int, int]]) -> str:
    """The digest of (kind, start, end) spans, as `digest` gives it."""
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in spans).encode()).hexdigest()
