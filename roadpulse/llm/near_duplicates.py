"""N-gram Jaccard join by a MinHash LSH forest.

Texts are sets of word shingles. Every tree of the forest holds the MinHash signatures of all
texts in the order of a prefix trie, so texts that share a prefix of a tree are a run of it. The
matched prefix starts at full depth and is shortened until pairs at the threshold meet in some
tree with the target recall. Pairs that meet are verified exactly on their shingle sets.

Equal texts are one text with copies throughout. Large runs are split into chunks and every pair
of chunks is a task of its own; what leaves a task is one row per text (its links, and the text
it is grouped with), never the pairs. A pair that meets in several trees belongs to the first.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.common import fresh, stored, text_key, texts
from roadpulse.llm.words import SHINGLE, mix, shingle_sets

TREES = 14
DEPTH = 8
# Members of a run that are compared with one another in one task.
CHUNK = 256
# Shingles that are compared at a time.
_COLUMNS = 4096


def prefix_depth(threshold: float, recall: float, trees: int = TREES, depth: int = DEPTH) -> int:
    """The longest prefix, at least one, at which pairs at the threshold reach the recall."""
    for d in range(depth, 1, -1):
        if 1 - (1 - threshold**d) ** trees >= recall:
            return d
    return 1


def _factors(count: int) -> np.ndarray:
    return mix(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def prefixes(sets: list[np.ndarray], depth: int, trees: int = TREES) -> np.ndarray:
    """Name of the node each (non-empty) set reaches at ``depth`` in every tree."""
    cuts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]]).astype(np.int64)
    flat = np.concatenate(sets)
    nodes = np.empty((len(sets), trees), np.uint64)
    factors = _factors(trees * depth)
    for tree in range(trees):
        node = np.full(len(sets), np.uint64(tree + 1))
        for level in range(depth):
            low = np.minimum.reduceat(mix(flat * factors[tree * depth + level]), cuts)
            node = mix(node * np.uint64(0xD6E8FEB86659FD93) + low)
        nodes[:, tree] = node
    return nodes.view(np.int64)


def _signatures(depth: int):
    names = ["doc_id", "text_key", "key_high", "key_low", "n_shingles", "nodes"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block = batch.column(2).to_pylist()
            for begin in range(0, len(block), 256):
                part = block[begin : begin + 256]
                digests = [hashlib.sha256(t.encode()).digest() for t in part]
                keys = np.frombuffer(b"".join(digests), ">i8").reshape(-1, 4).astype(np.int64)
                sets = shingle_sets(part)
                full = [i for i, s in enumerate(sets) if len(s)]
                nodes: list = [None] * len(part)
                if full:
                    for i, row in zip(full, prefixes([sets[i] for i in full], depth)):
                        nodes[i] = row
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(begin, len(part)),
                        batch.column(1).slice(begin, len(part)),
                        pa.array(keys[:, 0]),
                        pa.array(keys[:, 1]),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(nodes, pa.list_(pa.int64())),
                    ],
                    names,
                )

    return run


# One comparison of two chunks (or of a chunk with itself) of one run.
_TASK = ["run", "tree", "chunk", "other"]


def _whole_tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Sorted batches as tables that end where a task ends; a task has at most two chunks of about CHUNK rows."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([*held, batch]).combine_chunks()
        begin = int(_starts(table)[-1])
        if begin:
            yield table.slice(0, begin)
        held = table.slice(begin).to_batches()
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _starts(table: pa.Table) -> np.ndarray:
    """First row of each task of a sorted table."""
    new = np.zeros(table.num_rows, bool)
    new[0] = True
    for name in ("run", "chunk", "other"):
        column = table.column(name).to_numpy()
        new[1:] |= column[1:] != column[:-1]
    return np.flatnonzero(new)


def _nodes(table: pa.Table) -> np.ndarray:
    flat = table.column("nodes").combine_chunks().flatten().to_numpy()
    return flat.reshape(table.num_rows, -1)


def _may_link(a: np.ndarray, b: np.ndarray, tree, n_a, n_b, threshold: float) -> np.ndarray:
    """Whether rows of nodes meet first in ``tree`` and their sizes fit the threshold."""
    before = np.arange(a.shape[-1]) < np.asarray(tree)[..., None]
    met = ((a == b) & before).any(axis=-1)
    return ~met & (np.minimum(n_a, n_b) >= threshold * np.maximum(n_a, n_b))


def _needed(threshold: float):
    """The members of each task that have a pair to verify in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_tasks(batches):
            starts = _starts(table)
            task = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, table.num_rows)))
            nodes, n = _nodes(table), table.column("n_shingles").to_numpy()
            own, tree = table.column("own").to_numpy(), table.column("tree").to_numpy()
            alone = table.column("chunk").to_numpy() == table.column("other").to_numpy()
            keep = np.zeros(table.num_rows, bool)
            for step in range(1, table.num_rows):
                i = np.flatnonzero(task[:-step] == task[step:])
                if not len(i):
                    break
                j = i + step
                i, j = (x[alone[i] | (own[i] != own[j])] for x in (i, j))
                ok = _may_link(nodes[i], nodes[j], tree[i], n[i], n[j], threshold)
                keep[i[ok]] = keep[j[ok]] = True
            yield from table.filter(pa.array(keep)).select([*_TASK, "node", "own"]).to_batches()

    return run


def common_shingles(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Size of the intersection of every set on the left with every set on the right."""
    flat_left, flat_right = np.concatenate(left), np.concatenate(right)
    shared = np.intersect1d(flat_left, flat_right)
    total = np.zeros((len(left), len(right)), np.float32)
    for begin in range(0, len(shared), _COLUMNS):
        part = shared[begin : begin + _COLUMNS]

        def grid(sets: list[np.ndarray], part: np.ndarray = part) -> np.ndarray:
            made = np.zeros((len(sets), len(part)), np.float32)
            for row, s in enumerate(sets):
                at = np.minimum(np.searchsorted(part, s), len(part) - 1)
                made[row, at[part[at] == s]] = 1
            return made

        total += grid(left) @ grid(right).T
    return total


def _verify(threshold: float):
    """Links of each member of each task, and the smallest text it is joined with there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_tasks(batches):
            sets = shingle_sets(table.column("text").to_pylist())
            ids, n = table.column("node").to_numpy(), table.column("n_shingles").to_numpy()
            nodes, own = _nodes(table), table.column("own").to_numpy()
            tree, chunk, other = (table.column(c).to_numpy() for c in ("tree", "chunk", "other"))
            links, root = np.zeros(len(ids), np.int64), ids.copy()
            starts = _starts(table)
            for begin, end in zip(starts.tolist(), [*starts[1:].tolist(), len(ids)]):
                rows = np.arange(begin, end)
                left = rows[own[rows] == chunk[begin]]
                right = left if chunk[begin] == other[begin] else rows[own[rows] == other[begin]]
                if not len(left) or not len(right):
                    continue
                pairs = _may_link(nodes[left][:, None], nodes[right][None], tree[begin], n[left][:, None], n[right][None], threshold)
                pairs &= ids[left][:, None] != ids[right][None]
                same = common_shingles([sets[i] for i in left], [sets[i] for i in right])
                # both sides are whole numbers but for the threshold, so the slack decides no other case
                pairs &= same >= threshold * (n[left][:, None] + n[right][None] - same) - 1e-6
                links[left] += pairs.sum(axis=1)
                if right is not left:
                    links[right] += pairs.sum(axis=0)
                _spread(root, left, right, pairs)
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(links), pa.array(root)], ["node", "links", "root"])

    return run


def _spread(root: np.ndarray, left: np.ndarray, right: np.ndarray, pairs: np.ndarray) -> None:
    """The smallest root spreads along the pairs until nothing changes."""
    none = np.iinfo(np.int64).max
    while pairs.any():
        before = root[left].copy(), root[right].copy()
        root[left] = np.minimum(root[left], np.where(pairs, root[right][None], none).min(axis=1))
        root[right] = np.minimum(root[right], np.where(pairs, root[left][:, None], none).min(axis=0))
        if np.array_equal(before[0], root[left]) and np.array_equal(before[1], root[right]):
            return


def components(edges: DataFrame) -> DataFrame:
    """Edges (u, v) to (u, v): every vertex with the smallest one of its component.

    Larger and smaller neighbours are joined to the smallest neighbour in turn until nothing
    changes; every step is written to the shared folder. The smallest vertex of a component has
    no row.
    """

    def step(name: str, df: DataFrame) -> DataFrame:
        return stored(df.filter("u <> v").distinct(), name)

    def check(df: DataFrame):
        return df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()

    now = step("edges", edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")))
    seen = check(now)
    while seen[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        met = both.join(stored(low, "low"), "u").filter("v > u")
        large = step("large", met.select(F.col("v").alias("u"), F.col("m").alias("v")))
        low = stored(large.groupBy("u").agg(F.min("v").alias("m")), "low")
        met = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = step("small", met.unionByName(low.select("u", F.col("m").alias("v"))))
        if (made := check(now)) == seen:
            break
        seen = made
    return now


def _sorted_tasks(df: DataFrame) -> DataFrame:
    return df.repartition(*_TASK).sortWithinPartitions(*_TASK)


def near_duplicates(docs: DataFrame, threshold: float = 0.8, recall: float = 0.9999) -> DataFrame:
    """doc_id, text_key, class_key, class_id, text_id and n_links of every row.

    text_id is the smallest doc_id among the rows with the same text, class_id the smallest
    among all rows joined by links. n_links counts the other texts whose shingle sets have a
    Jaccard similarity of at least ``threshold``; copies of a text count once and are no links.
    A pair at the threshold is found with probability ``recall``, more similar ones more
    surely; every link is verified exactly. class_key is a name of the class of its own, for
    classes that share an id or have none.

    Null texts are empty. Texts without words are linked with nothing; texts of fewer than five
    words only with texts of the same words. Repeated rows are copies. Null ids belong to
    classes like others but name none; a class of null ids alone has a null name.
    """
    depth = prefix_depth(threshold, recall)
    signed = texts(docs).select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    schema = "doc_id bigint, text_key bigint, key_high bigint, key_low bigint, n_shingles bigint, nodes array<bigint>"
    rows = signed.mapInArrow(_signatures(depth), schema).withColumn("row", F.monotonically_increasing_id())
    rows = stored(rows, "signatures")
    # tables that hot keys are joined with are written first: a join of two plain tables can be
    # split by the adaptive planner wherever one key has many rows
    key = ["key_high", "key_low"]
    classes = stored(rows.groupBy(*key).agg(F.min("row").alias("node"), F.min("doc_id").alias("text_id")), "classes")
    members = stored(rows.join(classes, key).select("row", "doc_id", "text_key", "node", "text_id", "n_shingles", F.when(F.col("row") == F.col("node"), F.col("nodes")).alias("nodes")), "members")
    heads = members.filter("row = node")
    facts = heads.select("node", "n_shingles", "nodes")

    at = heads.select("node", F.posexplode("nodes").alias("tree", "run"))
    runs = stored(at.groupBy("run").agg(F.count("*").alias("size")).filter("size > 1"), "runs")
    live = at.join(runs, "run").withColumn("chunks", F.expr(f"cast(ceil(size / {CHUNK}) AS int)"))
    dealt = (
        live.withColumn("own", F.expr("cast(pmod(xxhash64(node, run), chunks) AS int)"))
        .withColumn("against", F.explode(F.expr("sequence(0, chunks - 1)")))
        .withColumn("chunk", F.least("own", "against"))
        .withColumn("other", F.greatest("own", "against"))
        .select(*_TASK, "node", "own")
    )
    task = "run bigint, tree int, chunk int, other int, node bigint, own int"
    asked = stored(_sorted_tasks(dealt.join(facts, "node")).mapInArrow(_needed(threshold), task), "tasks")

    # texts travel only where they have a pair to verify, one copy of each
    wanted = stored(
        asked.select("node").distinct().join(heads.select("node", F.col("doc_id").alias("d"), F.col("text_key").alias("k")), "node"),
        "wanted",
    )
    # always by a shuffle: the wanted texts are a share of all, however few the rows are
    loaded = signed.join(wanted.hint("merge"), signed["doc_id"].eqNullSafe(wanted["d"]) & (signed["text_key"] == wanted["k"]))
    loaded = loaded.groupBy("node").agg(F.first("text").alias("text"))
    full = asked.join(loaded, "node").join(facts, "node")
    verified = _sorted_tasks(full.select(*_TASK, "node", "own", "n_shingles", "nodes", "text"))
    verified = stored(verified.mapInArrow(_verify(threshold), "node bigint, links bigint, root bigint"), "links")

    links = verified.groupBy("node").agg(F.sum("links").alias("n_links"))
    joined = components(verified.select(F.col("node").alias("u"), F.col("root").alias("v")))
    of_text = (
        heads.select("node", "text_id")
        .join(links, "node", "left")
        .join(joined.select(F.col("u").alias("node"), F.col("v").alias("top")), "node", "left")
        .select("node", "text_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), F.coalesce("top", "node").alias("top"))
    )
    of_text = stored(of_text, "texts")
    names = stored(of_text.groupBy("top").agg(F.min("text_id").alias("class_id")), "names")
    of_text = of_text.join(names, "top").select("node", F.col("top").alias("class_key"), "class_id", "n_links")
    of_text = stored(of_text, "named")
    return members.drop("nodes").join(of_text, "node").select(
        "doc_id", "text_key", "class_key", "class_id", "text_id", "n_links"
    )


def keep_one(docs: DataFrame, threshold: float = 0.8, recall: float = 0.9999) -> DataFrame:
    """One row of each class, all columns: the one with the smallest doc_id, then text_key.

    A null id stays only where all ids of the class are null.
    """
    found = near_duplicates(docs, threshold, recall)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    kept = found.groupBy("class_key").agg(F.min(order).alias("first"))
    key, none, ident = (fresh(docs, n) for n in ("_key", "_none", "_ident"))
    marked = (
        docs.withColumn(key, text_key(docs["text"]))
        .withColumn(none, docs["doc_id"].isNull())
        .withColumn(ident, F.coalesce(docs["doc_id"].cast("long"), F.lit(0)))
    )
    kept = kept.select(
        F.col("first.text_key").alias(key),
        F.col("first.none").alias(none),
        F.coalesce("first.doc_id", F.lit(0)).alias(ident),
    )
    same = [key, none, ident]
    return marked.dropDuplicates(same).join(kept, same, "left_semi").drop(*same)
