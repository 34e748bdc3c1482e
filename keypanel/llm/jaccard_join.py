"""N-gram Jaccard self-join by MinHash banding.

Texts become sets of five-word shingles; equal sets are one node.  A MinHash
signature gives each node one label of ``DEPTH`` values in each of ``TREES`` trees.
Nodes under a common prefix of a label are candidates.  All prefixes have one fixed
depth, computed from threshold and recall (``prefix_depth``): the longest at which a
pair at the threshold meets in some tree with the target probability.  This is banding,
not an LSH forest: no trie is walked and no prefix is fitted to a node.  The threshold
is the same for all nodes, so one depth serves all; values beyond it only serve the
estimate of similarity.

A bucket is the set of nodes under one prefix.  The same set of nodes usually
meets in many trees and is treated once.  In a bucket signatures and sizes tell the
likely pairs; a spanning forest of them is passed on, which is enough to find the
groups of nodes that likely pairs connect.  A bucket too big for a block is cut into
blocks and every two of them are compared, so no pair of a bucket is left out.
Every pair of nodes of a group is then verified on whole shingle sets: a group's sets
meet in tiles of bounded size, each pair in one tile, and a tile gives the number of
links of each node and a spanning forest of the links, never a list of all pairs.
Linked nodes are joined to classes.

Result: one row per document with ``class_id`` (least doc_id of its class) and
``n_links`` (documents it is linked to by verified pairs, copies included).

Defined cases: a text of fewer than five words is one shingle of all its words.
Missing, empty and wordless texts have no shingles, no links and a class of their
own.  Repeated rows are documents and link to each other.  Extra columns stay.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keypanel.llm.words import LOWER, UPPER, arrow_rows, broadcast_if_bounded, digest
from keypanel.session import stored

# Executors get these functions with the job and need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHINGLE = 5
THRESHOLD = 0.8
RECALL = 0.995
TREES, DEPTH = 20, 8       # labels of DEPTH values in TREES trees
BLOCK = 2048               # nodes of a bucket on either side of a comparison
TILE, TILE_BYTES = 1024, 16 << 20  # nodes, and bytes of their sets, on either side of a tile
TEXTS = 1000               # texts, or pairs of sets, that a worker gets at a time
MARGIN = 0.12              # signatures may underrate a similarity by this much

_TABLE = bytes(ord(LOWER[UPPER.index(chr(c))]) if chr(c) in UPPER
               else c if c >= 0x80 or chr(c).isdigit() or chr(c) in LOWER else 0x20 for c in range(256))
_RANDOM = np.random.default_rng(20240229)
_A = _RANDOM.integers(0, 1 << 32, TREES * DEPTH, dtype=np.uint32) | np.uint32(1)
_B = _RANDOM.integers(0, 1 << 32, TREES * DEPTH, dtype=np.uint32)
_STEP = [np.uint64(int(x) | 1) for x in _RANDOM.integers(0, 1 << 63, SHINGLE)]


def prefix_depth(threshold: float = THRESHOLD, recall: float = RECALL) -> int:
    """The longest prefix at which two texts of the threshold's similarity meet often enough."""
    depth = DEPTH
    while depth > 1 and 1 - (1 - threshold ** depth) ** TREES < recall:
        depth -= 1
    return depth


def shingles(text: str) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's five-word shingles."""
    found = text.encode("utf-8", "surrogatepass").translate(_TABLE).split()
    if not found:
        return np.empty(0, np.uint64)
    if len(found) < SHINGLE:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(found))], np.uint64)
    ids = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    n = len(ids) - SHINGLE + 1
    with np.errstate(over="ignore"):
        x = ids[:n] * _STEP[0]
        for i in range(1, SHINGLE):
            x = (x ^ (x >> np.uint64(29))) + ids[i:i + n] * _STEP[i]
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(31)
    return np.unique(x)


def signature(grams: np.ndarray) -> bytes:
    """Sixteen bits of each minimum, tree by tree."""
    low = grams.astype(np.uint32)
    least = np.full(len(_A), 0xFFFFFFFF, np.uint32)
    with np.errstate(over="ignore"):
        for at in range(0, len(low), 1024):
            least = np.minimum(least, (_A[:, None] * low[None, at:at + 1024] + _B[:, None]).min(axis=1))
    return (least ^ (least >> np.uint32(16))).astype("<u2").tobytes()


def signed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(doc_id, text_key, set_key, signature, size) of every document with words; size counts shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                rows = []
                for doc, name, words in zip(*(part.column(i).to_pylist() for i in range(3))):
                    grams = shingles(words)
                    if len(grams):
                        rows.append((doc, name, xxhash.xxh3_128_digest(grams.tobytes()), signature(grams), len(grams)))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                        zip(*rows), (pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.int32()))],
                        names=["doc_id", "text_key", "set_key", "signature", "size"])

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), _text_key(text), F.col(text).alias("text"))
    return rows.where("text is not null").mapInArrow(
        run, "doc_id bigint, text_key binary, set_key binary, signature binary, size int")


def _text_key(text: str):
    return F.substring(digest(F.col(text)), 1, 16).alias("text_key")


def forest_pairs(nodes: DataFrame, depth: int, threshold: float) -> DataFrame:
    """Likely pairs (a, b), a < b, that connect all nodes of the stored table (node, signature, size) that meet and are alike."""
    labels = nodes.select("node", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree"), "signature").select(
        "node", "tree", F.substring(F.col("signature"), F.col("tree") * (2 * DEPTH) + 1, F.lit(2 * depth)).alias("prefix"))
    labels = labels.select("node", F.xxhash64("tree", "prefix").alias("bucket"))
    buckets = stored(labels.groupBy("bucket").agg(
        F.count("*").alias("n"), F.min("node").alias("a"), F.max("node").alias("b"),
        F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y")).where("n > 1"))
    larger = buckets.where("n > 2").groupBy("n", "a", "b", "x", "y").agg(F.min("bucket").alias("bucket"))
    members = labels.join(larger.select("bucket", F.ceil(F.col("n") / BLOCK).alias("parts")), "bucket")
    members = _tiled(members, F.xxhash64("node", "bucket")).join(nodes.select("node", "signature", "size"), "node")
    least = max(0.0, threshold - MARGIN)

    def match(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("second")
        node, size = frame["node"].to_numpy(np.int64), frame["size"].to_numpy(np.int64)
        across = frame["low"].iloc[0] != frame["high"].iloc[0]
        first = len(node) - int(frame["second"].sum())
        values = np.frombuffer(b"".join(frame["signature"]), "<u2").reshape(len(node), -1)
        group, found = np.arange(len(node)), []
        for i, at, end, new in _spans(len(node), first, across):
            near = np.flatnonzero(group[at:end] != group[i]) + at
            near = near[np.minimum(size[near], size[i]) >= threshold * np.maximum(size[near], size[i])]
            share = (values[near] == values[i]).mean(axis=1)
            _joined(group, i, near[share >= least], share[share >= least], found if new else [])
        left, right = _passed_on(len(node), *_columns(found))
        return pd.DataFrame({"a": np.minimum(node[left], node[right]), "b": np.maximum(node[left], node[right])})

    def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two = (np.frombuffer(b"".join(batch.column(i).to_pylist()), "<u2").reshape(batch.num_rows, -1) for i in (2, 3))
            yield batch.select([0, 1]).filter(pa.array((one == two).mean(axis=1) >= least))

    pairs = buckets.where("n = 2").select("a", "b").distinct()
    for end, name in (("a", "one"), ("b", "two")):
        pairs = pairs.join(nodes.select(F.col("node").alias(end), F.col("signature").alias(name), F.col("size").alias(f"n_{name}")), end)
    pairs = pairs.where(F.least("n_one", "n_two") >= threshold * F.greatest("n_one", "n_two")).select("a", "b", "one", "two")
    blocks = members.groupBy("bucket", "low", "high").applyInPandas(match, "a bigint, b bigint")
    return pairs.mapInArrow(alike, "a bigint, b bigint").unionByName(blocks).distinct()


def _tiled(rows: DataFrame, hashed: Column) -> DataFrame:
    """Rows dealt to ``parts`` parts and repeated for every tile (low, high): one part or two, ``second`` the one numbered higher."""
    rows = rows.withColumn("part", F.pmod(hashed, "parts")).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)))
    return rows.withColumns({"low": F.least("part", "other"), "high": F.greatest("part", "other"),
                             "second": F.col("part") > F.col("other")}).drop("parts", "part", "other")


def _joined(group: np.ndarray, i: int, near: np.ndarray, alike: np.ndarray, found: list) -> None:
    """Note one pair of i with every other group among the near nodes and make these groups one."""
    groups, at = np.unique(group[near], return_index=True)
    at, groups = at[groups != group[i]], groups[groups != group[i]]
    if len(at):
        found.append((np.full(len(at), i), near[at], alike[at]))
        group[np.isin(group, groups)] = group[i]


def _spans(n: int, first: int, across: bool) -> Iterator[tuple[int, int, int, bool]]:
    """(i, at, end, new): node i is compared with the nodes at:end of a tile.

    In a tile across two parts the pairs inside a part, which that part's own tile gives,
    come first and are not new: they only tell which nodes are connected already.
    """
    if across:
        for i in range(n):
            yield i, i + 1, first if i < first else n, False
    for i in range(first):
        yield i, first if across else i + 1, n, True


def _columns(found: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    left, right, alike = zip(*found) if found else ([np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0)])
    return np.concatenate(left), np.concatenate(right), np.concatenate(alike)


def _passed_on(n: int, left: np.ndarray, right: np.ndarray, alike: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a maximum spanning forest."""
    order = np.argsort(-alike, kind="stable")
    root = list(range(n))
    keep = []

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for k, i, j in zip(order.tolist(), left[order].tolist(), right[order].tolist()):
        a, b = find(i), find(j)
        if a != b:
            root[a] = b
            keep.append(k)
    return left[keep], right[keep]


def verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """(a, b, jaccard) of the pairs whose whole shingle sets reach the threshold; ``sets`` has (node, grams)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for one, two in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(one.as_buffer(), "<u8"), np.frombuffer(two.as_buffer(), "<u8")
                if min(len(x), len(y)) < threshold * max(len(x), len(y)):
                    out.append(0.0)
                    continue
                both = len(x) + len(y) - len(np.union1d(x, y))
                out.append(both / (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.float64())],
                                             names=["a", "b", "jaccard"])

    joined = pairs.join(sets.select(F.col("node").alias("a"), F.col("grams").alias("one")), "a")
    joined = joined.join(sets.select(F.col("node").alias("b"), F.col("grams").alias("two")), "b")
    return joined.select("a", "b", "one", "two").mapInArrow(run, "a bigint, b bigint, jaccard double").where(
        F.col("jaccard") >= threshold)


def group_links(groups: DataFrame, nodes: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Links inside the groups of the stored table (node, root), every pair of a group verified.

    Rows (a, b, jaccard, others): with a < b a link, as many as connect all linked nodes;
    with a = b a node and the number of documents that some of its links lead to.
    """
    sizes = groups.join(nodes.select("node", "size"), "node").groupBy("root").agg(
        F.count("*").alias("n"), F.min("node").alias("a"), F.max("node").alias("b"), F.sum("size").alias("grams"))
    sizes = stored(sizes.withColumn("parts", F.greatest(
        F.ceil(F.col("n") / TILE), F.ceil(F.col("grams") * 8 / TILE_BYTES))))

    tiles = groups.join(sizes.where("n > 2").select("root", "parts"), "root").join(nodes.select("node", "documents"), "node")
    tiles = _tiled(tiles, F.xxhash64("node")).join(sets, "node")

    def match(frame: pd.DataFrame) -> pd.DataFrame:
        size = frame["grams"].map(len).to_numpy(np.int64) // 8
        order = np.lexsort((size, frame["second"]))
        frame, size = frame.iloc[order], size[order]
        node, documents = frame["node"].to_numpy(np.int64), frame["documents"].to_numpy(np.int64)
        start = np.concatenate([[0], np.cumsum(size)])
        values, grams = np.unique(np.frombuffer(b"".join(frame["grams"]), "<u8"), return_inverse=True)
        mark, others = np.zeros(len(values), np.int32), np.zeros(len(node), np.int64)
        across = frame["low"].iloc[0] != frame["high"].iloc[0]
        first = len(node) - int(frame["second"].sum())
        group, found = np.arange(len(node)), []
        for i, at, end, new in _spans(len(node), first, across):
            low = at + np.searchsorted(size[at:end], threshold * size[i] - 0.001)
            high = at + np.searchsorted(size[at:end], size[i] / threshold + 0.001, "right")
            if low >= high or not new and (group[low:high] == group[i]).all():
                continue
            own = grams[start[i]:start[i + 1]]
            mark[own] = 1
            both = np.add.reduceat(mark[grams[start[low]:start[high]]], start[low:high] - start[low])
            mark[own] = 0
            share = both / (size[i] + size[low:high] - both)
            near = np.flatnonzero(share >= threshold)
            if new:
                others[i] += documents[low + near].sum()
                others[low + near] += documents[i]
            _joined(group, i, low + near, share[near], found if new else [])
        left, right, alike = _columns(found)
        kept = pd.DataFrame({"a": node[left], "b": node[right], "jaccard": alike, "others": 0})
        kept["a"], kept["b"] = kept[["a", "b"]].min(axis=1), kept[["a", "b"]].max(axis=1)
        counts = pd.DataFrame({"a": node, "b": node, "jaccard": 1.0, "others": others})
        return pd.concat([kept, counts[others > 0]])

    schema = "a bigint, b bigint, jaccard double, others bigint"
    many = tiles.groupBy("root", "low", "high").applyInPandas(match, schema)
    pairs = verified(sizes.where("n = 2").select("a", "b"), sets, threshold)
    for end in ("a", "b"):
        pairs = pairs.join(nodes.select(F.col("node").alias(end), F.col("documents").alias(f"n_{end}")), end)
    none = F.lit(0).cast("bigint")
    rows = F.array(F.struct("a", "b", "jaccard", none.alias("others")),
                   F.struct("a", F.col("a").alias("b"), F.lit(1.0).alias("jaccard"), F.col("n_b").alias("others")),
                   F.struct(F.col("b").alias("a"), "b", F.lit(1.0).alias("jaccard"), F.col("n_a").alias("others")))
    return many.unionByName(pairs.select(F.inline(rows)))


def shingle_sets(docs: DataFrame, wanted: DataFrame, text: str) -> DataFrame:
    """(node, grams) of the wanted nodes; ``wanted`` has (node, text_key)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                grams = [shingles(t).tobytes() for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(grams, pa.binary())], names=["node", "grams"])

    texts = docs.select(_text_key(text), F.col(text).alias("text")).where("text is not null")
    texts = texts.join(broadcast_if_bounded(wanted, 128), "text_key").dropDuplicates(["node"])
    return texts.select("node", "text").mapInArrow(run, "node bigint, grams binary")


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the least node of each connected component; ``edges`` is a stored table (a, b)."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    roots = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root")).select(
        "node", F.least("node", "root").alias("root")))
    while True:
        near = both.join(roots, both["b"] == roots["node"]).groupBy("a").agg(F.min("root").alias("near"))
        lower = roots.join(near, roots["node"] == near["a"]).select(
            "node", F.col("root").alias("old"), F.least("root", "near").alias("root"))
        above = roots.select(F.col("node").alias("root"), F.col("root").alias("above"))
        moved = stored(lower.join(above, "root").select("node", "old", F.least("root", "above").alias("root")))
        if moved.where("root <> old").isEmpty():
            return moved.select("node", "root")
        roots = moved.select("node", "root")


def linked(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD,
           recall: float = RECALL) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(signed documents, nodes, links): stored tables of the join.

    Nodes are (node, set_key, text_key, documents, least, signature, size, others), others being the
    documents of other nodes that a node is linked to; links (a, b, jaccard) connect all linked nodes.
    """
    with arrow_rows(docs.sparkSession, TEXTS):
        return _linked(docs, key, text, threshold, recall)


def _linked(docs: DataFrame, key: str, text: str, threshold: float,
            recall: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    rows = stored(signed(docs, key, text))
    nodes = stored(rows.groupBy("set_key").agg(
        F.min("text_key").alias("text_key"), F.count("*").alias("documents"), F.min("doc_id").alias("least"),
        F.first("signature").alias("signature"), F.first("size").alias("size")).withColumn("node", F.monotonically_increasing_id()))
    pairs = stored(forest_pairs(nodes, prefix_depth(threshold, recall), threshold))
    groups = components(pairs)
    sets = stored(shingle_sets(docs, groups.join(nodes.select("node", "text_key"), "node").select("node", "text_key"), text))
    found = stored(group_links(groups, nodes, sets, threshold))
    degrees = found.where("a = b").groupBy(F.col("a").alias("node")).agg(F.sum("others").alias("others"))
    nodes = nodes.join(degrees, "node", "left").fillna(0, ["others"])
    return rows, nodes, found.where("a < b").select("a", "b", "jaccard")


def jaccard_join(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD,
                 recall: float = RECALL) -> DataFrame:
    """All documents with ``class_id`` and ``n_links``."""
    return _classed(docs, key, text, threshold, recall).drop("_llm_root")


def _classed(docs: DataFrame, key: str, text: str, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """``jaccard_join`` with ``_llm_root``, the class's own identity; documents without words have none."""
    rows, nodes, links = linked(docs, key, text, threshold, recall)
    known = nodes.join(components(links), "node", "left").select(
        "set_key", "least", F.coalesce("root", "node").alias("root"), (F.col("documents") - 1 + F.col("others")).alias("n_links"))
    known = stored(known)
    classes = known.groupBy("root").agg(F.min("least").alias("class_id"))
    results = rows.select("text_key", "set_key").distinct().join(known, "set_key").join(classes, "root").select(
        F.col("text_key").alias("_llm_key"), F.col("root").alias("_llm_root"), "class_id", "n_links")
    out = docs.drop("class_id", "n_links").withColumn("_llm_text", _text_key(text))
    return out.join(broadcast_if_bounded(results, 128), F.col("_llm_text") == F.col("_llm_key"), "left").drop("_llm_text", "_llm_key").withColumns({
        "class_id": F.coalesce("class_id", F.col(key).cast("long")), "n_links": F.coalesce("n_links", F.lit(0)).cast("long")})


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with one of each class: the one with the least id, of several the one whose text has the least digest."""
    joined = _classed(docs, key, text)
    kept = joined.where(F.col(key).cast("long").eqNullSafe(F.col("class_id")))
    lone, shared = kept.where("n_links = 0"), kept.where("n_links > 0")
    if not shared.groupBy("_llm_root").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
        # Ids that repeat or are missing inside a class.
        order = Window.partitionBy("_llm_root").orderBy(F.sha2(F.col(text), 256))
        shared = shared.withColumn("_llm_rank", F.row_number().over(order)).where("_llm_rank = 1").drop("_llm_rank")
    return lone.unionByName(shared).drop("class_id", "n_links", "_llm_root")
