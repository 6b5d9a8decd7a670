"""N-gram Jaccard join: MinHash bands find candidates, full n-gram sets decide.

Documents with equal text form one node. A node's MinHash signature is cut into bands whose number and
width follow from the threshold and the wanted recall; nodes are shuffled on band hashes. Inside a
bucket, signatures tell which nodes may reach the threshold, and only the bucket's local groups leave
it, never its pairs. Connected groups of such nodes are then compared on their full n-gram sets. Large
buckets and groups are cut into blocks that meet each other pair by pair, so no task holds one whole and
no link is lost. The answer is a row for each document: its class, its copy group, its number of links.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from basketry.llm.common import KnownWords, field, keep, with_text_columns
from basketry.llm.components import connected_components

_WORDS = re.compile(r"\w+")
_ODD = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Settings:
    """Shingle width, similarity threshold and wanted recall at the threshold; block sizes bound a task's memory.

    A pair is compared in full if its signatures agree in at least ``likely`` of their places, which a
    pair at the threshold misses with a chance far below that of sharing no band.
    """
    words: int = 5
    threshold: float = 0.8
    recall: float = 0.999
    most_hashes: int = 96
    likely: float = 0.6
    bucket_block: int = 1000
    compare_block: int = 400

    def bands(self) -> tuple[int, int]:
        """(bands, rows): the widest bands that reach the recall with no more hashes than allowed."""
        for rows in range(self.most_hashes, 0, -1):
            chance = self.threshold ** rows
            bands = 1 if chance >= 1 else int(np.ceil(np.log(1 - self.recall) / np.log1p(-chance)))
            if bands * rows <= self.most_hashes:
                return bands, rows
        return self.most_hashes, 1


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Hashes of all shingles of texts: every run of so many words, or all words if there are fewer."""

    def __init__(self, words: int):
        self.words = words
        self.known = KnownWords(lambda ws: [xxhash.xxh64_digest(w.encode()) for w in ws])

    def batch(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(hashes of all texts one after another, number of hashes of each)."""
        words = [_WORDS.findall(t.lower()) for t in texts]
        self.known.learn(set().union(*words))
        out = [self._one(np.frombuffer(b"".join(map(self.known.__getitem__, ws)), dtype=np.uint64)) for ws in words]
        return (np.concatenate(out) if out else np.zeros(0, np.uint64)), np.array([len(x) for x in out], dtype=np.int64)

    def _one(self, hashes: np.ndarray) -> np.ndarray:
        n = len(hashes)
        if not n:
            return hashes
        width = min(n, self.words)
        total = np.zeros(n - width + 1, np.uint64)
        for k in range(width):
            total = total * _ODD + hashes[k:n - width + 1 + k]
        return _mix(total + np.uint64(width))


def signatures(hashes: np.ndarray, sizes: np.ndarray, count: int) -> np.ndarray:
    """MinHash signatures (texts x count) of texts that have shingles."""
    rng = np.random.default_rng(20240229)
    odd = rng.integers(0, 2 ** 63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    plus = rng.integers(0, 2 ** 63, count, dtype=np.uint64)
    starts = np.cumsum(sizes) - sizes
    out = np.empty((len(sizes), count), np.uint32)
    for k in range(count):
        out[:, k] = np.minimum.reduceat((hashes * odd[k] + plus[k]) >> np.uint64(32), starts)
    return out


SIGNED = T.StructType([field("signature", T.BinaryType()), field("bands", T.ArrayType(T.LongType()))])


def node_of(text: Column) -> Column:
    """The node of a text: the same for equal texts. A null text is as an empty one."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def sign(docs: DataFrame, text: str, settings: Settings) -> DataFrame:
    """Add signature and band hashes; both null for texts without words."""
    bands, rows = settings.bands()

    def start():
        shingler = Shingler(settings.words)

        def many(texts: list[str]) -> list:
            hashes, sizes = shingler.batch(texts)
            full = np.flatnonzero(sizes)
            signed, banded = [None] * len(texts), [None] * len(texts)
            if len(full):
                found = signatures(hashes, sizes[full], bands * rows)
                for i, row in zip(full.tolist(), found):
                    signed[i] = row.tobytes()
                    raw = signed[i]
                    banded[i] = [xxhash.xxh64_intdigest(raw[4 * rows * k:4 * rows * (k + 1)], k) - 2 ** 63
                                 for k in range(bands)]
            return [signed, banded]

        return many

    return with_text_columns(docs, text, SIGNED, start)


def local_groups(near: np.ndarray) -> np.ndarray:
    """The least member of each member's group in a symmetric matrix of links."""
    labels = np.arange(len(near))
    while True:
        lowest = np.minimum(labels, np.where(near, labels[None, :], len(near)).min(axis=1))
        lowest = lowest[lowest]
        if (lowest == labels).all():
            return labels
        labels = lowest


def in_blocks(df: DataFrame, key: str, node: str, n: str, block: int) -> DataFrame:
    """Deal the rows of each key to blocks of about ``block`` rows, and each block to all pairs of blocks that it is in."""
    parts = F.ceil(F.col(n) / block).cast("int")
    dealt = df.withColumn("parts", parts).withColumn("part", F.pmod(F.xxhash64(node), F.col("parts")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")
    return dealt.select("*", other).withColumn("low", F.least("part", "other")).withColumn(
        "high", F.greatest("part", "other")).drop("other", n)


def by_group(df: DataFrame, keys: list[str], schema: T.StructType,
             work: Callable[[], Callable[[list[dict]], Iterator[tuple]]]) -> DataFrame:
    """Run ``work`` on the rows of each key, one key after another in partitions sorted by key.

    A group here is a pair of blocks, so it is small; nothing but the current group is held.
    """
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        handle, current, group, out = work(), None, [], []

        def ready(least: int):
            if len(out) >= least and out:
                columns = zip(*out)
                yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, types)], names=names)
                out.clear()

        for batch in batches:
            for row in batch.to_pylist():
                key = tuple(row[k] for k in keys)
                if key != current:
                    if len(group) > 1:
                        out.extend(handle(group))
                        yield from ready(5000)
                    current, group = key, []
                group.append(row)
        if len(group) > 1:
            out.extend(handle(group))
        yield from ready(1)

    types = [to_arrow_type(f.dataType) for f in schema]
    return df.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


def _sides(rows: list[dict]) -> tuple[np.ndarray, bool]:
    """Which rows are in the low block, and whether the group is one block with itself."""
    low = np.array([r["part"] == r["low"] for r in rows])
    return low, rows[0]["low"] == rows[0]["high"]


def _meet(rows: list[dict], near: np.ndarray) -> np.ndarray:
    """Links that this group is in charge of: inside its one block, or across its two."""
    low, single = _sides(rows)
    if not single:
        near = near & (low[:, None] != low[None, :])
    np.fill_diagonal(near, False)
    return near


def likely_edges(signed: DataFrame, settings: Settings) -> DataFrame:
    """Edges (a, b) that join nodes which share a bucket and agree in enough of their signature, without their pairs."""
    spread = signed.select("node", F.explode("bands").alias("bucket"))
    crowded = spread.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    members = spread.join(crowded, "bucket").join(signed.select("node", "signature"), "node")
    schema = T.StructType([field("a", T.BinaryType()), field("b", T.BinaryType())])
    likely = settings.likely

    def work():
        def handle(rows: list[dict]) -> Iterator[tuple]:
            found = np.frombuffer(b"".join(r["signature"] for r in rows), dtype=np.uint32).reshape(len(rows), -1)
            near = np.concatenate([(found[i:i + 64, None] == found[None]).mean(axis=2) >= likely
                                   for i in range(0, len(rows), 64)])
            groups = local_groups(_meet(rows, near))
            for i, root in enumerate(groups.tolist()):
                if i != root:
                    yield rows[i]["node"], rows[root]["node"]
        return handle

    dealt = in_blocks(members, "bucket", "node", "n", settings.bucket_block)
    return by_group(dealt, ["bucket", "low", "high"], schema, work).distinct()


def overlaps(sets: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """Sizes of all pairwise intersections, from slices of the incidence matrix."""
    ids = np.unique(np.concatenate(sets), return_inverse=True)[1]
    counts = np.bincount(ids)
    shared = np.cumsum(counts > 1) - 1  # hashes in one set only meet nothing
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    kept = counts[ids] > 1
    row, column = row[kept], shared[ids[kept]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    total = np.zeros((len(sets), len(sets)), np.float32)
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, [start, start + width])
        matrix = np.zeros((len(sets), min(width, int(column[-1]) + 1 - start)), np.float32)
        matrix[row[a:b], column[a:b] - start] = 1
        total += matrix @ matrix.T
    return total


def verified(texts: DataFrame, settings: Settings) -> DataFrame:
    """(node, root, links, whole) from rows (group, n, node, text): links at the threshold on full sets.

    ``root`` is the least node of the local group. ``whole`` tells that the group was one block, so that
    its roots are final.
    """
    schema = T.StructType([field("node", T.BinaryType()), field("root", T.BinaryType()),
                           field("links", T.LongType()), field("whole", T.BooleanType())])

    def work():
        shingler = Shingler(settings.words)

        def handle(rows: list[dict]) -> Iterator[tuple]:
            rows = sorted({r["node"]: r for r in rows}.values(), key=lambda r: r["node"])
            hashes, sizes = shingler.batch([r["text"] for r in rows])
            sets = [np.unique(x) for x in np.split(hashes, np.cumsum(sizes)[:-1])]
            common = overlaps(sets)
            n = np.array([len(s) for s in sets], dtype=np.float64)
            union = n[:, None] + n[None, :] - common
            near = _meet(rows, common >= settings.threshold * union - 1e-9)
            groups, links = local_groups(near).tolist(), near.sum(axis=1).tolist()
            for r, root, count in zip(rows, groups, links):
                if count:
                    yield r["node"], rows[root]["node"], count, r["parts"] == 1
        return handle

    dealt = in_blocks(texts, "group", "node", "n", settings.compare_block)
    return by_group(dealt, ["group", "low", "high"], schema, work)


def link_classes(docs: DataFrame, key: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """One row per document: key, class_id, copy_id, n_copies, n_links, and the nodes of its text and its class.

    Documents linked by n-gram Jaccard similarity at the threshold, directly or through others, are a class;
    ``class_id`` is the least key in it, ``copy_id`` the least key among documents with the same text,
    ``n_copies`` their number, and ``n_links`` the number of different texts that this text is linked with.
    Texts without words are linked with nothing but their own copies. Repeated rows come out repeated.
    Other columns are left out; an empty table gives an empty result.
    """
    rows = keep(sign(docs.select(F.col(key).alias("key"), text, node_of(F.col(text)).alias("node")), text, settings)
                .drop(text))
    nodes = rows.groupBy("node").agg(F.min("key").alias("copy_id"), F.count("*").alias("n_copies"))
    signed = keep(rows.where("signature is not null").groupBy("node").agg(
        F.any_value("signature").alias("signature"), F.any_value("bands").alias("bands")))
    groups = connected_components(likely_edges(signed, settings))
    sizes = groups.groupBy("root").agg(F.count("*").alias("n"))
    wanted = groups.join(sizes, "root").join(nodes.select("node", F.col("copy_id").alias("__key")), "node") \
        .select("node", F.col("root").alias("group"), "n", "__key")
    own = docs.select(F.col(key).alias("__key"), F.col(text).alias("text"), node_of(F.col(text)).alias("node"))
    texts = own.join(wanted, (own["node"] == wanted["node"]) & own["__key"].eqNullSafe(wanted["__key"])) \
        .select(wanted["group"], wanted["n"], own["node"], own["text"])
    found = keep(verified(texts, settings))
    links = found.groupBy("node").agg(F.sum("links").alias("n_links"))
    across = connected_components(found.where("not whole and node != root"), "node", "root")
    roots = found.where("whole").select("node", "root").union(across.select("node", "root"))
    classed = nodes.join(roots, "node", "left").join(links, "node", "left").select(
        "node", "copy_id", "n_copies", F.coalesce("root", "node").alias("root"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    lowest = classed.groupBy("root").agg(F.min("copy_id").alias("class_id"))
    classed = classed.join(lowest, "root")
    return rows.select("key", "node").join(classed, "node").select(
        F.col("key").alias(key), "class_id", "copy_id", "n_copies", "n_links", "node", F.col("root").alias("class_node"))


def near_duplicate_filter(docs: DataFrame, key: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """One document of each class, with its own columns: that with the least key (a null key comes first)."""
    classes = link_classes(docs, key, text, settings)
    first = classes.groupBy("class_node").agg(
        F.min(F.struct(F.col(key).alias("key"), "node")).alias("first")).select("first.*")
    own = docs.withColumn("__node", node_of(F.col(text)))
    chosen = own.join(first, (own["__node"] == first["node"]) & own[key].eqNullSafe(first["key"]), "left_semi")
    return chosen.dropDuplicates([key, "__node"]).drop("__node")
