"""Exact duplicates through a minimal perfect hash over the digests already seen.

A history holds every distinct digest seen so far. Its digests are dealt to buckets by their own first
bytes; each bucket has a function that sends its n digests to the slots 0 to n-1, one each, and the slots
themselves: full digest, locator of the row that stays, number of rows. The function is a list of bit
levels: a digest belongs to the first level in which it has a place to itself, and its slot is the number
of set bits before. It answers something for any digest, so a lookup compares all 32 bytes with the slot.
Equal bytes make a repeat of a known text; everything else groups among itself.

Digests are SHA-256, so buckets are even whatever the texts are, and a text that a third of all rows hold
is one digest with a count before anything is dealt to a bucket.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.llm.common import keep, prepare, release_memory

SLOTS_PER_BUCKET = 5_000
# Digests of a batch in one lookup group. Beyond it a bucket is looked up in parts.
LOOKUPS_PER_GROUP = 20_000
# Places of a level for each digest that is left.
ROOM = 1.5
RESULTS = ("keep_id", "group_size", "kept", "text_sha256")

_LEVEL_SEED, _MIX_1, _MIX_2 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def words_of(digests: Sequence[bytes]) -> np.ndarray:
    """Digests of 32 bytes as rows of four unsigned numbers."""
    return np.frombuffer(b"".join(digests), dtype=">u8").reshape(-1, 4).astype(np.uint64)


def _places(words: np.ndarray, level: int, size: int) -> np.ndarray:
    x = np.full(len(words), level + 1, dtype=np.uint64) * _LEVEL_SEED
    for k in range(4):
        x = (x ^ words[:, k]) * _MIX_1
        x = (x ^ (x >> np.uint64(29))) * _MIX_2
        x ^= x >> np.uint64(32)
    return (x % np.uint64(size)).astype(np.int64)


class PerfectHash:
    """Slots 0 to n-1 for n distinct digests; for other digests any slot, or -1."""

    def __init__(self, levels: Sequence[np.ndarray]):
        self.levels = list(levels)
        self.ranks, before = [], 0
        for bits in self.levels:
            self.ranks.append(before + np.cumsum(bits) - 1)
            before += int(bits.sum())

    @classmethod
    def build(cls, words: np.ndarray) -> PerfectHash:
        if len(np.unique(words, axis=0)) != len(words):
            raise ValueError("the digests must be distinct")
        levels, left = [], words
        while len(left):
            size = max(8, int(ROOM * len(left)))
            at = _places(left, len(levels), size)
            alone = np.bincount(at, minlength=size)[at] == 1
            bits = np.zeros(size, dtype=bool)
            bits[at[alone]] = True
            levels.append(bits)
            left = left[~alone]
        return cls(levels)

    def slots(self, words: np.ndarray) -> np.ndarray:
        found, left = np.full(len(words), -1, dtype=np.int64), np.arange(len(words))
        for level, (bits, rank) in enumerate(zip(self.levels, self.ranks)):
            at = _places(words[left], level, len(bits))
            hit = bits[at]
            found[left[hit]] = rank[at[hit]]
            left = left[~hit]
        return found

    def packed(self) -> tuple[list[bytes], list[int]]:
        return [np.packbits(bits).tobytes() for bits in self.levels], [len(bits) for bits in self.levels]

    @classmethod
    def unpacked(cls, levels: Sequence[bytes], sizes: Sequence[int]) -> PerfectHash:
        return cls([np.unpackbits(np.frombuffer(b, dtype=np.uint8), count=n).astype(bool)
                    for b, n in zip(levels, sizes)])


@dataclass(frozen=True)
class History:
    """One row for each bucket: its function (levels, sizes) and its slots (digests, winners, rows) in slot order."""
    blocks: DataFrame
    buckets: int


def _with_digests(docs: DataFrame, text: str) -> DataFrame:
    """The documents with ``__row``, a number without order, and ``__digest``, the SHA-256 of the normalised text."""
    prepare(docs.sparkSession)
    rows = docs.select("*", F.monotonically_increasing_id().alias("__row"), F.col(text).cast("binary").alias("__digest"))
    at = len(rows.columns) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:  # bytes.lower changes A to Z only
            digests = [hashlib.sha256((t or b"").lower()).digest() for t in batch.column(at).to_pylist()]
            yield batch.set_column(at, "__digest", pa.array(digests, pa.binary()))
        release_memory()

    return rows.mapInArrow(run, rows.schema)


def _rows(digested: DataFrame, key: str, source: str) -> DataFrame:
    return digested.select(F.col(key).alias("id"), F.lit(source).alias("source"), F.col("__row").alias("row"),
                           F.col("__digest").alias("digest"))


def digest_rows(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "documents") -> DataFrame:
    """(id, source, row, digest): a stored row for each document. Runs a Spark job, the only one that reads texts.

    The digest is the SHA-256 of the UTF-8 text with A to Z made small; a null text counts as empty.
    ``row`` numbers the rows of this table without order; with ``source`` it tells equal rows apart.
    """
    return keep(_rows(_with_digests(docs.select(key, F.col(text).alias("__text")), "__text").drop("__text"), key, source))


def _bytes_number(digest: Column, first: int) -> Column:
    """Seven bytes of a digest as a number."""
    return F.conv(F.hex(F.substring(digest, first, 7)), 16, 10).cast("long")


def _groups(rows: DataFrame) -> DataFrame:
    """(digest, best, rows): one row for each digest; best is the row with the greatest id, then source and row."""
    return rows.groupBy("digest").agg(F.max(F.struct("id", "source", "row")).alias("best"),
                                      F.count("*").alias("rows"))


def build_history(rows: DataFrame) -> History:
    """The index over the distinct digests of ``digest_rows``. Runs Spark jobs. No rows make an empty history."""
    groups = keep(_groups(rows))
    buckets = max(1, -(-groups.count() // SLOTS_PER_BUCKET))
    best = groups.schema["best"].dataType
    schema = T.StructType([
        T.StructField("bucket", T.LongType()), T.StructField("levels", T.ArrayType(T.BinaryType())),
        T.StructField("sizes", T.ArrayType(T.IntegerType())), T.StructField("digests", T.ArrayType(T.BinaryType())),
        T.StructField("winners", T.ArrayType(best)), T.StructField("rows", T.ArrayType(T.LongType()))])

    def block(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        digests = group.column("digest").to_pylist()
        words = words_of(digests)
        hashed = PerfectHash.build(words)
        order = pa.array(np.argsort(hashed.slots(words)))
        levels, sizes = hashed.packed()
        taken = group.take(order)
        one = pa.array([0, len(order)], pa.int32())

        def listed(name: str) -> pa.Array:
            column = taken.column(name).combine_chunks()
            return pa.ListArray.from_arrays(one, column.chunk(0) if isinstance(column, pa.ChunkedArray) else column)

        return pa.Table.from_arrays(
            [pa.array([group.column("bucket")[0].as_py()], pa.int64()), pa.array([levels], pa.list_(pa.binary())),
             pa.array([sizes], pa.list_(pa.int32())), listed("digest"), listed("best"), listed("rows")],
            names=["bucket", "levels", "sizes", "digests", "winners", "rows"])

    dealt = groups.withColumn("bucket", _bytes_number(F.col("digest"), 1) % buckets)
    return History(keep(dealt.groupBy("bucket").applyInArrow(block, schema)), buckets)


def write_history(history: History, path: str) -> None:
    """A Parquet table of the blocks, a folder for each number of buckets."""
    history.blocks.withColumn("buckets", F.lit(history.buckets)).write.parquet(path)


def read_history(spark: SparkSession, path: str) -> History:
    blocks = prepare(spark).read.parquet(path)
    first = blocks.select("buckets").first()
    return History(blocks.drop("buckets"), first["buckets"] if first else 1)


def look_up(rows: DataFrame, history: History) -> DataFrame:
    """(digest, slot, past, past_rows, now, now_rows): every digest of the rows and of the history. Runs Spark jobs.

    ``slot`` and ``past`` are null for digests that the history lacks, ``now`` for those that the rows lack.
    A bucket's rows are compared with its slots in one task, in parts if there are many more than slots.
    """
    groups = keep(_groups(rows))
    parts = max(1, -(-groups.count() // (history.buckets * LOOKUPS_PER_GROUP)))
    best = groups.schema["best"].dataType
    schema = T.StructType([
        T.StructField("digest", T.BinaryType()), T.StructField("slot", T.LongType()),
        T.StructField("past", best), T.StructField("past_rows", T.LongType()),
        T.StructField("now", best), T.StructField("now_rows", T.LongType())])

    def compare(batch: pa.Table, blocks: pa.Table) -> pa.Table:
        batch = batch.select(["digest", "best", "rows"])
        digests = batch.column("digest").to_pylist()
        known, winners, counts, slots = [], None, None, np.full(len(digests), -1)
        if blocks.num_rows:
            block = {name: blocks.column(name)[0] for name in blocks.column_names}
            known, winners, counts = block["digests"].as_py(), block["winners"].values, block["rows"].values
            hashed = PerfectHash.unpacked(block["levels"].as_py(), block["sizes"].as_py())
            slots = hashed.slots(words_of(digests))
        same = np.array([s >= 0 and known[s] == d for s, d in zip(slots.tolist(), digests)], dtype=bool)  # all bytes
        strangers = np.flatnonzero(~same)
        # The slots of this part, each with the batch's row for it, if there is one.
        mine = np.flatnonzero((words_of(known)[:, 1] >> np.uint64(8)) % np.uint64(parts) == blocks.column("part")[0].as_py()) \
            if known else np.zeros(0, dtype=np.int64)
        partner = np.full(len(known), -1, dtype=np.int64)
        partner[slots[same]] = np.flatnonzero(same)
        partner = partner[mine]
        here = pa.array(np.concatenate([partner, strangers]), mask=np.concatenate([partner < 0, np.zeros(len(strangers), bool)]))
        there = pa.array(np.concatenate([mine, np.zeros(len(strangers), np.int64)]),
                         mask=np.concatenate([np.zeros(len(mine), bool), np.ones(len(strangers), bool)]))
        now = batch.take(here)
        past_type = batch.schema.field("best").type
        past = winners.take(there) if known else pa.nulls(len(there), past_type)
        past_rows = counts.take(there) if known else pa.nulls(len(there), pa.int64())
        names = [known[i] for i in mine.tolist()] + [digests[i] for i in strangers.tolist()]
        return pa.table([pa.array(names, pa.binary()), there.cast(pa.int64()), past, past_rows,
                         now.column("best"), now.column("rows")],
                        names=["digest", "slot", "past", "past_rows", "now", "now_rows"])

    dealt = groups.select("digest", "best", "rows",
                          (_bytes_number(F.col("digest"), 1) % history.buckets).alias("bucket"),
                          (_bytes_number(F.col("digest"), 9) % parts).alias("part"))
    blocks = history.blocks.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))
    return dealt.groupBy("bucket", "part").cogroup(blocks.groupBy("bucket", "part")).applyInArrow(compare, schema)


def verdicts(found: DataFrame) -> DataFrame:
    """(digest, winner, group_size) of ``look_up``: the greatest id stays, wherever it is; rows of both sides count."""
    return found.select("digest", F.greatest("past", "now").alias("winner"),
                        (F.coalesce("past_rows", F.lit(0)) + F.coalesce("now_rows", F.lit(0))).alias("group_size"))


def mark(rows: DataFrame, decided: DataFrame) -> DataFrame:
    """(id, source, row, keep_id, group_size, kept, text_sha256) for rows of ``digest_rows``.

    The side of verdicts has one row for each digest; Spark splits the partition of a digest that many rows share.
    """
    return rows.join(decided, "digest").select(
        "id", "source", "row", F.col("winner.id").alias("keep_id"), "group_size",
        ((F.col("winner.source") == F.col("source")) & (F.col("winner.row") == F.col("row"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", history: History | None = None,
                    source: str = "documents") -> DataFrame:
    """The documents that stay, with keep_id, group_size, kept and text_sha256. Runs Spark jobs.

    Texts equal but for the case of A to Z are one group; a null text counts as empty. The greatest key of
    the group stays, and of rows with that key exactly one; a null key comes before all others. With a
    history (whose ``source`` must differ from this one's) a document goes if the history holds a text with a
    greater key, or with the same key and a greater source. Columns named like the results are replaced,
    others stay. An empty table gives an empty result.
    """
    taken = {name.lower() for name in RESULTS}
    own = [c for c in docs.columns if c.lower() not in taken]
    stored = keep(_with_digests(docs.select(*own), text))
    rows = _rows(stored, key, source)
    history = history or build_history(rows.where(F.lit(False)))
    marked = mark(rows, verdicts(look_up(rows, history))).where("kept")
    return stored.join(marked.select(F.col("row").alias("__row"), *RESULTS), "__row").select(*own, *RESULTS)
