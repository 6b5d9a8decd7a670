"""Best-fit packing of documents into sequences, with several capacities.

Documents become pieces of at most one sequence's length. Packing looks at piece lengths only, so it
runs on the histogram of lengths, which has at most as many rows as a sequence has tokens, however
many pieces there are: equal pieces go to equal bins in one step. Lengths are taken in falling order.
A bin has three residual capacities (tokens, documents, attention cost, which is the square of the
length summed); among the bins that can take a piece under every constraint, the one with the best
weighted score wins: the largest dot product of demand and fill, or the smallest residual norm.
The outcome, patterns with multiplicities, gives each (length, rank among that length) its place, and
the pieces look theirs up in parallel.
"""

from __future__ import annotations

import base64
from collections import defaultdict
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.llm.common import field, keep, with_text_columns

SEPARATOR = 2
RANKS = "byte_bpe_50k.tiktoken"
END_OF_TEXT = {"<|endoftext|>": 50256}
ROWS_PER_RANKING = 2_000


@dataclass(frozen=True)
class Capacity:
    """What one sequence holds. The defaults bind by tokens alone: every piece has a token, and
    squares of lengths within the token capacity never sum to more than its square."""
    tokens: int = 1024
    documents: int = 1024
    attention: int = 1024 * 1024

    def vector(self) -> np.ndarray:
        return np.array([self.tokens, self.documents, self.attention], dtype=float)


@dataclass(frozen=True)
class Policy:
    """How a bin is chosen: ``norm`` (smallest weighted residual norm) or ``dot`` (largest weighted
    product of the piece's demand and the bin's fill), with a weight for each capacity."""
    rule: str = "norm"
    weights: tuple[float, float, float] = (1.0, 1.0, 1.0)


@dataclass(frozen=True)
class Pattern:
    """``count`` equal sequences, numbered from ``first``, with pieces of these lengths in this order."""
    first: int
    count: int
    lengths: tuple[int, ...]


class _Bins:
    """Groups of equal open bins: lengths inside, and how many bins there are of each."""

    def __init__(self, capacity: Capacity, policy: Policy):
        self.capacity, self.policy = capacity, policy
        self.groups: dict[tuple[int, ...], int] = defaultdict(int)
        self.left: dict[tuple[int, ...], tuple[int, int, int]] = {}
        self.closed: dict[tuple[int, ...], int] = defaultdict(int)

    def add(self, lengths: tuple[int, ...], count: int) -> None:
        c = self.capacity
        left = (c.tokens - sum(lengths), c.documents - len(lengths), c.attention - sum(x * x for x in lengths))
        if min(left[:2]) <= 0 or left[2] <= 0:
            self.closed[lengths] += count
        else:
            self.groups[lengths] += count
            self.left[lengths] = left

    def room(self, length: int, left: tuple[int, int, int]) -> int:
        """How many pieces of this length a bin with these residuals can take."""
        return min(left[0] // length, left[1], left[2] // (length * length))

    def best(self, length: int) -> tuple[int, ...] | None:
        """The open group that takes the piece best; ties go to the fuller, then the smaller lengths."""
        names = [g for g in self.groups if self.room(length, self.left[g])]
        if not names:
            return None
        full = self.capacity.vector()
        need = np.array([length, 1, length * length]) / full
        left = np.array([self.left[g] for g in names]) / full
        weights = np.array(self.policy.weights)
        if self.policy.rule == "norm":
            score = -np.sqrt((weights * (left - need) ** 2).sum(axis=1))
        elif self.policy.rule == "dot":
            score = (weights * need * (1 - left)).sum(axis=1)
        else:
            raise ValueError(f"unknown rule {self.policy.rule!r}")
        return max(zip(score, names))[1]


def plan(histogram: Mapping[int, int], capacity: Capacity = Capacity(), policy: Policy = Policy()) -> list[Pattern]:
    """Patterns that hold all pieces of a histogram (length -> pieces). Deterministic."""
    bins = _Bins(capacity, policy)
    for length in sorted((x for x, n in histogram.items() if n), reverse=True):
        left = histogram[length]
        if not 0 < length <= capacity.tokens or length * length > capacity.attention or capacity.documents < 1:
            raise ValueError(f"a piece of {length} tokens fits no sequence")
        while left and (group := bins.best(length)) is not None:
            fit = bins.room(length, bins.left[group])
            count = bins.groups.pop(group)
            # After one piece the same bin is the best again while it has room, so it is filled at once.
            used = min(count, left // fit)
            if used:
                bins.add(group + (length,) * fit, used)
                left -= used * fit
            if used < count and left:
                bins.add(group + (length,) * left, 1)
                used, left = used + 1, 0
            if used < count:
                bins.groups[group] += count - used
        if left:
            each = bins.room(length, (capacity.tokens, capacity.documents, capacity.attention))
            if left >= each:
                bins.add((length,) * each, left // each)
            if left % each:
                bins.add((length,) * (left % each), 1)
    out, first = [], 0
    for lengths, count in [*bins.closed.items(), *bins.groups.items()]:
        out.append(Pattern(first, count, lengths))
        first += count
    return out


def places(patterns: Sequence[Pattern]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per length: first ranks, first sequences and offsets of runs of places, in order of rank."""
    runs: dict[int, list] = defaultdict(list)
    ranks: dict[int, int] = defaultdict(int)
    for pattern in patterns:
        offset = 0
        for length in pattern.lengths:
            runs[length].append((ranks[length], pattern.first, offset))
            ranks[length] += pattern.count
            offset += length
    return {length: tuple(np.array(rows, dtype=np.int64).T) for length, rows in runs.items()}


def byte_tokeniser(path: str | None = None) -> tiktoken.Encoding:
    with open(path or public_tokenizers.path(RANKS), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens=END_OF_TEXT)


PIECE = T.StructType([field("piece", T.IntegerType()), field("start", T.LongType()),
                      field("length", T.LongType()), field("ids_crc32", T.LongType())])
PIECES = T.StructType([field("pieces", T.ArrayType(PIECE))])


def cut(n: int, most: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens: full ones, and a shorter one first if needed."""
    first = n % most
    return ([(0, first)] if first else []) + [(a, most) for a in range(first, n, most)]


def document_pieces(docs: DataFrame, text: str = "text", most: int = 1024, path: str | None = None,
                    separator: int = SEPARATOR) -> DataFrame:
    """One row per piece: the columns of ``docs`` but the text, and piece, start, length, ids_crc32."""

    def start():
        encoding = byte_tokeniser(path)

        def one(text: str) -> list[dict]:
            ids = encoding.encode(text, allowed_special="all", disallowed_special=())
            raw = np.array([*ids, separator], dtype="<u4").tobytes()
            return [{"piece": k, "start": a, "length": n, "ids_crc32": crc32(memoryview(raw)[4 * a:4 * (a + n)])}
                    for k, (a, n) in enumerate(cut(len(raw) // 4, most))]

        return lambda texts: [list(map(one, texts))]

    found = with_text_columns(docs, text, PIECES, start)
    others = [c for c in found.columns if c not in {text, "pieces", *PIECE.names}]
    return found.select(*others, F.inline("pieces"))


def pack(pieces: DataFrame, order: Sequence[str], capacity: Capacity = Capacity(), policy: Policy = Policy()) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces that have a ``length``; ``order`` names columns that
    tell pieces apart (pieces alike in them are interchangeable).

    Ranks inside a length are counted in chunks of about ROWS_PER_RANKING rows, so a common length
    does not meet in one task. The histogram has a row for each length, and only that is collected.
    """
    pieces = keep(pieces)
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    runs = places(plan(histogram, capacity, policy))
    chunks = max(1, -(-max(histogram.values(), default=0) // ROWS_PER_RANKING))
    chunked = pieces.withColumn("__chunk", F.pmod(F.xxhash64(*order), F.lit(chunks)).cast("int"))
    sizes = chunked.groupBy("length", "__chunk").agg(F.count("*").alias("__n"))
    before = Window.partitionBy("length").orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("length", "__chunk", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__from"))
    inside = Window.partitionBy("length", "__chunk").orderBy(*order)
    ranked = chunked.withColumn("__rank", F.row_number().over(inside) - 1).join(starts, ["length", "__chunk"])
    ranked = ranked.select(*pieces.columns, (F.col("__rank") + F.col("__from")).alias("__rank"))
    schema = T.StructType([*pieces.schema, field("sequence_id", T.LongType()), field("offset", T.LongType())])
    shared = pieces.sparkSession.sparkContext.broadcast(runs)  # a run per length and pattern: bounded by the capacity

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            lengths = batch.column("length").to_numpy(zero_copy_only=False)
            ranks = batch.column("__rank").to_numpy(zero_copy_only=False)
            sequence, offset = np.zeros(len(ranks), np.int64), np.zeros(len(ranks), np.int64)
            for length in np.unique(lengths).tolist():
                rows = np.flatnonzero(lengths == length)
                first, sequences, offsets = table[length]
                at = np.searchsorted(first, ranks[rows], side="right") - 1
                sequence[rows] = sequences[at] + ranks[rows] - first[at]
                offset[rows] = offsets[at]
            own = [batch.column(c) for c in batch.schema.names if c != "__rank"]
            yield pa.RecordBatch.from_arrays([*own, pa.array(sequence), pa.array(offset)], names=schema.names)

    return ranked.mapInArrow(look_up, schema)


def pack_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", capacity: Capacity = Capacity(),
                   policy: Policy = Policy(), path: str | None = None) -> DataFrame:
    """Tokenise, cut and pack documents: key, piece, start, length, ids_crc32, sequence_id, offset.

    A null or empty text is one piece holding the separator. Repeated rows are packed like any others.
    An empty table gives an empty result. Other columns are left out.
    """
    pieces = document_pieces(docs.select(key, text), text, capacity.tokens, path)
    return pack(pieces, [key, "piece", "start", "ids_crc32"], capacity, policy)
