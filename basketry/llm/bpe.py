"""Byte-level BPE encoding and decoding: speculate, verify, mend.

Greedy longest match proposes tokens for all new words of a batch at once. A proposal is the BPE
encoding exactly if every two neighbouring tokens are compatible, that is, if no merge across their
border would have come before the merges that formed them; this is tested for all neighbours with
array operations. Words that fail are merged step by step.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Sequence
from hashlib import sha256
from itertools import chain

import ahocorasick
import numpy as np
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from basketry.llm.common import KnownWords, field, with_text_columns

VOCABULARY = "byte_bpe_50k.json"

# Fixed pattern of byte-level pre-tokenisation; white space is spelt out as in Unicode's property.
_SPACE = r"\t-\r \x85\xa0  -     　"
PRETOKENS = (rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_SPACE}\p{{L}}\p{{N}}]+"
             rf"|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")
_PRETOKENS = regex.compile(PRETOKENS)
# Where no space is followed by a space or the end, each space starts a chunk that splits by itself.
_CHUNKS = re.compile(" ?[^ ]+")
# Words up to the last width are merged side by side, so many at a time; longer ones one by one.
_WIDTHS, _ROWS = (0, 8, 16, 32), 20_000
_NEVER = np.iinfo(np.int64).max


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable Latin-1 itself, the rest from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


class Vocabulary:
    """Tokens, merges and special tokens of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            loaded = json.load(file)
        letters = byte_letters()
        self.to_letters = {b: letter for b, letter in enumerate(letters)}
        to_byte = {letter: b for b, letter in enumerate(letters)}
        self.ids: dict[str, int] = loaded["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in loaded["added_tokens"]}
        size = max([*self.ids.values(), *self.special.values()]) + 1
        self.size = size
        self.bytes = [b""] * size
        for token, i in self.ids.items():
            self.bytes[i] = bytes(to_byte[c] for c in token)
        for token, i in self.special.items():
            self.bytes[i] = token.encode()
        self.lengths = np.array([len(b) for b in self.bytes])
        self.left, self.right = np.full(size, -1), np.full(size, -1)
        self.birth = np.full(size, -1)
        self.ranks: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, merge in enumerate(loaded["model"]["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            x, y, made = self.ids[a], self.ids[b], self.ids[a + b]
            self.ranks[x, y] = rank, made
            if self.birth[made] < 0:
                self.left[made], self.right[made], self.birth[made] = x, y, rank
        codes = np.array([x * size + y for x, y in self.ranks])
        order = np.argsort(codes)
        self.codes, self.code_ranks = codes[order], np.array([r for r, _ in self.ranks.values()])[order]
        self.made_by_rank = np.array([made for _, made in self.ranks.values()])
        self.letter_ids = [self.ids[c] for c in letters]

    def merge_rank(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair; a number beyond all ranks where there is none."""
        code = x * self.size + y
        at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        return np.where((self.codes[at] == code) & (x >= 0) & (y >= 0), self.code_ranks[at], _NEVER)

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether each pair of tokens can stand side by side in an encoding.

        The last part of ``a``'s last part, and so on, meets the first part of ``b``'s first part: a
        merge of two of these comes first if its rank is below that of the merge which takes its left
        part away, and not above that which takes its right part away (the left one of equals goes first).
        """
        good = np.ones(len(a), dtype=bool)
        x, x_gone = a, np.full(len(a), _NEVER)
        rows = np.arange(len(a))
        while len(rows):
            y, y_gone, inner = b[rows], np.full(len(rows), _NEVER), np.arange(len(rows))
            while len(inner):
                rank = self.merge_rank(x[inner], y)
                good[rows[inner[(rank < x_gone[inner]) & (rank <= y_gone)]]] = False
                y_gone, y = self.birth[y], self.left[y]
                more = (y >= 0) & good[rows[inner]]
                inner, y, y_gone = inner[more], y[more], y_gone[more]
            x_gone, x = self.birth[x], self.right[x]
            more = (x >= 0) & good[rows]
            rows, x, x_gone = rows[more], x[more], x_gone[more]
        return good

    def merge_many(self, words: list[bytes]) -> list[list[int]]:
        """The encodings of short words: each step merges the lowest rank, leftmost first, in every word at once."""
        sizes = np.array([len(w) for w in words])
        width = int(sizes.max())
        cells = np.arange(width)
        raw = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), dtype=np.uint8).reshape(-1, width)
        ids = np.where(cells < sizes[:, None], np.array(self.letter_ids)[raw], -1)
        ids = np.concatenate([ids, np.full((len(words), 1), -1)], axis=1)  # an empty cell ends each word
        ranks = self.merge_rank(ids[:, :-1], ids[:, 1:])
        out: list = [None] * len(words)
        rows = np.arange(len(words))
        while len(rows):
            at = ranks.argmin(axis=1)
            every = np.arange(len(rows))
            done = ranks[every, at] == _NEVER
            for row, left in zip(rows[done].tolist(), ids[done].tolist()):
                out[row] = left[:left.index(-1)]
            rows, ids, ranks, at = rows[~done], ids[~done], ranks[~done], at[~done]
            every = every[:len(rows)]
            made = self.made_by_rank[ranks[every, at]]
            shift = cells + (cells > at[:, None])  # the cell after the pair is taken out
            ids[:, :-1] = np.take_along_axis(ids, shift, axis=1)
            ids[every, at] = made
            ranks[:, :-1] = np.take_along_axis(ranks, shift[:, :-1], axis=1)
            ranks[:, -1] = _NEVER
            ranks[every, at] = self.merge_rank(made, ids[every, at + 1])
            inner = np.flatnonzero(at > 0)
            before = at[inner] - 1
            ranks[inner, before] = self.merge_rank(ids[inner, before], made[inner])
        return out

    def merge(self, word: bytes) -> list[int]:
        """The encoding of one word of any length by merging the lowest rank, leftmost first."""
        ids = [self.letter_ids[b] for b in word]
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = []

        def offer(i: int) -> None:
            j = after[i]
            if j < n and (found := self.ranks.get((ids[i], ids[j]))):
                heapq.heappush(queue, (found[0], i, ids[i], ids[j], found[1]))

        for i in range(n - 1):
            offer(i)
        while queue:
            _, i, x, y, made = heapq.heappop(queue)
            j = after[i]
            if j >= n or ids[i] != x or ids[j] != y:
                continue
            ids[i], ids[j], after[i] = made, -1, after[j]
            if after[j] < n:
                before[after[j]] = i
            if before[i] >= 0:
                offer(before[i])
            offer(i)
        return [i for i in ids if i >= 0]


class Encoder:
    """Encodes texts batch by batch; ``known`` maps a chunk to what ``value`` makes of its ids."""

    def __init__(self, path: str | None = None, value=tuple):
        self.vocabulary = v = Vocabulary(path or public_tokenizers.path(VOCABULARY))
        self.tokens = ahocorasick.Automaton()
        for token, i in v.ids.items():
            self.tokens.add_word(token, i)
        self.tokens.make_automaton()
        self.value = value
        self.known = KnownWords(self._chunks)
        self.special = re.compile("|".join(f"({re.escape(s)})" for s in v.special)) if v.special else None
        self.proposed = self.mended = 0

    def words(self, words: list[str]) -> list[list[int]]:
        """The ids of every word."""
        v = self.vocabulary
        raw = [w.encode() for w in words]
        spelt = [w.decode("latin-1").translate(v.to_letters) for w in raw]
        sizes = np.array([len(w) for w in raw])
        found = np.array(list(self.tokens.iter_long("\n".join(spelt))), dtype=np.int64).reshape(-1, 2)
        ends, ids = found[:, 0] + 1, found[:, 1]
        starts = np.cumsum(sizes + 1) - sizes - 1  # where each word begins in the joined string
        owner = np.searchsorted(starts, ends - 1, side="right") - 1
        good = np.bincount(owner, weights=v.lengths[ids], minlength=len(words)) == sizes
        inside = np.flatnonzero(owner[1:] == owner[:-1])
        pairs, back = np.unique(ids[inside] * v.size + ids[inside + 1], return_inverse=True)
        fit = v.compatible(pairs // v.size, pairs % v.size)[back]
        good[owner[inside[~fit]]] = False
        bounds = np.searchsorted(owner, np.arange(len(words) + 1)).tolist()
        flat = ids.tolist()
        out = [flat[a:b] for a, b in zip(bounds, bounds[1:])]
        failed = np.flatnonzero(~good)
        self.proposed += len(words)
        self.mended += len(failed)
        for low, high in zip(_WIDTHS, _WIDTHS[1:]):
            rows = failed[(sizes[failed] > low) & (sizes[failed] <= high)].tolist()
            for a in range(0, len(rows), _ROWS):
                some = rows[a:a + _ROWS]
                for k, merged in zip(some, v.merge_many([raw[k] for k in some])):
                    out[k] = merged
        for k in failed[sizes[failed] > _WIDTHS[-1]].tolist():
            out[k] = v.merge(raw[k])
        return out

    def _chunks(self, chunks: list[str]) -> list:
        parts = list(map(_PRETOKENS.findall, chunks))
        words = list(dict.fromkeys(chain.from_iterable(parts)))
        ids = dict(zip(words, self.words(words)))
        return [self.value(ids[ws[0]] if len(ws) == 1 else [i for w in ws for i in ids[w]]) for ws in parts]

    def split(self, text: str) -> list[str | int]:
        """Chunks that encode by themselves; special tokens as their id."""
        if self.special and self.special.search(text):
            out: list[str | int] = []
            for piece in self.special.split(text):
                if piece:
                    out += [self.vocabulary.special[piece]] if piece in self.vocabulary.special else self._plain(piece)
            return out
        return self._plain(text)

    @staticmethod
    def _plain(text: str) -> list[str]:
        if "  " in text or text.endswith(" "):
            return _PRETOKENS.findall(text)
        return _CHUNKS.findall(text)

    def values(self, texts: Sequence[str]) -> list[list]:
        """Per text, the value of each chunk in order."""
        split = list(map(self.split, texts))
        new = set().union(*split)
        numbers = {x for x in new if isinstance(x, int)}
        self.known.learn(new - numbers)
        self.known.rare.update({i: self.value([i]) for i in numbers})
        return [list(map(self.known.__getitem__, chunks)) for chunks in split]

    def encode(self, texts: Sequence[str]) -> list[list[int]]:
        """The ids of every text (``value`` must give sequences of ids)."""
        return [[int(i) for ids in values for i in ids] for values in self.values(texts)]

    def decode(self, ids: Sequence[int]) -> str:
        """The text of ids; broken UTF-8 becomes replacement characters."""
        return b"".join(map(self.vocabulary.bytes.__getitem__, ids)).decode("utf-8", "replace")


FIELDS = T.StructType([
    field("n_tokens", T.LongType()), field("ids", T.ArrayType(T.IntegerType())), field("decoded", T.StringType()),
])
DIGEST_FIELDS = T.StructType([
    field("n_tokens", T.LongType()), field("ids_sha256", T.StringType()), field("decoded_sha256", T.StringType()),
])


def tokenise(docs: DataFrame, text: str = "text", path: str | None = None) -> DataFrame:
    """Add the token ids of every text and the text decoded from them.

    A null text counts as empty and has no ids. Special tokens written out in a text are encoded as
    such. Columns named like a result are replaced.
    """

    def start():
        encoder = Encoder(path)

        def many(texts: list[str]) -> list:
            ids = encoder.encode(texts)
            return [list(map(len, ids)), ids, list(map(encoder.decode, ids))]

        return many

    return with_text_columns(docs, text, FIELDS, start)


def digests(docs: DataFrame, text: str = "text", path: str | None = None) -> DataFrame:
    """As ``tokenise``, with SHA-256 digests of the ids (decimal, comma-joined) and of the decoded text.

    The ids of a chunk and the bytes they decode to are worked out once for each known chunk.
    """

    def start():
        encoder = Encoder(path)
        token_bytes = encoder.vocabulary.bytes
        encoder.value = lambda ids: (",".join(map(str, ids)), b"".join(map(token_bytes.__getitem__, ids)), len(ids))

        def one(values: list) -> tuple[int, str, str]:
            if not values:
                return 0, sha256(b"").hexdigest(), sha256(b"").hexdigest()
            decimals, raw, sizes = zip(*values)
            decoded = b"".join(raw).decode("utf-8", "replace")
            return (sum(sizes), sha256(",".join(decimals).encode()).hexdigest(),
                    sha256(decoded.encode()).hexdigest())

        return lambda texts: list(zip(*map(one, encoder.values(texts)))) or [[], [], []]

    return with_text_columns(docs, text, DIGEST_FIELDS, start)
