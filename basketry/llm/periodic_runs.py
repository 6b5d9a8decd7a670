"""Periodic runs of words, found in a grammar of the text.

A run is a stretch of words with smallest period q, at least max(LEAST_LENGTH, LEAST_EXPONENT * q) words
long, that no neighbouring word extends. Words become numbers and Re-Pair writes the most frequent pair of
neighbours as a new symbol until no pair occurs twice; what is left is joined by balanced rules. A run
crosses the boundary between the two halves of exactly one smallest node of the derivation that holds it,
so it is enough to look at the boundary of each rule once, however often the rule is used: prefix and
suffix extensions (Z-functions) give all runs there for every period. They are then copied to all places
that derive the rule, and overlapping intervals of one period merge to the maximal run.

Before that, stretches that cannot hold a run are cut away: in a run every pair of neighbours occurs at
least LEAST_EXPONENT - 1 times, so a pair that is rarer within its stretch is a cut, again and again until
nothing changes. This is exact and leaves little of ordinary prose.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from basketry.llm.common import field, with_text_columns

LEAST_LENGTH = 6
LEAST_EXPONENT = 4

Run = tuple[int, int, int]  # start, length, period


# Re-Pair

def re_pair(symbols: Sequence[int], first_rule: int) -> tuple[list[tuple[int, int]], list[int]]:
    """(rules, rest): rule k stands for the symbol first_rule + k and writes two symbols.

    The pair with most occurrences that do not overlap goes first (ties: the one counted first); each
    replacement only touches the counts of the pairs beside it.
    """
    seq = list(symbols)
    n = len(seq)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    places: dict[tuple[int, int], set[int]] = {}
    for i in range(n - 1):
        places.setdefault((seq[i], seq[i + 1]), set()).add(i)
    heap = [(-len(at), order, pair) for order, (pair, at) in enumerate(places.items()) if len(at) > 1]
    heapq.heapify(heap)
    order = len(places)
    rules: list[tuple[int, int]] = []
    while heap:
        claimed, _, pair = heapq.heappop(heap)
        chosen = sorted(places.get(pair, ()))
        a, b = pair
        if a == b:  # of overlapping places every second one
            taken, apart = -1, []
            for i in chosen:
                if i != taken:
                    apart.append(i)
                    taken = after[i]
            chosen = apart
        if len(chosen) < 2:
            continue
        if len(chosen) != -claimed:  # fewer than when it was counted: wait for its turn
            heapq.heappush(heap, (-len(chosen), order, pair))
            order += 1
            continue
        new = first_rule + len(rules)
        rules.append(pair)
        touched = set()
        for i in chosen:
            j = after[i]
            left, right = before[i], after[j]
            if left >= 0:
                old = (seq[left], a)
                if old in places:
                    places[old].discard(left)
                places.setdefault((seq[left], new), set()).add(left)
                touched.add((seq[left], new))
            if right < n:
                old = (b, seq[right])
                if old in places:
                    places[old].discard(j)
                places.setdefault((new, seq[right]), set()).add(i)
                touched.add((new, seq[right]))
                before[right] = i
            seq[i], after[i] = new, right
            seq[j] = -1
        del places[pair]
        for other in touched:
            if other in places and len(places[other]) > 1:
                heapq.heappush(heap, (-len(places[other]), order, other))
                order += 1
    rest, i = [], 0
    while i < n:
        rest.append(seq[i])
        i = after[i]
    return rules, rest


# Runs at the boundary of a rule

def _prefixes(seq: Sequence[int]) -> list[int]:
    """For each place, how many symbols from there on agree with the beginning."""
    n = len(seq)
    z = [0] * n
    if n:
        z[0] = n
    left = right = 0
    for i in range(1, n):
        k = min(z[i - left], right - i) if i < right else 0
        while i + k < n and seq[k] == seq[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


def _right_of(u: list[int], v: list[int], found: dict[tuple[int, int], int], mirrored: bool) -> None:
    """Runs of u + v that reach into u and at least one period into v, as {(start, end): period}."""
    m, n = len(u), len(u) + len(v)
    longest = min(len(v), n // LEAST_EXPONENT)
    if not m or not longest:
        return
    ahead = _prefixes(v)
    u_back = u[::-1]
    back = _prefixes([*u_back, -1, *v[:longest][::-1], *u_back])
    for q in range(1, longest + 1):
        a = back[m + 1 + longest - q]
        if not a:
            continue
        b = ahead[q] if q < len(v) else 0
        if a + b + q >= max(LEAST_LENGTH, LEAST_EXPONENT * q):
            start, end = m - a, m + b + q
            key = (n - end, n - start) if mirrored else (start, end)
            if found.get(key, n) > q:
                found[key] = q


def boundary_runs(u: list[int], v: list[int]) -> dict[tuple[int, int], int]:
    """{(start, end): smallest period} of the runs of u + v that cross the boundary between the two.

    Such a run reaches a period into v or a period into u, since it holds four of them.
    """
    found: dict[tuple[int, int], int] = {}
    _right_of(u, v, found, False)
    _right_of(v[::-1], u[::-1], found, True)
    return found


def stretch_runs(symbols: Sequence[int], first_rule: int) -> list[Run]:
    """All runs of a sequence of symbols below ``first_rule``, by start, then period."""
    rules, rest = re_pair(symbols, first_rule)
    while len(rest) > 1:  # balanced rules over what is left
        joined = []
        for i in range(0, len(rest) - 1, 2):
            rules.append((rest[i], rest[i + 1]))
            joined.append(first_rule + len(rules) - 1)
        rest = joined + rest[len(rest) - len(rest) % 2:]
    text: list[list[int]] = []
    runs: list[dict[tuple[int, int], int]] = []

    def derived(symbol: int) -> list[int]:
        return text[symbol - first_rule] if symbol >= first_rule else [symbol]

    for a, b in rules:
        u, v = derived(a), derived(b)
        text.append(u + v)
        runs.append(boundary_runs(u, v) if len(u) + len(v) >= LEAST_LENGTH else {})
    # From the whole down: where each rule is derived, and so where its runs lie.
    at: list[list[int]] = [[] for _ in rules]
    if rules:
        at[-1].append(0)
    of_period: dict[int, list[tuple[int, int]]] = {}
    for k in range(len(rules) - 1, -1, -1):
        for (start, end), q in runs[k].items():
            of_period.setdefault(q, []).extend((p + start, p + end) for p in at[k])
        a, b = rules[k]
        for symbol, shift in ((a, 0), (b, len(derived(a)))):
            if symbol >= first_rule and len(text[symbol - first_rule]) >= LEAST_LENGTH:
                at[symbol - first_rule].extend([p + shift for p in at[k]])
    merged: list[Run] = []
    for q, intervals in of_period.items():
        intervals.sort()
        start, end = intervals[0]
        for s, e in intervals[1:]:
            if s + q <= end:  # one run: the rules inside it saw parts of it
                end = max(end, e)
            else:
                merged.append((start, end - start, q))
                start, end = s, e
        merged.append((start, end - start, q))
    return sorted(merged, key=lambda r: (r[0], r[2]))


# Stretches that can hold a run

def live_stretches(ids: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """Intervals of the words of a batch outside which no run lies. ``ends``: where each text ends.

    A pair of neighbours that occurs fewer than LEAST_EXPONENT - 1 times in its stretch is a cut, and so
    is every pair of a stretch under LEAST_LENGTH words.
    """
    if len(ids) < 2:
        return []
    alive = np.ones(len(ids) - 1, dtype=bool)
    alive[ends[:-1][(ends[:-1] > 0) & (ends[:-1] < len(ids))] - 1] = False
    at = np.flatnonzero(alive)
    pairs = np.unique(ids[at].astype(np.int64) * (int(ids.max()) + 1) + ids[at + 1], return_inverse=True)[1]
    while len(at):
        fresh = np.diff(at, prepend=-2) != 1
        stretch = np.cumsum(fresh) - 1
        _, kind, counts = np.unique(stretch * (int(pairs.max()) + 1) + pairs, return_inverse=True, return_counts=True)
        stays = (counts[kind] >= LEAST_EXPONENT - 1) & (np.bincount(stretch)[stretch] >= LEAST_LENGTH - 1)
        if stays.all():
            first = at[fresh]
            return list(zip(first.tolist(), (first + np.bincount(stretch) + 1).tolist()))
        at, pairs = at[stays], pairs[stays]
    return []


def strongest(runs: Sequence[Run]) -> Run | None:
    """The run with the greatest length / period; ties: smallest start, then period."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def runs_of_texts(texts: Sequence[str]) -> list[tuple[list[bytes], list[Run]]]:
    """The words of each text and its runs."""
    words = [t.encode().split() for t in texts]
    table: dict[bytes, int] = {}
    ids = np.array([table.setdefault(w, len(table)) for ws in words for w in ws], dtype=np.int32)
    ends = np.cumsum([len(ws) for ws in words])
    found: list[list[Run]] = [[] for _ in texts]
    for start, end in live_stretches(ids, ends):
        text = int(np.searchsorted(ends, start, side="right"))
        shift = start - int(ends[text]) + len(words[text])
        found[text] += [(s + shift, n, q) for s, n, q in stretch_runs(ids[start:end].tolist(), len(table))]
    return [(ws, sorted(runs, key=lambda r: (r[0], r[2]))) for ws, runs in zip(words, found)]


def collapse(words: Sequence[bytes], runs: Sequence[Run]) -> str:
    """The words without those behind the first period of any run, joined by one space."""
    if runs:
        kept = np.ones(len(words), dtype=bool)
        for start, length, period in runs:
            kept[start + period:start + length] = False
        words = [words[i] for i in np.flatnonzero(kept).tolist()]
    return b" ".join(words).decode()


RUN = T.StructType([field("start", T.LongType()), field("length", T.LongType()), field("period", T.LongType())])


def find_runs(docs: DataFrame, text: str = "text", collapsed: str = "collapsed") -> DataFrame:
    """Add n_words, runs (by start, then period), strongest and the collapsed text to every document.

    Words are stretches without the characters x20 and x09 to x0D, numbered from 0. ``strongest`` is null
    without a run. A null or empty text has no words, no runs and an empty collapsed text. Columns named
    like the results are replaced, others stay; ``collapsed`` may name the text column, which is replaced
    then. Equal rows give equal results. A text is worked on by one task.
    """
    fields = T.StructType([field("n_words", T.LongType()), field("runs", T.ArrayType(RUN)), field("strongest", RUN),
                           field(collapsed, T.StringType())])
    names = RUN.names

    def start():
        def compute(texts: list[str]):
            found = runs_of_texts(texts)
            best = [strongest(runs) for _, runs in found]
            return ([len(ws) for ws, _ in found],
                    [[dict(zip(names, r)) for r in runs] for _, runs in found],
                    [r and dict(zip(names, r)) for r in best],
                    [collapse(ws, runs) for ws, runs in found])
        return compute

    return with_text_columns(docs, text, fields, start)
