"""Personal data by patterns and a skip-chain conditional random field.

Patterns find the base spans. Other stretches of a text that resemble a base span of the same text (the
same digits written otherwise, an address spelt with "at" or "dot", or its name part alone with a digit or
dot in it) become hidden tokens of a random field, together with the base spans as nearly certain ones.
Tokens in sequence share weak chain potentials; equal or similar tokens share strong skip potentials,
however far apart they stand. Skip edges run over one hub for each entity, so their number grows with the
tokens and not with pairs of them. Loopy message passing gives each token's label; a hidden token that
ends up with a kind of personal data becomes a span beside the base ones, which all stay.
"""

from __future__ import annotations

import re
from collections import defaultdict
from hashlib import sha256

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.llm.common import field, with_text_columns

KINDS = ("email", "ip", "card", "phone")
MASKS = {kind: f"<{kind.upper()}>" for kind in KINDS}

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NUMBERS = re.compile(r"[0-9][0-9 ().-]*[0-9]")
_SPELT_EMAIL = re.compile(
    r"(?<![A-Za-z0-9._%+-])([A-Za-z0-9._%+-]++) ?(?:\(at\)|\[at\]| at |@ ) ?([A-Za-z0-9-]+(?: ?(?:\.|\(dot\)|\[dot\]| dot ) ?[A-Za-z0-9-]+)+)")
_NAME = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9%+-]++(?:[._][A-Za-z0-9%+-]++)++")
_MAYBE = re.compile("[0-9@]")
_DOTS = re.compile(r" ?(?:\(dot\)|\[dot\]| dot ) ?")

# Log-potentials of the field: labels are "none" and the kinds.
CERTAIN = 8.0
PRIOR_NONE = 1.5
SHAPE = 0.5
CHAIN = 0.1
SKIP_EQUAL, SKIP_SIMILAR = 4.0, 2.5
ROUNDS = 10
LEAST_DIGITS = 7

FIELDS = T.StructType([
    *[field(f"n_{kind}", T.LongType()) for kind in KINDS], field("base_sha256", T.StringType()),
    field("spans", T.StringType()), field("n_added", T.LongType()), field("masked", T.StringType()),
])


def _luhn(digits: str) -> bool:
    total = 0
    for place, c in enumerate(reversed(digits)):
        d = int(c) * (1 + place % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    """Local parts are taken back from each @, so long texts without one cost nothing."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and (text[start - 1].isascii() and (text[start - 1].isalnum() or text[start - 1] in "._%+-")):
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            out.append((start, found.end()))
            last = found.end()
        else:
            last = at + 1
        at = text.find("@", max(last, at + 1))
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of every base match, ordered by start, then kind."""
    spans = [(a, 0, b) for a, b in _emails(text)] if "@" in text else []
    for found in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in found.group().split(".")):
            spans.append((found.start(), 1, found.end()))
    for found in _CARD.finditer(text):
        if found.end() - found.start() >= 12:
            digits = found.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and _luhn(digits):
                spans.append((found.start(), 2, found.end()))
    if "+" in text:
        for found in _PHONE.finditer(text):
            if 9 <= sum(map(str.isdigit, found.group())) <= 15:
                spans.append((found.start(), 3, found.end()))
    return sorted(spans)


def _digits(text: str) -> str:
    return "".join(filter(str.isdigit, text))


def entity_keys(text: str, kind: int) -> dict[str, float]:
    """What a base span's other mentions may be known by, with the strength of the skip potential."""
    if kind == 0:
        name = text.partition("@")[0].lower()
        keys = {f"mail:{text.lower()}": SKIP_EQUAL}
        if re.search(r"[0-9._]", name) and len(name) >= 6:
            keys[f"name:{name}"] = SKIP_SIMILAR
        return keys
    digits = _digits(text)
    if kind == 1:
        return {f"ip:{text}": SKIP_EQUAL}
    keys = {f"number:{digits}": SKIP_EQUAL}
    if kind == 3 and len(digits) >= LEAST_DIGITS + 2:
        # A number without its country code (1 to 3 digits) is similar.
        keys |= {f"number:{digits[n:]}": SKIP_SIMILAR for n in (1, 2, 3) if len(digits) - n >= LEAST_DIGITS}
    return keys


def candidates(text: str, free) -> list[tuple[int, int, str]]:
    """(start, end, key) of stretches outside the base spans that may mention an entity again."""
    out = []
    for found in _SPELT_EMAIL.finditer(text):
        key = f"mail:{found[1]}@{_DOTS.sub('.', found[2])}".lower().replace(" ", "")
        out.append((found.start(), found.end(), key))
    for found in _NUMBERS.finditer(text):
        if found.end() - found.start() >= LEAST_DIGITS:
            out.append((found.start(), found.end(), f"number:{_digits(found.group())}"))
    for found in _NAME.finditer(text):
        out.append((found.start(), found.end(), f"name:{found.group().lower()}"))
    return [c for c in out if free(c[0], c[1])]


def propagate(unary: np.ndarray, edges: list[tuple[int, int, float]], rounds: int = ROUNDS) -> np.ndarray:
    """Marginals of a pairwise field whose edges favour equal labels, by loopy message passing.

    ``unary``: log-potentials (nodes x labels). An edge (i, j, w) multiplies equal labels by exp(w).
    """
    n, labels = unary.shape
    if not edges:
        belief = unary
    else:
        a, b, w = (np.array(x) for x in zip(*edges))
        source, target = np.concatenate([a, b]), np.concatenate([b, a])
        force = np.exp(np.concatenate([w, w]))[:, None] - 1
        back = np.concatenate([np.arange(len(a)) + len(a), np.arange(len(a))])
        messages = np.zeros((2 * len(a), labels))
        for _ in range(rounds):
            belief = unary.copy()
            np.add.at(belief, target, messages)
            out = belief[source] - messages[back]
            out = np.exp(out - out.max(axis=1, keepdims=True))
            new = np.log(out.sum(axis=1, keepdims=True) + force * out)
            new -= new.max(axis=1, keepdims=True)
            if np.abs(new - messages).max() < 1e-6:
                messages = new
                break
            messages = new
        belief = unary.copy()
        np.add.at(belief, target, messages)
    p = np.exp(belief - belief.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def added_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans that the field adds to the base ones; never across a base span or each other."""
    if not base:
        return []
    keys: dict[str, dict[int, float]] = defaultdict(dict)  # key -> entity -> strength
    entities: dict[str, int] = {}
    nodes: list[tuple[int, int]] = []
    for start, kind, end in base:
        strongest = None
        for key, strength in entity_keys(text[start:end], kind).items():
            strongest = strongest or f"{kind}:{key}"
            entity = entities.setdefault(strongest, len(entities))
            keys[key][entity] = max(strength, keys[key].get(entity, 0.0))
        nodes.append((start, entities[strongest]))
    starts = np.array([a for a, _, _ in base])
    reach = np.maximum.accumulate([b for _, _, b in base])

    def free(a: int, b: int) -> bool:
        before = int(np.searchsorted(starts, b)) - 1
        return before < 0 or reach[before] <= a

    hidden = [c for c in candidates(text, free) if c[2] in keys]
    if not hidden:
        return []
    labels = len(KINDS) + 1
    unary = np.zeros((len(base) + len(hidden) + len(entities), labels))
    order = []
    edges: list[tuple[int, int, float]] = []
    hub = len(base) + len(hidden)
    for i, (start, kind, _) in enumerate(base):
        unary[i, kind + 1] = CERTAIN
        edges.append((i, hub + nodes[i][1], SKIP_EQUAL))
        order.append((start, i))
    for k, (start, _, key) in enumerate(hidden):
        i = len(base) + k
        unary[i, 0] = PRIOR_NONE
        unary[i, [1] if key[0] in "mn" and not key.startswith("number") else [3, 4]] += SHAPE
        edges += [(i, hub + entity, strength) for entity, strength in keys[key].items()]
        order.append((start, i))
    order.sort()
    edges += [(i, j, CHAIN) for (_, i), (_, j) in zip(order, order[1:])]
    marginals = propagate(unary, edges)
    out, end_before = [], 0
    for k, (start, end, _) in sorted(enumerate(hidden), key=lambda x: (x[1][0], -x[1][1])):
        label = int(marginals[len(base) + k].argmax())
        if label and marginals[len(base) + k, label] >= 0.5 and start >= end_before:
            out.append((start, label - 1, end))
            end_before = end
    return out


def spans_text(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in sorted(spans))


def mask(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with every span replaced by its kind; overlapping spans become one, named by the first."""
    out, at = [], 0
    for start, kind, end in sorted(spans):
        if start >= at:
            out += [text[at:start], MASKS[KINDS[kind]]]
        at = max(at, end)
    return "".join([*out, text[at:]])


def find_personal_data(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add base counts by kind, the digest of the base spans, all spans, how many were added, and the masked text.

    Offsets are code points, ends exclusive. A null or empty text has no spans. Repeated rows get equal
    results; columns named like a result are replaced.
    """

    def one(text: str) -> tuple:
        base = base_spans(text) if _MAYBE.search(text) else []
        added = added_spans(text, base)
        kinds = [kind for _, kind, _ in base]
        return (*map(kinds.count, range(len(KINDS))), sha256(spans_text(base).encode()).hexdigest(),
                spans_text(base + added), len(added), mask(text, base + added) if base else text)

    return with_text_columns(docs, text, FIELDS,
                             lambda: lambda texts: list(zip(*map(one, texts))) or [[]] * len(FIELDS))



def mask_documents(docs: DataFrame, text: str = "text", size: str = "n_chars") -> DataFrame:
    """The same documents with personal data masked, and the size column, if there is one, counted anew.

    A null text stays null.
    """
    own = {c: f"__own_{c}" for c in docs.columns if c in FIELDS.names}
    found = find_personal_data(docs.withColumnsRenamed(own), own.get(text, text))
    masked = F.when(F.col(own.get(text, text)).isNotNull(), F.col("masked"))
    columns = {text: masked, size: F.length(masked).cast(dict(docs.dtypes).get(size, "long"))}
    return found.select(*[columns[c].alias(c) if c in columns else F.col(own.get(c, c)).alias(c) for c in docs.columns])
