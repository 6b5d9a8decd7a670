"""Toxicity by a weighted finite-state pattern grammar.

Each word is read as a symbol: insult, threat, target, negation, report or other. Insults are words and
word beginnings learnt from labelled texts; the other classes are short fixed lists. Small transducers,
one for each pattern, run over a clause together: an insult near a target, a threat near a target, a
negation before an insult ("not an idiot") and a reporting verb before it ("he said ..."). A clause
comes out as one match kind; a text's score is a logistic sum over its matched clauses, with weights
fitted on the labelled texts. Single words outside a matched clause score nothing.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.llm.common import KnownWords, field, keep, with_text_columns

# Labelled rows learnt from, at most so many of each class (by hash of the id).
SAMPLE_ROWS = 4_000
# An insult stands in at least so many independent places of toxic texts.
LEAST_PLACES = 8
# Its places in toxic texts for each in clean ones, relative to the words of both.
LEAST_ODDS = 25.0
# Least log-likelihood ratio of the word's spread over the classes against chance; so large that among
# millions of rare words none is expected to pass by luck.
LEAST_RATIO = 40.0
SHORTEST_STEM, LONGEST_STEM = 4, 8

# Fixed word lists of the grammar.
TARGETS = frozenset("you your yours he she him her they them his their u du dich dir dein ihr sie er tu te toi "
                    "ton ta vous votre il elle ils usted tú ti él ella ellos".split())
THREATS = frozenset("kill murder hurt destroy shoot stab burn töten umbringen schlagen tuer détruire frapper "
                    "matar golpear destruir".split())
NEGATIONS = frozenset("not no never isn aren wasn don kein keine nicht nie pas jamais aucun nunca ningún".split())
REPORTS = frozenset("said says say wrote called claims claimed reported quoted sagte schrieb behauptet dit écrit "
                    "dijo escribió llamó".split())

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)
KINDS = ("insult", "insult_at_target", "insult_negated", "insult_reported", "threat", "threat_at_target")
NEAR = 4

_CLAUSE = re.compile(r"[.!?;:,\n]+")
_WORDS = re.compile(r"[^\W\d_]+")

FIELDS = T.StructType([
    field("score", T.DoubleType()), field("predicted", T.IntegerType()), field("n_clauses", T.LongType()),
    field("matched", T.ArrayType(T.StringType())),
])


@dataclass(frozen=True)
class Grammar:
    """Learnt insults (whole words and beginnings), and the weight of each match kind."""
    words: frozenset[str]
    stems: frozenset[str]
    bias: float = -3.0
    weights: tuple[float, ...] = (4.0, 5.0, 2.0, 2.0, 1.0, 4.0)

    def symbol(self, word: str) -> int:
        if word in self.words or any(word[:n] in self.stems for n in range(SHORTEST_STEM, min(len(word), LONGEST_STEM) + 1)):
            return INSULT
        for symbol, listed in ((TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS), (THREAT, THREATS)):
            if word in listed:
                return symbol
        return OTHER


def run_clause(symbols: Sequence[int]) -> int | None:
    """The match kind of a clause: the composed transducers' output for its strongest match.

    States count down the words since a target, a negation and a report; an insult or a threat reads
    them and writes a kind. A target may also follow.
    """
    target = negation = report = 0
    pending = -1  # words left in which a target may still follow an unaimed match
    found, best = None, -1
    strength = {3: 0, 2: 1, 4: 2, 0: 3, 5: 4, 1: 5}
    for symbol in symbols:
        if symbol == TARGET:
            target = NEAR + 1
            if pending > 0 and found in (0, 4):
                found, best = (1, 5) if found == 0 else (5, 4)
        elif symbol == NEGATION:
            negation = NEAR
        elif symbol == REPORT:
            report = 2 * NEAR
        elif symbol in (INSULT, THREAT):
            if symbol == THREAT:
                kind = 5 if target else 4
            else:
                kind = 3 if report else 2 if negation else 1 if target else 0
            if strength[kind] > best:
                found, best = kind, strength[kind]
            pending = NEAR + 1
        target, negation, report, pending = max(target - 1, 0), max(negation - 1, 0), max(report - 1, 0), pending - 1
    return found


def _grams(rows: DataFrame, text: str) -> DataFrame:
    """(gram, whole, before, after): each word of each text, whole and by its beginnings, between its neighbours."""
    words = F.regexp_extract_all(F.lower(text), F.lit(r"\p{L}+"), F.lit(0))
    places = F.transform(F.col("words"), lambda w, i: F.struct(
        w.alias("word"), F.coalesce(F.get("words", i - 1), F.lit("")).alias("before"),
        F.coalesce(F.get("words", i + 1), F.lit("")).alias("after")))
    found = rows.select(words.alias("words")).select(F.explode(places).alias("p")).select("p.*")
    lengths = F.sequence(F.lit(SHORTEST_STEM), F.least(F.length("word"), F.lit(LONGEST_STEM)))
    stems = F.when(F.length("word") >= SHORTEST_STEM, F.transform(
        lengths, lambda n: F.struct(F.col("word").substr(F.lit(1), n).alias("gram"), F.lit(False).alias("whole"))))
    whole = F.array(F.struct(F.col("word").alias("gram"), F.lit(True).alias("whole")))
    return found.select("before", "after", F.explode(F.concat(whole, F.coalesce(stems, F.array_repeat(
        F.struct(F.col("word").alias("gram"), F.lit(False).alias("whole")), F.lit(0))))).alias("g")).select("g.*", "before", "after")


def _class_counts(toxic: DataFrame, clean: DataFrame, text: str) -> DataFrame:
    """(gram, whole, toxic, clean): independent places of a gram in toxic texts, and its places in clean ones.

    Copies of a text, edited or not, repeat a word between the same neighbours. Places count as
    independent if both neighbours differ from the gram's commonest ones, and one more for those.
    """
    places = _grams(toxic, text).distinct()
    common = places.groupBy("gram", "whole").agg(
        F.mode("before", True).alias("common_before"), F.mode("after", True).alias("common_after"),
        F.count("*").alias("n")).where(F.col("n") >= LEAST_PLACES).drop("n")
    apart = (F.col("before") != F.col("common_before")) & (F.col("after") != F.col("common_after"))
    counted = places.join(common, ["gram", "whole"]).groupBy("gram", "whole").agg(
        (F.count_if(apart) + 1).alias("toxic")).where(F.col("toxic") >= LEAST_PLACES)
    others = _grams(clean, text).groupBy("gram", "whole").agg(F.count("*").alias("clean"))
    return counted.join(others, ["gram", "whole"], "left").fillna(0, ["clean"])


def learn(labelled: DataFrame, text: str = "text", label: str = "toxic", least_odds: float = LEAST_ODDS) -> Grammar:
    """Learn insults and weights from a sample as ``labelled_sample`` makes it (text, label 0 or 1).

    Equal texts count once (as toxic, if any of them is). Match counts of the sampled rows and the
    lexicon are collected; both are bounded by the sample. Without toxic rows the grammar knows no insults.
    """
    labelled = keep(labelled.groupBy(text).agg(F.max(label).alias(label)))
    toxic, clean = labelled.where(F.col(label) == 1), labelled.where(F.col(label) == 0)
    size = labelled.groupBy(label).agg(F.sum(F.size(F.regexp_extract_all(F.lower(text), F.lit(r"\p{L}+"), F.lit(0)))).alias("n"))
    words_in = {r[label]: max(r["n"], 1) for r in size.collect()}
    if 1 not in words_in:
        return Grammar(frozenset(), frozenset())
    share = words_in[1] / (words_in[1] + words_in.get(0, 1))
    t, c = F.col("toxic"), F.col("clean")
    seen = t + c
    ratio = 2 * (t * F.log(t / (seen * share)) + F.when(c > 0, c * F.log(c / (seen * (1 - share)))).otherwise(0.0))
    odds = (t + 0.5) / words_in[1] / ((c + 0.5) / words_in.get(0, 1))
    counts = _class_counts(toxic, clean, text).where((ratio >= LEAST_RATIO) & (odds >= least_odds)).collect()
    words = {r["gram"] for r in counts if r["whole"]}
    stems = _stems({r["gram"]: (r["toxic"], r["clean"]) for r in counts if not r["whole"]})
    grammar = Grammar(frozenset(words), frozenset(stems))
    counted = _matches(labelled.select(text, label), grammar, text).select(label, "kinds").collect()
    return _fit(grammar, [list(r["kinds"]) for r in counted], [r[label] for r in counted])


def _stems(counts: dict[str, tuple[int, int]]) -> set[str]:
    """Of nested beginnings the shortest one, but lengthened while that loses clean places and hardly any toxic ones."""
    stems: set[str] = set()
    for gram in sorted(counts, key=lambda g: (len(g), g)):
        if any(gram[:n] in stems for n in range(SHORTEST_STEM, len(gram) + 1)):
            continue
        while counts[gram][1]:
            longer = max((g for g in counts if len(g) == len(gram) + 1 and g.startswith(gram)),
                         key=lambda g: (counts[g][0], g), default=None)
            if longer is None or counts[longer][0] < 0.9 * counts[gram][0] or counts[longer][1] >= counts[gram][1]:
                break
            gram = longer
        stems.add(gram)
    return stems


def _features(kinds: Sequence[Sequence[int]]) -> np.ndarray:
    """Matches of a kind count with falling force: log(1 + n)."""
    return np.log1p(np.array(kinds, dtype=float).reshape(-1, len(KINDS)))


def _fit(grammar: Grammar, kinds: list, labels: list[int], ridge: float = 0.05, steps: int = 50) -> Grammar:
    """Weights by ridge logistic regression (Newton steps), kept from going below zero."""
    x = np.column_stack([np.ones(len(kinds)), _features(kinds)])
    y = np.array(labels, dtype=float)
    w, penalty = np.zeros(x.shape[1]), np.diag([1e-6] + [ridge] * len(KINDS))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + penalty
        step = np.linalg.solve(hessian, x.T @ (y - p) - penalty @ w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return Grammar(grammar.words, grammar.stems, float(w[0]), tuple(float(max(v, 0.0)) for v in w[1:]))


def clause_reader(grammar: Grammar):
    """A function from texts to (number of clauses, match counts by kind, matched clauses) of each."""
    known = KnownWords(lambda words: list(map(grammar.symbol, words)))

    def one(text: str, words: list[str]) -> tuple[int, list[int], list[str]]:
        counts, matched = [0] * len(KINDS), []
        symbols = list(map(known.__getitem__, words))
        if INSULT not in symbols and THREAT not in symbols:
            return 0, counts, matched
        clauses = [c for c in zip(_CLAUSE.split(text), _CLAUSE.split(text.lower())) if c[0].strip()]
        for clause, lowered in clauses:
            kind = run_clause([known[w] for w in _WORDS.findall(lowered)])
            if kind is not None:
                counts[kind] += 1
                matched.append(f"{KINDS[kind]}: {clause.strip()}")
        return len(clauses), counts, matched

    def many(texts: list[str]) -> list[tuple[int, list[int], list[str]]]:
        words = [_WORDS.findall(t.lower()) for t in texts]
        known.learn(set().union(*words))
        return [one(t, w) for t, w in zip(texts, words)]

    return many


def _matches(docs: DataFrame, grammar: Grammar, text: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(grammar)

    def start():
        read = clause_reader(shared.value)
        return lambda texts: [[counts for _, counts, _ in read(texts)]]

    return with_text_columns(docs, text, T.StructType([field("kinds", T.ArrayType(T.IntegerType()))]), start)


def score(docs: DataFrame, grammar: Grammar, text: str = "text") -> DataFrame:
    """Add score (0 to 1), predicted (1 from 0.5 on), the number of clauses read and the matched clauses.

    A null or empty text matches nothing and gets the score of a text without matches. Clauses are
    counted in texts with an insult or threat only. Columns named like a result are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(grammar)

    def start():
        learnt: Grammar = shared.value
        read = clause_reader(learnt)
        weights = np.array(learnt.weights)

        def many(texts: list[str]) -> list:
            found = read(texts)
            force = learnt.bias + _features([counts for _, counts, _ in found]) @ weights
            scores = (1 / (1 + np.exp(-np.clip(force, -30, 30)))).tolist()
            return [scores, [int(s >= 0.5) for s in scores], [n for n, _, _ in found], [m for _, _, m in found]]

        return many

    return with_text_columns(docs, text, FIELDS, start)


def labelled_sample(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
                    label: str = "toxic", rows: int = SAMPLE_ROWS) -> DataFrame:
    """Up to ``rows`` labelled rows of each class, by hash of the id, with their texts.

    Only the bounded list of ids is broadcast; texts of other rows are not shuffled.
    """
    usable = labels.where(F.col(key).isNotNull() & F.col(label).isin(0, 1)).select(key, F.col(label).cast("int").alias(label))
    parts = [usable.where(F.col(label) == v).orderBy(F.xxhash64(key), key).limit(rows) for v in (0, 1)]
    chosen = parts[0].union(parts[1]).groupBy(key).agg(F.max(label).alias(label))
    return docs.where(F.col(text).isNotNull()).select(key, text).join(F.broadcast(chosen), key)
