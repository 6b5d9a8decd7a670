"""Language identification by words first, character n-grams after.

Training counts every word of the labelled texts per language, then the character n-grams of all
those words, weighted by the words' counts. A word or n-gram is kept if it makes up a given share of a
language's words or of its n-grams of that order, so the model has at most (languages / share) entries
however large the corpus is. A known word scores by its log frequency in each language; an unseen one
by the mean log frequency of its longest known n-grams.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.llm.common import KnownWords, field, keep, release_memory, with_text_columns

UNDETERMINED = "und"
ORDERS = (4, 3, 2, 1)
WORD_SHARE = 1e-5
GRAM_SHARE = 1e-5
# Counts held in a task before they are passed on.
HELD_COUNTS = 150_000
# Below this score the pipeline takes a text's language as unknown.
LEAST_SCORE = 0.5

_WORDS = re.compile(r"[^\W\d_]+")
FIELDS = T.StructType([field("lang_pred", T.StringType()), field("score", T.DoubleType())])


@dataclass(frozen=True)
class Model:
    """Languages in order, and log frequencies per language of known words and n-grams."""
    languages: tuple[str, ...]
    words: dict[str, tuple[float, ...]]
    grams: dict[str, tuple[float, ...]]


def words_of(text: str) -> list[str]:
    return _WORDS.findall(text.lower())


def grams_of(word: str, order: int) -> list[str]:
    padded = f" {word} "
    return [padded[i:i + order] for i in range(len(padded) - order + 1)]


def _counted(df: DataFrame, items) -> DataFrame:
    """(lang, item, n) summed over rows (lang, value, weight); ``items(value, weight)`` gives item counts."""
    schema = T.StructType([field("lang", T.StringType()), field("item", T.StringType()), field("n", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}

        def flush():
            for lang, counts in held.items():
                yield pa.RecordBatch.from_arrays([
                    pa.array([lang], pa.string()).take(pa.array([0] * len(counts), pa.int32())),
                    pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=schema.names)
            held.clear()

        for batch in batches:
            for lang, value, weight in zip(*(c.to_pylist() for c in batch.columns)):
                items(held.setdefault(lang, Counter()), value, weight)
            if sum(map(len, held.values())) > HELD_COUNTS:
                yield from flush()
        yield from flush()
        release_memory()

    return df.mapInArrow(run, schema).groupBy("lang", "item").agg(F.sum("n").alias("n"))


def _add_words(counts: Counter, text: str, weight: int) -> None:
    counts.update(words_of(text))


def _add_grams(counts: Counter, word: str, weight: int) -> None:
    for order in ORDERS:
        for gram in grams_of(word, order):
            counts[gram] += weight


def _frequent(counts: DataFrame, by: list[str], share: float) -> list:
    """The entries that make up at least ``share`` of their group's total; bounded by groups / share."""
    totals = counts.groupBy(*by).agg(F.sum("n").alias("total"))
    return counts.join(F.broadcast(totals), by).where(F.col("n") >= share * F.col("total")) \
        .select("lang", "item", (F.col("n") / F.col("total")).alias("share")).collect()


def _log_table(rows: list, languages: tuple[str, ...], least: float) -> dict[str, tuple[float, ...]]:
    """item -> log share per language; a language without the item gets a fraction of the least share."""
    at = {lang: i for i, lang in enumerate(languages)}
    floor = float(np.log(least / 10))
    table: dict[str, list[float]] = {}
    for lang, item, share in rows:
        table.setdefault(item, [floor] * len(languages))[at[lang]] = float(np.log(share))
    return {item: tuple(values) for item, values in table.items()}


def train(labelled: DataFrame, text: str = "text", lang: str = "lang", word_share: float = WORD_SHARE,
          gram_share: float = GRAM_SHARE) -> Model:
    """Learn from all rows that have a text and a language. Runs Spark jobs; only the bounded model is collected."""
    rows = labelled.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(
        F.col(lang).alias("lang"), F.col(text).alias("value"), F.lit(1).cast("long").alias("weight"))
    words = keep(_counted(rows, _add_words))
    known = _frequent(words, ["lang"], word_share)
    grams = keep(_counted(words.select("lang", F.col("item").alias("value"), F.col("n").alias("weight")), _add_grams)
                 .withColumn("order", F.length("item")))
    pieces = _frequent(grams, ["lang", "order"], gram_share)
    languages = tuple(sorted({r["lang"] for r in known}))
    return Model(languages, _log_table(known, languages, word_share), _log_table(pieces, languages, gram_share))


def word_scores(model: Model, word: str) -> tuple[float, ...]:
    """Log frequency of a known word per language, else the mean of its longest known n-grams, else zeros."""
    if word in model.words:
        return model.words[word]
    for order in ORDERS:
        found = [model.grams[g] for g in grams_of(word, order) if g in model.grams]
        if found:
            return tuple(sum(v) / len(found) for v in zip(*found))
    return (0.0,) * len(model.languages)


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add ``lang_pred`` and ``score`` (0 to 1, the share of the evidence) to every document.

    A text that is null or has no letter is ``und`` with score 0, and so is any text under a model
    without languages. Ties go to the language that sorts first. Columns named like a result are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def start():
        learnt: Model = shared.value
        n = len(learnt.languages)
        known = KnownWords(lambda words: [np.array(word_scores(learnt, w)).tobytes() for w in words])

        def one(words: list[str]) -> tuple[str, float]:
            if not n or not any(c.isalpha() for w in words for c in w):
                return UNDETERMINED, 0.0
            scores = np.frombuffer(b"".join(map(known.__getitem__, words))).reshape(-1, n).sum(axis=0)
            # Words of a text depend on each other: evidence counts as the root of their number.
            odds = np.exp((scores - scores.max()) / np.sqrt(len(words)))
            best = int(odds.argmax())
            return learnt.languages[best], float(odds[best] / odds.sum())

        def many(texts: list[str]) -> list:
            words = list(map(words_of, texts))
            known.learn(set().union(*words))
            return list(zip(*map(one, words))) or [[], []]

        return many

    return with_text_columns(docs, text, FIELDS, start)


def held_out(key: Column | str, parts: int = 4, part: int = 2) -> Column:
    """Whether a row's id falls into the part that is never learnt from."""
    return F.crc32(F.col(key).cast("string") if isinstance(key, str) else key.cast("string")) % parts == part


def language_filter(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id",
                    least: float = LEAST_SCORE) -> DataFrame:
    """The documents whose language is told with enough certainty, with their own columns."""
    model = train(docs.where(~held_out(key)).select(text, lang), text, lang)
    own = {c: f"__own_{c}" for c in docs.columns if c in FIELDS.names}
    judged = identify(docs.withColumnsRenamed(own), model, text)
    return judged.where((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= least)) \
        .select(*[own.get(c, c) for c in docs.columns]).withColumnsRenamed({v: k for k, v in own.items()})
