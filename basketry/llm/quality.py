"""Quality rules by tokeniser fertility.

A public piece vocabulary with byte fallback measures every text: characters per token, the share of
byte-fallback tokens, and the entropy of the token distribution relative to the most that so many
tokens could have. Each script has fixed bands. Inside them, each script and language has narrower bands that
come from the quartiles of all its texts, so that a text is held against its own kind. A text outside
the bands is rejected, and so is one that fails the base rules (too few words, too much repetition).
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.llm.common import KnownWords, field, keep, with_text_columns
from basketry.session import hinted, lookup

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

# Unicode block ranges that tell the script of a letter.
SCRIPTS = {
    "latin": "A-Za-zÀ-ɏ", "greek": "Ͱ-Ͽ", "cyrillic": "Ѐ-ԯ",
    "hebrew": "֐-׿", "arabic": "؀-ۿ", "devanagari": "ऀ-ॿ",
    "thai": "฀-๿", "kana": "぀-ヿ", "han": "一-鿿", "hangul": "가-힯",
}


@dataclass(frozen=True)
class Band:
    """Accepted range of the three measures."""
    least_chars: float
    most_chars: float
    most_bytes: float
    least_entropy: float


# Scripts that the vocabulary covers well spell out little; sentences in the far scripts spell out up to a
# fifth, in scripts that SCRIPTS lacks any share is normal. Text without letters must be covered like Latin.
LATIN_BAND = Band(1.2, 9.0, 0.10, 0.35)
CLOSE_BAND = Band(0.8, 8.0, 0.50, 0.30)
LISTED_BAND = Band(0.25, 6.0, 0.40, 0.25)
FAR_BAND = Band(0.25, 6.0, 1.0, 0.25)
BANDS = {"latin": LATIN_BAND, "greek": CLOSE_BAND, "cyrillic": CLOSE_BAND, "none": LATIN_BAND,
         **dict.fromkeys(("hebrew", "arabic", "devanagari", "thai", "kana", "han", "hangul"), LISTED_BAND)}

# Bands of a script and language: its quartiles, widened by so many times their distance, which counts as
# this share of the median at least. Fewer different texts than LEAST_TEXTS have the fixed bands only.
WIDEN = 2.0
LEAST_SPREAD = 0.02
LEAST_TEXTS = 200
BYTES_SPARED = 0.02

FIELDS = T.StructType([
    field("n_words", T.LongType()), field("word_chars", T.LongType()), field("n_symbols", T.LongType()),
    field("n_dup_lines", T.LongType()), field("n_repeat_words", T.LongType()),
    field("base_failed", T.BooleanType()), field("script", T.StringType()),
    field("chars_per_token", T.DoubleType()), field("byte_share", T.DoubleType()),
    field("token_entropy", T.DoubleType()), field("kept", T.BooleanType()),
])

_WORDS = re.compile(r"[^\x20\x09-\x0D]+")
_SYMBOLS = re.compile(r"[#*$%&|<>]")
_BEYOND_LATIN = re.compile(r"[\u0250-\U0010ffff]")
_LETTERS = {name: re.compile(f"[{chars}]+") for name, chars in SCRIPTS.items()}


def repeated_words(words: list[str]) -> int:
    """Words covered by a 3-word window that occurs twice or more."""
    if len(words) < 4:
        return 0
    windows = list(zip(words, words[1:], words[2:]))
    counts = Counter(windows)
    if len(counts) == len(windows):
        return 0
    covered = total = 0
    for i, window in enumerate(windows):
        if counts[window] > 1:
            total += i + 3 - max(i, covered)
            covered = i + 3
    return total


def duplicate_lines(text: str) -> int:
    lines = [line for line in text.split("\n") if _WORDS.search(line)]
    return len(lines) - len(set(lines))


def script_of(text: str) -> str:
    """The script with most letters; ``other`` with letters of unknown scripts only, ``none`` without letters."""
    if not _BEYOND_LATIN.search(text):
        return "latin" if _LETTERS["latin"].search(text) else "none"
    best, most = "other", 0
    for name, letters in _LETTERS.items():
        n = sum(map(len, letters.findall(text)))
        if n > most:
            best, most = name, n
    return best if most or any(map(str.isalpha, text)) else "none"


def piece_measurer(model: str | None = None):
    """A function from lists of words to (characters per token, byte share, relative entropy) of each."""
    pieces = sentencepiece.SentencePieceProcessor(
        model_file=model or public_tokenizers.path("piece_bpe_32k.model"))
    is_byte = np.array([pieces.is_byte(i) for i in range(pieces.get_piece_size())])
    kind = np.uint16 if len(is_byte) < 65536 else np.uint32

    def tokens(words: list[str]) -> list[bytes]:
        found = pieces.encode(words, num_threads=1)
        flat = np.fromiter((i for ids in found for i in ids), dtype=kind).tobytes()
        ends = np.cumsum([len(ids) for ids in found]) * kind().itemsize
        return [flat[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]

    known = KnownWords(tokens)

    def measure(words: list[str]) -> tuple[float, float, float]:
        ids = np.frombuffer(b"".join(map(known.__getitem__, words)), dtype=kind)
        n = len(ids)
        if not n:
            return 0.0, 0.0, 0.0
        counts = np.bincount(ids) if n > 4000 else np.diff(
            np.flatnonzero(np.diff(np.sort(ids), prepend=-1, append=len(is_byte))))
        counts = counts[counts > 1]  # a token that occurs once adds nothing to the sum below
        bits = np.log2(n) - float((counts * np.log2(counts)).sum()) / n
        return sum(map(len, words)) / n, float(is_byte[ids].mean()), bits / np.log2(n) if n > 1 else 1.0

    def measure_all(texts: list[list[str]]) -> list[tuple[float, float, float]]:
        known.learn(set().union(*texts))
        return list(map(measure, texts))

    return measure_all


def measured(docs: DataFrame, text: str = "text", model: str | None = None, bands: dict[str, Band] = BANDS,
             other: Band = FAR_BAND) -> DataFrame:
    """Add the word counts, the three measures and the verdict ``kept`` of base rules and fixed bands."""

    def start():
        measure_all = piece_measurer(model)

        def one(text: str, words: list[str], measures: tuple[float, float, float]) -> tuple:
            n, chars = len(words), sum(map(len, words))
            repeats = repeated_words(words)
            failed = n < MIN_WORDS or 100 * repeats > MAX_REPEAT_PERCENT * n
            per_token, byte_share, entropy = measures
            script = script_of(text)
            band = bands.get(script, other)
            good = (band.least_chars <= per_token <= band.most_chars and byte_share <= band.most_bytes
                    and entropy >= band.least_entropy)
            return (n, chars, len(_SYMBOLS.findall(text)), duplicate_lines(text), repeats, failed, script,
                    per_token, byte_share, entropy, bool(good and not failed))

        def many(texts: list[str]) -> list:
            words = list(map(_WORDS.findall, texts))
            return list(zip(*map(one, texts, words, measure_all(words)))) or [[]] * len(FIELDS)

        return many

    return with_text_columns(docs, text, FIELDS, start)


def corpus_bands(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The bands of each script and language, from all its texts that base rules and fixed bands keep.

    Texts with equal measures count once, so copies move no band.
    """
    measures = {"chars_per_token": 4, "byte_share": 4, "token_entropy": 4}  # so few values that exact quartiles are small
    texts = rows.where("kept").select(*keys, *[F.round(c, n).alias(c) for c, n in measures.items()]).distinct()
    groups = texts.groupBy(*keys).agg(F.count("*").alias("n"), *[
        F.percentile(c, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias(c) for c in measures])

    def fence(name: str, side: int):
        low, middle, high = (F.col(name)[i] for i in range(3))
        spread = WIDEN * F.greatest(high - low, LEAST_SPREAD * middle)
        return low - spread if side < 0 else high + spread

    return groups.where(F.col("n") >= LEAST_TEXTS).select(
        *keys, fence("chars_per_token", -1).alias("__least_chars"), fence("chars_per_token", 1).alias("__most_chars"),
        (fence("byte_share", 1) + BYTES_SPARED).alias("__most_bytes"), fence("token_entropy", -1).alias("__least_entropy"))


def within_corpus(rows: DataFrame, language: str = "lang") -> DataFrame:
    """``measured`` rows with ``kept`` narrowed to the bands of their script and language. Runs Spark jobs.

    Rows without the language column are held against their script alone; a null language is one more
    language. The rows are read twice, so they should be stored.
    """
    columns = rows.columns
    tongue = F.coalesce(F.col(language).cast("string"), F.lit("")) if language in columns else F.lit("")
    rows = rows.withColumns({"__script": F.col("script"), "__language": tongue})
    bands, small = lookup(corpus_bands(rows, ["__script", "__language"]))
    inside = (F.col("chars_per_token").between(F.col("__least_chars"), F.col("__most_chars"))
              & (F.col("byte_share") <= F.col("__most_bytes")) & (F.col("token_entropy") >= F.col("__least_entropy")))
    return rows.join(hinted(bands, small), ["__script", "__language"], "left").withColumn(
        "kept", F.col("kept") & F.coalesce(inside, F.lit(True))).select(*columns)


def judge(docs: DataFrame, text: str = "text", model: str | None = None, bands: dict[str, Band] = BANDS,
          other: Band = FAR_BAND, language: str = "lang") -> DataFrame:
    """Add the word counts, the three measures and the verdict ``kept`` to every document. Runs Spark jobs.

    A null or empty text has no words and is not kept. Repeated rows are judged alike. Columns named
    like a result are replaced. Drop the text after ``measured`` where it need not be stored.
    """
    return within_corpus(keep(measured(docs, text, model, bands, other)), language)


def quality_filter(docs: DataFrame, text: str = "text", language: str = "lang") -> DataFrame:
    """The documents that the rules keep, with their own columns. Runs Spark jobs."""
    own = {c: f"__own_{c}" for c in docs.columns if c in FIELDS.names}
    rows = keep(measured(docs.withColumnsRenamed(own), text).where("kept"))
    return within_corpus(rows, language).where("kept").select(*[own.get(c, c) for c in docs.columns]) \
        .withColumnsRenamed({v: k for k, v in own.items()})
