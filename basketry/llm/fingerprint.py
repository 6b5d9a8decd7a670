"""Document fingerprints as threshold-scaled sketches.

A text's shingles are five consecutive words (all its words, if fewer). Each is hashed with MD5, and
every hash below a fixed fraction of the range is kept. Sketches of any two texts are samples of one
and the same hash range, so they can be merged, and the share of one sketch found in another estimates
containment, however unequal the texts are. A text whose sketch would be empty keeps its least hash.
Only built-in functions run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.common import WORD
from basketry.llm.ordering import RANGE, key_ranges

SHINGLE_WORDS = 5
# Hashes whose first hex digit is below this one are kept: an eighth of the range.
BELOW = "2"
HASH_DIGITS = 16


def shingle_hashes(text: Column, words: int = SHINGLE_WORDS) -> Column:
    """The MD5 hashes (hex, shortened) of all shingles of a text; none without words."""
    found = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))

    def of(array: Column) -> Column:
        n = F.size(array)
        starts = F.sequence(F.lit(1), F.greatest(n - (words - 1), F.lit(1)))
        return F.when(n > 0, F.transform(starts, lambda i: F.substring(F.md5(F.array_join(
            F.slice(array, i, words), " ").cast("binary")), 1, HASH_DIGITS))).otherwise(F.array().cast("array<string>"))

    # A lambda names the array once, so that the text is split once.
    return F.transform(F.array(found), of)[0]


def sketch(text: Column, words: int = SHINGLE_WORDS, below: str = BELOW) -> Column:
    """The hashes below the threshold, distinct and sorted; the least hash if none is below."""

    def of(hashes: Column) -> Column:
        low = F.array_sort(F.array_distinct(F.filter(hashes, lambda h: h < below)))
        return F.when((F.size(low) == 0) & (F.size(hashes) > 0), F.array(F.array_min(hashes))).otherwise(low)

    return F.transform(F.array(shingle_hashes(text, words)), of)[0]


def containment(a: Column, b: Column) -> Column:
    """The share of the smaller sketch that the other one holds; two empty ones are alike, one is not."""
    least = F.least(F.size(a), F.size(b))
    return F.when(F.greatest(F.size(a), F.size(b)) == 0, 1.0).when(least == 0, 0.0).otherwise(
        F.size(F.array_intersect(a, b)) / least)


def jaccard(a: Column, b: Column) -> Column:
    """The common share of two sketches; 1 for two empty ones."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / union)


def merge(sketches: DataFrame, by: list[str], column: str = "sketch", below: str = BELOW) -> DataFrame:
    """The sketch of several texts together, by keys: that of all their shingles.

    It is the union of theirs without the least hashes that stood in for empty sketches, or, where all
    are such, the least of them.
    """
    hashes = sketches.select(*by, F.explode(column).alias("hash")).distinct()
    low = F.array_sort(F.collect_list(F.when(F.col("hash") < below, F.col("hash"))))
    return hashes.groupBy(*by).agg(low.alias(column), F.min("hash").alias("__least")).withColumn(
        column, F.when(F.size(column) == 0, F.array("__least")).otherwise(F.col(column))).drop("__least")


def compare_with_next(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited form, and their likeness.

    The next document has the next lower key (after the lowest comes the highest; rows with equal keys
    follow each other by text, a null key comes last). The edited text replaces the last half of the code
    points by the first as many of the next document's, or all of them. Each document meets its next one
    inside a key range; a range also gets the first document of the next range that has any.
    A null text is empty. One document alone is its own next. Other columns are left out.
    """
    base = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    ranges = key_ranges(base.select("key"), "key")
    rows = base.withColumn(RANGE, ranges.of(F.col("key")))
    first = F.struct(F.col("key").isNotNull().alias("known"), "key")
    heads = rows.groupBy(RANGE).agg(F.max(first)["key"].alias("top"))  # one row for each range
    every = Window.partitionBy().orderBy(F.col(RANGE).desc())
    whole = every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # The range before takes the head; the highest range's head closes the circle in the lowest.
    takers = heads.select(F.col("top").alias("__top"), F.col(RANGE).alias("__from"),
                          F.coalesce(F.lag(RANGE).over(every), F.last(RANGE).over(whole)).alias("__to"))
    at_head = rows["key"].eqNullSafe(F.col("__top")) & (rows[RANGE] == F.col("__from"))
    guests = rows.join(F.broadcast(takers), at_head).groupBy(F.col("__to").alias(RANGE)).agg(
        F.min("text").alias("text"))
    column = sketch(F.col("text"))
    both = rows.select("key", "text", RANGE, F.lit(0).alias("guest")).unionByName(
        guests.select(F.lit(None).cast(rows.schema["key"].dataType).alias("key"), "text", RANGE, F.lit(1).alias("guest")))
    inside = Window.partitionBy(RANGE).orderBy("guest", F.col("key").desc_nulls_last(), "text")
    met = both.withColumn("sketch", column).select(
        "key", "text", "guest", "sketch", F.lead("text").over(inside).alias("next_text"),
        F.lead("sketch").over(inside).alias("next_sketch")).where("guest = 0")
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next_text"), F.lit(1), half))
    done = met.withColumn("edited", edited).withColumn("edited_sketch", sketch(F.col("edited")))
    return done.select(
        F.col("key").alias(key), n.cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        F.array_join("sketch", "").alias("fingerprint"), F.array_join("edited_sketch", "").alias("edited_fingerprint"),
        containment(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        containment(F.col("sketch"), F.col("next_sketch")).alias("near_next"))
