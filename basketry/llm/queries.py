"""Registered queries of the corpus operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm import (bpe, conversation_trie, exact_dedup, fingerprint, langid, licenses, ngram_join, packing,
                          periodic_runs, pii, quality, sharding, toxicity)
from basketry.llm.common import WORD, documents, keep, prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build
    return register


@query("op1_language_backoff")
def _language(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text", "lang")
    model = langid.train(docs.where(~langid.held_out("doc_id")).select("text", "lang"))
    return langid.identify(docs.select("doc_id", "text"), model).select(
        "doc_id", langid.held_out("doc_id").alias("held_out"), "lang_pred", "score")


@query("op2_best_fit_packing")
def _packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(documents(spark, folder))


@query("op3_skip_chain_crf")
def _personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return pii.find_personal_data(documents(spark, folder).select("doc_id", "text")).drop("text", "masked")


@query("op4_pattern_grammar")
def _toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text")
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic")
    away = langid.held_out("doc_id", 5, 0)
    grammar = toxicity.learn(toxicity.labelled_sample(docs, labels.where(~away)))
    return toxicity.score(docs, grammar).select("doc_id", away.alias("held_out"), "score", "predicted", "n_clauses")


@query("op5_minhash_bands")
def _near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.link_classes(documents(spark, folder)).drop("node", "class_node")


@query("op6_tokeniser_fertility")
def _quality(spark: SparkSession, folder: str) -> DataFrame:
    rows = quality.measured(documents(spark, folder).select("doc_id", "text", "lang")).drop("text")
    return quality.within_corpus(keep(rows)).drop("lang")


_FINGERPRINT_SQL = """
WITH sketches(doc_id, text, sketch) AS (
    SELECT doc_id, text, CASE WHEN len(hashes) > 0 AND len(low) = 0 THEN [list_min(hashes)] ELSE low END
    FROM (SELECT doc_id, text, hashes, list_sort(list_distinct(list_filter(hashes, lambda h: h < '2'))) AS low
          FROM (SELECT doc_id, text, {hashes} AS hashes
                FROM (SELECT doc_id, coalesce(text, '') AS text, {words} AS words FROM documents)))),
pairs AS (
    SELECT doc_id, text, sketch,
           coalesce(lead(text) OVER (ORDER BY doc_id DESC), first_value(text) OVER (ORDER BY doc_id DESC)) AS next_text,
           coalesce(lead(sketch) OVER (ORDER BY doc_id DESC), first_value(sketch) OVER (ORDER BY doc_id DESC)) AS next_sketch
    FROM sketches),
edits AS (
    SELECT *, substr(text, 1, length(text) - length(text) // 2) || substr(next_text, 1, length(text) // 2) AS edited
    FROM pairs),
edited_sketches AS (
    SELECT * REPLACE (CASE WHEN len(hashes) > 0 AND len(low) = 0 THEN [list_min(hashes)] ELSE low END AS low)
    FROM (SELECT *, list_sort(list_distinct(list_filter(hashes, lambda h: h < '2'))) AS low
          FROM (SELECT *, {hashes} AS hashes FROM (SELECT *, {edited_words} AS words FROM edits))))
SELECT doc_id, length(text)::BIGINT AS n_chars, sha256(edited) AS edited_sha256,
       array_to_string(sketch, '') AS fingerprint, array_to_string(low, '') AS edited_fingerprint,
       {near_edited} AS near_edited, {near_next} AS near_next
FROM edited_sketches"""


def _fingerprint_sql() -> str:
    words = "regexp_extract_all({0}, '[^\\x20\\x09-\\x0D]+')"
    hashes = ("CASE WHEN len(words) = 0 THEN []::VARCHAR[] ELSE list_transform(range(1, greatest(len(words) - 4, 1) + 1), "
              "lambda i: substr(md5(array_to_string(words[i:i + 4], ' ')), 1, 16)) END")
    near = ("CASE WHEN greatest(len({0}), len({1})) = 0 THEN 1.0 WHEN least(len({0}), len({1})) = 0 THEN 0.0 "
            "ELSE len(list_intersect({0}, {1}))::DOUBLE / least(len({0}), len({1})) END")
    return _FINGERPRINT_SQL.format(
        hashes=hashes, words=words.format("coalesce(text, '')"), edited_words=words.format("edited"),
        near_edited=near.format("sketch", "low"), near_next=near.format("sketch", "next_sketch"))


@query("op7_scaled_sketch", _fingerprint_sql())
def _fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprint.compare_with_next(documents(spark, folder))


# The usual table of CRC-32, made on the spot.
_CRC_CODES = """codes AS (
    SELECT list(list_reduce(list_concat([i::UBIGINT], [0, 1, 2, 3, 4, 5, 6, 7]::UBIGINT[]), lambda c, k:
        CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384::UBIGINT) ELSE c // 2 END) ORDER BY i) AS code
    FROM range(256) AS r(i))"""

# CRC-32 byte by byte over the text's hex digits.
_SHARDING_SQL = f"""
WITH {_CRC_CODES},
sized AS (
    SELECT doc_id, (coalesce(strlen(text), 0) + 1)::BIGINT AS size,
           xor(list_reduce(list_concat([4294967295::UBIGINT], list_transform(range(coalesce(strlen(text), 0)), lambda i:
               (instr('0123456789ABCDEF', hex(encode(text))[2 * i + 1]) * 16 + instr('0123456789ABCDEF', hex(encode(text))[2 * i + 2]) - 17)::UBIGINT)),
               lambda c, b: xor(c // 256, code[(xor(c, b) % 256)::BIGINT + 1])), 4294967295::UBIGINT)::BIGINT AS text_crc32
    FROM documents, codes),
placed AS (
    SELECT *, (8 * (2 * sum(size) OVER (ORDER BY doc_id NULLS FIRST, text_crc32, size ROWS UNBOUNDED PRECEDING) - size)
               // (2 * sum(size) OVER ()))::INTEGER AS shard
    FROM sized)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1 AS slot,
       NULL::INTEGER AS grown_shard
FROM placed"""


@query("op8_prefix_sum_shards", _SHARDING_SQL)
def _shards(spark: SparkSession, folder: str) -> DataFrame:
    placed = sharding.shard_by_bytes(documents(spark, folder).select("doc_id", "text"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


@query("op9_bpe_codec")
def _bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.digests(documents(spark, folder).select("doc_id", "text")).drop("text")


@query("op10_rare_word_index")
def _licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(documents(spark, folder)).drop("matches")


_COPIES_SQL = """
SELECT doc_id, max(doc_id) OVER copies AS keep_id, count(*) OVER copies AS group_size,
       doc_id = max(doc_id) OVER copies AS kept, sha256(norm) AS text_sha256
FROM (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
      FROM documents)
WINDOW copies AS (PARTITION BY norm)"""


@query("op11_perfect_hash_dedup", _COPIES_SQL)
def _copies(spark: SparkSession, folder: str) -> DataFrame:
    """The documents with the greater ids are the history, the others are looked up in it."""
    rows = exact_dedup.digest_rows(documents(spark, folder))
    middle = rows.agg(F.percentile_approx("id", 0.5)).first()[0]
    past = F.col("id") >= F.lit(middle)
    history = exact_dedup.build_history(rows.where(past))
    found = exact_dedup.look_up(rows.where(past.isNull() | ~past), history)
    return exact_dedup.mark(rows, exact_dedup.verdicts(found)).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256")


def periodic_tails(docs: DataFrame) -> DataFrame:
    """(doc_id, text): with h the checksum of the id, texts with h % 10 = 0 go on periodically from word (h / 10) % n."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = docs.select("doc_id", "text", F.floor(h / 10).alias("g"),
                        F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(WORD), F.lit(0))).alias("words"))
    placed = words.withColumn("n", F.size("words")).withColumn(
        "a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    placed = placed.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    rewritten = F.array_join(F.transform(
        F.sequence(F.lit(0), F.col("n") - 1),
        lambda i: F.col("words")[F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))]), " ")
    return placed.select("doc_id", F.when(F.col("n") > 0, rewritten).otherwise(F.col("text")).alias("text"))


@query("op12_repair_runs")
def _periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic_runs.find_runs(periodic_tails(documents(spark, folder)), "text", "text")
    best = F.col("strongest")
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"),
        best["length"].alias("length"), best["period"].alias("period"),
        F.expr("1000 * strongest.length div strongest.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("text", 256).alias("collapsed_sha256"))


_TRIE_SQL = f"""
WITH {_CRC_CODES},
ordered AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS position,
           md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS key,
           length(coalesce(text, '')) AS chars
    FROM conversations),
convs AS (
    SELECT conv_id, conv_id - conv_id % 100 AS base,
           (xor(list_reduce(list_concat([4294967295::UBIGINT], list_transform(range(1, length(conv_id::VARCHAR) + 1),
               lambda i: ascii(substr(conv_id::VARCHAR, i::BIGINT, 1))::UBIGINT)),
               lambda c, b: xor(c // 256, code[(xor(c, b) % 256)::BIGINT + 1])), 4294967295::UBIGINT) % 6)::BIGINT AS h
    FROM (SELECT DISTINCT conv_id FROM conversations), codes),
rebuilt AS (
    SELECT c.conv_id, 0 AS part, o.position, key, chars FROM convs c JOIN ordered o ON o.conv_id = base AND position < h
    UNION ALL
    SELECT c.conv_id, 1, o.position, key, chars FROM convs c JOIN ordered o ON o.conv_id = c.conv_id AND position >= h),
paths AS (
    SELECT c.conv_id, coalesce(list(key ORDER BY part, position) FILTER (key IS NOT NULL), []) AS keys,
           coalesce(list(chars ORDER BY part, position) FILTER (key IS NOT NULL), []) AS chars
    FROM convs c LEFT JOIN rebuilt USING (conv_id) GROUP BY c.conv_id),
steps AS (
    SELECT conv_id, depth, array_to_string(keys[1:depth], '') AS node, len(keys) = depth AS ending,
           CASE WHEN depth > 0 THEN array_to_string(keys[1:depth - 1], '') END AS parent,
           CASE WHEN depth > 0 THEN chars[depth] ELSE 0 END AS chars
    FROM (SELECT *, unnest(range(0, len(keys) + 1)) AS depth FROM paths)),
nodes AS (
    SELECT node, any_value(parent) AS parent, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
           any_value(chars) AS chars,
           sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ending), '')) AS ends_sha256
    FROM steps GROUP BY node),
grown AS (
    SELECT n.*, p.conv_id AS parent_conv_id, coalesce(k.n_children, 0) AS n_children
    FROM nodes n LEFT JOIN nodes p ON p.node = n.parent
    LEFT JOIN (SELECT parent, count(*) AS n_children FROM nodes GROUP BY parent) k ON k.parent = n.node),
below AS (
    SELECT substr(node, 1, 32 * up) AS node, sum((n_convs - 1) * chars) AS saved,
           count(*) FILTER (n_children = 0) AS leaves
    FROM (SELECT *, unnest(range(0, depth + 1)) AS up FROM grown) GROUP BY ALL)
SELECT conv_id, depth, parent_conv_id, n_convs, n_children, leaves AS n_leaves, saved::BIGINT AS saved_tokens, ends_sha256
FROM grown JOIN below USING (node)"""


def share_heads(numbered: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rebuilt turns, conversations): the first h turns of conversation c come from c - c % 100, h the checksum of c modulo 6."""
    h = (F.crc32(F.col("conv").cast("string").cast("binary")) % 6).alias("h")
    counted = numbered.groupBy("conv").agg(F.count("*").alias("turns")).select(
        "conv", h, (F.col("conv") - F.col("conv") % 100).alias("base"), "turns")
    first = numbered.where((F.col("conv") % 100 == 0) & (F.col("position") < 5))  # h is 5 at most
    sizes = counted.where(F.col("conv") == F.col("base")).select("base", F.col("turns").alias("base_turns"))
    convs = keep(counted.join(sizes, "base", "left").select(
        "conv", "base", "h", F.least("h", F.coalesce("base_turns", F.lit(0).cast("long"))).alias("shared")))
    heads = convs.join(first.withColumnRenamed("conv", "base"), "base").where(F.col("position") < F.col("h"))
    own = numbered.join(convs, "conv").where(F.col("position") >= F.col("h")).withColumn(
        "position", F.col("position") - F.col("h") + F.col("shared"))
    names = ["conv", "position", "id", "chars"]
    return keep(heads.select(*names).unionByName(own.select(*names))), convs.select("conv")


@query("op13_radix_trie", _TRIE_SQL)
def _conversations(spark: SparkSession, folder: str) -> DataFrame:
    turns = prepare(spark).read.parquet(f"{folder}/conversations.parquet")
    numbered, width = conversation_trie.number_turns(conversation_trie.encode_turns(turns))
    rebuilt, conversations = share_heads(numbered)
    return conversation_trie.prefix_trie(rebuilt, width, conversations).drop("node", "parent")
