"""The pipeline and the registered corpus queries against brute force over a whole small table."""

import math
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from test_corpus_operators import brute_classes, brute_quality, brute_spans, library  # noqa: F401

import __spark_entry__ as contract
import corpus_pipeline
from basketry.llm import langid, packing, pii, quality
from basketry.llm.common import documents
from tools.compare import compare, connect

COLUMNS = {
    "op1": {"doc_id", "held_out", "lang_pred", "score"},
    "op2": {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"},
    "op3": {"doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"},
    "op4": {"doc_id", "held_out", "score", "predicted"}, "op5": {"doc_id", "class_id", "n_links"},
    "op6": {"doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"},
    "op7": {"doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"},
    "op8": {"doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"},
    "op9": {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"},
    "op10": {"doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"},
}


def test_every_corpus_query_is_registered():
    names = [n for n in contract.queries() if n.startswith("op") and n[2].isdigit()]
    assert sorted(n.split("_")[0] for n in names) == sorted(COLUMNS) and "pipeline" in contract.queries()
    assert [f.__name__ for _, f in corpus_pipeline.STAGES] == [
        "quality_stage", "language_stage", "near_duplicate_stage", "personal_data_stage", "packing_stage"]


@pytest.mark.parametrize("name", [n for n in contract.queries() if n.split("_")[0] in COLUMNS])
def test_query_has_a_row_for_each_document(spark, data, name):
    if name in contract.oracle_sql():
        good, note = compare(spark, connect(data), data, name, contract.oracle_sql()[name])
        assert good, note
    found = contract.queries()[name](spark, data)
    assert COLUMNS[name.split("_")[0]] <= set(found.columns)
    ids = sorted(r["doc_id"] for r in documents(spark, data).select("doc_id").collect())
    rows = sorted(r["doc_id"] for r in found.select("doc_id").collect())
    assert (sorted(set(rows)) if name.startswith("op2_") else rows) == ids


def brute_model(rows):
    """The language model by plain counting."""
    words = defaultdict(Counter)
    for lang, text in rows:
        words[lang].update(langid.words_of(text))
    languages = tuple(sorted(words))
    found, grams = [], []
    for lang, counts in words.items():
        found += [(lang, w, n / counts.total()) for w, n in counts.items() if n >= langid.WORD_SHARE * counts.total()]
        for order in langid.ORDERS:
            pieces = Counter()
            for w, n in counts.items():
                for g in langid.grams_of(w, order):
                    pieces[g] += n
            grams += [(lang, g, n / pieces.total()) for g, n in pieces.items() if n >= langid.GRAM_SHARE * pieces.total()]
    return langid.Model(languages, langid._log_table(found, languages, langid.WORD_SHARE),
                        langid._log_table(grams, languages, langid.GRAM_SHARE))


def brute_language(model, text):
    words = langid.words_of(text)
    if not any(c.isalpha() for c in text):
        return "und", 0.0
    totals = [sum(langid.word_scores(model, w)[k] for w in words) / math.sqrt(len(words)) for k in range(len(model.languages))]
    odds = [math.exp(t - max(totals)) for t in totals]
    return model.languages[odds.index(max(odds))], max(odds) / sum(odds)


def test_pipeline_equals_brute_force(spark, data, library):  # noqa: F811
    docs = [(r["doc_id"], r["text"], r["lang"]) for r in documents(spark, data).collect()]
    pieces = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))

    def good(text):
        if brute_quality(text)[-1]:
            return False
        words = text.split()
        ids = [i for w in words for i in pieces.encode(w)]
        shares = [n / len(ids) for n in Counter(ids).values()]
        entropy = -sum(p * math.log2(p) for p in shares) / math.log2(len(ids))
        band = quality.BANDS.get(quality.script_of(text), quality.FAR_BAND)
        spelt = sum(map(pieces.is_byte, ids)) / len(ids)
        return (band.least_chars <= sum(map(len, words)) / len(ids) <= band.most_chars and spelt <= band.most_bytes
                and entropy >= band.least_entropy)

    docs = [d for d in docs if good(d[1])]
    model = brute_model([(lang, text) for i, text, lang in docs if lang and zlib.crc32(str(i).encode()) % 4 != 2])
    judged = {i: brute_language(model, text) for i, text, _ in docs}
    docs = [d for d in docs if judged[d[0]][0] != "und" and judged[d[0]][1] >= langid.LEAST_SCORE]
    classes = brute_classes([(i, text) for i, text, _ in docs])
    docs = [d for d in docs if classes[d[0]][0] == d[0]]
    expected = Counter()
    for i, text, _ in docs:
        base = brute_spans(text)
        ids = library.encode(pii.mask(text, base + pii.added_spans(text, base)), add_special_tokens=False).ids + [packing.SEPARATOR]
        for k, (a, n) in enumerate(packing.cut(len(ids), 1024)):
            expected[i, k, a, n, zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids[a:a + n]))] += 1
    assert docs and corpus_pipeline.ORACLE_SQL is None
    placed = corpus_pipeline.run(spark, data).collect()
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in placed) == expected
    ends = defaultdict(int)
    for r in sorted(placed, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends[r["sequence_id"]]
        ends[r["sequence_id"]] += r["length"]
    assert max(ends.values()) <= 1024


def test_stages_keep_the_columns_and_take_empty_tables(spark, data):
    docs = documents(spark, data)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs.where("false"), data)
        assert kept.columns == docs.columns and kept.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs.where("false"), data).count() == 0
