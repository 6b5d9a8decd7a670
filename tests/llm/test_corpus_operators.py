"""The corpus operators against brute force, on small rows with every awkward case."""

import hashlib
import math
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

from basketry.llm import (bpe, fingerprint, langid, licenses, ngram_join, packing, pii, quality,  # noqa: E402
                          sharding, toxicity)
from basketry.llm.common import prepare  # noqa: E402
from basketry.llm.components import connected_components  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, shard int, spans int, n_words int"
EXTRA = ("score", "shard", "spans", "n_words")


def rows_of(texts, ids=None, lang="en"):
    return [(i, t, lang, "s", None if t is None else len(t), "own", -1, -2, -3)
            for i, t in zip(ids or range(len(texts)), texts)]


@pytest.fixture(scope="module")
def odd(spark):
    """Null and empty texts, null ids, ties, repeated rows, very long texts, columns named like results."""
    prepare(spark)
    rng = random.Random(7)
    letters = " \n\tabcdefghiorstu'0123.,-!éßñ日　_<|>²+@%#"
    texts = [None, "", " ", "a", "  two  spaces ", "x<|endoftext|>y", "\x00\x01\x1c é", "日本語 テキスト", "word " * 9000,
             "a" * 30_000, "b" * 5 + " " * 5000, "one two three four five six", "one two three four five six"]
    texts += ["".join(rng.choice(letters) for _ in range(rng.randint(0, 300))) for _ in range(60)]
    rows = rows_of(texts)
    rows += [rows[11], rows[11], (None, "lonely text", None, None, None, None, None, None, None),
             (None, None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    prepare(spark)
    return spark.createDataFrame([], SCHEMA)


def texts_of(df):
    return [r["text"] or "" for r in df.collect()]


@pytest.fixture(scope="module")
def library():
    tokeniser = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokeniser.no_truncation()
    tokeniser.no_padding()
    return tokeniser


# BPE

def test_bpe_round_trip(odd, library):
    for r in bpe.tokenise(odd).collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["ids"] == ids and r["n_tokens"] == len(ids)
        assert r["decoded"] == library.decode(ids, skip_special_tokens=False)


def test_bpe_digests(odd, library):
    for r in bpe.digests(odd).collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        decoded = library.decode(ids, skip_special_tokens=False)
        assert r["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()


def test_bpe_mends_what_greedy_gets_wrong(library):
    encoder = bpe.Encoder(value=list)
    rng = random.Random(3)
    words = ["".join(rng.choice("abeinorst") for _ in range(rng.randint(1, 40))) for _ in range(3000)]
    assert encoder.words(words) == [library.encode(w, add_special_tokens=False).ids for w in words]
    assert 0 < encoder.mended < encoder.proposed
    long = "ab" * 4000 + "nation" * 300
    assert encoder.words([long]) == [library.encode(long, add_special_tokens=False).ids]


# Packing

def test_packing_places_every_token_once(odd, library):
    placed = packing.pack_documents(odd).collect()
    expected = Counter()
    for r in odd.collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids + [packing.SEPARATOR]
        for k, (a, n) in enumerate(packing.cut(len(ids), 1024)):
            raw = b"".join(i.to_bytes(4, "little") for i in ids[a:a + n])
            expected[r["doc_id"], k, a, n, zlib.crc32(raw)] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in placed) == expected
    sequences = defaultdict(list)
    for r in placed:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    tokens = sum(r["length"] for r in placed)
    assert len(sequences) <= math.ceil(tokens / 1024) + 2


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_plan_keeps_every_capacity(rule):
    rng = random.Random(1)
    histogram = Counter(min(64, int(rng.expovariate(0.1)) + 1) for _ in range(5000))
    capacity = packing.Capacity(64, 5, 2500)
    with pytest.raises(ValueError):
        packing.plan(histogram, capacity, packing.Policy(rule))
    histogram = Counter({k: n for k, n in histogram.items() if k <= 50})
    patterns = packing.plan(histogram, capacity, packing.Policy(rule))
    held = Counter()
    for p in patterns:
        assert sum(p.lengths) <= 64 and len(p.lengths) <= 5 and sum(x * x for x in p.lengths) <= 2500
        for x in p.lengths:
            held[x] += p.count
    assert held == histogram
    assert [p.first for p in patterns] == [sum(q.count for q in patterns[:i]) for i in range(len(patterns))]
    assert packing.plan({}, capacity) == []


def test_plan_equals_best_fit_piece_by_piece():
    rng = random.Random(2)
    for _ in range(30):
        histogram = Counter(rng.randint(1, 100) for _ in range(rng.randint(1, 300)))
        bins = []
        for length in sorted(histogram.elements(), reverse=True):
            fits = [b for b in range(len(bins)) if bins[b] + length <= 100]
            if fits:
                bins[max(fits, key=lambda b: bins[b])] += length
            else:
                bins.append(length)
        policy = packing.Policy("norm", (1.0, 0.0, 0.0))
        patterns = packing.plan(histogram, packing.Capacity(100, 10 ** 6, 10 ** 9), policy)
        assert sum(p.count for p in patterns) == len(bins)


# Personal data

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
            "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
            "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def brute_spans(text):
    out = []
    for kind, (name, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            luhn = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits)))
            good = {"email": True, "ip": name != "ip" or all(int(p) <= 255 for p in m.group().split(".")),
                    "card": 12 <= len(digits) <= 19 and luhn % 10 == 0, "phone": 9 <= len(digits) <= 15}[name]
            if good:
                out.append((m.start(), kind, m.end()))
    return sorted(out)


def test_personal_data_base_spans(odd):
    rng = random.Random(4)
    for alphabet in ("01245@@..+-- ()ab_é%", "0123456789999 -..+@a"):
        for _ in range(3000):
            text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60)))
            assert pii.base_spans(text) == brute_spans(text)
    for r in pii.find_personal_data(odd).collect():
        base = brute_spans(r["text"] or "")
        assert r["base_sha256"] == hashlib.sha256(pii.spans_text(base).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(s[1] == i for s in base) for i in range(4)]
        assert set(filter(None, pii.spans_text(base).split(","))) <= set(r["spans"].split(","))


def test_skip_chain_adds_other_mentions_only():
    text = ("write to ann.b42@mail8.example.com or ann.b42 at mail8.example.com, call +1 (988) 555-2485; "
            "later 988-555-2485, and 555-0000 is nobody's; card 4041894974608795 again 4041.8949.7460.8795")
    base = pii.base_spans(text)
    added = {(pii.KINDS[k], text[a:b]) for a, k, b in pii.added_spans(text, base)}
    assert added == {("email", "ann.b42 at mail8.example.com"), ("phone", "988-555-2485"), ("card", "4041.8949.7460.8795")}
    assert pii.added_spans("988-555-2485 and 555-0000", []) == []
    assert "@" not in pii.mask(text, base + pii.added_spans(text, base))


def test_messages_agree_with_enumeration_on_a_tree():
    import itertools

    import numpy as np
    unary = np.array([[0.3, 1.0, 0.0], [0.0, 0.2, 0.1], [0.5, 0.0, 0.4], [0.0, 0.0, 0.0]])
    edges = [(0, 3, 1.0), (1, 3, 2.0), (2, 3, 0.5)]
    weights = {x: math.exp(sum(unary[i, v] for i, v in enumerate(x)) + sum(w for i, j, w in edges if x[i] == x[j]))
               for x in itertools.product(range(3), repeat=4)}
    total = sum(weights.values())
    exact = [[sum(w for x, w in weights.items() if x[i] == v) / total for v in range(3)] for i in range(4)]
    assert np.allclose(pii.propagate(unary, edges), exact, atol=1e-6)


def test_masking_keeps_columns(odd, empty):
    masked = pii.mask_documents(odd)
    assert masked.columns == odd.columns and masked.count() == odd.count()
    assert {r["score"] for r in masked.collect()} == {"own", None}
    assert masked.where("text is null").count() == odd.where("text is null").count()
    assert pii.mask_documents(empty).count() == 0


# Quality

def brute_quality(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {j for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for j in range(i, i + 3)}
    lines, seen, duplicates = text.split("\n"), set(), 0
    for line in lines:
        if re.search(r"[^\x20\x09-\x0D]", line):
            duplicates += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), duplicates, len(covered), failed


def test_quality_counts(odd):
    for r in quality.judge(odd).collect():
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"],
                r["base_failed"]) == brute_quality(r["text"] or "")
        assert not (r["base_failed"] and r["kept"])


def test_quality_measures_and_bands(spark):
    import sentencepiece
    pieces = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    prose = " ".join("".join(random.Random(i).choice("abcdefgh") for _ in range(5)) for i in range(80))
    junk = " ".join(chr(0x1F600 + i) * 3 for i in range(80)) + " a"
    docs = spark.createDataFrame(rows_of([prose, junk, "same " * 80]), SCHEMA)
    good, bad, same = sorted(quality.judge(docs).collect(), key=lambda r: r["doc_id"])
    ids = [i for w in prose.split() for i in pieces.encode(w)]
    shares = [n / len(ids) for n in Counter(ids).values()]
    assert good["chars_per_token"] == pytest.approx(sum(map(len, prose.split())) / len(ids))
    assert good["token_entropy"] == pytest.approx(-sum(p * math.log2(p) for p in shares) / math.log2(len(ids)))
    assert good["kept"] and not bad["kept"] and bad["byte_share"] > 0.5 and not same["kept"]
    kept = quality.quality_filter(docs)
    assert kept.columns == docs.columns and [r["n_words"] for r in kept.collect()] == [-3]


def test_quality_bands_come_from_the_corpus(spark):
    prepare(spark)
    rng = random.Random(5)
    syllables = ["the", "ing", "and", "ion", "ent", "for", "tion", "ter"]
    prose = [" ".join(rng.choice(syllables) + rng.choice(syllables) for _ in range(120)) for _ in range(300)]
    noise = " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(100))  # inside the fixed band
    other = " ".join(chr(0x5D0 + i % 27) + chr(0xE000 + i) * 4 for i in range(100))  # a few Hebrew letters, spelt in bytes
    signs = " ".join("".join(rng.choice("#*$%&|<>!?") for _ in range(5)) for _ in range(100))
    docs = spark.createDataFrame(rows_of(prose + [noise, other, signs]), SCHEMA)
    judged = {r["doc_id"]: r for r in quality.judge(docs).collect()}
    assert [judged[i]["kept"] for i in (300, 301, 302)] == [False] * 3
    assert not any(judged[i]["base_failed"] for i in (300, 301, 302))
    assert [judged[i]["script"] for i in (300, 301, 302)] == ["latin", "hebrew", "none"]
    assert sum(judged[i]["kept"] for i in range(300)) >= 290
    alone = quality.judge(docs.where("doc_id = 300 OR doc_id < 50")).where("doc_id = 300").first()
    assert alone["kept"]  # too few texts for bands of their own
    kept = {r["doc_id"] for r in quality.quality_filter(docs).collect()}
    assert kept == {i for i, r in judged.items() if r["kept"]}


# Language

def test_language_backoff(spark, odd, empty):
    prepare(spark)
    texts = [("en", "the cat and the dog went to the house of the king"), ("de", "der hund und die katze gehen in das haus"),
             ("fr", "le chat et le chien vont dans la maison du roi"), (None, "zzz zzz")]
    train = spark.createDataFrame(texts * 3, "lang string, text string")
    model = langid.train(train)
    assert model.languages == ("de", "en", "fr")
    counts = Counter(langid.words_of(texts[0][1]))
    assert model.words["the"][1] == pytest.approx(math.log(counts["the"] / sum(counts.values())))
    assert langid.word_scores(model, "katzen")[0] == max(langid.word_scores(model, "katzen"))
    docs = spark.createDataFrame(rows_of(["the dog of the king", "die katze", "chat du roi", "123 ...", None, ""]), SCHEMA)
    found = {r["doc_id"]: r for r in langid.identify(docs, model).collect()}
    assert [found[i]["lang_pred"] for i in range(6)] == ["en", "de", "fr", "und", "und", "und"]
    assert all(0 <= r["score"] <= 1 for r in found.values())
    assert langid.identify(odd, model).count() == odd.count()
    nothing = langid.train(train.where("false"))
    assert {r["lang_pred"] for r in langid.identify(odd, nothing).collect()} == {"und"}
    assert langid.language_filter(empty).columns == empty.columns


# Toxicity

def test_grammar_reads_clauses():
    o, i, t, a, n, r = toxicity.OTHER, toxicity.INSULT, toxicity.THREAT, toxicity.TARGET, toxicity.NEGATION, toxicity.REPORT
    kinds = {tuple(s): toxicity.run_clause(s) for s in ([o, o], [i], [a, i], [i, o, a], [n, i], [r, o, i], [t], [t, a],
                                                       [n, i, o, i], [a] + [o] * 6 + [i])}
    names = [None if k is None else toxicity.KINDS[k] for k in kinds.values()]
    assert names == [None, "insult", "insult_at_target", "insult_at_target", "insult_negated", "insult_reported", "threat",
                     "threat_at_target", "insult_negated", "insult"]


def test_toxicity_learns_words_and_stems(spark, odd):
    prepare(spark)
    rng = random.Random(5)
    filler = ["".join(rng.choice("aeiknrst") for _ in range(6)) for _ in range(300)]
    rows, labels = [], []
    for i in range(400):
        words = [rng.choice(filler) for _ in range(30)]
        toxic = i % 4 == 0
        if toxic:
            words[rng.randrange(30)] = rng.choice(["dunce", "zorgax", "zorgen", "zorgit"])
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marked = spark.createDataFrame(labels + [(0, 1), (None, 1), (5, None)], "doc_id long, toxic int")
    grammar = toxicity.learn(toxicity.labelled_sample(docs, marked))
    assert "dunce" in grammar.words and any("zorg".startswith(s) or s.startswith("zorg") for s in grammar.stems)
    found = {r["doc_id"]: r for r in toxicity.score(docs, grammar).collect()}
    assert sum(found[i]["predicted"] == y for i, y in labels) >= 0.98 * len(labels)
    scores = toxicity.score(odd, grammar)
    assert scores.count() == odd.count() and scores.where("score < 0 or score > 1 or score is null").count() == 0
    nothing = toxicity.learn(toxicity.labelled_sample(docs, marked.where("false")))
    assert toxicity.score(docs, nothing).where("predicted = 1").count() == 0


# Near duplicates

def brute_classes(rows, threshold=0.8):
    sets = []
    for _, text in rows:
        words = re.findall(r"\w+", (text or "").lower())
        sets.append({tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set())
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    linked = [set() for _ in rows]
    for i in range(len(rows)):
        for j in range(i):
            same = (rows[i][1] or "") == (rows[j][1] or "")
            union = sets[i] | sets[j]
            near = bool(union) and len(sets[i] & sets[j]) >= threshold * len(union) - 1e-9
            if same or near:
                parent[root(i)] = root(j)
            if near and not same:
                linked[i].add(rows[j][1])
                linked[j].add(rows[i][1])
    members = defaultdict(list)
    for i in range(len(rows)):
        members[root(i)].append(rows[i][0])
    return {rows[i][0]: (min(members[root(i)]), len(linked[i])) for i in range(len(rows))}


@pytest.mark.parametrize("blocks", [(1000, 400), (7, 5)])
def test_join_finds_all_links(spark, blocks):
    prepare(spark)
    rng = random.Random(6)
    base = [["".join(rng.choice("abcdefg") for _ in range(5)) for _ in range(60)] for _ in range(12)]
    rows = []
    for words in base:
        for k in range(rng.choice([1, 2, 9])):
            edited = list(words)
            for _ in range(k % 4):
                edited[rng.randrange(60)] = "edit%d" % rng.randrange(1000)
            rows.append((len(rows), " ".join(edited)))
    rows += [(len(rows), rows[0][1]), (len(rows) + 1, rows[0][1].upper() + "!"), (len(rows) + 2, ""), (len(rows) + 3, None),
             (len(rows) + 4, "one two"), (len(rows) + 5, "One, two.")]
    docs = spark.createDataFrame(rows_of([t for _, t in rows]), SCHEMA)
    settings = ngram_join.Settings(bucket_block=blocks[0], compare_block=blocks[1])
    found = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in ngram_join.link_classes(docs, settings=settings).collect()}
    assert found == brute_classes(rows)
    kept = ngram_join.near_duplicate_filter(docs, settings=settings)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c for c, _ in found.values()})


def test_join_takes_odd_rows(odd, empty):
    found = ngram_join.link_classes(odd)
    assert found.count() == odd.count()
    assert ngram_join.near_duplicate_filter(odd.union(odd)).count() == ngram_join.near_duplicate_filter(odd).count()
    assert ngram_join.link_classes(empty).count() == 0


def test_bands_reach_the_recall():
    for threshold in (0.5, 0.8, 0.95):
        settings = ngram_join.Settings(threshold=threshold)
        bands, rows = settings.bands()
        assert bands * rows <= settings.most_hashes
        if threshold >= 0.8:
            assert 1 - (1 - threshold ** rows) ** bands >= settings.recall


def test_components(spark):
    prepare(spark)
    rng = random.Random(8)
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 102), (102, 100), (200, 200)]
    rng.shuffle(edges)
    found = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 102: 100, 200: 200}


# Fingerprints

def test_fingerprints(spark, odd, empty):
    def sketch(text):
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        hashes = {hashlib.md5(" ".join(words[i:i + 5]).encode()).hexdigest()[:16]
                  for i in range(max(1, len(words) - 4))} if words else set()
        low = sorted(h for h in hashes if h < "2")
        return low or sorted(hashes)[:1]

    rows = sorted(((r["doc_id"], r["text"] or "") for r in odd.collect()),
                  key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    expected = []
    for k, (i, text) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        a, b, c = sketch(text), sketch(edited), sketch(after)

        def near(x, y):
            return 1.0 if not x and not y else 0.0 if not x or not y else len({*x} & {*y}) / min(len(x), len(y))

        expected.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), "".join(a), "".join(b), near(a, b), near(a, c)))
    found = [tuple(r) for r in fingerprint.compare_with_next(odd).collect()]
    assert sorted(found, key=str) == sorted(expected, key=str)
    assert fingerprint.compare_with_next(empty).count() == 0


def test_fingerprints_meet_across_ranges(spark, monkeypatch):
    from basketry.llm import ordering
    prepare(spark)
    docs = spark.createDataFrame([(i * 7 % 101, f"text {i} " + "word " * (i % 9)) for i in range(101)], "doc_id long, text string")
    once = sorted(map(tuple, fingerprint.compare_with_next(docs).collect()))
    monkeypatch.setattr(ordering, "ROWS_PER_RANGE", 10)
    assert sorted(map(tuple, fingerprint.compare_with_next(docs).collect())) == once
    monkeypatch.setattr(ordering, "ROWS_PER_STEP", 3)
    assert sorted(map(tuple, fingerprint.compare_with_next(docs).collect())) == once


def test_sketches_merge(spark):
    prepare(spark)
    words = [f"w{i}" for i in range(400)]
    parts = spark.createDataFrame([(1, " ".join(words[:250])), (1, " ".join(words[246:]))], "g int, text string")
    merged = fingerprint.merge(parts.select("g", fingerprint.sketch(F.col("text")).alias("sketch")), ["g"]).first()["sketch"]
    whole = spark.createDataFrame([(" ".join(words),)], "text string").select(fingerprint.sketch(F.col("text"))).first()[0]
    assert merged == whole


def test_short_texts_merge_to_the_sketch_of_the_whole(spark):
    """Least hashes that stand in for empty sketches do not stay beside real ones."""
    texts = [f"word{i} more{i} last{i}" for i in range(20)]
    parts = spark.createDataFrame([(g, t) for g, part in (("all", texts), ("two", texts[:2])) for t in part] + [("none", "")],
                                  "g string, text string")
    merged = {r.g: r["sketch"] for r in fingerprint.merge(
        parts.select("g", fingerprint.sketch(F.col("text")).alias("sketch")), ["g"]).collect()}
    for g, part in (("all", texts), ("two", texts[:2])):
        hashes = [hashlib.md5(t.encode()).hexdigest()[:fingerprint.HASH_DIGITS] for t in part]
        assert merged[g] == (sorted(h for h in hashes if h < fingerprint.BELOW) or [min(hashes)])
    assert 0 < len(merged["all"]) < 20 and "none" not in merged


# Shards

def test_shards(odd, empty, monkeypatch):
    from basketry.llm import ordering
    for rows in (5000, 7):
        monkeypatch.setattr(ordering, "ROWS_PER_RANGE", rows)
        placed = sharding.shard_by_bytes(odd).collect()
        assert len(placed) == odd.count()
        total, sizes, slots = 0, Counter(), defaultdict(list)
        for r in placed:
            raw = (r["text"] or "").encode()
            assert (r["size"], r["text_crc32"]) == (len(raw) + 1, zlib.crc32(raw))
            total += r["size"]
            sizes[r["shard"]] += r["size"]
            slots[r["shard"]].append(r["slot"])
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
        largest = max(r["size"] for r in placed)
        assert all(abs(n - total / 8) <= largest for n in sizes.values()) and set(sizes) <= set(range(8))
        order = sorted(placed, key=lambda r: (r["doc_id"] is not None, r["doc_id"], r["text_crc32"]))
        assert [r["shard"] for r in order] == sorted(r["shard"] for r in placed)
    assert sharding.shard_by_bytes(empty).count() == 0


# Licences

def test_licences(spark, odd, empty):
    prepare(spark)
    mit = licenses.TEMPLATES[11].text
    texts = ["x y Apache License z", "plain words", mit.upper() + " more", "Released under the MIT License.",
             "cc by CC BY; Licensed under CC BY-NC 4.0.", "permission granted free charge person obtaining copy software",
             "İcc by", "GNU General public LICENSE and GNU lesser general public license", None, "all rights reserved"]
    docs = spark.createDataFrame(rows_of(texts), SCHEMA)
    found = {r["doc_id"]: r for r in licenses.scan(docs).collect()}
    assert found[0]["base_labels"] == "apache" and (found[0]["first_word"], found[0]["last_word"]) == (2, 2)
    assert found[1]["labels"] == "" and found[1]["score"] == 0 and found[1]["first_word"] is None
    assert found[2]["labels"] == "mit" and found[2]["n_base"] == 0 and found[2]["score"] == pytest.approx(1, abs=1e-6)
    assert found[3]["labels"] == "mit"
    assert found[4]["n_base"] == 3 and found[4]["labels"] == "cc-by,cc-by-nc-4.0"
    assert found[5]["labels"] == ""
    assert found[6]["n_base"] == 0
    assert found[7]["base_labels"] == "gpl" and "lgpl" in found[7]["labels"]
    assert found[9]["labels"] == "all-rights-reserved"
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    for r in licenses.scan(odd).collect():
        assert r["n_base"] == 0
    counted = sorted((str(r["doc_id"]), r["n_words"]) for r in licenses.scan(odd).collect())
    ascii_lower = str.maketrans(licenses.UPPER, licenses.LOWER)
    assert counted == sorted((str(r["doc_id"]), len(pattern.findall((r["text"] or "").translate(ascii_lower))))
                             for r in odd.collect())
    assert licenses.scan(empty).count() == 0


def test_licences_of_a_file_with_many_notices(spark):
    prepare(spark)
    by_label = {t.label: t.text for t in licenses.TEMPLATES}
    common = [t.text for t in licenses.TEMPLATES if t.label not in ("isc", "mit", "bsd", "mpl-2.0", "public-domain")]
    rare = sorted({w for label in ("isc", "mit", "bsd", "mpl-2.0", "public-domain") for w in by_label[label].split()
                   if w not in licenses.FUNCTION_WORDS})
    whole = [" | ".join(t.text for t in licenses.TEMPLATES),
             " | ".join(licenses.TEMPLATES[i].text for i in (11, 2, 1)),
             "prose ".join(f"{w} " for w in rare) + " | " + by_label["gpl-3.0"]]
    docs = spark.createDataFrame(rows_of(whole + common * 20), SCHEMA)
    found = {r["doc_id"]: r for r in licenses.scan(docs).where("doc_id < 3").collect()}
    assert {t.label for t in licenses.TEMPLATES} <= set(found[0]["labels"].split(","))
    assert {m["label"] for m in found[0]["matches"]} == {t.label for t in licenses.TEMPLATES}
    assert [m["label"] for m in found[1]["matches"]] == ["apache-2.0", "bsd", "mit"]
    assert [m["label"] for m in found[2]["matches"]] == ["gpl-3.0"]
    assert all(m["coverage"] == 1 for r in found.values() for m in r["matches"] if m["label"] in ("apache-2.0", "gpl-3.0"))


# The whole

def test_every_result_survives_empty_tables(empty):
    assert bpe.tokenise(empty).count() == 0
    assert packing.pack_documents(empty).count() == 0
    assert pii.find_personal_data(empty).count() == 0
    assert quality.quality_filter(empty).count() == 0


def test_results_replace_clashing_columns(odd):
    scored = pii.find_personal_data(odd)
    assert scored.columns.count("spans") == 1 and isinstance(scored.schema["spans"].dataType, T.StringType)
    assert sharding.shard_by_bytes(odd).columns.count("shard") == 1
