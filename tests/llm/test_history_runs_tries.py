"""Exact dedup with a perfect hash, periodic runs and conversation tries against brute force."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.llm import conversation_trie as trie
from basketry.llm import exact_dedup, periodic_runs, queries
from basketry.llm.common import prepare

DOCS = "doc_id long, text string, lang string, runs int, kept string, source string, id string, digest int"


def doc_rows(texts, first=0):
    return [(first + i, t, "en", -1, "own", "s", "i", -2) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def docs(spark):
    """Null and empty texts, copies in other cases, repeated rows, null ids, long texts, columns named like results."""
    prepare(spark)
    rng = random.Random(5)
    texts = [None, "", " ", "Ab c", "aB C", "AB C", "É", "é", "x " * 9000, "word " * 9000, "a\x00b", "日本 " * 20,
             "one\ttwo\x1cthree four \x0b" * 6, "the end"]
    for _ in range(150):
        words = [rng.choice("abcd") * rng.randint(1, 2) for _ in range(rng.randint(0, 60))]
        if len(words) > 10:
            a, p = rng.randrange(len(words)), rng.randint(1, 6)
            words[a:] = [words[a:][i % p] if i % p < len(words[a:]) else words[a] for i in range(len(words) - a)]
        texts.append(rng.choice([" ", "  ", "\n"]).join(words))
    rows = doc_rows(texts)
    rows += [rows[20], rows[20], (None, "the end", None, None, None, None, None, None),
             (None, "no id", None, None, None, None, None, None), (None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


# Perfect hash

def test_perfect_hash_gives_each_member_a_slot_of_its_own():
    for n in (0, 1, 2, 7, 1000, 5000):
        digests = [hashlib.sha256(str(i).encode()).digest() for i in range(n)]
        words = exact_dedup.words_of(digests)
        hashed = exact_dedup.PerfectHash.build(words)
        assert sorted(hashed.slots(words).tolist()) == list(range(n))
        again = exact_dedup.PerfectHash.unpacked(*hashed.packed())
        assert (again.slots(words) == hashed.slots(words)).all()
        others = again.slots(exact_dedup.words_of([hashlib.sha256(b"%d!" % i).digest() for i in range(500)]))
        assert ((others >= -1) & (others < max(n, 1))).all()
    # Digests that differ in one byte only, and equal ones.
    near = [bytes(31) + bytes([i]) for i in range(200)]
    words = exact_dedup.words_of(near)
    assert sorted(exact_dedup.PerfectHash.build(words).slots(words).tolist()) == list(range(200))
    with pytest.raises(ValueError):
        exact_dedup.PerfectHash.build(exact_dedup.words_of(near[:1] * 2))


def groups_of(rows):
    groups = defaultdict(list)
    for key, text in rows:
        norm = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        groups[hashlib.sha256(norm.encode()).hexdigest()].append(key)
    return groups


def check_marks(marked, rows):
    groups = groups_of(rows)
    got = defaultdict(list)
    for r in marked:
        got[r["text_sha256"]].append(r)
    assert {k: len(v) for k, v in got.items()} == {k: len(v) for k, v in groups.items()}
    for digest, members in got.items():
        ids = [i for i in groups[digest] if i is not None]
        assert {(r["keep_id"], r["group_size"]) for r in members} == {(max(ids, default=None), len(groups[digest]))}
        stays = [r for r in members if r["kept"]]
        assert len(stays) == 1 and stays[0]["id"] == max(ids, default=None)


@pytest.mark.parametrize("limits", [(5_000, 20_000), (3, 2)])
def test_marks_do_not_depend_on_what_is_history(docs, monkeypatch, limits):
    monkeypatch.setattr(exact_dedup, "SLOTS_PER_BUCKET", limits[0])
    monkeypatch.setattr(exact_dedup, "LOOKUPS_PER_GROUP", limits[1])
    rows = exact_dedup.digest_rows(docs)
    plain = [(r["doc_id"], r["text"]) for r in docs.collect()]
    for past in (F.lit(True), F.lit(False), F.col("id") % 2 == 0, F.col("id") > 100, F.col("id").isNull()):
        past = F.coalesce(past, F.lit(False))
        history = exact_dedup.build_history(rows.where(past))
        found = exact_dedup.look_up(rows.where(~past), history)
        check_marks(exact_dedup.mark(rows, exact_dedup.verdicts(found)).collect(), plain)
        for r in found.where("past IS NOT NULL").collect():
            assert r["slot"] is not None


def test_history_from_an_earlier_table(spark, docs, nothing, tmp_path):
    old = spark.createDataFrame(doc_rows(["THE END", "gone", "one"], 1000), DOCS)
    exact_dedup.write_history(exact_dedup.build_history(exact_dedup.digest_rows(old, source="a")), str(tmp_path / "h"))
    history = exact_dedup.read_history(spark, str(tmp_path / "h"))
    kept = exact_dedup.without_repeats(docs, history=history, source="b")
    assert set(kept.columns) == set(docs.columns) | set(exact_dedup.RESULTS)
    found = {r["text"]: r for r in kept.collect()}
    assert "the end" not in found  # the earlier table has it under a greater id
    plain = groups_of((r["doc_id"], r["text"]) for r in docs.collect())
    assert kept.count() == len(plain) - 1 and found["no id"]["source"] is None
    alone = exact_dedup.without_repeats(docs).collect()
    assert sorted(r["text_sha256"] for r in alone) == sorted(plain)
    assert exact_dedup.without_repeats(nothing).count() == 0
    empty = exact_dedup.build_history(exact_dedup.digest_rows(nothing))
    exact_dedup.write_history(empty, str(tmp_path / "e"))
    again = exact_dedup.read_history(spark, str(tmp_path / "e"))
    assert exact_dedup.without_repeats(docs, history=again).count() == len(plain)


def test_keys_of_text(spark):
    table = spark.createDataFrame([("b", "T"), ("a", "t"), ("b", "t"), ("c", "u")], "doc_id string, text string")
    check_marks(exact_dedup.mark(*(lambda rows: (rows, exact_dedup.verdicts(exact_dedup.look_up(
        rows.where("id = 'a'"), exact_dedup.build_history(rows.where("id <> 'a'"))))))(
            exact_dedup.digest_rows(table))).collect(), [tuple(r) for r in table.collect()])


# Periodic runs

def brute_runs(words):
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def brute_collapse(words, runs):
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in dropped)


def test_re_pair_derives_its_text():
    rng = random.Random(1)
    for _ in range(500):
        k = rng.randint(1, 5)
        seq = [rng.randrange(k) for _ in range(rng.randint(0, 60))]
        rules, rest = periodic_runs.re_pair(seq, k)

        def derived(symbol):
            return [symbol] if symbol < k else derived(rules[symbol - k][0]) + derived(rules[symbol - k][1])

        assert [s for symbol in rest for s in derived(symbol)] == seq
        pairs = defaultdict(list)
        for i, pair in enumerate(zip(rest, rest[1:])):
            if not pairs[pair] or pairs[pair][-1] < i - 1 or pair[0] != pair[1]:
                pairs[pair].append(i)
        assert all(len(at) < 2 for at in pairs.values())  # no pair is left that occurs twice apart


def test_re_pair_takes_the_most_frequent_pair_first():
    rules, _ = periodic_runs.re_pair([0, 1, 0, 1, 2, 3, 0, 1, 2, 3], 4)
    assert rules[0] == (0, 1)
    assert periodic_runs.re_pair([0, 0, 0, 0, 0, 1, 2, 9, 1, 2, 8, 1, 2], 10)[0][0] == (1, 2)  # 0 0 twice apart


def test_runs_of_sequences():
    rng = random.Random(2)
    for _ in range(1500):
        k, n = rng.choice([1, 2, 2, 3, 4, 6]), rng.randint(0, 90)
        seq = [rng.randrange(k) for _ in range(n)]
        for _ in range(rng.randint(0, 3)):
            if n > 8:
                a, p = rng.randrange(n), rng.randint(1, 8)
                for i in range(a + p, min(n, a + rng.randint(0, 60))):
                    seq[i] = seq[i - p]
        assert periodic_runs.stretch_runs(seq, k) == brute_runs(seq)
        texts = [" ".join(map(str, seq)), "", " ".join(map(str, seq[::-1]))]
        assert [runs for _, runs in periodic_runs.runs_of_texts(texts)] == [brute_runs(seq), [], brute_runs(seq[::-1])]


def test_cuts_leave_nothing_of_prose_without_repeats():
    words = [f"w{i % 97}" for i in range(3 * 97)]  # three periods are no run
    ids = np.array([int(w[1:]) for w in words])
    assert periodic_runs.live_stretches(ids, np.array([len(ids)])) == []
    assert periodic_runs.live_stretches(np.array([5] * 6), np.array([6])) == [(0, 6)]
    assert periodic_runs.live_stretches(np.array([5] * 12), np.array([5, 7, 12])) == []
    assert periodic_runs.live_stretches(np.array([], dtype=int), np.array([0])) == []


def test_runs_of_documents(docs, nothing):
    found = periodic_runs.find_runs(docs)
    assert set(found.columns) == set(docs.columns) | {"n_words", "runs", "strongest", "collapsed"}
    for r in found.collect():
        words = [w.decode() for w in (r["text"] or "").encode().split()]
        runs = brute_runs(words)
        assert r["n_words"] == len(words) and [tuple(x) for x in r["runs"]] == runs
        assert r["collapsed"] == brute_collapse(words, runs)
        best = min(runs, key=lambda x: (-x[1] / x[2], x[0], x[2]), default=None)
        assert (tuple(r["strongest"]) if r["strongest"] else None) == best
    assert periodic_runs.find_runs(nothing).count() == 0
    replaced = periodic_runs.find_runs(docs, "text", "text")
    assert "collapsed" not in replaced.columns and replaced.where("text LIKE 'word word%'").count() == 0


def brute_periodic(spark, folder):
    for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect():
        words = [w.decode() for w in (r["text"] or "").encode().split()]
        h = zlib.crc32(str(r["doc_id"]).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = brute_runs(words)
        start, length, period = min(runs, key=lambda x: (-x[1] / x[2], x[0], x[2]), default=(None,) * 3)
        yield (r["doc_id"], len(runs), start, length, period, None if start is None else 1000 * length // period,
               hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest(),
               hashlib.sha256(brute_collapse(words, runs).encode()).hexdigest())


def test_run_query(spark, data):
    got = queries.QUERIES["op12_repair_runs"](spark, data)
    assert sorted(tuple(r) for r in got.collect()) == sorted(brute_periodic(spark, data))
    assert got.where("n_runs > 0").count() > 5


# Conversation trie

def test_radix_tree_holds_all_keys():
    rng = random.Random(3)
    for most, length in ((2, 12), (40, 3), (256, 2), (256, 4)):
        tree, held = trie.RadixTree(), defaultdict(int)
        for i in range(3000):
            key = bytes(rng.randrange(most) for _ in range(rng.randint(0, length)))
            tree.insert(key, i)
            held[key] += 1
        tree.add_up(lambda _: 1, lambda a, b: a + b)
        stack, seen, layouts = [(tree.root, b"")], {}, set()
        while stack:
            node, key = stack.pop()
            key += node.prefix
            layouts.add((type(node).__name__, getattr(node, "most", 0)))
            assert node.total == sum(n for k, n in held.items() if k.startswith(key))
            if node.ends:
                seen[key] = len(node.ends)
            stack += [(child, key + bytes([b])) for b, child in node.items()]
            assert node is tree.root or node.ends or len(node.items()) > 1  # paths are compressed
        assert seen == held
    assert {"Sorted", "Indexed", "Direct"} >= {name for name, _ in layouts} and ("Direct", 0) in layouts


def brute_trie(conversations):
    """{path: row} of conversations {id: [(role, text)]}."""
    members = defaultdict(list)
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    rows = []
    for path, cs in members.items():
        below = [p for p in members if p[:len(path)] == path]
        ends = sorted(c for c in cs if len(conversations[c]) == len(path))
        rows.append((min(cs), len(path), min(members[path[:-1]]) if path else None, len(cs), len(children[path]),
                     sum(not children[p] for p in below),
                     sum((len(members[p]) - 1) * len(p[-1][1]) for p in below if p),
                     hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(rows, key=str)


COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


TURNS = "conv_id long, turn long, role string, text string, node string, depth int, id int, key string"


def table_of(spark, conversations):
    rows = [(c, t, role, text, "own", 1, 2, "k") for c, turns in conversations.items() for t, (role, text) in enumerate(turns)]
    random.Random(4).shuffle(rows)
    return spark.createDataFrame(rows, TURNS)


@pytest.mark.parametrize("limits", [(256, 4096), (2, 3), (1, 1)])
def test_trie_of_conversations(spark, monkeypatch, limits):
    prepare(spark)
    monkeypatch.setattr(trie, "SEGMENT", limits[0])
    monkeypatch.setattr(trie, "TREE_KEYS", limits[1])
    rng = random.Random(6)
    turns = [("user", "hello"), ("bot", "hello"), ("", "userhello"), ("user", ""), ("", ""), ("user", "日本"), ("bot", "x" * 50)]
    conversations = {i * 7 - 50: [rng.choice(turns[:rng.choice([2, 7])]) for _ in range(rng.randint(1, 7))] for i in range(70)}
    conversations |= {1000 + i: [turns[0], turns[1], turns[5]] for i in range(25)}  # copies
    conversations[5000] = [turns[i % 3] for i in range(40)]
    assert rows_of(trie.trie_of(table_of(spark, conversations))) == brute_trie(conversations)


def test_trie_of_odd_turns(spark):
    rows = [(1, None, None, None), (1, 5, "a", "b"), (1, 5, "a", "b"), (2, None, "", ""), (2, 9_000, "a", "b"),
            (None, 0, "user", "no conversation"), (3, -4, "z", "z"), (3, None, "", None), (3, 4000, "a", "b")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    expected = {1: [("", ""), ("a", "b"), ("a", "b")], 2: [("", ""), ("a", "b")], 3: [("", ""), ("z", "z"), ("a", "b")]}
    assert rows_of(trie.trie_of(turns)) == brute_trie(expected)
    assert trie.trie_of(turns.limit(0)).count() == 0
    numbered, width = trie.number_turns(trie.encode_turns(turns.limit(0)))
    silent = spark.createDataFrame([(4,), (2,)], "conv long")
    assert rows_of(trie.prefix_trie(numbered, width, silent)) == brute_trie({2: [], 4: []})


def test_trie_query(spark, data):
    turns = defaultdict(list)
    for r in spark.read.parquet(f"{data}/conversations.parquet").orderBy("conv_id", "turn").collect():
        turns[r["conv_id"]].append((r["role"] or "", r["text"] or ""))
    rebuilt = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        rebuilt[c] = turns.get(c - c % 100, [])[:h] + own[h:]
    assert rows_of(queries.QUERIES["op13_radix_trie"](spark, data)) == brute_trie(rebuilt)
