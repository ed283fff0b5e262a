"""Importance resampling, the source audit and exact dedup against plain Python, with nulls, ties, copies and clashing columns."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from patronlens.llm import divergence, exact_dedup, resampling

DOCS = "doc_id bigint, text string, lang string, source string, score string, rank string, kept string, keep_id string, _row string, term string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def some_documents(seed, n=200):
    rng = random.Random(seed)
    words = ["alpha", "Beta", "ÄRGER", "x1", "été", "of", "the", "it's", "a\x00b", "日本", "i̇", "ﬁn", "K"] + [f"w{i}" for i in range(60)]
    rows = []
    for i in range(n):
        text = rng.choice([" ", "\n", ", "]).join(rng.choices(words, k=rng.choice([0, 1, 3, 19, 20, 25, 60])))
        rows.append((i, text, rng.choice(["en", "de", None, ""]), rng.choice(["s1", "s2", "ß", None, "s1"])))
    rows += [(n, None, "en", "s1"), (None, "no id " * 20, "fr", "lone"), (None, None, None, None), (n + 1, " ".join(words * 3000), "en", "s2"), (n + 2, "!?", "xx", "no terms")]
    rows += [(n + 3 + i, rows[3][1], "en", "s1") for i in range(5)] + [rows[0], rows[5], rows[5]]
    return [(*r, "10", "x", "no", "7", "r", "t") for r in rows]


def asked(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.collect()]


# --- importance resampling

def features(text):
    words = WORD.findall(lowered(text))
    return words, [zlib.crc32(f.encode()) % resampling.BUCKETS for f in words + [f"{a} {b}" for a, b in zip(words, words[1:])]]


def plain_resampling(docs, target):
    s, t = Counter(), Counter()
    for r in docs:
        s.update(features(r[1])[1])
    for text in target:
        t.update(features(text)[1])
    S, T, B = sum(s.values()), sum(t.values()), resampling.BUCKETS
    out = []
    for k, r in enumerate(docs):
        words, at = features(r[1])
        weight = sum(math.floor(1000 * math.log((t[b] + 1.0) * (S + B) / ((s[b] + 1.0) * (T + B)))) for b in at) // len(at) if at else 0
        h = int(hashlib.sha256(f"7:{'' if r[0] is None else r[0]}".encode()).hexdigest()[:8], 16)
        out.append([r[0], len(at), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words)])
    enough = sorted((r for r in out if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0]))
    for place, r in enumerate(enough[: 25 * len(enough) // 100]):
        r[4] = place + 1
    return sorted((tuple(r[:5]) for r in out), key=repr)


@pytest.mark.parametrize("target", [["w1 w2 w3 alpha Beta", None, "the été"], []])
def test_resampling_equals_plain_python(spark, target):
    docs = some_documents(1)
    got = resampling.digest(spark.createDataFrame(docs, DOCS), spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id bigint, text string"))
    assert sorted(asked(got, "doc_id", "n_features", "weight", "score", "rank"), key=repr) == plain_resampling(docs, target)


def test_resampling_of_nothing(spark):
    none = spark.createDataFrame([], DOCS)
    assert resampling.digest(none, spark.createDataFrame([("a b",)], "text string")).collect() == []
    one = resampling.digest(spark.createDataFrame([(1, "a")], "doc_id bigint, text string"), none)
    assert asked(one, "doc_id", "n_features", "rank") == [(1, 1, None)]


def test_resampling_keeps_what_is_asked_for(spark):
    docs = spark.createDataFrame(some_documents(2), DOCS)
    kept = resampling.resample(docs.drop("score", "rank"), docs, ["doc_id", "lang", "kept"])
    assert kept.columns == ["doc_id", "lang", "kept", "n_words", "n_features", "weight", "score", "rank"]
    assert kept.count() == docs.count()


@pytest.mark.parametrize("ids, block", [(range(500), 64), ([0, 1, -1, 2**63 - 1, -(2**63), None, None] * 3, 3), ([7] * 40, None), ([], None)])
def test_radix_ranks_follow_the_order(spark, ids, block):
    rng = random.Random(9)
    rows = [(rng.choice([-3, 0, 5, 4000, -90000, 123456]), i) for i in ids]
    got = resampling.radix_rank(spark.createDataFrame(rows, "score bigint, id bigint").repartition(5), "score", "id", block=block)
    got = sorted(asked(got, "rank", "score", "id"))
    assert [r[0] for r in got] == list(range(1, len(rows) + 1))
    assert [r[1:] for r in got] == sorted(rows, key=lambda r: (-r[0], r[1] is None, r[1]))


def test_radix_rank_of_extreme_and_missing_scores(spark):
    scores = [2**63 - 1, -(2**63), None, 0, -1, None, 5]
    got = resampling.radix_rank(spark.createDataFrame([(s, i) for i, s in enumerate(scores)], "score bigint, id bigint"), "score", "id", block=2)
    assert [r[1] for r in sorted(asked(got, "rank", "score"))] == [2**63 - 1, 5, 0, -1, -(2**63), None, None]
    with pytest.raises(TypeError):
        resampling.radix_rank(spark.createDataFrame([(1, "a")], "score bigint, id string"), "score", "id")


# --- source audit

def plain_audit(docs, least, top):
    groups, counts, holds = set(), Counter(), defaultdict(set)
    for k, r in enumerate(docs):
        lang, source = r[2] or "", r[3] or ""
        groups.add((lang, source))
        for term in TERM.findall(lowered(r[1])):
            counts[lang, source, term] += 1
            holds[lang, term].add(k)
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for (l, t), docs_of in holds.items() if l == lang and len(docs_of) >= least]
        sources = [s for l, s in groups if l == lang]

        def scaled(count):
            total = sum(count.values())
            return {t: 1 + 10**9 * (count[t] + 2) // (total + 2 * len(kept)) for t in kept}

        count = {s: {t: counts[lang, s, t] for t in kept} for s in sources}
        p = {s: scaled(count[s]) for s in sources}
        q = scaled({t: sum(c[t] for c in count.values()) for t in kept})
        for s in sources:
            pairs = [(sum((p[s][t] - p[o][t]) ** 2 // (p[s][t] + p[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [((p[s][t] - q[t]) ** 2 // (p[s][t] + q[t]), t) for t in kept if count[s][t] and p[s][t] > q[t]]
            for part, found in (("pair", pairs), ("term", sorted(terms, key=lambda x: (-x[0], x[1].encode()))[:top])):
                out += [(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(sorted(found, key=lambda x: (-x[0], x[1].encode())))]
    return sorted(out)


@pytest.mark.parametrize("least, cells", [(10, 1 << 18), (1, 7), (10**6, 100)])
def test_audit_equals_plain_python(spark, least, cells):
    docs = some_documents(3)
    got = divergence.audit(spark.createDataFrame(docs, DOCS).repartition(6), least_docs=least, cells=cells)
    assert sorted(asked(got, "lang", "source", "part", "item", "value", "rank")) == plain_audit(docs, least, divergence.TOP)


def test_audit_of_nothing_and_of_nulls(spark):
    assert divergence.digest(spark.createDataFrame([], DOCS)).collect() == []
    nulls = spark.createDataFrame([(1, None, None, None), (2, None, None, "b")], "doc_id int, text string, lang string, source string")
    assert sorted(asked(divergence.digest(nulls), "lang", "source", "part", "item", "value", "rank")) == [("", "", "pair", "b", 0, 1), ("", "b", "pair", "", 0, 1)]


def test_a_task_hands_its_counts_on(spark):
    docs = spark.createDataFrame(some_documents(4), DOCS).coalesce(1)
    few, all_ = (sorted((r.lang, r.term or "", r.docs, sorted(zip(r.sources, r.counts))) for r in divergence.term_counts(docs, held=h).collect()) for h in (20, 1 << 20))
    assert few == all_


def test_shares_are_exact():
    rng = random.Random(5)
    for _ in range(300):
        v, total = rng.randint(1, 10**7), rng.randint(0, 9 * 10**15)
        count = rng.randint(0, total)
        assert divergence.shares(np.array([count]), total, v)[0] == 1 + 10**9 * (count + 2) // (total + 2 * v)


# --- exact dedup

def plain_copies(docs, largest):
    groups = defaultdict(list)
    for k, r in enumerate(docs):
        groups[r[1] or ""].append((r[0], k))
    out = []
    for text, rows in groups.items():
        ids = [i for i, _ in rows if i is not None]
        stays = None if not ids else max(ids) if largest else min(ids)
        sha = hashlib.sha256(text.encode()).hexdigest()
        first = True
        for i, _ in rows:
            out.append((i, stays, len(rows), i == stays and first, sha))
            first = first and i != stays
    return sorted(out, key=repr)


@pytest.mark.parametrize("largest", [True, False])
@pytest.mark.parametrize("memory, bits", [(exact_dedup.MEMORY, 64), (3000, 0)])
def test_copies_equal_plain_grouping(spark, largest, memory, bits):
    docs = some_documents(6, 120)
    got = exact_dedup.mark(spark.createDataFrame(docs, DOCS).repartition(4), ["doc_id", "lang", "term"], largest=largest, memory=memory, bits=bits)
    assert got.columns == ["doc_id", "lang", "term", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(asked(got, "doc_id", "keep_id", "group_size", "kept", "text_sha256"), key=repr) == plain_copies(docs, largest)


def test_copies_of_nothing_and_of_a_hot_text(spark):
    assert exact_dedup.digest(spark.createDataFrame([], DOCS)).collect() == []
    hot = spark.range(5000).select(F.col("id").alias("doc_id"), F.expr("if(id % 3 = 0, 'the same', concat('text ', id % 900))").alias("text"))
    rows = [(r.doc_id, r.text) for r in hot.collect()]
    assert sorted(asked(exact_dedup.digest(hot), "doc_id", "keep_id", "group_size", "kept", "text_sha256"), key=repr) == plain_copies(rows, True)
    distinct = exact_dedup.distinct_texts(hot, "text", "doc_id", True)
    assert distinct.filter("content = CAST('the same' AS BINARY)").count() <= 2 * hot.rdd.getNumPartitions()


def test_text_ids(spark):
    docs = spark.createDataFrame([("b", "x"), ("a", "x"), (None, "x"), ("é", "y")], "doc_id string, text string")
    assert sorted(asked(exact_dedup.digest(docs), "doc_id", "keep_id", "kept"), key=repr) == sorted([("a", "b", False), ("b", "b", True), (None, "b", False), ("é", "é", True)], key=repr)
    with pytest.raises(TypeError):
        exact_dedup.digest(spark.createDataFrame([(1.5, "x")], "doc_id double, text string"))


def test_trie_keeps_strings_apart_and_hands_subtrees_on():
    rng = random.Random(8)
    strings = [b"", b"a", b"ab", b"abc", b"b" * 5000, b"b" * 5000 + b"c"] + [bytes(rng.choices(b"ab\x00\xff", k=rng.randint(0, 12))) for _ in range(3000)]
    trie = exact_dedup.Trie(lambda a, b: (a[0] + b[0],))
    given, gone = Counter(), Counter()
    for s in strings:
        gone[s] += not trie.insert(s, (1,))
        while trie.held > 2000 and (taken := trie.spill()):
            gone.update({t: v[0] for t, v in taken})
    given.update({s: v[0] for s, v in trie.terminals()})
    assert trie.held <= 2000 and trie.held == sum(map(len, given)) and trie.held > 500
    assert not set(given) & set(+gone), "a string is either held or handed on"
    assert given + gone == Counter(strings)


def test_common_prefix():
    rng = random.Random(2)
    for _ in range(2000):
        a = bytes(rng.choices(b"ab", k=rng.randint(0, 300)))
        cut = rng.randint(0, len(a))
        b = b"zz" + a[:cut] + bytes(rng.choices(b"ab", k=rng.randint(0, 300)))
        most = min(len(a), len(b) - 2)
        plain = next((i for i in range(most) if a[i] != b[i + 2]), most)
        assert exact_dedup.common(a, b, 0, 2, most) == plain
