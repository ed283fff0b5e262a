"""Text operators against brute force on small tables, with nulls, empty and long texts and repeated rows."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from patronlens.llm import languages, licenses, lm, packing, quality, queries, url_filter

DOCS = "doc_id bigint, text string, lang string, score double, label string"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def low(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def some_texts(seed=1, n=60):
    rng = random.Random(seed)
    syllables = "th an re on é tion ß ñ st in ed 4 x’".split() + ["日本", "ö"]
    texts = [None, "", " \t\n", "!!!", "a", "\n\n", "ends \x1c odd\x85 space ", "<|endoftext|> in a <|endoftext|>", "x" * 3000]
    for _ in range(n):
        words = ["".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(rng.randint(1, 120))]
        sep = rng.choice([" ", "  ", "\n", ", ", " \r\n"])
        texts.append(sep.join(w.upper() if rng.random() < 0.1 else w for w in words) + rng.choice(["", " ", "."]))
    texts += [texts[-1], texts[-1]]
    return texts


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i if i % 11 else None, t, ("aa", "bb", None)[i % 3], 0.5, "clash") for i, t in enumerate(some_texts())]
    return spark.createDataFrame(rows + [rows[20]], DOCS)


def same_rows(df, want):
    got = sorted((tuple(r) for r in df.collect()), key=repr)
    assert got == sorted(want, key=repr)


def test_quality_measures(docs):
    def one(text):
        t = text or ""
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", t) if x]
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        grams = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
        twice = {i + k for i in range(len(w) - 4) if grams[tuple(w[i : i + 5])] > 1 for k in range(5)}
        return (len(w), sum(map(len, w)), sum(c in quality.SYMBOLS for c in t), len(lines) - len(set(lines)), len(twice))

    repeated = docs.withColumn("text", F.concat_ws("\n", "text", F.when(F.col("doc_id") % 2 == 0, F.col("text"))))
    got = quality.digest(repeated)
    rows = repeated.select("doc_id", "text").collect()
    want = [(r.doc_id, *one(r.text)) for r in rows]
    same_rows(got.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"), want)
    assert got.filter("base_failed AND kept").count() == 0
    assert quality.judge(docs.limit(0)).count() == 0


def test_quality_table_names_what_fails(spark):
    text = " ".join(f"the word{i} of" for i in range(10))
    rows = quality.judge(spark.createDataFrame([(1, text), (2, "####" * 9), (3, text + "\n" + text)], "doc_id bigint, text string")).orderBy("doc_id").collect()
    assert rows[0].kept and rows[0].failed == []
    assert not rows[1].kept and "few_symbols" in rows[1].failed
    assert rows[2].failed == ["few_repeated_words"]


def test_license_base_places(spark):
    texts = ["Licensed under CC-BY 4.0, cc by", "the General  Public\nLICENSE general public licenses", "All rights reserved. ALL RIGHTS RESERVED", "acc by cc byte", None, "", "cc by cc by"]
    docs = spark.createDataFrame([(i, t, 3) for i, t in enumerate(texts)], "doc_id bigint, text string, matches int")

    def one(i, text):
        w = re.findall(WORD, low(text))
        places = [(at, label) for phrase, label in licenses.BASE.items() for at in range(len(w)) if w[at : at + len(phrase.split())] == phrase.split()]
        starts = [p for p, _ in places]
        return (i, len(w), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places})))

    got = licenses.digest(docs)
    same_rows(got.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels"), [one(i, t) for i, t in enumerate(texts)])
    assert licenses.digest(docs.limit(0)).count() == 0


def test_license_places_in_a_long_text():
    """The cost follows the length of the text: 400,000 places are numbered one by one."""
    scanner = licenses.Scanner(licenses.NOTICES, licenses.BASE)
    n, base, matches, _ = scanner.scan("cc by " * 400_000 + "all rights reservd")
    assert n == 800_003 and [b["word"] for b in base] == list(range(0, 800_000, 2))
    assert [(m["word"], m["n_words"], m["edits"]) for m in matches] == [(800_000, 3, 1)]


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_license_notices_against_all_windows(spark):
    """Every notice within its edits is found, and none that no window of words comes near."""
    rng = random.Random(5)
    texts = []
    for notice in licenses.NOTICES:
        for edits in range(notice.edits + 3):
            chars = list(notice.words)
            for _ in range(edits):
                at = rng.randrange(len(chars))
                kind = rng.random()
                chars[at : at + 1] = ["q"] if kind < 0.4 else [] if kind < 0.7 else [chars[at], "z"]
            texts.append(f"Lorem ipsum, dolor {''.join(chars).upper()}. sit amet")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r.matches for r in licenses.scan(docs, ["doc_id"]).collect()}
    for i, text in enumerate(texts):
        w = re.findall(WORD, low(text))
        for notice in licenses.NOTICES:
            best = min((edit_distance(notice.words, " ".join(w[a:b])) for a in range(len(w)) for b in range(a + 1, len(w) + 1) if abs(len(" ".join(w[a:b])) - len(notice.words)) <= notice.edits), default=99)
            found = [m for m in got[i] if m.notice == notice.words]
            assert bool(found) == (best <= notice.edits), (text, notice, best)
            for m in found:
                assert m.edits == best
                span = " ".join(re.findall(WORD, low(text[m.start : m.stop])))
                assert edit_distance(span, notice.words) <= notice.edits


def test_packing_round_trip(spark, docs):
    from tokenizers import Tokenizer
    import public_tokenizers

    code = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    size = 64
    got = packing.pack(docs.select("doc_id", "text"), size=size, chunk=20, slack=2).collect()
    want = []
    for r in docs.collect():
        ids = code.encode(r.text or "", add_special_tokens=False).ids + [2]
        first = len(ids) % size or min(size, len(ids))
        cuts = [0, *range(first, len(ids) + 1, size)]
        for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want.append((r.doc_id, i, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    assert sorted(((*r[:5],) for r in got), key=repr) == sorted(want, key=repr)
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for members in bins.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= size
    tokens = sum(w[3] for w in want)
    assert len(bins) <= 1.1 * math.ceil(tokens / size) + 1
    assert packing.pack(docs.select("doc_id", "text").limit(0)).count() == 0


def test_best_fit_takes_the_tightest_bin():
    assert packing.best_fit(np.array([6, 5, 4, 3, 2]), 10) == [[0, 2], [1, 3, 4]]


def brute_lm(texts, learns):
    """Word base and interpolated byte model, by recursion over plain counts."""
    def words(t):
        return [w for w in re.split(r"[\x20\x09-\x0D]+", low(t)) if w]

    def symbols(t):
        return b"".join(w.encode() + b" " for w in words(t)) + b"\n"

    unigrams, grams = Counter(), Counter()
    for t, learn in zip(texts, learns):
        if learn:
            unigrams.update([*words(t), None])
            s = b"\n" * 4 + symbols(t)
            for i in range(4, len(s)):
                for k in range(5):
                    grams[s[i - k : i + 1]] += 1
    context = Counter()
    kinds = Counter()
    for g, n in grams.items():
        context[g[:-1]] += n
        kinds[g[:-1]] += 1

    def chance(h, c):
        lower = chance(h[1:], c) if h else 1 / 256
        n, t = context[h], kinds[h]
        return lower if not n else grams[h + c] / (n + t) + t / (n + t) * lower

    out = []
    total, v = sum(unigrams.values()), len(unigrams)
    for t in texts:
        w = [*words(t), None]
        s = b"\n" * 4 + symbols(t)
        out.append((len(w), sum(unigrams[x] > 0 for x in w), total, sum(math.log10((unigrams[x] + 1) / (total + v + 1)) for x in w), sum(math.log10(chance(s[i - 4 : i], s[i : i + 1])) for i in range(4, len(s)))))
    return out


@pytest.mark.parametrize("share,chunk", [(1e-9, 1 << 22), (0.01, 300)])
def test_lm_against_brute_force(spark, monkeypatch, share, chunk):
    monkeypatch.setattr(lm, "CHUNK", chunk)
    texts = some_texts(3, 40)
    learns = [i % 4 != 1 for i in range(len(texts))]
    docs = spark.createDataFrame([(i if i % 7 else None, t, x, "c") for i, (t, x) in enumerate(zip(texts, learns))], "doc_id bigint, text string, learns boolean, n_tokens string")
    docs = docs.drop("n_tokens")
    got = sorted((tuple(r) for r in lm.score(docs, keep=("doc_id",), share=share).collect()), key=lambda r: (r[1], r[2], round(r[4], 6), round(r[5], 6) * (share < 1e-6)))
    want = sorted(brute_lm(texts, learns), key=lambda r: (r[0], r[1], round(r[3], 6), round(r[4], 6) * (share < 1e-6)))
    assert [r[1:4] for r in got] == [w[:3] for w in want]
    np.testing.assert_allclose([r[4] for r in got], [w[3] for w in want], rtol=1e-9)
    if share < 1e-6:
        np.testing.assert_allclose([r[5] for r in got], [w[4] for w in want], rtol=1e-9)


@pytest.mark.parametrize("share", [0.0003, 0.003, 0.5])
def test_lm_scores_do_not_depend_on_the_share(spark, share):
    """n-grams outside the automaton have their whole counts too."""
    texts = some_texts(5, 40)
    learns = [i % 4 != 1 for i in range(len(texts))]
    docs = spark.createDataFrame(list(zip(range(len(texts)), texts, learns)), "doc_id bigint, text string, learns boolean")
    got = {r.doc_id: r.score for r in lm.score(docs, share=share).collect()}
    np.testing.assert_allclose([got[i] for i in range(len(texts))], [w[4] for w in brute_lm(texts, learns)], rtol=1e-9)


def test_lm_parts_of_a_long_text_agree_with_the_whole():
    texts = pa.array([None, "Some words\tand\r\n more  " * 50, "", "tail"])
    whole = list(lm.stretches(texts, 1 << 20))
    parts = list(lm.stretches(texts, 100))
    assert len(parts) > 5
    joined = np.concatenate([p.symbols[p.skip :] for p in parts])
    assert (joined == np.concatenate([p.symbols[p.skip :] for p in whole])).all()
    assert (np.concatenate([lm.word_hashes(p)[0] for p in parts]) == np.concatenate([lm.word_hashes(p)[0] for p in whole])).all()
    assert (np.concatenate([lm.gram_codes(p) for p in parts]) == np.concatenate([lm.gram_codes(p) for p in whole])).all()


def test_lm_without_learning_rows(spark):
    docs = spark.createDataFrame([(1, "a b", False), (2, None, None)], "doc_id bigint, text string, learns boolean")
    rows = {r.doc_id: r for r in lm.score(docs).collect()}
    assert rows[1].n_tokens == 3 and rows[2].n_tokens == 1 and rows[1].base_score == 0
    assert rows[2].score == pytest.approx(math.log10(1 / 256))
    assert lm.score(docs.limit(0)).count() == 0


def test_lm_probabilities_sum_to_one(spark):
    docs = spark.createDataFrame([(i, t, True) for i, t in enumerate(some_texts(4, 20))], "doc_id bigint, text string, learns boolean")
    model = lm.fit(lm.corpus_counts(docs), 1e-4)
    automaton = lm.Automaton(model.grams)
    chance = 10 ** automaton.log.reshape(-1, len(np.unique(automaton.classes)))
    sizes = np.bincount(automaton.classes, minlength=chance.shape[1])
    np.testing.assert_allclose(chance @ sizes, 1.0, rtol=1e-9)


def test_language_mixture(spark):
    rng = random.Random(2)
    words = {"aa": ["kalo", "mira", "tolu", "besa"], "bb": ["schrift", "wurzel", "knopf", "trank"], "cc": ["ñandu", "éxito", "caño", "año"]}

    def text(*langs, n=40):
        return " ".join(rng.choice(words[lang]) for lang in langs for _ in range(n))

    rows = [(i, text(lang), lang) for i, lang in enumerate(["aa", "bb", "cc"] * 20)]
    model = languages.learn(spark.createDataFrame(rows + [(1, None, "aa"), (2, "x", None)], "doc_id bigint, text string, lang string"))
    assert model[0] == ["aa", "bb", "cc"]
    asked = [(0, text("aa")), (1, text("bb", "cc", n=60)), (2, None), (3, ""), (4, "12 -- 7"), (5, text("cc", n=2000)), (None, text("bb")), (None, text("bb"))]
    docs = spark.createDataFrame([(i, t, 1.5) for i, t in asked], "doc_id bigint, text string, judged double")
    got = [r for r in languages.identify(docs, ["doc_id"], model).collect()]
    by = {r.doc_id: r for r in got}
    assert by[0].lang_pred == "aa" and by[0].score > 0.95 and len(by[0].languages) == 1
    assert {x.lang for x in by[1].languages} == {"bb", "cc"} and 0.4 < by[1].score < 0.6
    assert [by[i].lang_pred for i in (2, 3, 4)] == ["und"] * 3 and by[5].lang_pred == "cc"
    assert sum(r.doc_id is None and r.lang_pred == "bb" for r in got) == 2
    empty = languages.learn(docs.limit(0).withColumn("lang", F.lit("aa")))
    assert {r.lang_pred for r in languages.identify(docs, ["doc_id"], empty).collect()} == {"und"}


def test_mixture_of_all_languages(spark):
    """A text of four or five languages has them all, and its top language no more than its part."""
    rng = random.Random(7)
    words = {"aa": ["kalo", "mira", "tolu"], "bb": ["schrift", "wurzel", "knopf"], "cc": ["ñandu", "éxito", "caño"], "dd": ["wyżej", "łąka", "ćma"], "ee": ["fjörd", "þing", "ævi"]}
    text = lambda names: " ".join(rng.choice(words[x]) for x in names for _ in range(60))
    model = languages.learn(spark.createDataFrame([(i, text([x]), x) for i, x in enumerate(list(words) * 10)], "doc_id bigint, text string, lang string"))
    asked = [["aa"], ["aa", "cc", "dd", "ee"], list(words)]
    docs = spark.createDataFrame([(i, text(names)) for i, names in enumerate(asked)], "doc_id bigint, text string")
    for r in languages.identify(docs, ["doc_id"], model).collect():
        assert sorted(x.lang for x in r.languages) == asked[r.doc_id]
        assert abs(r.score - 1 / len(asked[r.doc_id])) < 0.1


def test_language_slices_agree(monkeypatch):
    text = ["Ein Wort, noch ein Wort " * 30, "kurz"]
    whole = [np.concatenate(x) for x in zip(*[(n + f, b, c) for f, n, b, c in languages.grams(text)])]
    monkeypatch.setattr(languages, "SLICE", 101)
    parts = [np.concatenate(x) for x in zip(*[(n + f, b, c) for f, n, b, c in languages.grams(text)])]
    assert all((a == b).all() for a, b in zip(whole, parts))


def test_url_rules_and_trees(spark):
    rng = random.Random(9)
    urls = [None, "", "no scheme", "http://", "HTTP://Example.ORG/es/x?q", "http://a.example.org/en/12", "http://a.example.org/en/2", "http://xorg/en/", "http://b.com/fr/1#x", "http://b.com/de/", "http://org/", "ftp://c.net?x://d.org/"]
    urls += [f"http://h{rng.randint(0, 9)}.com/{rng.choice(['fr', 'de'])}/{rng.randint(1, 999)}" for _ in range(200)]
    urls += [f"http://h{rng.randint(0, 9)}.net/{lang}/{rng.randint(1, 999)}" for lang in ("fr", "de") for _ in range(50)]
    pages = spark.createDataFrame([(i, u, "x", 2.0) for i, u in enumerate(urls)], "page_id bigint, url string, html string, score double")

    def one(i, url):
        m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
        host, path = (low(m[1]), m[2]) if m else ("", "")
        fit = [r for r in url_filter.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        best = max(fit, key=lambda r: len(r.text), default=None)
        return (i, host, path, best and best.text, best and best.verdict)

    got = {r.page_id: r for r in url_filter.digest(pages).collect()}
    assert len(got) == len(urls)
    for i, url in enumerate(urls):
        want = one(i, url)
        assert tuple(got[i])[:4] == want[:4], url
        assert got[i].verdict == want[4] if want[4] else got[i].verdict in ("allow", "block")
    learned = [r for r in got.values() if r.host.endswith(".net")]
    assert sum((r.verdict == "block") == r.path.startswith("/de/") for r in learned) > 0.9 * len(learned)
    assert url_filter.digest(pages.limit(0)).count() == 0
    assert {r.verdict for r in url_filter.digest(pages.filter("url LIKE '%//b.com/fr%' OR url = ''")).collect()} == {"allow"}


def test_every_query_has_its_columns(spark):
    folder = "/root/testdata/sf0.001"
    for name in ("op1_license_scan", "op4_backoff_automaton", "op7_language_mixture", "op8_best_fit_packing", "op9_quality_rules"):
        assert queries.QUERIES[name](spark, folder).columns[0] == "doc_id"
