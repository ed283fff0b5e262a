"""Restoration, toxicity scores, benchmark leaks and the pipeline, on small tables."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from patronlens.llm import decontamination, jaccard_join, toxicity

FOLDER = "/root/testdata/sf0.001"
PLAIN = "the river runs over stones and people walk along green hills with small houses near water light".split()
BAD = "moron idiot stupid trash".split()


@pytest.fixture(scope="module")
def learned(spark):
    rng = random.Random(4)
    rows = []
    for i in range(400):
        words = rng.choices(PLAIN, k=30)
        if i % 4 == 0:
            words[rng.randrange(30)] = rng.choice(BAD)
        rows.append((i, " ".join(words), int(i % 4 == 0)))
    rows += [(1000, None, 1), (1001, "no label", None), rows[0]]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    return toxicity.fitted(docs, docs.select("doc_id", "toxic"))


@pytest.mark.parametrize("written", ["m0ron", "mor0n", "m o r o n", "m.o.r.o.n", "mooooron", "1d10t", "idiiiot", "$tupid", "tr@sh", "tra5h!!", "st-u-p-i-d".replace("st", "s-t")])
def test_disguised_words_are_restored(learned, written):
    model, scorer = learned
    text = f"the river {written} runs"
    words, readings = toxicity.restored_words(text, toxicity.Decoder(model), scorer.collapsed)
    assert words & set(BAD), readings
    assert scorer.score(words) > 0.5


@pytest.mark.parametrize("written", ["stuppid", "stuppid,", "(stuppid)", "\"morron\".", "traash;", "stuppid?"])
def test_a_doubled_letter_beside_punctuation(learned, written):
    model, scorer = learned
    words, readings = toxicity.restored_words(f"the river {written} runs", toxicity.Decoder(model), scorer.collapsed)
    assert words & set(BAD), readings
    assert not toxicity.restored_words(f"green hills, {written}", toxicity.Decoder(model))[0] & set(BAD)


def test_plain_words_are_left_alone(learned):
    model, scorer = learned
    words, readings = toxicity.restored_words("people walk along hills, 1984 green houses!! with a small tree.", toxicity.Decoder(model), scorer.collapsed)
    assert all(a == b for a, b in readings.items()) and scorer.score(words) < 0.1


def test_viterbi_equals_all_paths(learned):
    model, _ = learned
    decoder = toxicity.Decoder(model)
    rng = random.Random(1)

    def cost(pieces):
        text, total, x, y = "".join(p for p, _ in pieces) + " ", sum(c for _, c in pieces), toxicity.EDGE, toxicity.EDGE
        for char in text:
            c = toxicity.EDGE if char == " " else toxicity._class(char)
            total += decoder.model[(x * toxicity.CLASSES + y) * toxicity.CLASSES + c]
            x, y = (toxicity.EDGE, toxicity.EDGE) if c == toxicity.EDGE else (y, c)
        return total, text.strip()

    for _ in range(60):
        written = "".join(rng.choices("aeorst0134$!ll ", k=6)).strip() or "a"
        steps = toxicity.Decoder.lattice(written)
        paths = [[]]
        for step in steps:
            paths = [p + [s] for p in paths for s in step]
        best = max(cost(p) for p in paths)
        got = decoder._viterbi(steps)
        assert max(c for c, t in map(cost, paths) if t == got) == pytest.approx(best[0])


def test_scores_of_odd_rows(spark, learned):
    rows = [(1, "you moron", "x"), (2, None, "x"), (3, "", None), (None, "green hills", "x"), (None, "green hills", "x"), (4, "moron " * 20_000, "x")]
    got = toxicity.score(spark.createDataFrame(rows, "doc_id bigint, text string, score_of string"), ["doc_id", "score_of"], *learned).collect()
    assert [r.predicted for r in sorted(got, key=lambda r: (r.doc_id is None, r.doc_id or 0))] == [1, 0, 0, 1, 0, 0]
    assert all(0 <= r.score <= 1 for r in got)
    docs = spark.createDataFrame([], "doc_id bigint, text string, toxic int")
    model, scorer = toxicity.fitted(docs, docs)
    assert toxicity.score(docs, ["doc_id"], model, scorer).count() == 0


def test_held_out_labels(spark):
    """Ranking of the held-out labelled documents of the small tables."""
    from patronlens.llm import queries

    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic")
    rows = queries.QUERIES["op2_toxicity"](spark, folder).filter("held_out").join(labels, "doc_id").collect()
    bad = [r.score for r in rows if r.toxic]
    good = [r.score for r in rows if not r.toxic]
    area = np.mean([(b > g) + 0.5 * (b == g) for b in bad for g in good])
    assert area > 0.75


def item_texts(rng):
    vocabulary = [f"term{i}" for i in range(300)]
    return [(i, " ".join(rng.choices(PLAIN, k=6) + rng.sample(vocabulary, rng.randint(8, 40)))) for i in range(30)]


def longest_common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_leaks_against_all_windows(spark):
    """Every planted leak is found, and what is found has the words in common that it says."""
    rng = random.Random(6)
    items = item_texts(rng)
    rows, planted = [], set()
    for d in range(120):
        words = rng.choices(PLAIN, k=rng.randint(0, 200))
        if d % 3 == 0:
            i, text = rng.choice(items)
            leak = text.split()
            for _ in range(len(leak) // 8 if d % 2 else 0):
                leak[rng.randrange(len(leak))] = "other"
            at = rng.randint(0, len(words))
            words[at:at] = [w.upper() + "!!" for w in leak] if d % 4 == 0 else leak
            planted.add((d, i))
        rows.append((d, " ".join(words), "n"))
    rows += [(None, None, "n"), (500, "", "n"), (501, ", ;", "n"), rows[0]]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, leaks string")
    benchmark = spark.createDataFrame([*items, (None, items[0][1]), (99, None), (98, "!"), items[1]], "item_id bigint, text string")
    got = decontamination.digest(docs, benchmark).collect()
    found = {(r.doc_id, r.item_id) for r in got if r.item_id is not None}
    assert found == planted
    assert {(r.doc_id, 0) for r in got if r.item_id is None} == {p for p in planted if p[1] == 0}
    by_id = dict(items)
    for r in got:
        item = re.findall(r"\w+", by_id[r.item_id or 0])
        text = re.findall(r"\w+", rows[r.doc_id][1].lower())
        assert r.common_words <= longest_common(item, text) and r.item_words == len(item)
    blocks = decontamination.scan(docs, benchmark, size=7)
    assert blocks.columns == ["doc_id", "text", "leaks"]
    assert {(r.doc_id, x.item_id) for r in blocks.collect() for x in r.leaks if x.item_id is not None} == planted
    assert decontamination.scan(docs.limit(0), benchmark).count() == 0
    assert decontamination.scan(docs, benchmark.limit(0)).filter(F.size("leaks") > 0).count() == 0


@pytest.fixture(scope="module")
def many_words(spark):
    """A corpus of 500 topics, more than the decomposition has directions, and items of topic words or of rare words."""
    rng = random.Random(12)
    topics = [[f"topic{t}x{k}" for k in range(6)] for t in range(500)]
    vocabulary = [f"filler{i}" for i in range(500)]
    texts = []
    for _ in range(2500):
        texts.append([])
        for _ in range(rng.randint(2, 10)):
            stretch = rng.choices(rng.choice(topics), k=16) + rng.choices(vocabulary, k=32)
            texts[-1] += rng.sample(stretch, 48)
    items = [(i, " ".join(rng.choices(sum(topics, []), k=rng.randint(15, 59)))) for i in range(100)]
    items += [(i, " ".join(rng.choices([f"rare{r}" for r in range(4000)], k=rng.randint(15, 59)))) for i in range(100, 200)]
    index = decontamination.fit(spark.createDataFrame([(" ".join(t),) for t in texts], "text string"), items)
    return rng, vocabulary, texts, items, index


@pytest.mark.parametrize("replaced,least", [(0.0, 1.0), (0.1, 0.9), (0.25, 0.9), (0.4, 0.9)])
def test_recall_on_a_large_vocabulary(many_words, replaced, least):
    """Of the planted leaks that the verifier accepts where they lie, the cosine search finds all copies and 0.9 of the paraphrases."""
    rng, vocabulary, texts, items, index = many_words
    assert len(index.vocabulary) > 10 * decontamination.RANK
    planted, accepted = [], []
    for i, text in items:
        words = text.split()
        for at in rng.sample(range(len(words)), round(replaced * len(words))):
            words[at] = rng.choice(vocabulary)
        hashes = decontamination.words_of(_texts([" ".join(words)]))[0]
        common, answer = decontamination.common_words(index.words[i], hashes.tolist()), len(index.answers[i] & set(hashes.tolist()))
        size = len(index.words[i])
        accepted.append(common >= decontamination.LITERAL * size or (common >= decontamination.PARAPHRASE * size and answer >= min(decontamination.ANSWER_FOUND, len(index.answers[i]))))
        around = rng.choice(texts)
        at = rng.randint(0, len(around))
        planted.append(" ".join(around[:at] + words + around[at:]))
    found = [any(x["item_id"] == i for x in leaks) for (i, _), leaks in zip(items, decontamination.leaks_in(index, _texts(planted)))]
    assert sum(accepted) > 50
    assert sum(f for f, ok in zip(found, accepted) if ok) >= least * sum(accepted)


def test_long_items_are_found(spark):
    """Copies and paraphrases of items of 600 and more words, whole and with words replaced; a short part is no leak."""
    rng = random.Random(9)
    vocabulary = [f"long{i}" for i in range(3000)]
    items = [(i, " ".join(rng.choices(vocabulary, k=n))) for i, n in enumerate([600, 1500, 97, 96, 400, 20])]
    rows, want = [], set()
    for d in range(60):
        words = [rng.choice(PLAIN) for _ in range(rng.randint(0, 400))]
        i, text = items[d % 6]
        leak = text.split()
        for at in rng.sample(range(len(leak)), len(leak) * (d // 6 % 3) // 10):
            leak[at] = "other"
        at = rng.randint(0, len(words))
        if d < 48:
            want.add((d, i))
        else:
            leak = leak[: len(leak) // 4]
        rows.append((d, " ".join(words[:at] + leak + words[at:])))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    got = decontamination.digest(docs, benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want
    assert all(r.common_words == r.item_words for r in got if r.doc_id // 6 % 3 == 0)
    assert len(list(decontamination.item_blocks(benchmark, 20))) > 2


def test_common_words_and_recall_of_candidates():
    rng = random.Random(3)
    for _ in range(300):
        a, b = (rng.choices(range(6), k=rng.randint(1, 70)) for _ in range(2))
        assert decontamination.common_words(np.array(a), b) == longest_common(a, b)


def test_decomposition_is_close_to_the_exact_one(spark):
    rng = np.random.default_rng(2)
    dense = rng.poisson(0.3, (200, 40)) * (1 + 5 * (rng.random(40) < 0.2))
    rows = [([int(t) for t in np.flatnonzero(x)], [int(v) for v in x[x > 0]]) for x in dense]
    sample = spark.createDataFrame(rows, "terms array<bigint>, times array<bigint>")
    none = np.zeros(0, np.int64)
    basis = decontamination.randomised_svd(sample, (none, none, none), np.ones(40), rank=8)
    exact = np.linalg.svd(dense, full_matrices=False)
    assert np.linalg.norm(dense @ basis) >= 0.97 * np.linalg.norm(exact.S[:8])


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    counts = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = stage(spark, docs, FOLDER).cache()
        assert docs.columns == columns and docs.schema.simpleString() == before.schema.simpleString(), name
        counts.append(docs.count())
        if name in ("toxicity", "decontamination"):
            assert docs.join(before, ["doc_id", "text"], "left_anti").count() == 0
        if name == "jaccard_join":
            sets = [jaccard_join.shingle_sets(_texts([r.text]))[0] for r in docs.select("text").collect()]
            for i, a in enumerate(sets):
                for b in sets[:i]:
                    common = len(np.intersect1d(a, b))
                    assert not len(a) or 100 * common < 85 * (len(a) + len(b) - common)
    assert counts == sorted(counts, reverse=True) and counts[-1] > 100
    benchmark = [r.text for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    assert not [1 for r in docs.collect() for b in benchmark if b in r.text]
    packed = corpus_pipeline.run(spark, FOLDER)
    assert packed.select("doc_id").distinct().count() == counts[-1]


def test_pipeline_drops_near_copies(spark):
    """Pairs just above and just below the stage's threshold, by appended text and by replaced words."""
    def shingles(text):
        w = text.split()
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}

    texts, want = [], set()
    for k, (extra, replaced) in enumerate([(44, 0), (0, 4), (60, 0), (0, 7), (50, 0)]):
        base = [f"p{k}w{i}" for i in range(204)]
        near = base + [f"p{k}e{i}" for i in range(extra)]
        for r in range(replaced):
            near[20 + 25 * r] = f"p{k}r{r}"
        a, b = shingles(" ".join(base)), shingles(" ".join(near))
        share = len(a & b) / len(a | b)
        assert not 0.85 <= share
        texts += [(2 * k, " ".join(base)), (2 * k + 1, " ".join(near))]
        want |= {2 * k} | ({2 * k + 1} if share < 0.8 else set())
    assert len(want) == 7
    got = corpus_pipeline.one_of_each_group(spark, spark.createDataFrame(texts, "doc_id bigint, text string"), FOLDER).collect()
    assert {r.doc_id for r in got} == want


def test_stages_carry_columns_of_any_name(spark):
    """Columns named like those the operators add come through unchanged, with nulls, empty texts and repeated rows."""
    names = "label node predicted score restored row_key removed n_lines leaks text_hash _text judged_text _key carried_0".split()
    texts = [(1, "one plain line of words here"), (1, "one plain line of words here"), (2, None), (3, ""), (None, "words without an id\nand a line")]
    rows = [(i, t, None if t is None else len(t), *[f"{n}-{k}" for n in names]) for k, (i, t) in enumerate(texts)]
    schema = "doc_id bigint, text string, n_chars int, " + ", ".join(f"`{n}` string" for n in names)
    docs = spark.createDataFrame(rows, schema)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, FOLDER)
        assert got.schema.simpleString() == docs.schema.simpleString(), name
        carried = [tuple(r)[3:] for r in got.collect()]
        assert len(carried) == (4 if name == "jaccard_join" else 5) and set(carried) <= {r[3:] for r in rows}, name
        assert stage(spark, docs.limit(0), FOLDER).count() == 0, name


def test_short_items_and_small_shares(spark):
    """Items of one and two words are found, and a tiny share of a large corpus still names a sample."""
    corpus = [(i, " ".join(random.Random(i).choices(PLAIN, k=60))) for i in range(300)]
    corpus += [(1000, "some more words zyxwort qwertzu and more"), (1001, "nothing but onlyword among others")]
    docs = spark.createDataFrame(corpus, "doc_id bigint, text string")
    items = spark.createDataFrame([(1, "zyxwort qwertzu"), (2, "onlyword")], "item_id bigint, text string")
    assert {(r.doc_id, r.item_id) for r in decontamination.digest(docs, items).collect()} == {(1000, 1), (1001, 2)}
    assert decontamination.fit(docs, [(1, "the river runs over stones")], fit_passages=1e-6).project.shape[0] > 0


def _texts(values):
    import pyarrow as pa

    return pa.array(values, pa.string())


def test_decomposition_covers_all_passages(spark, monkeypatch):
    """More passages than the bounded sample of former times had; all of them are counted, and their sums are exact."""
    seen = []

    def spied(sample, items, weights, *more):
        seen.append(sample.count())
        return svd(sample, items, weights, *more)

    svd = decontamination.randomised_svd
    monkeypatch.setattr(decontamination, "randomised_svd", spied)
    docs = spark.range(120_000).selectExpr("concat('river ', 'a', id % 97, ' b', id % 89) AS text")
    decontamination.fit(docs, [(1, " ".join(f"a{i} b{i}" for i in range(80)))])
    assert seen[0] == docs.filter("cast(substring(split(text, ' ')[1], 2) AS int) < 80 OR cast(substring(split(text, ' ')[2], 2) AS int) < 80").count()

    rng = np.random.default_rng(4)
    dense = rng.poisson(0.3, (300, 30))
    rows = spark.createDataFrame([([int(t) for t in np.flatnonzero(x)], [int(v) for v in x[x > 0]]) for x in dense], "terms array<bigint>, times array<bigint>")
    for held in (1 << 21, 50):
        monkeypatch.setattr(decontamination, "HELD_PAIRS", held)
        got = {(r.a, r.b): r.n for r in decontamination.co_occurrences(rows).collect()}
        gram = dense.T @ dense
        assert got == {(a, b): gram[a, b] for a in range(30) for b in range(a, 30) if gram[a, b]}
