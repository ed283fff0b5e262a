"""The words of texts in pieces, and the passages that are looked at for leaks."""

import random

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from patronlens.llm import decontamination, lm


def _words_one_by_one(texts):
    """The words' hashes by the symbols of the language model, and how many words come before each text."""
    hashes, docs = [], []
    for part in lm.stretches(pc.utf8_lower(texts.cast(pa.large_string())), fold=decontamination._FOLD):
        h, d = lm.word_hashes(part)
        hashes += h[h != lm.END_WORD].tolist()
        docs += d[h != lm.END_WORD].tolist()
    return hashes, np.searchsorted(docs, np.arange(len(texts) + 1)).tolist()


@pytest.mark.parametrize("piece", [5, 40, 1 << 17])
def test_words_of_texts_in_pieces(piece, monkeypatch):
    monkeypatch.setattr(decontamination, "PIECE", piece)
    rng = random.Random(piece)
    texts = [None, "", " ", "a", "Ab ", "Ä é x 日本 Y", "x" * 60, "Hello  World--foo\n\nbar"] * 3 + ["".join(rng.choices("ab ä-9", k=rng.randint(0, 90))) for _ in range(50)]
    rng.shuffle(texts)
    for given in (pa.array(texts, pa.string()), pa.array(texts, pa.string())[7:40], pa.array([], pa.string()), pa.array([None, ""], pa.string())):
        words, bounds = decontamination.words_of(given)
        assert (words.tolist(), bounds.tolist()) == _words_one_by_one(given)


def test_few_passages_are_projected_and_no_candidate_is_lost(spark, monkeypatch):
    """The products of a passage's own terms leave out what cannot reach an item; with all passages the candidates are the same."""
    rng = random.Random(17)
    pool = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(900)]
    wide = [*pool, *("".join(rng.choices("ijklmnop", k=5)) for _ in range(4000))]
    items = [(i, " ".join(rng.choices(pool, k=rng.choice([3, 8, 30, 150])))) for i in range(40)]
    texts = [" ".join(rng.choices(wide, k=rng.randint(1, 400))) for _ in range(60)]
    for i, x in items:
        words = x.split()
        texts.append(" ".join([*rng.choices(wide, k=30), *(w for w in words if rng.random() < 0.7), *rng.choices(wide, k=20)]))
    index = decontamination.fit(spark.createDataFrame([(t,) for t in texts], "text string"), items)
    halves = decontamination.halves_of(*decontamination.words_of(pa.array(texts)), index.vocabulary)
    order = np.argsort(halves.half, kind="stable")
    first, last = decontamination.passages(halves)
    kept = decontamination.reaching(index, halves.half[order], halves.term[order], first, last)
    assert 0 < len(kept) < 0.8 * len(first)
    got = sorted((*place, round(cosine, 4)) for *place, cosine in decontamination.candidates(index, halves))
    monkeypatch.setattr(decontamination, "reaching", lambda index, half, term, first, last: np.arange(len(first)))
    assert got == sorted((*place, round(cosine, 4)) for *place, cosine in decontamination.candidates(index, halves))
    assert len({x[3] for x in got}) > 30
