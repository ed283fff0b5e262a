"""Benchmark decontamination by latent semantic retrieval.

Texts are overlapping passages of words; benchmark items are the queries. TF-IDF weights over the words of the items, with
document frequencies from all passages of the corpus, are projected onto the span of all items of a block and beside it
the directions of a randomised singular value decomposition, which is fitted on all items and all passages: one distributed
pass counts which words meet in a passage, and the rounds of the decomposition read these counts. Passages whose cosine with an item reaches ``COSINE`` are candidates; a longest common subsequence of words verifies near-literal copies, and together with the
item's most telling words (its answer) paraphrases.

An item of more than ``WHOLE`` words is searched by its passages, each a row of its own, and verified as a whole.
Items come in blocks of about ``BLOCK`` rows, so what each task holds is bounded but for a longer item; every block is held against all passages of
all texts. A text is judged where it is read: nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronlens.llm import lm
from patronlens.llm.common import sliced
from patronlens.session import materialise

#: Words of half a passage: passages are two halves long and begin at every half.
HALF = 24
#: Latent dimensions of the corpus, and extra ones of the random start. The items' own directions come beside them.
RANK, EXTRA = 224, 16
POWER_ROUNDS = 2
#: Bytes of texts whose words are hashed at once.
PIECE = 1 << 17
#: Bits of a word's hash that tell whether it may be one of the vocabulary.
VOCABULARY_BITS = 20
#: Pairs of words whose counts a task holds before it gives them out.
HELD_PAIRS = 1 << 21
#: Rows of the items in a block, about.
BLOCK = 200
#: Words of an item that is searched as one row. A longer one is searched by passages like those of the texts, and still
#: verified whole: no passage of a text reaches a fair share of a long item's length.
WHOLE = 4 * HALF
#: Words of more than this share of all passages say nothing about a passage and are left out of the vectors, but for items
#: that have fewer than ``TELLING`` other words.
FREQUENT, TELLING = 0.01, 4
#: Words of the vectors that a passage needs to be compared; fewer if a row of an item has so few that a paraphrase of it would not.
FEWEST = 3
COSINE = 0.35
#: Least share of an item's own length that a passage reaches in the item's direction: one or two words in common do not.
REACH = 0.15
#: Share of an item's words in the common subsequence: alone, and with the answer words present.
LITERAL, PARAPHRASE = 0.8, 0.5
#: Most telling words of an item, and how many of them a paraphrase must hold.
ANSWER_WORDS, ANSWER_FOUND = 5, 3
SEED = 11

_FOLD = np.full(256, lm.BLANK, np.uint8)
_FOLD[48:58] = np.arange(48, 58)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)

LEAK = "struct<item_id:bigint,cosine:double,common_words:int,item_words:int,answer_words:int,start_word:bigint>"
_LEAK = pa.struct([("item_id", pa.int64()), ("cosine", pa.float64()), ("common_words", pa.int32()), ("item_words", pa.int32()), ("answer_words", pa.int32()), ("start_word", pa.int64())])


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, first word of each text and the end): letters, digits and all beyond ASCII, lower-cased."""
    texts = pc.utf8_lower(texts.cast(pa.large_string())).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    words, starts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    start, end = int(offsets[0]), int(offsets[-1])
    while start < end:
        # texts of about PIECE bytes together; a longer one in parts that are cut between words
        stop = int(offsets[np.searchsorted(offsets, start + PIECE, side="right") - 1])
        if stop <= start:
            text_end = int(offsets[np.searchsorted(offsets, start, side="right")])
            stop = min(start + PIECE, text_end)
            while stop < text_end and _FOLD[data[stop - 1]] != lm.BLANK:
                stop += 1
        inside = offsets[np.searchsorted(offsets, start, side="right") : np.searchsorted(offsets, stop)]
        hashed, first = _hashed_words(_FOLD[data[start:stop]], inside - start)
        words.append(hashed)
        starts.append(first + start)
        start = stop
    return np.concatenate(words), np.searchsorted(np.concatenate(starts), offsets)


def _hashed_words(symbols: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first symbol) of the words between blanks and ``cuts``; the hashes of ``lm.word_hashes``."""
    word = symbols != lm.BLANK
    opens, closes = word.copy(), word.copy()
    opens[1:] &= ~word[:-1]
    closes[:-1] &= ~word[1:]
    opens[cuts], closes[cuts - 1] = word[cuts], word[cuts - 1]
    start, stop = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    with np.errstate(over="ignore"):
        power = lm._powers(len(symbols) + 1)
        total = np.zeros(len(symbols) + 1, np.uint64)
        np.cumsum(lm._MIX[symbols] * power[: len(symbols)], out=total[1:])
        # a word's hash counts the blank after it
        hashed = (total[stop] - total[start]) * lm._inverse_powers(len(symbols))[start] + lm._MIX[lm.BLANK] * power[stop - start]
        hashed ^= hashed >> np.uint64(29)
        hashed *= np.uint64(0xBF58476D1CE4E5B9)
        hashed ^= hashed >> np.uint64(32)
    return hashed.view(np.int64), start


@dataclass
class Halves:
    """Half passages of texts: text of each, and the vocabulary words in them as (half, term)."""

    doc: np.ndarray
    first: np.ndarray
    half: np.ndarray
    term: np.ndarray


def halves_of(words: np.ndarray, bounds: np.ndarray, vocabulary: np.ndarray) -> Halves:
    sizes = np.diff(bounds)
    count = -(-sizes // HALF)
    first = np.concatenate([[0], np.cumsum(count)])
    # few words share their last bits with one of the vocabulary; only these are searched for
    held = np.zeros(1 << VOCABULARY_BITS, bool)
    held[vocabulary & (len(held) - 1)] = True
    known = np.flatnonzero(held[words & (len(held) - 1)])
    at = np.searchsorted(vocabulary, words[known])
    found = at < len(vocabulary)
    found[found] = vocabulary[at[found]] == words[known[found]]
    known, at = known[found], at[found]
    doc = np.searchsorted(bounds, known, side="right") - 1
    return Halves(np.repeat(np.arange(len(sizes)), count), first, first[doc] + (known - bounds[doc]) // HALF, at)


def passages(halves: Halves) -> tuple[np.ndarray, np.ndarray]:
    """(first half, last half) of each passage: two neighbours of a text, or its only half."""
    n = len(halves.doc)
    begin = np.arange(n)
    paired = np.append(halves.doc[1:] == halves.doc[:-1], False)[:n] if n else np.zeros(0, bool)
    alone = ~paired & (halves.first[halves.doc] == begin) if n else paired
    keep = paired | alone
    return begin[keep], begin[keep] + paired[keep]


def _pair_counts(halves: Halves) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(passage, term, times) of the vocabulary words of all passages."""
    a, b = passages(halves)
    of = np.full((2, len(halves.doc)), -1)
    of[0, a] = np.arange(len(a))
    two = b > a
    of[1, b[two]] = np.flatnonzero(two)
    passage = np.concatenate([of[0, halves.half], of[1, halves.half]])
    term = np.concatenate([halves.term, halves.term])
    key, n = np.unique((passage[passage >= 0] << 32) | term[passage >= 0], return_counts=True)
    return key >> 32, key & 0xFFFFFFFF, n


def document_frequencies(docs: DataFrame, vocabulary: np.ndarray, text: str) -> tuple[int, np.ndarray]:
    """(number of passages of the corpus, passages that hold each vocabulary word)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(len(vocabulary), np.int64), 0
        for batch in sliced(batches, 0):
            halves = halves_of(*words_of(batch.column(0)), vocabulary)
            n += len(passages(halves)[0])
            total += np.bincount(_pair_counts(halves)[1], minlength=len(vocabulary))
        found = np.append(-1, np.flatnonzero(total))
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(np.append(n, total[found[1:]]))], names=["term", "n"])

    rows = docs.select(text).mapInArrow(run, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(len(vocabulary) + 1, np.int64)
    counts[rows.column("term").to_numpy()] = rows.column("n").to_numpy()
    return int(counts[-1]), counts[:-1]


def _product(sparse: tuple[np.ndarray, np.ndarray, np.ndarray], dense: np.ndarray) -> np.ndarray:
    """transpose(X) (X dense) for sparse rows X given as (row, column, value) sorted by row."""
    row, column, value = sparse
    out = np.zeros_like(dense)
    step = 1 << 15
    starts = np.flatnonzero(np.append(True, row[1:] != row[:-1])) if len(row) else np.zeros(0, np.int64)
    for s in range(0, len(starts), step // 8):
        group = starts[s : s + step // 8]
        stop = starts[s + step // 8] if s + step // 8 < len(starts) else len(row)
        cut = slice(group[0], stop)
        weighted = dense[column[cut]] * value[cut, None]
        rows = np.add.reduceat(weighted, group - group[0], axis=0)
        back = np.repeat(rows, np.diff(np.append(group, stop)), axis=0) * value[cut, None]
        np.add.at(out, column[cut], back)
    return out


def _pairs_within(row: np.ndarray, term: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(smaller term and larger term as one number, product of their times) for all pairs of a row's terms, each with itself too.

    Entries are sorted by row; a row has a term once.
    """
    keys, products = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    at, apart = np.arange(len(row)), 0
    while len(at):
        a, b = term[at], term[at + apart]
        keys.append(np.minimum(a, b) << 32 | np.maximum(a, b))
        products.append(times[at] * times[at + apart])
        apart += 1
        at = at[at + apart < len(row)]
        at = at[row[at + apart] == row[at]]
    return np.concatenate(keys), np.concatenate(products)


def _summed(keys: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, numbers = keys[order], numbers[order]
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
    return keys[starts], np.add.reduceat(numbers, starts) if len(starts) else numbers


def co_occurrences(rows: DataFrame) -> DataFrame:
    """(a, b, n) for a <= b: the products of the times of terms a and b, summed over all rows (terms, times).

    Tasks sum what they read and hold a bounded number of pairs; the result has a row for each pair of terms at most.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def told(keys: np.ndarray, numbers: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(keys >> 32), pa.array(keys & 0xFFFFFFFF), pa.array(numbers)], names=["a", "b", "n"])

        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0
        for batch in batches:
            sizes = pc.list_value_length(batch.column(0)).to_numpy()
            term, times = (pc.list_flatten(batch.column(k)).to_numpy() for k in (0, 1))
            held.append(_pairs_within(np.repeat(np.arange(len(sizes)), sizes), term, times))
            size += len(held[-1][0])
            if size > HELD_PAIRS:
                held = [_summed(*map(np.concatenate, zip(*held)))]
                size = len(held[0][0])
                if size > HELD_PAIRS // 2:
                    yield told(*held[0])
                    held, size = [], 0
        if held:
            yield told(*_summed(*map(np.concatenate, zip(*held))))

    return rows.select("terms", "times").mapInArrow(run, "a bigint, b bigint, n bigint").groupBy("a", "b").agg(F.sum("n").alias("n"))


def randomised_svd(sample: DataFrame, items: tuple, weights: np.ndarray, rank: int = RANK, seed: int = SEED) -> np.ndarray:
    """Leading right singular vectors (terms x rank) of the TF-IDF rows of ``sample`` (terms, times) and of the items.

    Each round multiplies a thin matrix by transpose(A) A, which is summed once over all rows: every task does so for its
    pairs of terms, the driver adds one thin matrix for each of a fixed number of tasks.
    """
    n = len(weights)
    width = min(rank + EXTRA, n)
    thin = np.linalg.qr(np.random.default_rng(seed).standard_normal((n, width)))[0]
    together = materialise(co_occurrences(sample).repartition(8, "a").sortWithinPartitions("a"))

    def multiplied(by: np.ndarray) -> np.ndarray:
        by = by.astype(np.float32)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros_like(by)
            for batch in batches:
                a, b, count = (batch.column(k).to_numpy() for k in range(3))
                value = (count * weights[a] * weights[b]).astype(np.float32)
                apart = a != b
                for x, y, v in ((a, b, value), (b[apart], a[apart], value[apart])):
                    order = np.argsort(x, kind="stable")
                    x, y, v = x[order], y[order], v[order]
                    starts = np.flatnonzero(np.append(True, x[1:] != x[:-1])[: len(x)])
                    if len(starts):
                        total[x[starts]] += np.add.reduceat(by[y] * v[:, None], starts, axis=0)
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["part"])

        parts = together.coalesce(8).mapInArrow(run, "part binary").toArrow().column("part").to_pylist()
        row, term, times = items
        total = _product((row, term, (times * weights[term]).astype(np.float32)), by).astype(float)
        for part in parts:
            total += np.frombuffer(part, np.float32).reshape(by.shape)
        return total

    for _ in range(POWER_ROUNDS):
        thin = np.linalg.qr(multiplied(thin))[0]
    small = thin.T @ multiplied(thin)
    values, vectors = np.linalg.eigh((small + small.T) / 2)
    return thin @ vectors[:, np.argsort(-values)[:rank]]


def latent_basis(items: np.ndarray, corpus: np.ndarray) -> tuple[np.ndarray, int]:
    """(orthonormal basis of the items' rows and then of what the corpus directions add, number of the items' directions).

    Every item lies in the basis with its full length, whatever the energy of the corpus.
    """
    own, sizes, _ = np.linalg.svd(items.T, full_matrices=False)
    own = own[:, sizes > 1e-6 * max(sizes.max(initial=0.0), 1e-9)]
    rest = corpus - own @ (own.T @ corpus)
    beside, sizes, _ = np.linalg.svd(rest - own @ (own.T @ rest), full_matrices=False)
    return np.hstack([own, beside[:, sizes > 1e-4]]), own.shape[1]


@dataclass
class Index:
    """Items in latent space and what verifies a candidate. The first ``own`` dimensions span the items' rows; ``item`` has
    the item of each row. ``row`` and ``share`` have, from ``begin`` of a term on, the rows that hold it and the share of the
    row's own length that it brings a passage."""

    vocabulary: np.ndarray
    project: np.ndarray
    own: int
    latent: np.ndarray
    item: np.ndarray
    items: list[int]
    words: list[np.ndarray]
    answers: list[frozenset]
    kinds: list[frozenset]
    lengths: np.ndarray
    begin: np.ndarray
    row: np.ndarray
    share: np.ndarray
    fewest: int = FEWEST


def search_rows(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(item, first word, end) of the rows that items of so many words are searched by: whole, or passages at every half."""
    rows = [(i, a, min(a + 2 * HALF, n)) for i, n in enumerate(sizes.tolist()) for a in (range(0, n - HALF, HALF) if n > WHOLE else (0,))]
    item, start, stop = np.array(rows, np.int64).reshape(-1, 3).T
    whole = sizes[item] <= WHOLE
    return item, start, np.where(whole, sizes[item], stop)


def fit(docs: DataFrame, items: list[tuple[int, str]], text: str = "text", rank: int = RANK, fit_passages: float | None = None) -> Index:
    """The index of a block of items. Document frequencies and the decomposition cover all items and all passages.

    With ``fit_passages`` the decomposition sees only the passages of texts whose hash lies in the share that gives about so many.
    """
    hashes, bounds = words_of(pa.array([t for _, t in items], pa.string()))
    words = [hashes[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
    vocabulary = np.unique(hashes)
    n, df = document_frequencies(docs, vocabulary, text)
    all_weights = np.log((n + 2) / (df + 1))
    order = dict(zip(vocabulary.tolist(), all_weights.tolist()))
    seldom = df <= FREQUENT * n
    telling = seldom.copy()
    for w in words:
        mine = np.searchsorted(vocabulary, np.unique(w))
        if seldom[mine].sum() < TELLING:
            telling[mine] = True
    vocabulary, weights = vocabulary[telling], all_weights[telling]
    hash_bits = 62

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 0):
            passage, term, times = _pair_counts(halves_of(*words_of(batch.column(0)), vocabulary))
            cuts = np.append(np.flatnonzero(np.append(True, passage[1:] != passage[:-1])), len(passage)) if len(passage) else np.zeros(1, np.int64)
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(v.astype(np.int64))) for v in (term, times)], names=["terms", "times"])

    chosen = docs.select(text)
    if fit_passages is not None:
        hashed = F.xxhash64(text).bitwiseAND(F.lit((1 << hash_bits) - 1))
        chosen = chosen.filter(hashed < F.lit(int(min(1.0, fit_passages / max(n, 1)) * (1 << hash_bits))))
    sample = chosen.mapInArrow(rows, "terms array<bigint>, times array<bigint>")
    term = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
    known = vocabulary[term] == hashes
    item, start, stop = search_rows(np.diff(bounds))
    of = np.repeat(np.arange(len(item)), stop - start)
    word = np.arange(len(of)) - np.repeat(np.cumsum(stop - start) - stop + start, stop - start) + (bounds[item] + start)[of]
    key, times = np.unique((of << 32 | term[word])[known[word]], return_counts=True)
    row, column = key >> 32, key & 0xFFFFFFFF
    distinct = np.bincount(row, minlength=len(item))
    fewest = max(1, min(FEWEST, int(PARAPHRASE * distinct[distinct > 0].min(initial=2 * FEWEST))))
    rows_of_items = np.zeros((len(item), len(weights)))
    rows_of_items[row, column] = times * weights[column]
    basis, own = latent_basis(rows_of_items, randomised_svd(sample, (row, column, times), weights, rank))
    project = (basis * weights[:, None]).astype(np.float32)
    latent = np.zeros((len(item), project.shape[1]), np.float32)
    np.add.at(latent, row, project[column] * times[:, None])
    norms = np.linalg.norm(latent, axis=1, keepdims=True)
    latent /= np.maximum(norms, 1e-9)
    by_term = np.argsort(column, kind="stable")
    begin, holder = np.searchsorted(column[by_term], np.arange(len(weights) + 1)), row[by_term]
    # a passage's product with a row, by terms: what the basis of all rows gives too
    share = (times * weights[column] ** 2)[by_term] / np.maximum(norms[:, 0].astype(float) ** 2, 1e-18)[holder]
    answers = [frozenset(sorted(set(w.tolist()), key=lambda h: (-order[h], h))[:ANSWER_WORDS]) for w in words]
    return Index(vocabulary, project, own, latent, item, [i for i, _ in items], words, answers, [frozenset(w.tolist()) for w in words], norms[:, 0], begin, holder, share, fewest)


def common_words(item: np.ndarray, window: list[int]) -> int:
    """Length of the longest common subsequence; one bit for each word of the item."""
    places: dict[int, int] = {}
    for i, w in enumerate(item.tolist()):
        places[w] = places.get(w, 0) | 1 << i
    full = (1 << len(item)) - 1
    row = full
    for w in window:
        if at := places.get(w):
            met = row & at
            row = (row + met | row - met) & full
    return len(item) - row.bit_count()


def _ranges(start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the range, place) for all places of all ranges."""
    sizes = stop - start
    return np.repeat(np.arange(len(start)), sizes), np.arange(sizes.sum()) + np.repeat(start - np.cumsum(sizes) + sizes, sizes)


def reaching(index: Index, half: np.ndarray, term: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Numbers of the passages that may reach REACH of a row's length (a little less, for sums are rounded). ``half`` is sorted."""
    rows = len(index.lengths)
    largest = np.zeros(len(index.begin) - 1)
    np.maximum.at(largest, np.repeat(np.arange(len(largest)), np.diff(index.begin)), index.share)
    start, stop = np.searchsorted(half, first), np.searchsorted(half, last, side="right")
    total = np.append(0.0, np.cumsum(largest[term]))
    may = np.flatnonzero(total[stop] - total[start] >= 0.99 * REACH)
    found, step = [np.zeros(0, np.int64)], max(1, (1 << 19) // max(1, rows))
    for a in range(0, len(may), step):
        now = may[a : a + step]
        passage, entry = _ranges(start[now], stop[now])
        of, place = _ranges(index.begin[term[entry]], index.begin[term[entry] + 1])
        shares = np.bincount(passage[of] * rows + index.row[place], weights=index.share[place], minlength=len(now) * rows)
        found.append(now[shares.reshape(len(now), rows).max(axis=1) >= 0.99 * REACH])
    return np.concatenate(found)


def candidates(index: Index, halves: Halves, cosine: float = COSINE) -> Iterator[tuple[int, int, int, int, float]]:
    """(text, first half, last half, item, cosine) of passages near a row of an item."""
    n, own = len(halves.doc), index.own
    order = np.argsort(halves.half, kind="stable") if (np.diff(halves.half) < 0).any() else slice(None)
    half, term = halves.half[order], halves.term[order]
    step = 1 << 15

    def placed(project: np.ndarray, half: np.ndarray, term: np.ndarray) -> np.ndarray:
        place = np.zeros((n, project.shape[1]), np.float32)
        for a in range(0, len(half), step):
            mine = half[a : a + step]
            starts = np.flatnonzero(np.append(True, mine[1:] != mine[:-1]))
            place[mine[starts]] += np.add.reduceat(project[term[a : a + step]], starts, axis=0)
        return place

    first, last = passages(halves)
    held = np.bincount(halves.half, minlength=n)
    enough = held[first] + np.where(last > first, held[last], 0) >= index.fewest
    first, last = first[enough], last[enough]
    # most passages reach no item's share, which a few products of their terms tell
    keep = reaching(index, half, term, first, last)
    first, last = first[keep], last[keep]
    if not len(first):
        return
    asked = np.zeros(n, bool)
    asked[first] = asked[last] = True
    half, term = half[asked[half]], term[asked[half]]
    # the items' dimensions give every product with an item, and a cosine that is never too small; the others are looked at
    # only for the halves of passages that reach an item there
    place = placed(np.ascontiguousarray(index.project[:, :own]), half, term)
    latent = np.ascontiguousarray(index.latent[:, :own].T)
    found = []
    for a in range(0, len(first), step):
        x, y = first[a : a + step], last[a : a + step]
        vectors = place[x] + np.where((y > x)[:, None], place[y], 0)
        length = np.einsum("ij,ij->i", vectors, vectors)
        along = vectors @ latent
        p, i = np.nonzero((along >= cosine * np.sqrt(length)[:, None]) & (along >= REACH * index.lengths) & (index.lengths > 0))
        found.append((x[p], y[p], i, along[p, i], length[p]))
    x, y, i, along, length = (np.concatenate(parts) for parts in zip(*found)) if found else (np.zeros(0, np.int64),) * 5
    if not len(x):
        return
    asked = np.zeros(n, bool)
    asked[x] = asked[y] = True
    beside = placed(np.ascontiguousarray(index.project[:, own:]), half[asked[half]], term[asked[half]])
    for a in range(0, len(x), step):
        cut = slice(a, a + step)
        vectors = beside[x[cut]] + np.where((y[cut] > x[cut])[:, None], beside[y[cut]], 0)
        near = along[cut] / np.maximum(np.sqrt(length[cut] + np.einsum("ij,ij->i", vectors, vectors)), 1e-9)
        for k in np.flatnonzero(near >= cosine).tolist():
            yield int(halves.doc[x[a + k]]), int(x[a + k]), int(y[a + k]), int(index.item[i[a + k]]), float(near[k])


def leaks_in(index: Index, texts: pa.Array) -> list[list[dict]]:
    """For each text the items that leak into it, each with its best passage."""
    words, bounds = words_of(texts)
    out: list[dict[int, dict]] = [{} for _ in range(len(texts))]
    # about a million words at a time
    a = 0
    while a < len(texts):
        b = max(a + 1, int(np.searchsorted(bounds, bounds[a] + (1 << 20), side="right")) - 1)
        halves = halves_of(words[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a], index.vocabulary)
        near: dict[tuple[int, int, int, int], float] = {}
        for *place, cosine in candidates(index, halves):
            near[tuple(place)] = max(cosine, near.get(tuple(place), 0.0))
        for (doc, first, last, i), cosine in near.items():
            held = out[a + doc].get(i)
            if held is not None and held["common_words"] == held["item_words"]:
                continue
            begin, end = int(bounds[a + doc]), int(bounds[a + doc + 1])
            item = index.words[i]
            margin = max(len(item) // 2, len(item) - HALF)
            start = max(begin, begin + int(first - halves.first[doc]) * HALF - margin)
            window = words[start : min(end, begin + int(last + 1 - halves.first[doc]) * HALF + margin)].tolist()
            distinct = set(window)
            if len(index.kinds[i] & distinct) + len(item) - len(index.kinds[i]) < PARAPHRASE * len(item):
                continue  # too few words in common in any order
            common = common_words(item, window)
            answer = len(index.answers[i] & distinct)
            enough = min(ANSWER_FOUND, len(index.answers[i]))
            if common >= LITERAL * len(item) or (common >= PARAPHRASE * len(item) and answer >= enough):
                if held is None or common > held["common_words"]:
                    out[a + doc][i] = {"item_id": index.items[i], "cosine": min(1.0, cosine), "common_words": common, "item_words": len(item), "answer_words": answer, "start_word": start - begin}
        a = b
    return [list(found.values()) for found in out]


def item_blocks(benchmark: DataFrame, size: int = BLOCK) -> Iterator[list[tuple[int, str]]]:
    """Items with a word, in blocks of about ``size`` rows of the search; one with more rows makes its block as much larger."""
    known = benchmark.filter(F.col("text").rlike(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")).select(F.col("item_id").cast("bigint").alias("item_id"), "text").distinct()
    words = F.size(F.split("text", r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"))
    rows = F.when(words > WHOLE, F.ceil(words / F.lit(HALF)) - 1).otherwise(1)
    blocks = max(1, -(-(known.agg(F.sum(rows)).first()[0] or 0) // size))
    for k in range(blocks):
        rows = known.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).orderBy("item_id", "text").collect()
        if rows:
            yield [(r.item_id, r.text) for r in rows]


def scan(docs: DataFrame, benchmark: DataFrame, text: str = "text", size: int = BLOCK) -> DataFrame:
    """``docs`` with ``leaks``: benchmark items (item_id, text) that a text holds literally or paraphrased.

    leaks: item_id (null for an item without one), cosine and start word of the best passage, common words, item words,
    answer words. Null, empty and wordless texts and items leak nothing. Repeated rows are judged alike, equal items
    (id and text) count once; an empty table gives an empty table and an empty benchmark no leaks.
    """
    clean = docs.drop("leaks")
    out = clean.withColumn("leaks", F.array().cast(f"array<{LEAK}>"))
    at = clean.columns.index(text)
    first = True
    for block in item_blocks(benchmark, size):
        index = fit(clean, block, text)
        out = out if first else materialise(out)
        first = False

        def run(batches: Iterator[pa.RecordBatch], index: Index = index) -> Iterator[pa.RecordBatch]:
            for batch in sliced(batches, at):
                before = batch.column(batch.num_columns - 1).to_pylist()
                found = [a + b for a, b in zip(before, leaks_in(index, batch.column(at)))]
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, pa.list_(_LEAK))], names=batch.schema.names)

        out = out.mapInArrow(run, out.schema)
    return out


def digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The result of the query: one row for each document and item that leaks into it."""
    return scan(docs.select("doc_id", "text"), benchmark).select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")
