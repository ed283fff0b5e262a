"""Toxicity: noisy-channel restoration of disguised words, then a score of the restored text.

A character trigram model is counted over the words of all texts. A disguised word (letters written as digits or signs,
letters repeated, letters set apart) is a lattice: each written sign may stand for itself or for a letter, a run of equal
letters for one or two, a separator for nothing or for a word end. Viterbi decoding under the trigram model and the
channel's costs picks the reading. Words that have one reading only are their own reading, so most words cost a look-up.

The score is learned from labelled texts: words and word beginnings that mark one class (log-odds over distinct texts),
and a logistic curve over the marks of a restored text. Scoring reads each text by itself; nothing is shuffled.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronlens.llm.common import sliced
from patronlens.session import materialise

#: Signs and the letters they may stand for (fixed values).
SIGNS = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "*": "aeiou"}
SEPARATORS = " .-_·"
#: log10 costs of the channel: a sign for a letter, a sign kept, a run for one letter, a run for two, two letters for one, a separator for a word end.
SIGN_COST, KEEP_COST, SINGLE_COST, DOUBLE_COST, PAIR_COST, WORD_END_COST = -0.5, -2.0, -0.3, -0.6, -2.0, -1.0
#: Classes of the character model: a-z, any other letter or sign, word end.
OTHER, EDGE, CLASSES = 26, 27, 28
PREFIXES = (4, 6)
#: Labels that the score is fitted on at most (those with the smallest hash of the id).
MAX_LABELLED = 50_000
#: Toxic texts that a mark needs.
MIN_TEXTS = 5
THRESHOLD = 0.3
#: Readings remembered by a task.
CACHE = 200_000

_WORD = re.compile(r"[^\W_]+")
_PLAIN = re.compile(r"[a-zß-öø-ÿ]+")
_SIGN = "".join(re.escape(s) for s in SIGNS)
#: A token with a sign before a letter and a letter somewhere.
_MIXED = re.compile(rf"[{_SIGN}]+[^\W\d_]|[^\W\d_][{_SIGN}]+[^\W\d_]")
_RUN = re.compile(r"([^\W\d_])\1\1")
_DOUBLE = re.compile(r"([^\W\d_])\1+")
_ONE = rf"(?:[^\W\d_]|[{_SIGN}])"
#: Single letters or signs, each set apart from the next by one separator or two equal ones.
_APART = re.compile(rf"(?<!\S){_ONE}(?:([{SEPARATORS[:2]}\-_·])\1?{_ONE}){{2,}}(?![^\s.,;:?])")


def _class(char: str) -> int:
    return ord(char) - 97 if "a" <= char <= "z" else OTHER


def trigram_model(docs: DataFrame, text: str = "text", smoothing: float = 0.5) -> np.ndarray:
    """log10 probability of each class after two others, from the letter words of all texts: CLASSES ** 3 numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CLASSES**3, np.int64)
        kind = np.full(0x10000, OTHER, np.int32)
        kind[[c for c in range(0x10000) if not chr(c).isalpha()]] = EDGE
        kind[97:123] = np.arange(26)
        for batch in batches:
            for value in batch.column(0):
                if not (t := value.as_py()):
                    continue
                for a in range(0, len(t), 1 << 20):
                    codes = np.frombuffer(f" {t[a : a + (1 << 20)].lower()} ".encode("utf-32-le"), "<u4")
                    c = kind[np.minimum(codes, 0xFFFF)]
                    c = c[np.append(True, (c[1:] != EDGE) | (c[:-1] != EDGE))]
                    # a word begins after its edge: the class before the edge does not count
                    first = np.append(EDGE, c[:-2])
                    first[1:][c[:-2] == EDGE] = EDGE
                    total += np.bincount((np.where(c[:-1] == EDGE, EDGE, first) * CLASSES + c[:-1]) * CLASSES + c[1:], minlength=CLASSES**3)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), pa.array(total[found])], names=["trigram", "n"])

    rows = docs.select(text).mapInArrow(run, "trigram int, n bigint").groupBy("trigram").agg(F.sum("n").alias("n")).toArrow()
    counts = np.full(CLASSES**3, smoothing)
    counts[rows.column("trigram").to_numpy()] += rows.column("n").to_numpy()
    counts = counts.reshape(CLASSES * CLASSES, CLASSES)
    return np.log10(counts / counts.sum(axis=1, keepdims=True)).ravel()


class Decoder:
    """Viterbi decoding of one disguised stretch of text."""

    def __init__(self, model: np.ndarray):
        self.model = model.tolist()
        self.known: dict[str, str] = {}

    def read(self, written: str) -> str:
        """The best reading; words are separated by blanks. ``written`` is lower-cased."""
        if (found := self.known.get(written)) is None:
            if len(self.known) >= CACHE:
                self.known.clear()
            found = self.known[written] = self._viterbi(self.lattice(written))
        return found

    @staticmethod
    def lattice(written: str) -> list[list[tuple[str, float]]]:
        """For each step the pieces that may be meant and their costs."""
        steps, i = [], 0
        apart = len(written) > 2 and written[1] in SEPARATORS
        while i < len(written):
            char, n = written[i], 1
            while i + n < len(written) and written[i + n] == char:
                n += 1
            i += n
            if char in SEPARATORS:
                steps.append([("", 0.0), (" ", WORD_END_COST if apart and n == 1 else 0.0)])
                continue
            meant = [(letter, SIGN_COST) for letter in SIGNS.get(char, "")] + [(char, KEEP_COST if char in SIGNS else 0.0)]
            if n == 1:
                steps.append(meant)
            else:
                steps.append([(c, cost + (SINGLE_COST if n > 2 else PAIR_COST)) for c, cost in meant] + [(c + c, cost + (DOUBLE_COST if n > 2 else 0.0)) for c, cost in meant])
        return steps

    def _viterbi(self, steps: list[list[tuple[str, float]]]) -> str:
        best = {(EDGE, EDGE): (0.0, "")}
        for pieces in [*steps, [(" ", 0.0)]]:
            after: dict[tuple[int, int], tuple[float, str]] = {}
            for ((a, b), (score, text)), (piece, cost) in product(best.items(), pieces):
                now, x, y = score + cost, a, b
                for char in piece:
                    c = EDGE if char == " " else _class(char)
                    now += self.model[(x * CLASSES + y) * CLASSES + c]
                    x, y = (EDGE, EDGE) if c == EDGE else (y, c)
                if (x, y) not in after or now > after[x, y][0]:
                    after[x, y] = (now, text + piece)
            best = after
        return max(best.values())[1].strip()


def restored_words(text: str, decoder: Decoder, collapsed: frozenset[str] = frozenset()) -> tuple[set[str], dict[str, str]]:
    """(distinct words of the restored text, disguised stretch -> reading). ``text`` is lower-cased.

    ``collapsed``: marked words with each run of letters as one; a word with a doubled letter is decoded if it is one of
    these, for nearly every clean text has doubled letters. A mark as a reading of a run without word ends counts too.
    """
    tokens = set(text.split())
    readings: dict[str, str] = {}

    def doubled(word: str) -> bool:
        return bool(collapsed and _DOUBLE.search(word)) and _DOUBLE.sub(r"\1", word) in collapsed

    for token in tokens:
        if _PLAIN.fullmatch(token):
            if _RUN.search(token) or doubled(token):
                readings[token] = decoder.read(token)
        else:
            core = token.strip(".,;:?\"'()[]{}«»")
            if _MIXED.search(core) or _RUN.search(core):
                readings[core] = decoder.read(core)
                if (tail := core.rstrip("!*$|+")) != core and tail:
                    readings[tail] = decoder.read(tail)
            elif _PLAIN.fullmatch(core) and doubled(core):
                readings[core] = decoder.read(core)
    for m in _APART.finditer(text):
        if not any(map(str.isalpha, m[0])):
            continue
        readings[m[0]] = f"{decoder.read(m[0])} {decoder.read(re.sub(rf'[{SEPARATORS}]', '', m[0]))}"
    words = {w for w in tokens if w.isalpha()}
    words.update(_WORD.findall(" ".join(tokens - words)))
    for reading in readings.values():
        words.update(_WORD.findall(reading))
    return words, readings


@dataclass
class Scorer:
    """Marks (words, and beginnings that end in '^') with their log-odds, and the logistic curve over a text's marks."""

    words: dict[str, float] = field(default_factory=dict)
    prefixes: dict[str, float] = field(default_factory=dict)
    curve: tuple[float, ...] = (-2.2, 0.0, 0.0, 0.0)

    @property
    def collapsed(self) -> frozenset[str]:
        return frozenset(_DOUBLE.sub(r"\1", w) for w in self.words)

    def features(self, words: set[str]) -> tuple[float, float, float]:
        """Strongest mark, second strongest, and the logarithm of the number of marks."""
        found = [self.words[w] for w in words & self.words.keys()]
        for n in PREFIXES:
            found += [self.prefixes[p] for p in {w[:n] for w in words} & self.prefixes.keys()]
        found.sort(reverse=True)
        return (found[0] if found else 0.0, found[1] if len(found) > 1 else 0.0, math.log1p(len(found)))

    def score(self, words: set[str]) -> float:
        z = self.curve[0] + sum(c * x for c, x in zip(self.curve[1:], self.features(words)))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def _marks(counts: dict[str, tuple[int, int]], n_clean: int, n_toxic: int) -> Scorer:
    """Marks of at least MIN_TEXTS toxic texts whose log-odds, less two standard errors, are over 0.5.

    counts: clean and toxic texts with each mark; a mark that ends in '^' is a beginning. A mark weighs that lower bound, so
    one of many texts outweighs one of few.
    """
    weights = {}
    for mark, (clean, toxic) in counts.items():
        if toxic >= MIN_TEXTS:
            cells = (toxic + 0.5, n_toxic - toxic + 0.5, clean + 0.5, n_clean - clean + 0.5)
            bound = math.log(cells[0] * cells[3] / (cells[1] * cells[2])) - 2 * math.sqrt(sum(1 / c for c in cells))
            if bound > 0.5:
                weights[mark] = bound
    return Scorer({m: w for m, w in weights.items() if m[-1] != "^"}, {m[:-1]: w for m, w in weights.items() if m[-1] == "^"})


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> tuple[float, ...]:
    """Newton steps for a ridge logistic regression; the constant is not drawn to zero."""
    x = np.column_stack([np.ones(len(x)), x])
    beta, pull = np.zeros(x.shape[1]), np.array([0.0] + [ridge] * (x.shape[1] - 1))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(pull + 1e-6), x.T @ (y - p) - pull * beta)
        beta += step
        if np.abs(step).max() < 1e-6:
            break
    return tuple(beta.tolist())


def learn(docs: DataFrame, labels: DataFrame, model: np.ndarray, max_labelled: int = MAX_LABELLED) -> Scorer:
    """Marks and curve from texts (doc_id, text) and labels (doc_id, toxic 0/1).

    Rows without an id, text or label teach nothing, equal texts teach once. At most ``max_labelled`` labels are used, those
    with the smallest hash of the id; so few go to every task, and no text is shuffled. Restoring, counting and
    features are jobs over the sample; the driver gets marks of several toxic texts and three numbers a text. The curve is
    fitted on each half of the texts with marks of the other half, so it knows how far marks hold on other texts. Without
    both classes every score is the same.
    """
    known = labels.filter("doc_id IS NOT NULL AND toxic IN (0, 1)").select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    sample = known.distinct().orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(max_labelled)
    texts = docs.filter("text IS NOT NULL").select("doc_id", "text")
    labelled = texts.join(F.broadcast(sample), "doc_id").select(F.xxhash64("text").alias("order"), "toxic", "text")

    def restore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(model)
        for batch in sliced(batches, 2):
            words = [sorted(restored_words(t.as_py().lower(), decoder)[0]) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(words, pa.list_(pa.string()))], names=["order", "toxic", "words"])

    restored = labelled.mapInArrow(restore, "order bigint, toxic int, words array<string>")
    texts = materialise(restored.groupBy("order").agg(F.min("toxic").alias("toxic"), F.first("words").alias("words")).withColumn("half", F.pmod(F.hash("order"), F.lit(2))))
    starts = [F.transform("words", lambda w, n=n: F.when(F.length(w) >= n, F.concat(F.substring(w, 1, n), F.lit("^")))) for n in PREFIXES]
    marks = texts.select("toxic", "half", F.explode(F.array_compact(F.array_distinct(F.concat("words", *starts)))).alias("mark"))
    cell = {(t, h): F.count(F.when((F.col("toxic") == t) & (F.col("half") == h), 1)) for t in (0, 1) for h in (0, 1)}
    names = {key: f"n{key[0]}{key[1]}" for key in cell}
    found = marks.groupBy("mark").agg(*[c.alias(names[key]) for key, c in cell.items()]).filter(f"n10 + n11 >= {MIN_TEXTS}").collect()
    sizes = {(r.toxic, r.half): r["count"] for r in texts.groupBy("toxic", "half").count().collect()}
    n = {(t, h): sizes.get((t, h), 0) for t in (0, 1) for h in (0, 1)}
    if not (n[0, 0] + n[0, 1] and n[1, 0] + n[1, 1]):
        return Scorer(curve=(4.0 if n[1, 0] + n[1, 1] else -2.2, 0.0, 0.0, 0.0))
    by_half = [_marks({r.mark: (r[names[0, h]], r[names[1, h]]) for r in found}, n[0, h], n[1, h]) for h in (0, 1)]

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([by_half[1 - h].features(set(w)) for h, w in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, x.T)], names=["toxic", "first", "second", "n"])

    points = texts.select("toxic", "half", "words").mapInArrow(featured, "toxic int, first double, second double, n double").toArrow()
    points = np.array([c.to_numpy() for c in points.columns], float).T
    points = points[np.lexsort(points.T)]
    scorer = _marks({r.mark: (r.n00 + r.n01, r.n10 + r.n11) for r in found}, n[0, 0] + n[0, 1], n[1, 0] + n[1, 1])
    scorer.curve = _logistic(points[:, 1:], points[:, 0])
    return scorer


def score(docs: DataFrame, keep: list[str], model: np.ndarray, scorer: Scorer, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Columns ``keep`` with score (0 to 1), predicted (1 from ``threshold`` on) and restored (array of stretch and reading).

    A null or empty text has no marks and gets the curve's lowest score. restored lists the readings that differ from
    what is written. Repeated rows are scored alike and all returned; an empty table gives none. ``keep`` may hold any
    columns but the three added.
    """
    pair = pa.list_(pa.struct([("written", pa.string()), ("read", pa.string())]))
    at = keep.index(text) if text in keep else len(keep)  # a text that is kept goes to the workers once
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema.fields) + ", score double, predicted int, restored array<struct<written:string,read:string>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder, collapsed = Decoder(model), scorer.collapsed
        for batch in sliced(batches, at):
            scores, restored = [], []
            for value in batch.column(at):
                words, readings = restored_words((value.as_py() or "").lower(), decoder, collapsed)
                scores.append(scorer.score(words))
                restored.append([{"written": a, "read": b} for a, b in sorted(readings.items()) if a != b])
            values = pa.array(scores, pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], values, pa.array([int(s >= threshold) for s in scores], pa.int32()), pa.array(restored, pair)], names=[*keep, "score", "predicted", "restored"])

    return docs.select(*keep, *([] if at < len(keep) else [F.col(text).alias("judged_text")])).mapInArrow(run, schema)


def fitted(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, Scorer]:
    """Character model of all texts of ``docs`` and the scorer learned from ``labels``."""
    model = trigram_model(docs)
    return model, learn(docs, labels, model)
