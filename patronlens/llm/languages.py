"""Language identification by mixture inference.

Each language is a distribution over hashed letter trigrams, counted over all learning texts. A document is a mixture of
languages: expectation-maximisation estimates its proportions, for the whole language set and for the nested sets
of its strongest one, two, three and more languages; the set with the best penalised likelihood (Schwarz) is taken.

The model has ``buckets`` numbers for each language, whatever the corpus; learning sums counts map-side, and a
document is judged by itself, so nothing but counts is exchanged.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 16
#: Added to each trigram count of a language.
SMOOTHING = 0.05
ROUNDS = 6
#: Characters handled at once; longer texts are counted in slices.
SLICE = 1 << 20


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _buckets(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of the trigram around each letter, and the letters' places; all else counts as one blank."""
    letter = _letters()[codes]
    padded = np.zeros(len(codes) + 2, np.uint32)
    padded[1:-1] = np.where(letter, codes, 0)
    at = np.flatnonzero(letter)
    mixed = padded[at] * np.uint32(0x9E3779B1) ^ padded[at + 1] * np.uint32(0x85EBCA77) ^ padded[at + 2] * np.uint32(0xC2B2AE3D)
    mixed ^= mixed >> np.uint32(15)
    mixed *= np.uint32(0x2C1B3C6D)
    return (mixed >> np.uint32(16)).astype(np.int64), at


def grams(texts: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first text, number in group, bucket, count), texts in groups of about SLICE characters, sorted by text.

    A text longer than that forms its own group and is counted in slices, so memory follows SLICE and BUCKETS.
    """
    start, held, size = 0, [], 0
    for i, text in enumerate(texts):
        if len(text) > SLICE:
            if held:
                yield start, *_counted(held)
            total = np.zeros(BUCKETS, np.int64)
            low = text.lower()
            for a in range(0, len(low), SLICE):
                part = np.frombuffer(low[max(0, a - 1) : a + SLICE + 1].encode("utf-32-le"), "<u4")
                bucket, at = _buckets(part)
                inside = (at >= (a > 0)) & (at < SLICE + (a > 0))
                total += np.bincount(bucket[inside], minlength=BUCKETS)
            found = np.flatnonzero(total)
            yield i, np.zeros(len(found), np.int64), found, total[found]
            start, held, size = i + 1, [], 0
            continue
        if held and size + len(text) > SLICE:
            yield start, *_counted(held)
            start, held, size = i, [], 0
        held.append(text)
        size += len(text) + 1
    if held:
        yield start, *_counted(held)


def _counted(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    low = [t.lower() for t in texts]
    codes = np.frombuffer("\n".join(low).encode("utf-32-le"), "<u4")
    ends = np.cumsum([len(t) + 1 for t in low])
    bucket, at = _buckets(codes)
    keys = np.sort(np.searchsorted(ends, at, side="right") * BUCKETS + bucket)
    if not len(keys):
        return keys, keys, keys
    new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    unique = keys[new]
    return unique // BUCKETS, unique % BUCKETS, np.diff(np.append(new, len(keys)))


def learn(docs: DataFrame, text: str = "text", lang: str = "lang") -> tuple[list[str], np.ndarray]:
    """(languages, probability of each bucket under each) from the rows with a language and a text.

    Counts are summed in each task and then by language and bucket; the driver gets one row for each of these.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column(1).to_pylist()
            for first, number, bucket, count in grams(batch.column(0).to_pylist()):
                of = [langs[first + i] for i in range(int(number[-1]) + 1)] if len(number) else []
                for name in set(of):
                    mine = np.array([x == name for x in of])[number]
                    if name not in sums:
                        sums[name] = np.zeros(BUCKETS, np.int64)
                    sums[name] += np.bincount(bucket[mine], count[mine], BUCKETS).astype(np.int64)
        for name, counts in sums.items():
            found = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(found), pa.string()), pa.array(found.astype(np.int32)), pa.array(counts[found])], names=["lang", "bucket", "n"])

    counts = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(text, F.col(lang).cast("string")).mapInArrow(run, "lang string, bucket int, n bigint")
    rows = counts.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    languages = sorted(set(rows.column("lang").to_pylist()))
    number = {name: k for k, name in enumerate(languages)}
    model = np.full((BUCKETS, len(languages)), SMOOTHING)
    model[rows.column("bucket").to_numpy(), [number[x] for x in rows.column("lang").to_pylist()]] += rows.column("n").to_numpy()
    return languages, (model / model.sum(axis=0)).astype(np.float32)


def proportions(likely: np.ndarray, count: np.ndarray, starts: np.ndarray, per_doc: np.ndarray, allowed: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Expectation-maximisation over the allowed languages of each document: proportions and log-likelihood.

    likely: probability of each trigram (sorted by document) under each language; starts: first trigram of each document.
    """
    share = allowed / allowed.sum(axis=1, keepdims=True)
    weight = count.astype(np.float32)[:, None]
    for _ in range(rounds):
        joint = likely * np.repeat(share, per_doc, axis=0)
        joint *= weight / joint.sum(axis=1, keepdims=True)
        share = np.add.reduceat(joint, starts, axis=0)
        share /= share.sum(axis=1, keepdims=True)
    mixed = np.einsum("ij,ij->i", likely, np.repeat(share, per_doc, axis=0))
    return share, np.add.reduceat(count * np.log(mixed, dtype=np.float64), starts)


def infer(model: np.ndarray, number: np.ndarray, bucket: np.ndarray, count: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """(document numbers, proportions of the selected language set) for the documents that have a trigram."""
    docs, starts = np.unique(number, return_index=True)
    per_doc = np.diff(np.append(starts, len(number)))
    likely = model[bucket]
    n_languages = model.shape[1]
    total = np.add.reduceat(count, starts)
    full, full_fit = proportions(likely, count, starts, per_doc, np.ones((len(docs), n_languages), np.float32), rounds)
    rank = np.argsort(np.argsort(-full, axis=1, kind="stable"), axis=1, kind="stable")
    best_value, best = np.full(len(docs), -np.inf), full
    for m in range(1, n_languages + 1):
        share, fit = (full, full_fit) if 1 < m == n_languages else proportions(likely, count, starts, per_doc, (rank < m).astype(np.float32), rounds if m > 1 else 0)
        value = fit - 0.5 * (m - 1) * np.log(total)
        better = value > best_value
        best_value = np.where(better, value, best_value)
        best = np.where(better[:, None], share, best)
    return docs, best


def identify(docs: DataFrame, keep: list[str], model: tuple[list[str], np.ndarray], text: str = "text", least: float = 0.05) -> DataFrame:
    """Columns ``keep`` with lang_pred, score (its proportion) and languages (the set: name and proportion of at least ``least``).

    A null text and one without a letter give 'und', score 0 and no languages; so does every text when nothing was
    learned. Ties go to the language that comes first by name. Repeated rows are judged alike and all returned.
    """
    names, table = model
    kind = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema.fields) + ", lang_pred string, score double, languages array<struct<lang:string,share:double>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [("und", 0.0, [])] * batch.num_rows
            texts = [t or "" for t in batch.column(batch.num_columns - 1).to_pylist()]
            for first, number, bucket, count in grams(texts) if names else ():
                if not len(number):
                    continue
                which, shares = infer(table, number, bucket, count)
                tops = shares.argmax(axis=1)
                for i, top, row in zip(which.tolist(), tops.tolist(), shares.tolist()):
                    found[first + i] = (names[top], min(1.0, row[top]), [{"lang": names[k], "share": row[k]} for k in range(len(names)) if row[k] >= least])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64()), pa.array([f[2] for f in found], kind)],
                names=[*keep, "lang_pred", "score", "languages"],
            )

    return docs.select(*keep, F.col(text).alias("judged_text")).mapInArrow(run, schema)
