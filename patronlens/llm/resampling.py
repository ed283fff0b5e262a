"""Importance resampling towards a target text: array-scored weights and a distributed LSD radix sort.

Words and word pairs are hashed into buckets. What the target has more of than the corpus gives a bucket a gain; a text's
weight is the mean gain of its features, looked up in one array. A Gumbel number drawn from the id turns the weights into a
sample without replacement: the rows of the highest scores are drawn.

The ranks come from a radix sort over the digits of (score descending, id ascending), lowest digit first. A pass counts the
digits in blocks of consecutive places; the sums of all lower digits, and of the same digit in earlier blocks, give each
(block, digit) its first destination, and rows keep their order within it. No pass compares keys across blocks, gathers
more than a block's rows of one digit or orders the table in one task.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from itertools import repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from patronlens.llm.common import UPPER, sliced
from patronlens.session import materialise

BUCKETS = 10_000
SEED = 7
#: Texts with fewer words are never drawn.
LEAST_WORDS = 20
#: Percentage of the texts with enough words that is drawn.
PERCENT = 25
#: Bits of a digit of the sort.
DIGIT = 11
#: Places of a block of the sort, at most and at least; between them it follows the rows, for some blocks a shuffle partition.
BLOCK, LEAST_BLOCK = 1 << 16, 1 << 9

#: Every byte that is no word's becomes a blank, A-Z become a-z. Beyond ASCII all bytes are letters.
_PLAIN = bytes(b if b >= 0x80 or chr(b).isdigit() or chr(b).islower() else b + 32 if chr(b).isupper() else 32 for b in range(256))

SCORED = "n_words bigint, n_features bigint, weight bigint, score bigint"


def words(text: bytes) -> list[bytes]:
    """Lower-cased words of letters, digits and characters beyond ASCII, as UTF-8."""
    return text.translate(_PLAIN).split()


def feature_buckets(text: bytes, buckets: int = BUCKETS) -> tuple[int, np.ndarray]:
    """Number of words, and the bucket of each word and of each pair of neighbours joined by a blank."""
    found = words(text)
    single = list(map(crc32, found))
    pairs = map(crc32, found[1:], map(crc32, repeat(b" "), single))  # the checksum goes on from that of the first word
    return len(found), np.fromiter((*single, *pairs), np.int64) % buckets


def _bytes(column: pa.Array) -> list[bytes]:
    return [t or b"" for t in column.cast(pa.large_binary()).to_pylist()]


def bucket_counts(docs: DataFrame, text: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """Number of features of all texts in each bucket: one row of counts a task and bucket, summed map-side."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for part in sliced(batches, 0):
            found = [feature_buckets(value, buckets)[1] for value in _bytes(part.column(0))]
            total += np.bincount(np.concatenate(found), minlength=buckets)
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(total[there])], names=["bucket", "n"])

    sums = docs.select(text).mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    counts = np.zeros(buckets, np.int64)
    for bucket, n in sums.collect():  # as many rows as buckets
        counts[bucket] = n
    return counts


def gains(target: np.ndarray, corpus: np.ndarray) -> np.ndarray:
    """floor(1000 * log ratio) of each bucket's smoothed share in the target and in the corpus."""
    buckets, all_target, all_corpus = len(target), float(target.sum()), float(corpus.sum())
    return np.array(
        [math.floor(1000 * math.log((t + 1) * (all_corpus + buckets) / ((s + 1) * (all_target + buckets)))) for t, s in zip(target.astype(float).tolist(), corpus.astype(float).tolist())],
        np.int64,
    )


def gumbel(key: str) -> int:
    """floor(1000 * a Gumbel number) that depends on the key alone."""
    h = int(hashlib.sha256(key.encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weigh(docs: DataFrame, keep: list[str], gain: np.ndarray, text: str = "text", id: str = "doc_id", seed: int = SEED) -> DataFrame:
    """Columns ``keep`` with n_words, n_features, weight (floored mean gain; 0 without features) and score (weight + Gumbel number).

    A null text counts as empty, a null id as ''. Columns of ``docs`` outside ``keep`` play no part, whatever their names;
    ``keep`` must not hold the four new names.
    """
    width = len(keep)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema), SCORED])
    key, value = "_key", "_value"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sliced(batches, width + 1):
            rows = []
            for k, t in zip(part.column(width).to_pylist(), _bytes(part.column(width + 1))):
                n_words, at = feature_buckets(t, len(gain))
                weight = int(gain[at].sum()) // len(at) if len(at) else 0
                rows.append((n_words, len(at), weight, weight + gumbel(f"{seed}:{k or ''}")))
            new = [pa.array(c, pa.int64()) for c in zip(*rows)]
            yield pa.RecordBatch.from_arrays([*part.columns[:width], *new], names=[*part.schema.names[:width], "n_words", "n_features", "weight", "score"])

    given = docs.select(*keep, F.col(id).cast("string").alias(key), F.col(text).alias(value))
    return given.mapInArrow(run, schema)


def _digits(low: int, high: int, column: str) -> list[Column]:
    """Digits of the column, lowest first: of its distance from ``low``, or of all 64 bits where that is no signed number."""
    near = high - low < 1 << 63
    value = F.col(column).cast("bigint") - low if near else F.col(column).bitwiseXOR(F.lit(-1 << 63))
    bits = (high - low).bit_length() if near else 64
    return [F.shiftrightunsigned(value, at).bitwiseAND((1 << DIGIT) - 1).cast("int") for at in range(0, bits, DIGIT)]


def counting_pass(rows: DataFrame, digit: Column, block: int, at: str = "_at", first: bool = False) -> DataFrame:
    """The rows with their places ``at`` after one stable counting sort by ``digit``.

    ``first``: the places are those of `monotonically_increasing_id`, so the block is the written part.
    """
    cell = F.shiftrightunsigned(F.col(at), 33) if first else F.floor(F.col(at) / block)
    dealt = rows.withColumns({"_block": cell.cast("bigint"), "_digit": digit})
    counts = dealt.groupBy("_digit", "_block").agg(F.count("*").alias("_n"))
    lower = counts.groupBy("_digit").agg(F.sum("_n").alias("_all")).select("_digit", (F.sum("_all").over(W.orderBy("_digit")) - F.col("_all")).alias("_lower"))  # 2 ** DIGIT rows
    earlier = F.sum("_n").over(W.partitionBy("_digit").orderBy("_block")) - F.col("_n")  # a row for each block
    begin = counts.withColumn("_earlier", earlier).join(F.broadcast(lower), "_digit").select("_digit", "_block", (F.col("_lower") + F.col("_earlier")).alias("_begin"))
    inside = F.row_number().over(W.partitionBy("_digit", "_block").orderBy(at)) - 1
    return dealt.withColumn("_inside", inside).join(begin, ["_digit", "_block"]).select(*[c for c in rows.columns if c != at], (F.col("_begin") + F.col("_inside")).alias(at))


def radix_rank(rows: DataFrame, descending: str, ascending: str, name: str = "rank", block: int | None = None) -> DataFrame:
    """``rows`` with their rank (from 1) by ``descending`` and then ``ascending``, two columns of whole numbers.

    Nulls come last in either column. Rows equal in both have ranks in any order. Names that start with ``_`` are the
    operator's own; an existing column ``name`` is replaced. An empty table gives an empty one.
    """
    for column in (descending, ascending):
        if not isinstance(rows.schema[column].dataType, IntegralType):
            raise TypeError(f"{column} must hold whole numbers")
    rows = rows.drop(name)
    placed = materialise(rows.withColumn("_at", F.monotonically_increasing_id()))
    d, a = descending, ascending
    (n, d_low, d_high, d_null, a_low, a_high, a_null) = placed.agg(F.count("*"), *[f for c in (d, a) for f in (F.min(c), F.max(c), F.count_if(F.col(c).isNull()))]).first()
    if block is None:
        parts = int(placed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        block = min(max(n // (4 * parts), LEAST_BLOCK), BLOCK)
    passes: list[Column] = []
    if a_low is not None:
        passes += [F.coalesce(digit, F.lit(0)) for digit in _digits(a_low, a_high, a)]
    if a_null:
        passes.append(F.col(a).isNull().cast("int"))
    if d_low is not None:
        passes += [F.coalesce((1 << DIGIT) - 1 - digit, F.lit(0)) for digit in _digits(d_low, d_high, d)]
    if d_null:
        passes.append(F.col(d).isNull().cast("int"))
    for turn, digit in enumerate(passes or [F.lit(0)]):
        placed = materialise(counting_pass(placed, digit, block, first=turn == 0))
    return placed.select(*rows.columns, (F.col("_at") + 1).alias(name))


def draw(scored: DataFrame, score: str = "score", id: str = "doc_id", least_words: int = LEAST_WORDS, percent: int = PERCENT, block: int | None = None) -> DataFrame:
    """``scored`` with ``rank`` (null if not drawn): of the N texts with enough words the floor(percent * N / 100) highest scores.

    The numbers of rows with each score, as many as there are whole scores, tell the score of the last drawn row; only
    rows from it upwards are sorted. ``scored`` is read several times and should be a written table.
    """
    enough = F.col("n_words") >= least_words
    by_score = scored.filter(enough).groupBy(score).agg(F.count("*").alias("_n"))
    total = by_score.agg(F.sum("_n")).first()[0] or 0
    take = percent * total // 100
    above = by_score.select(score, F.sum("_n").over(W.orderBy(F.col(score).desc())).alias("_above"))
    last = above.filter(F.col("_above") >= take).agg(F.max(score)).first()[0] if take else None
    sorts = enough & (F.col(score) >= last) if take else F.lit(False)
    ranked = radix_rank(scored.filter(sorts), score, id, block=block)
    ranked = ranked.withColumn("rank", F.expr(f"if(rank <= {take}, rank, NULL)"))
    return ranked.unionByName(scored.filter(~sorts).withColumn("rank", F.lit(None).cast("bigint")))


def resample(docs: DataFrame, target: DataFrame, keep: list[str], text: str = "text", id: str = "doc_id", buckets: int = BUCKETS, seed: int = SEED, least_words: int = LEAST_WORDS, percent: int = PERCENT) -> DataFrame:
    """Columns ``keep`` (with ``id``) of every row of ``docs``, its n_words, n_features, weight, score, and rank if it is drawn.

    Empty tables: without documents the result is empty, without target texts all gains come from the corpus alone.
    Repeated rows are scored alike and each may be drawn. Ties go to smaller ids, rows without an id last.
    """
    gain = gains(bucket_counts(target, text, buckets), bucket_counts(docs, text, buckets))
    return draw(materialise(weigh(docs, keep, gain, text, id, seed)), id=id, least_words=least_words, percent=percent)


def digest(docs: DataFrame, target: DataFrame) -> DataFrame:
    return resample(docs, target, ["doc_id"]).select("doc_id", "n_features", "weight", "score", "rank")


def sql() -> str:
    """The digest in DuckDB's SQL. The checksum is worked out byte by byte, once for each distinct feature."""
    table = "list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END))"
    features = "SELECT k, unnest(w) AS f FROM {0} UNION ALL SELECT k, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM {0}"
    words = f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w"
    return rf"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS k, doc_id, {words} FROM documents),
b AS MATERIALIZED (SELECT row_number() OVER () AS k, {words} FROM benchmark),
df AS MATERIALIZED ({features.format("d")}),
bf AS MATERIALIZED ({features.format("b")}),
names AS MATERIALIZED (SELECT DISTINCT f, hex(encode(f)) AS h FROM (SELECT f FROM df UNION ALL SELECT f FROM bf)),
crc AS (SELECT {table} AS t),
byte AS (SELECT f, list_transform(range(1, len(h), 2), lambda i: (instr('0123456789ABCDEF', h[i]) - 1) * 16 + instr('0123456789ABCDEF', h[i + 1]) - 1) AS l FROM names),
bucket AS MATERIALIZED (SELECT f, xor(4294967295, list_reduce(list_prepend(4294967295, l), lambda c, x: xor(t[xor(c, x) % 256 + 1], c // 256))) % {BUCKETS} AS b FROM byte, crc),
s AS (SELECT b, count(*) AS s FROM df JOIN bucket USING (f) GROUP BY b),
t AS (SELECT b, count(*) AS t FROM bf JOIN bucket USING (f) GROUP BY b),
g AS (SELECT b, CAST(floor(1000 * ln((CAST(coalesce(t, 0) AS DOUBLE) + 1) * ((SELECT count(*) FROM df) + {BUCKETS}) / ((CAST(coalesce(s, 0) AS DOUBLE) + 1) * ((SELECT count(*) FROM bf) + {BUCKETS})))) AS BIGINT) AS gain
    FROM (SELECT DISTINCT b FROM bucket) LEFT JOIN s USING (b) LEFT JOIN t USING (b)),
w AS (SELECT k, count(*) AS n, CAST(sum(gain) AS BIGINT) AS total FROM df JOIN bucket USING (f) JOIN g USING (b) GROUP BY k),
scored AS (SELECT doc_id, len(w) AS n_words, coalesce(n, 0) AS n_features, coalesce(CASE WHEN total >= 0 THEN total // n ELSE -((n - 1 - total) // n) END, 0) AS weight,
    CAST('0x' || substr(sha256('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h FROM d LEFT JOIN w USING (k)),
r AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5) / 4294967296))) AS BIGINT) AS score FROM scored),
p AS (SELECT *, n_words >= {LEAST_WORDS} AS enough FROM r),
o AS (SELECT *, row_number() OVER (PARTITION BY enough ORDER BY score DESC, doc_id) AS place, count(*) OVER (PARTITION BY enough) AS n FROM p)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, CAST(weight AS BIGINT) AS weight, CAST(score AS BIGINT) AS score,
    CASE WHEN enough AND place <= {PERCENT} * n // 100 THEN place END AS rank FROM o"""
