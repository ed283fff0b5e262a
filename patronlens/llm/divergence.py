"""Source divergence audit: how far the term shares of each source of a language lie from those of the other sources.

Tasks turn texts into terms and partial counts with Arrow kernels alone (lower-casing, splitting, dictionary encoding, hash
grouping). The counts of a term meet in one task as a row for each source, so a term is kept or not where it lies. The
merged shards are then read as columns: a block of terms is a matrix of counts by source, from which scaled shares and the
divergences of all pairs of sources are formed and summed. All numbers are whole, so sums of parts are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from patronlens.llm.common import UPPER, sliced
from patronlens.session import materialise

#: What parts terms, once A-Z are lower case: all of ASCII but letters.
SEPARATORS = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
#: A term is kept in a language if at least so many of its documents hold it.
LEAST_DOCS = 10
#: Terms reported for each group.
TOP = 10
#: Shares are whole numbers of 1 / BASE ** STEPS.
BASE, STEPS = 1000, 3
#: Rows of merged counts that a task hands on, and cells of a block of terms by sources.
HELD, CELLS = 1 << 20, 1 << 18

_COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])
COUNTS = "lang string, source string, term string, n bigint, docs bigint"
_KEYS = ["lang", "source", "term"]
_REPORT = pa.schema([("lang", pa.string()), ("source", pa.string()), ("part", pa.string()), ("item", pa.string()), ("value", pa.int64())])


def partial_counts(part: pa.RecordBatch) -> pa.Table:
    """(lang, source, term, n, docs) of a batch of (lang, source, text): occurrences, and documents that hold the term.

    A group has a row with a null term too, so that one without terms is known.
    """
    lang, source = (pc.fill_null(part.column(i).cast(pa.string()), "").dictionary_encode() for i in (0, 1))
    width = len(source.dictionary)
    group = lang.indices.to_numpy().astype(np.int64) * width + source.indices.to_numpy()
    terms = pc.split_pattern_regex(pc.ascii_lower(pc.fill_null(part.column(2).cast(pa.string()), "")), SEPARATORS)
    document, term = pc.list_parent_indices(terms), pc.list_flatten(terms)
    real = pc.not_equal(term, "")
    document, term = document.filter(real), term.filter(real).dictionary_encode()
    # a row for each document and term, then for each group and term: strings are met once, as dictionary entries
    once = pa.table({"document": document, "code": term.indices}).group_by(["document", "code"]).aggregate([([], "count_all")])
    of = pa.array(group[once["document"].to_numpy()])
    counted = pa.table({"group": of, "code": once["code"], "n": once["count_all"]}).group_by(["group", "code"]).aggregate([("n", "sum"), ("n", "count")])

    def rows(at: np.ndarray, term: pa.Array, n: pa.Array, docs: pa.Array) -> pa.Table:
        return pa.table([lang.dictionary.take(pa.array(at // width)), source.dictionary.take(pa.array(at % width)), term, n, docs], schema=_COUNTS)

    known = np.unique(group)
    zero = pa.array(np.zeros(len(known), np.int64))
    found = rows(counted["group"].to_numpy(), term.dictionary.take(counted["code"].combine_chunks()), counted["n_sum"], counted["n_count"])
    return pa.concat_tables([found, rows(known, pa.nulls(len(known), pa.string()), zero, zero)])


def _merged(parts: list[pa.Table]) -> pa.Table:
    return pa.concat_tables(parts).group_by(_KEYS).aggregate([("n", "sum"), ("docs", "sum")]).select([*_KEYS, "n_sum", "docs_sum"]).rename_columns(_COUNTS.names)


def term_counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", held: int = HELD) -> DataFrame:
    """(lang, term, docs, sources, counts): one row for each term of each language, its sources side by side.

    A row with a null term lists all sources of the language. Null texts, languages and sources count as ''. A task hands
    its merged counts on when they reach ``held`` rows, so its memory is bounded. Other columns of ``docs`` play no part.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, rows, merge_at = [], 0, held // 4
        for part in sliced(batches, 2):
            parts.append(partial_counts(part))
            rows += len(parts[-1])
            if rows >= merge_at:
                parts = [_merged(parts)]
                rows = len(parts[0])
                if rows >= held:
                    yield from parts[0].to_batches()
                    parts, rows = [], 0
                merge_at = rows + held // 4
        if parts:
            yield from _merged(parts).to_batches()

    given = docs.select(F.col(lang).alias("lang"), F.col(source).alias("source"), F.col(text).alias("text"))
    # dealt by term, so that the sums by source and the row of the term need no further exchange
    partial = given.mapInArrow(run, COUNTS).repartition("lang", "term")
    counts = partial.groupBy(*_KEYS).agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    by_source = F.collect_list(F.struct("source", "n"))  # each source once
    return counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), by_source.alias("by")).select("lang", "term", "docs", F.col("by.source").alias("sources"), F.col("by.n").alias("counts"))


def shares(count: np.ndarray, total: int, kept: int) -> np.ndarray:
    """1 + floor(10**9 * (count + 2) / (total + 2 * kept)) by long division in base 1000, exact up to totals of 9 * 10**15."""
    whole, rest = np.divmod(count + 2, total + 2 * kept)
    for _ in range(STEPS):
        digit, rest = np.divmod(rest * BASE, total + 2 * kept)
        whole = whole * BASE + digit
    return whole + 1


def divergences(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q) ** 2 / (p + q)) of scaled shares; the square of a share stays below 2 ** 63."""
    return (p - q) * (p - q) // (p + q)


def _shards(kept: DataFrame, totals: dict[str, dict[str, int]], vocabulary: dict[str, int], top: int, cells: int) -> DataFrame:
    """Partial rows (lang, source, part, item, value) of the merged shards.

    totals: N of each source, by language; vocabulary: V of each language. A task adds up one matrix of pairs for each
    language, no larger than what is returned of it, and keeps ``top`` terms of each group.
    """
    order = {lang: sorted(sources) for lang, sources in totals.items()}

    def block(lang: str, rows: pa.RecordBatch, pairs: np.ndarray, best: list[list[tuple[int, bytes]]]) -> None:
        names, v = order[lang], vocabulary[lang]
        count = np.zeros((len(names), rows.num_rows), np.int64)
        at = pc.index_in(pc.list_flatten(rows["sources"]), pa.array(names, pa.string())).to_numpy()
        count[at, pc.list_parent_indices(rows["sources"]).to_numpy()] = pc.list_flatten(rows["counts"]).to_numpy()
        p = np.stack([shares(c, totals[lang][s], v) for s, c in zip(names, count)])
        q = shares(count.sum(0), sum(totals[lang].values()), v)
        for i in range(len(names)):
            pairs[i, i + 1 :] += divergences(p[i], p[i + 1 :]).sum(1)
            high = np.flatnonzero((count[i] > 0) & (p[i] > q))
            value = divergences(p[i, high], q[high])
            if len(high) > top:  # all that reach the value of place ``top``
                reach = value >= np.partition(value, -top)[-top]
                high, value = high[reach], value[reach]
            terms = rows["term"].take(pa.array(high)).cast(pa.binary()).to_pylist()
            best[i] = sorted([*best[i], *zip((-value).tolist(), terms)])[:top]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = {lang: np.zeros((len(names), len(names)), np.int64) for lang, names in order.items()}
        best: dict[str, list] = {lang: [[] for _ in names] for lang, names in order.items()}
        for batch in batches:
            for lang in pc.unique(batch["lang"]).to_pylist():
                rows = batch.filter(pc.equal(batch["lang"], lang))
                step = max(1, cells // len(order[lang]))
                for start in range(0, rows.num_rows, step):
                    block(lang, rows.slice(start, step), pairs[lang], best[lang])
        for lang, names in order.items():
            i, j = np.nonzero(pairs[lang])
            found = [(names[a], "pair", names[b].encode(), x) for a, b, x in zip(i.tolist(), j.tolist(), pairs[lang][i, j].tolist())]
            found += [(name, "term", item, -x) for name, rows in zip(names, best[lang]) for x, item in rows]
            if found:
                source, part, item, value = zip(*found)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(found)), pa.array(source), pa.array(part), pa.array(item, pa.binary()).cast(pa.string()), pa.array(value, pa.int64())], schema=_REPORT)

    return kept.select("lang", "term", "sources", "counts").mapInArrow(run, "lang string, source string, part string, item string, value bigint")


def audit(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least_docs: int = LEAST_DOCS, top: int = TOP, cells: int = CELLS) -> DataFrame:
    """(lang, source, part, item, value, rank): part ``pair`` has every other source of the language with the divergence of
    the two, part ``term`` the ``top`` terms that a source has more of than its language.

    An empty table gives an empty result; a language of one source has no pairs; where no term is kept all pairs are 0.
    Repeated rows count each time, other columns play no part. The list of groups passes through the driver: the result has
    a row for each two sources of a language, so the list is about the square root of what is returned.
    """
    terms = materialise(term_counts(docs, text, lang, source).filter((F.col("docs") >= least_docs) | F.col("term").isNull()))
    kept = terms.filter("term IS NOT NULL")
    totals: dict[str, dict[str, int]] = {name: dict.fromkeys(sources, 0) for name, sources in terms.filter("term IS NULL").select("lang", "sources").collect()}
    each = kept.select("lang", F.explode(F.arrays_zip("sources", "counts")).alias("x")).groupBy("lang", "x.sources").agg(F.sum("x.counts"))
    for name, own, n in each.collect():
        totals[name][own] = n
    vocabulary = dict.fromkeys(totals, 0) | dict(kept.groupBy("lang").agg(F.count("*")).collect())
    parts = _shards(kept, totals, vocabulary, top, cells)

    groups = terms.filter("term IS NULL").select("lang", F.explode("sources").alias("source"), F.col("sources").alias("item"))
    pairs = groups.select("lang", "source", F.explode("item").alias("item")).filter("source <> item")
    half = parts.filter("part = 'pair'")
    both = half.unionByName(half.select("lang", F.col("item").alias("source"), "part", F.col("source").alias("item"), "value"))
    sums = both.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    pairs = pairs.join(sums, ["lang", "source", "item"], "left").select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).alias("value"))
    place = F.row_number().over(W.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), "item"))
    ranked = pairs.unionByName(parts.filter("part = 'term'")).withColumn("rank", place)
    return ranked.filter(F.expr(f"part = 'pair' OR rank <= {top}"))


def digest(docs: DataFrame) -> DataFrame:
    return audit(docs).select("lang", "source", "part", "item", "value", "rank")


def sql() -> str:
    """The digest in DuckDB's SQL, over whole 128-bit numbers."""
    return rf"""
WITH d AS (SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
o AS MATERIALIZED (SELECT k, lang, source, unnest(w) AS term FROM d),
kept AS MATERIALIZED (SELECT lang, term FROM o GROUP BY lang, term HAVING count(DISTINCT k) >= {LEAST_DOCS}),
c AS MATERIALIZED (SELECT lang, source, term, count(*) AS n FROM o JOIN kept USING (lang, term) GROUP BY ALL),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
dense AS MATERIALIZED (SELECT lang, source, term, CAST(coalesce(n, 0) AS HUGEINT) AS n FROM g JOIN kept USING (lang) LEFT JOIN c USING (lang, source, term)),
p AS MATERIALIZED (SELECT lang, source, term, n, 1 + 1000000000 * (n + 2) // (sum(n) OVER (PARTITION BY lang, source) + 2 * v) AS p FROM dense JOIN v USING (lang)),
w AS (SELECT lang, term, sum(n) AS n FROM p GROUP BY lang, term),
q AS (SELECT lang, term, 1 + 1000000000 * (n + 2) // (sum(n) OVER (PARTITION BY lang) + 2 * v) AS q FROM w JOIN v USING (lang)),
f AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
        LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
    UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
s AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM r)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INT) AS rank FROM s WHERE part = 'pair' OR rank <= {TOP}"""
