"""Quality rules: a table of thresholds compiled into one projection.

Every measure is a built-in expression on the row itself. There is no exchange, no user function and no
second reading of the text; the plan is a scan and projections, so the cost grows with the text alone.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Stop words of the rule table (fixed values): English, French, German, Spanish.
STOP_WORDS = (
    "the of and to in is that it for with be was on are by this "
    "le la les de des et un une que pour dans est qui en "
    "der die das und ist mit von den ein eine nicht zu sich "
    "el los las que y en un una por con para del no se"
).split()

SYMBOLS = "#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_stop_words", "n_lines", "n_dup_lines", "n_repeat_words")
WINDOW = 5


@dataclass(frozen=True)
class Rule:
    """``measure`` (SQL over the measured columns) must lie in [least, most]; None leaves a side open."""

    name: str
    measure: str
    least: float | None = None
    most: float | None = None

    def holds(self) -> str:
        """A measure without a value (no words, no lines) fails."""
        sides = [f"({self.measure}) >= {self.least}"] * (self.least is not None)
        sides += [f"({self.measure}) <= {self.most}"] * (self.most is not None)
        return f"coalesce({' AND '.join(sides)}, false)"


#: The production table. Ratios are products so that both engines compare integers.
RULES = (
    Rule("enough_words", "n_words", least=10),
    Rule("words_not_long", "word_chars - 15 * n_words", most=0),
    Rule("words_not_short", "word_chars - 2 * n_words", least=0),
    Rule("few_symbols", "10 * n_symbols - n_words", most=0),
    Rule("some_stop_words", "50 * n_stop_words - n_words", least=0),
    Rule("few_repeated_lines", "2 * n_dup_lines - n_lines", most=0),
    Rule("few_repeated_words", "100 * n_repeat_words - 20 * n_words", most=0),
)


def _sql_list(words) -> str:
    forms = sorted({f for w in words for f in (w, w.capitalize(), w.upper())})
    return ", ".join(f"'{w}'" for w in forms)


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the measures of the rule table added.

    n_words, word_chars (code points in words), n_symbols, n_stop_words, n_lines (``\\n``-split lines with a word),
    n_dup_lines (of these, equal to an earlier one), n_repeat_words (words in a 5-word window that the text
    holds twice or more). A null text counts as empty and gives zeros. Windows are compared by a 64-bit hash
    within one text. Columns of ``docs`` with these names are replaced; names that start with ``_`` are left out.
    """
    space = r"[\\x20\\x09-\\x0D]"
    no_symbols = "_t"
    for symbol in SYMBOLS:
        no_symbols = f"replace({no_symbols}, '{symbol}', '')"
    steps = [
        {"_t": f"coalesce(`{text}`, '')"},
        {
            "_w": f"array_remove(split(_t, '{space}+'), '')",
            "_lines": r"filter(split(_t, '\\n'), l -> length(trim(BOTH ' \t\n\u000b\f\r' FROM l)) > 0)",
            "n_symbols": f"CAST(length(_t) - length({no_symbols}) AS BIGINT)",
        },
        {
            "n_words": "CAST(size(_w) AS BIGINT)",
            "word_chars": "CAST(length(array_join(_w, '')) AS BIGINT)",
            "n_lines": "CAST(size(_lines) AS BIGINT)",
            "n_dup_lines": "CAST(size(_lines) - size(array_distinct(_lines)) AS BIGINT)",
            "n_stop_words": f"CAST(size(filter(_w, x -> x IN ({_sql_list(STOP_WORDS)}))) AS BIGINT)",
            "_word": "transform(_w, x -> xxhash64(x))",
        },
        {"_hash": f"if(size(_word) < {WINDOW}, array(), transform(slice(_word, 1, size(_word) - {WINDOW - 1}), (x, i) -> xxhash64(x, {', '.join(f'get(_word, i + {k})' for k in range(1, WINDOW))})))"},
        {"_at": "if(size(array_distinct(_hash)) = size(_hash), array(), array_sort(transform(_hash, (h, i) -> struct(h, i))))"},
        {"_twice": "array_sort(transform(filter(_at, (x, j) -> x.h <=> get(_at, j - 1).h OR x.h <=> get(_at, j + 1).h), x -> x.i))"},
        # a repeated window covers its words up to the next repeated window
        {"n_repeat_words": f"aggregate(transform(_twice, (s, j) -> CAST(least({WINDOW}, coalesce(get(_twice, j + 1) - s, {WINDOW})) AS BIGINT)), 0L, (a, x) -> a + x)"},
    ]
    for step in steps:
        docs = docs.withColumns({name: F.expr(sql) for name, sql in step.items()})
    # The generator ends the projections: a filter on a measure would else be written out in terms of the text, with
    # every shared step repeated each time that it is used.
    own = [c for c in docs.columns if not c.startswith("_") and c not in MEASURES]
    return docs.select(*own, F.inline(F.array(F.struct(*MEASURES))))


def verdict(rules: tuple[Rule, ...] = RULES) -> Column:
    """True where every rule holds: the whole table as one expression."""
    return F.expr(" AND ".join(r.holds() for r in rules))


def failed_rules(rules: tuple[Rule, ...] = RULES) -> Column:
    """Names of the rules that fail, in the order of the table."""
    return F.expr("array_compact(array(" + ", ".join(f"if({r.holds()}, NULL, '{r.name}')" for r in rules) + "))")


def judge(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with the measures, ``failed`` (array of rule names) and ``kept``.

    An empty table gives an empty table. Null and empty texts fail for want of words. Repeated rows are
    judged alike and all returned.
    """
    return measured(docs, text).withColumns({"failed": failed_rules(rules), "kept": verdict(rules)})


BASE_FAILED = "n_words < 10 OR 100 * n_repeat_words > 20 * n_words"


def digest(docs: DataFrame) -> DataFrame:
    """The result of the query: the fixed measures, ``base_failed`` and ``kept`` (false where the base fails)."""
    judged = judge(docs).withColumn("base_failed", F.expr(BASE_FAILED))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", F.expr("kept AND NOT base_failed").alias("kept"))


def sql() -> str:
    """The digest in DuckDB's SQL; windows are compared as texts."""
    rules = " AND ".join(r.holds() for r in RULES)
    return rf"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
g AS (SELECT k, unnest(range(1, len(w) - 3)) AS i, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) AS g FROM w WHERE len(w) >= 5),
r AS (SELECT k, i FROM (SELECT k, i, count(*) OVER (PARTITION BY k, g) AS c FROM g) WHERE c > 1),
c AS (SELECT k, sum(least(5, coalesce(lead_i - i, 5))) AS n FROM (SELECT k, i, lead(i) OVER (PARTITION BY k ORDER BY i) AS lead_i FROM r) GROUP BY k),
m AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(l) AS BIGINT) AS n_lines,
    CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
    CAST(len(list_filter(w, lambda x: x IN ({_sql_list(STOP_WORDS)}))) AS BIGINT) AS n_stop_words FROM w LEFT JOIN c USING (k))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, ({BASE_FAILED}) AS base_failed,
    ({rules}) AND NOT ({BASE_FAILED}) AS kept FROM m"""
