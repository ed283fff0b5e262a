"""License scans: fuzzy search for short notices.

A notice that occurs with at most k edits, cut into k + 1 pieces, has one piece that occurs unchanged
(pigeonhole). One automaton over all pieces finds these seeds in a single pass over the words of a text; around
each seed the regex library's bounded-error matching verifies the edits and gives the span. Base phrases are notices
with k = 0, whose only piece is the whole phrase between word ends.

Each text is handled by itself, so there is no exchange and no group that could grow.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronlens.llm.common import LETTER_WORD, lower_ascii

#: Phrases whose words must stand consecutively, and their labels (fixed values).
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


@dataclass(frozen=True)
class Notice:
    label: str
    words: str
    edits: int

    def pieces(self) -> list[tuple[int, str]]:
        """edits + 1 pieces that cover the phrase, with their offsets."""
        n, parts = len(self.words), self.edits + 1
        cuts = [n * i // parts for i in range(parts + 1)]
        return [(a, self.words[a:b]) for a, b in zip(cuts, cuts[1:])]


#: Notices of the method: label, words, edits allowed (in characters of the words joined by one space).
NOTICES = (
    Notice("apache-2.0", "licensed under the apache license version 2 0", 4),
    Notice("bsd", "redistribution and use in source and binary forms", 4),
    Notice("cc-by", "creative commons attribution", 2),
    Notice("cc-by-nc", "licensed under cc by nc", 2),
    Notice("gpl", "gnu general public license", 2),
    Notice("lgpl", "gnu lesser general public license", 3),
    Notice("mit", "released under the mit license", 2),
    Notice("mit", "permission is hereby granted free of charge to any person", 5),
    Notice("mpl", "mozilla public license", 2),
    Notice("reserved", "all rights reserved", 1),
    Notice("unlicense", "free and unencumbered software released into the public domain", 5),
)

MATCH = "struct<label:string,notice:string,edits:int,word:bigint,n_words:int,start:bigint,stop:bigint>"
SCHEMA = "n_words bigint, base array<struct<label:string,word:bigint>>, matches array<" + MATCH + ">, score double"
_MATCH = pa.struct([("label", pa.string()), ("notice", pa.string()), ("edits", pa.int32()), ("word", pa.int64()), ("n_words", pa.int32()), ("start", pa.int64()), ("stop", pa.int64())])
_BASE = pa.struct([("label", pa.string()), ("word", pa.int64())])


class Scanner:
    """Finds base phrases and notices in one text."""

    def __init__(self, notices: tuple[Notice, ...], base: dict[str, str]):
        import ahocorasick
        import regex

        seeds: dict[str, list] = {}
        for phrase, label in base.items():
            seeds.setdefault(f" {phrase} ", []).append((None, label))
        for i, notice in enumerate(notices):
            for offset, piece in notice.pieces():
                seeds.setdefault(piece, []).append((i, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, uses in seeds.items():
            self.automaton.add_word(piece, (len(piece), uses))
        self.automaton.make_automaton()
        self.notices = notices
        self.verify = [regex.compile(rf"(?b)(?<= )(?:{regex.escape(n.words, literal_spaces=True)}){{e<={n.edits}}}(?= )") for n in notices]

    def scan(self, text: str) -> tuple[int, list[dict], list[dict], float]:
        words = LETTER_WORD.findall(lower_ascii(text))
        joined = f" {' '.join(words)} "
        blanks: list[int] = []
        base, spans, tried = [], {}, set()
        for end, (length, uses) in self.automaton.iter(joined):
            first = end - length + 1
            for notice, at in uses:
                if notice is None:
                    blanks = blanks or self._blanks(words)
                    base.append({"label": at, "word": bisect_left(blanks, first)})
                elif (notice, first - at) not in tried:
                    tried.add((notice, first - at))
                    self._verify(joined, notice, first - at, spans)
        matches = self._located(text, blanks or self._blanks(words), spans) if spans else []
        score = 1.0 if base else max((1 - m["edits"] / len(m["notice"]) for m in matches), default=0.0)
        return len(words), base, matches, score

    @staticmethod
    def _blanks(words: list[str]) -> list[int]:
        """Places of the blanks before, between and after the words; a place's word number is a binary search in them."""
        return list(accumulate((len(w) + 1 for w in words), initial=0))

    def _verify(self, joined: str, i: int, start: int, spans: dict) -> None:
        """Keep the best match of notice ``i`` that starts within its edits of ``start``."""
        notice = self.notices[i]
        low, high = max(0, start - notice.edits - 1), start + len(notice.words) + notice.edits + 1
        if m := self.verify[i].search(joined, low, high):
            edits = sum(m.fuzzy_counts)
            key = (i, m.start())
            if key not in spans or edits < spans[key][0]:
                spans[key] = (edits, m.end())

    def _located(self, text: str, blanks: list[int], spans: dict) -> list[dict]:
        """Matches with their words and their characters in the text itself; overlapping ones of a notice are one."""
        at = [(m.start(), m.end()) for m in LETTER_WORD.finditer(lower_ascii(text))]
        out, last = [], {}
        for (i, start), (edits, end) in sorted(spans.items()):
            word = bisect_left(blanks, start) - 1
            n = bisect_left(blanks, end) - word
            found = {"label": self.notices[i].label, "notice": self.notices[i].words, "edits": edits, "word": word, "n_words": n, "start": at[word][0], "stop": at[min(word + n, len(at)) - 1][1]}
            if i in last and word < last[i]["word"] + last[i]["n_words"]:
                if edits < last[i]["edits"]:
                    last[i].update(found)
            else:
                last[i] = found
                out.append(found)
        return out


def scan(docs: DataFrame, keep: list[str], text: str = "text", notices: tuple[Notice, ...] = NOTICES, base: dict[str, str] | None = None) -> DataFrame:
    """Columns ``keep`` of ``docs`` with n_words, base places, matches and score.

    base: every place of a base phrase (label, index of its first word). matches: notices within their edits, with
    words, characters of the original text (start, stop) and edits. score: 1 with a base place, else one less the
    share of edits of the best match, else 0. A null text counts as empty: no words, no places, score 0. Repeated rows
    are scanned and returned each; an empty table gives none. ``keep`` may hold any columns but the four added.
    """
    base = BASE if base is None else base
    spark_schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema.fields) + ", " + SCHEMA

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(notices, base)
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            found = [scanner.scan(t.as_py() or "") for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:-1],
                    pa.array([f[0] for f in found], pa.int64()),
                    pa.array([f[1] for f in found], pa.list_(_BASE)),
                    pa.array([f[2] for f in found], pa.list_(_MATCH)),
                    pa.array([f[3] for f in found], pa.float64()),
                ],
                names=[*keep, "n_words", "base", "matches", "score"],
            )

    return docs.select(*keep, F.col(text).alias("scanned_text")).mapInArrow(run, spark_schema)


def digest(docs: DataFrame) -> DataFrame:
    """The result of the query: counts, first and last base word, label lists and score for each row."""
    sorted_labels = "array_join(array_sort(array_distinct({})), ',')"
    return scan(docs, ["doc_id"]).select(
        "doc_id",
        "n_words",
        F.expr("CAST(size(base) AS BIGINT)").alias("n_base"),
        F.expr("array_min(base.word)").alias("first_word"),
        F.expr("array_max(base.word)").alias("last_word"),
        F.expr(sorted_labels.format("base.label")).alias("base_labels"),
        F.expr(sorted_labels.format("concat(base.label, matches.label)")).alias("labels"),
        "score",
    )
