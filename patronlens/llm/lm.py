"""Language-model scoring with a weighted backoff automaton.

The model is over bytes: each word of the lower-cased text is its UTF-8 bytes and one blank, the text ends with one end
symbol, so the probabilities of all texts sum to one. Smoothed n-grams (Witten-Bell) are states with arcs for the
bytes seen after them and a failure arc to their longest suffix that is a state. Failure arcs are resolved when the
automaton is compiled, so scoring is one left-to-right traversal with one table look-up for each byte. The state
depends on the last ``ORDER - 1`` bytes only; a task therefore walks many stretches of its texts side by side, each begun
that many bytes early.

Learning sums n-gram and word counts in each task and then by key. No n-gram is dropped: each one of the texts has a row
with its probability under all counts. The automaton has the n-grams that make up at least ``SHARE`` of all learning bytes,
and every task the counts of words of at least ``SHARE`` of all tokens: at most 1 / SHARE of each, whatever the corpus.
Its arcs tell those n-grams' probabilities; all other n-grams and words of a text are joined with their rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronlens.llm.common import with_row_key
from patronlens.session import materialise

ORDER = 5
#: Least share of an n-gram of the automaton among all n-grams, and of a word whose count each task holds.
SHARE = 1e-6
#: Bytes handled at once.
CHUNK = 1 << 20
#: Length of the stretches walked side by side.
LANE = 512
BLANK, END = 0x20, 0x0A
_FOLDED = np.arange(256, dtype=np.uint8)
_FOLDED[65:91] += 32
_FOLDED[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = BLANK
_MIX = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
#: The word hash of the end token.
END_WORD = int(np.uint64(0xD1B54A32D192ED03).astype(np.int64))


@dataclass
class Stretch:
    """Symbols of whole texts, or of a part of a long one: the first ``skip`` symbols are context only."""

    symbols: np.ndarray
    doc: np.ndarray
    skip: int


def _normal(raw: np.ndarray, ends: np.ndarray, first: int, closed: bool, before: np.ndarray, fold: np.ndarray) -> Stretch:
    """Fold bytes, leave one blank after each word, and put an end after each text (after the last only if ``closed``)."""
    n = len(ends)
    symbols = fold[raw]
    doc = np.repeat(np.arange(first, first + n, dtype=np.int32), np.diff(np.concatenate([[0], ends])))
    blank = symbols == BLANK
    # a word's blank is the first one after it; texts that end in a word get theirs with the end
    after_word = np.zeros(len(symbols), bool)
    after_word[1:] = ~blank[:-1] & (doc[1:] == doc[:-1])
    keep = ~blank | after_word
    lengths = np.diff(np.concatenate([[0], ends]))
    open_word = np.zeros(n, bool)
    some = lengths > 0
    open_word[some] = ~blank[ends[some] - 1]
    kept_before = np.concatenate([[0], np.cumsum(keep)])[ends]
    at = np.concatenate([kept_before[open_word], kept_before if closed else kept_before[:-1]])
    added = np.concatenate([np.full(open_word.sum(), BLANK), np.full(n if closed else n - 1, END)]).astype(np.uint8)
    whose = np.concatenate([np.flatnonzero(open_word), np.arange(n if closed else n - 1)]).astype(np.int32) + first
    order = np.lexsort((added == END, whose, at))
    symbols = np.insert(symbols[keep], at[order], added[order])
    doc = np.insert(doc[keep], at[order], whose[order])
    return Stretch(np.concatenate([before, symbols]), np.concatenate([np.full(len(before), first, np.int32), doc]), len(before))


def stretches(texts: pa.Array, chunk: int | None = None, fold: np.ndarray = _FOLDED) -> Iterator[Stretch]:
    """The symbols of all texts in order, in groups of texts of about ``chunk`` bytes.

    A longer text comes in parts that are cut between words. Nulls count as empty. ``fold`` gives each byte's symbol.
    """
    chunk = chunk or CHUNK
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    none = np.zeros(0, np.uint8)
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + chunk, side="right")) - 1)
        start, stop = int(offsets[i]), int(offsets[j])
        if stop - start <= chunk:
            yield _normal(data[start:stop], offsets[i + 1 : j + 1] - start, i, True, none, fold)
        else:
            before = none
            while start < stop:
                cut = min(stop, start + chunk)
                while cut < stop and fold[data[cut - 1]] != BLANK:
                    cut += 1
                part = _normal(data[start:cut], np.array([cut - start]), i, cut == stop, before, fold)
                yield part
                before, start = part.symbols[-(ORDER - 1) :], cut
        i = j


def word_hashes(part: Stretch) -> tuple[np.ndarray, np.ndarray]:
    """(hash, document) of each token that ends in the part; a token ends with its blank, or is the end."""
    symbols, doc = part.symbols[part.skip :], part.doc[part.skip :]
    if not len(symbols):
        return np.zeros(0, np.int64), doc
    with np.errstate(over="ignore"):
        power = _powers(len(symbols))
        total = np.cumsum(_MIX[symbols] * power[: len(symbols)], dtype=np.uint64)
    stop = np.flatnonzero((symbols == BLANK) | (symbols == END))
    before = np.append(np.uint64(0), total[stop[:-1]])
    start = np.concatenate([[0], stop[:-1] + 1])
    with np.errstate(over="ignore"):
        hashed = (total[stop] - before) * _inverse_powers(len(symbols))[start]
        hashed ^= hashed >> np.uint64(29)
        hashed *= np.uint64(0xBF58476D1CE4E5B9)
        hashed ^= hashed >> np.uint64(32)
    hashed = hashed.view(np.int64)
    hashed[symbols[stop] == END] = END_WORD
    return hashed, doc[stop]


_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> np.ndarray:
    return _grown("base", int(_BASE), n)


def _inverse_powers(n: int) -> np.ndarray:
    return _grown("inverse", pow(int(_BASE), -1, 1 << 64), n)


def _grown(name: str, base: int, n: int) -> np.ndarray:
    """The powers 0 .. n - 1 of ``base`` modulo 2^64, kept for the next call."""
    if len(_POWERS.get(name, ())) < n:
        with np.errstate(over="ignore"):
            _POWERS[name] = np.cumprod(np.append(np.uint64(1), np.full(max(n, CHUNK + CHUNK // 4), base, np.uint64)), dtype=np.uint64)
    return _POWERS[name]


def gram_codes(part: Stretch) -> np.ndarray:
    """For each symbol, it and the ORDER - 1 before it as one number; ends stand before the start of a text."""
    symbols, n = part.symbols, len(part.symbols)
    code = symbols.astype(np.uint64)
    ended = np.zeros(n, bool)
    for back in range(1, ORDER):
        earlier = np.full(n, END, np.uint8)
        earlier[back:] = symbols[:-back] if back < n else earlier[back:]
        earlier[ended] = END
        code |= earlier.astype(np.uint64) << np.uint64(8 * back)
        ended |= earlier == END
    return code[part.skip :]


def _summed(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    if counts is None:
        return np.unique(keys, return_counts=True)
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[new], np.add.reduceat(counts, new) if len(new) else counts


def corpus_counts(docs: DataFrame) -> DataFrame:
    """(kind, key, n, n_train) for each word ('w') and each n-gram of ORDER bytes ('g') of all texts.

    ``docs`` has a text and ``learns``. Each task sums what it has read before anything is shuffled. Words are told apart
    by a 64-bit hash.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {"w": [], "l": [], "g": [], "h": []}

        def merged(kind: str) -> tuple[np.ndarray, np.ndarray]:
            if len(held[kind]) > 1:
                held[kind] = [_summed(np.concatenate([k for k, _ in held[kind]]), np.concatenate([c for _, c in held[kind]]))]
            return held[kind][0] if held[kind] else (np.zeros(0, np.int64), np.zeros(0, np.int64))

        def flush() -> Iterator[pa.RecordBatch]:
            words, n = merged("w")
            learned, n_train = merged("l")
            of = np.zeros(len(words), np.int64)
            of[np.searchsorted(words, learned)] = n_train
            codes, n_codes = merged("g")
            others, n_others = merged("h")
            held.update(w=[], l=[], g=[], h=[])
            for kind, key, count, train in (("w", words, n, of), ("g", codes.astype(np.int64), n_codes, n_codes), ("g", others.astype(np.int64), n_others, np.zeros(len(others), np.int64))):
                for a in range(0, len(key), 1 << 18):
                    cut = slice(a, a + (1 << 18))
                    yield pa.RecordBatch.from_arrays([pa.array([kind] * len(key[cut]), pa.string()), pa.array(key[cut]), pa.array(count[cut]), pa.array(train[cut])], names=["kind", "key", "n", "n_train"])

        for batch in batches:
            learns = np.asarray(batch.column(1).to_numpy(zero_copy_only=False), bool)
            for part in stretches(batch.column(0)):
                words, doc = word_hashes(part)
                held["w"].append(_summed(words))
                held["l"].append(_summed(words[learns[doc]]))
                codes = gram_codes(part)
                learned = learns[part.doc[part.skip :]]
                held["g"].append(_summed(codes[learned]))
                held["h"].append(_summed(codes[~learned]))
                if len(held["w"]) >= 8:
                    for kind in held:
                        merged(kind)
                if any(len(held[kind][0][0]) > 4_000_000 for kind in held):
                    yield from flush()
        yield from flush()

    rows = docs.select("text", "learns").mapInArrow(run, "kind string, key bigint, n bigint, n_train bigint")
    return rows.groupBy("kind", "key").agg(F.sum("n").alias("n"), F.sum("n_train").alias("n_train"))


class Automaton:
    """Dense form of the backoff automaton: next state and log10 probability for each state and class of bytes."""

    def __init__(self, grams: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
        """grams[k - 1]: (n-gram of length k as a number, its count, count of its context), kept ones only, sorted."""
        single = grams[0][0].astype(np.int64)
        used = np.union1d(single, [BLANK, END])
        self.classes = np.full(256, len(used), np.uint8 if len(used) < 256 else np.int16)
        self.classes[used] = np.arange(len(used))
        width = len(used) + 1
        # states by length of context; the root is state 0
        contexts = [np.zeros(1, np.int64)] + [np.unique(g[0].astype(np.int64) >> 8) for g in grams[1:]]
        first = np.cumsum([0] + [len(c) for c in contexts])
        self.next = np.zeros((first[-1], width), np.int32)
        chance = np.full((first[-1], width), 1 / 256)

        def state(context: np.ndarray, length: int) -> np.ndarray:
            """The state of each context, or of its longest suffix that is one."""
            found = np.zeros(len(context), np.int64)
            for k in range(1, length + 1):
                suffix = context & ((1 << 8 * k) - 1)
                if k < len(contexts) and len(contexts[k]):
                    at = np.minimum(np.searchsorted(contexts[k], suffix), len(contexts[k]) - 1)
                    found = np.where(contexts[k][at] == suffix, first[k] + at, found)
            return found

        for k, (code, count, context_count) in enumerate(grams):
            code = code.astype(np.int64)
            mine = np.arange(first[k], first[k + 1])
            if k:
                fail = state(contexts[k], k - 1)
                self.next[mine] = self.next[fail]
                chance[mine] = chance[fail]
            owner = np.searchsorted(contexts[k], code >> 8) if k else np.zeros(len(code), np.int64)
            kept = np.bincount(owner, count, len(mine))
            kinds = np.bincount(owner, minlength=len(mine))
            total = np.zeros(len(mine))
            total[owner] = context_count
            seen = total + kinds
            weight = np.divide(total - kept + kinds, seen, out=np.ones(len(mine)), where=seen > 0)
            chance[mine] *= weight[:, None]
            column = self.classes[code & 255]
            chance[mine[owner], column] += count / seen[owner]
            self.next[mine[owner], column] = state(code, min(k + 1, ORDER - 1))
        self.deepest = contexts[-1], int(first[-2]), width
        start = np.array([sum(END << 8 * i for i in range(ORDER - 1))])
        self.start = int(state(start, ORDER - 1)[0])
        self.next[:, self.classes[END]] = self.start
        self.log = np.log10(chance).ravel()
        self.next = (self.next * width).ravel()
        self.start *= width

    def tell(self, codes: np.ndarray, logs: np.ndarray) -> None:
        """From now on ``walk`` gives ``logs`` for these n-grams of ORDER bytes, and NaN for all others."""
        contexts, first, width = self.deepest
        self.log = np.full(len(self.log), np.nan)
        if len(codes):
            self.log[(first + np.searchsorted(contexts, codes >> 8)) * width + self.classes[codes & 255]] = logs

    def walk(self, part: Stretch) -> np.ndarray:
        """log10 probability of each symbol after the context symbols of the part."""
        reach = ORDER - 1
        symbols = self.classes[part.symbols]
        n = len(symbols)
        lanes = -(-n // LANE)
        padded = np.zeros(reach + lanes * LANE, symbols.dtype)
        padded[:reach] = self.classes[END]
        padded[reach : reach + n] = symbols
        view = np.lib.stride_tricks.as_strided(padded, (lanes, reach + LANE), (LANE * padded.strides[0], padded.strides[0]))
        steps = np.ascontiguousarray(view.T)
        out = np.empty((LANE, lanes))
        at = np.full(lanes, 0, np.int32)
        at[0] = self.start
        for t in range(reach + LANE):
            arc = at + steps[t]
            if t >= reach:
                out[t - reach] = self.log[arc]
            at = self.next[arc]
        return out.T.ravel()[part.skip : n]


@dataclass
class Model:
    grams: list[tuple[np.ndarray, np.ndarray, np.ndarray]]
    heavy: np.ndarray
    heavy_train: np.ndarray
    tokens: int
    kinds: int
    all_tokens: int
    symbols: int


def chances(counts: DataFrame) -> DataFrame:
    """(key, n, log) for each n-gram of ORDER bytes of all texts: its learning count and log10 probability under all counts.

    Witten-Bell, from the shortest n-grams to the longest, as joins by context and by suffix: of each there are at most
    256 n-grams.
    """
    whole = counts.filter("kind = 'g'").select("key", F.col("n_train").alias("n"))
    shorter = None
    for k in range(1, ORDER + 1):
        grams = whole.groupBy(F.col("key").bitwiseAND(F.lit((1 << 8 * k) - 1)).alias("key")).agg(F.sum("n").alias("n")) if k < ORDER else whole
        grams = grams.withColumn("context", F.shiftright("key", 8))
        seen = grams.filter("n > 0").groupBy("context").agg(F.sum("n").alias("total"), F.count("*").alias("kinds"))
        joined = grams.join(seen, "context", "left")
        if shorter is None:
            joined = joined.withColumn("lower", F.lit(1 / 256))
        else:
            joined = joined.withColumn("suffix", F.col("key").bitwiseAND(F.lit((1 << 8 * (k - 1)) - 1))).join(shorter, "suffix")
        chance = F.when(F.col("total").isNull(), F.col("lower")).otherwise((F.col("n") + F.col("kinds") * F.col("lower")) / (F.col("total") + F.col("kinds")))
        if k == ORDER:
            return materialise(joined.select("key", "n", F.log10(chance).alias("log")))
        shorter = materialise(joined.select(F.col("key").alias("suffix"), chance.alias("lower")))


def fit(counts: DataFrame, share: float = SHARE) -> Model:
    """The automaton's n-grams of each length and the frequent words, from a written table of counts."""
    total = counts.groupBy("kind").agg(F.sum("n").alias("n"), F.sum("n_train").alias("n_train"), F.count(F.when(F.col("n_train") > 0, 1)).alias("kinds"))
    totals = {r.kind: r for r in total.collect()}
    words, symbols = totals.get("w"), totals.get("g")
    grams = []
    n_symbols = int(symbols.n_train) if symbols else 0
    for k in range(1, ORDER + 1):
        own = F.col("key").bitwiseAND(F.lit((1 << 8 * k) - 1))
        kept = [
            counts.filter("kind = 'g' AND n_train > 0").groupBy(key.alias("key")).agg(F.sum("n_train").alias("n")).filter(F.col("n") >= share * n_symbols).orderBy("key").toArrow()
            for key in (own, F.shiftright(own, 8))
        ]
        (code, n), (context, total_n) = ((t.column("key").to_numpy(), t.column("n").to_numpy()) for t in kept)
        # a kept n-gram's context is at least as frequent, so it is among the kept contexts
        grams.append((code, n, total_n[np.searchsorted(context, code >> 8)]))
    heavy = counts.filter("kind = 'w'").filter(F.col("n") >= share * (words.n if words else 0)).select("key", "n_train").toArrow()
    key = heavy.column("key").to_numpy()
    order = np.argsort(key)
    return Model(grams, key[order], heavy.column("n_train").to_numpy()[order], int(words.n_train) if words else 0, int(words.kinds) if words else 0, int(words.n) if words else 0, n_symbols)


def score(docs: DataFrame, learns: str = "learns", text: str = "text", keep: tuple[str, ...] = ("doc_id",), share: float = SHARE) -> DataFrame:
    """Columns ``keep`` with n_tokens, n_known, train_tokens, base_score and score.

    Rows where ``learns`` is true are counted, all rows are scored. base_score: add-one unigrams over words and one end
    for each text; score: log10 probability under all n-grams, whatever ``share`` is. A null text counts as empty: one token, the end.
    Without learning rows the base is 0 and the automaton gives each byte 1/256. Repeated rows count each time and are
    returned each; rows without an id stay apart.
    """
    docs = docs.select(*keep, F.col(text).alias("text"), F.coalesce(F.col(learns), F.lit(False)).alias("learns"))
    counts = materialise(corpus_counts(docs))
    model = fit(counts, share)
    told = chances(counts)
    light = (F.col("n") == 0) | (F.col("n") < share * model.symbols)
    arcs = told.filter(~light).select("key", "log").toArrow()
    arc_codes, arc_logs = arcs.column("key").to_numpy(), arcs.column("log").to_numpy()
    norm = float(np.log10(model.tokens + model.kinds + 1))
    spark_schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema.fields) + ", n_tokens bigint, known bigint, logs double, score double, rest array<bigint>, rest_grams array<bigint>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(model.grams)
        automaton.tell(arc_codes, arc_logs)
        logs = np.log10(model.heavy_train + 1.0)
        for batch in batches:
            rows = batch.num_rows
            tokens, known, base, scores = np.zeros(rows, np.int64), np.zeros(rows, np.int64), np.zeros(rows), np.zeros(rows)
            rest, rest_doc = [np.zeros(0, np.int64)], [np.zeros(0, np.int32)]
            grams, grams_doc = [np.zeros(0, np.int64)], [np.zeros(0, np.int32)]
            for part in stretches(batch.column(batch.num_columns - 1)):
                walked, of = automaton.walk(part), part.doc[part.skip :]
                unknown = np.isnan(walked)
                scores += np.bincount(of[~unknown], walked[~unknown], rows)
                grams.append(gram_codes(part)[unknown].astype(np.int64))
                grams_doc.append(of[unknown])
                words, doc = word_hashes(part)
                tokens += np.bincount(doc, minlength=rows)
                unique, back = np.unique(words, return_inverse=True)
                at = np.minimum(np.searchsorted(model.heavy, unique), max(0, len(model.heavy) - 1))
                found = model.heavy[at] == unique if len(model.heavy) else np.zeros(len(unique), bool)
                log = np.where(found, logs[at] if len(logs) else 0.0, 0.0)
                is_known = found & (model.heavy_train[at] > 0) if len(logs) else found
                base += np.bincount(doc, log[back], rows)
                known += np.bincount(doc, is_known[back], rows).astype(np.int64)
                light = ~found[back]
                rest.append(words[light])
                rest_doc.append(doc[light])
            lists = []
            for of, values in ((rest_doc, rest), (grams_doc, grams)):
                sizes = np.bincount(np.concatenate(of), minlength=rows)
                lists.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(np.concatenate(values))))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(tokens), pa.array(known), pa.array(base), pa.array(scores), *lists], names=[*keep, "n_tokens", "known", "logs", "score", "rest", "rest_grams"])

    scored = docs.select(*keep, "text").mapInArrow(run, spark_schema)
    scored = with_row_key(scored, scored.columns)
    seldom = counts.filter("kind = 'w' AND n_train > 0").filter(F.col("n") < share * model.all_tokens).select(F.col("key").alias("word"), "n_train")
    words = scored.select("row_key", F.explode("rest").alias("word")).join(seldom, "word").select("row_key", F.lit(1).alias("known"), F.log10(F.col("n_train") + 1.0).alias("base"), F.lit(0.0).alias("log"))
    grams = scored.select("row_key", F.explode("rest_grams").alias("key")).join(told.filter(light).select("key", "log"), "key").select("row_key", F.lit(0).alias("known"), F.lit(0.0).alias("base"), "log")
    more = words.unionByName(grams).groupBy("row_key").agg(F.sum("known").alias("more_known"), F.sum("base").alias("more_logs"), F.sum("log").alias("more_score"))
    return scored.join(more, "row_key", "left").select(
        *keep,
        "n_tokens",
        (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(model.tokens).cast("bigint").alias("train_tokens"),
        (F.col("logs") + F.coalesce("more_logs", F.lit(0.0)) - F.col("n_tokens") * norm).alias("base_score"),
        (F.col("score") + F.coalesce("more_score", F.lit(0.0))).alias("score"),
    )

