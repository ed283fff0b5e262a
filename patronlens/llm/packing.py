"""Best-fit packing: hierarchical residual packing of documents into sequences of a fixed length.

Every partition packs its own pieces by best fit, longest first, and emits the bins that are nearly full. Underfull
bins become items of the next round, in fewer partitions, until one chunk holds all that is left. A chunk has at most
``chunk`` items, so no task grows with the corpus, and a bin holds at most ``size`` pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronlens.session import materialise

SIZE = 1024
END = 2
#: Items that one task packs at most.
CHUNK = 50_000
#: A bin with at most this many free places is emitted at once.
SLACK = 8

_PIECE = pa.struct([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("offset", pa.int64())])
_BIN = pa.schema([("total", pa.int64()), ("closed", pa.bool_()), ("members", pa.list_(_PIECE))])
BIN = "total bigint, closed boolean, members array<struct<doc_id:bigint,piece:int,start:bigint,length:bigint,ids_crc32:bigint,offset:bigint>>"


def encoder(vocabulary: str | None = None):
    """text -> unsigned 32-bit ids of the byte-level vocabulary, as `tokenizers` gives them without special tokens added.

    The rank file beside the JSON holds the same vocabulary; its library returns arrays. The end-of-text string in a
    text is its special token, as in the JSON.
    """
    import base64

    import public_tokenizers
    import tiktoken

    path = vocabulary or public_tokenizers.path("byte_bpe_50k.tiktoken")
    with open(path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    code = tiktoken.Encoding("byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={"<|endoftext|>": len(ranks)})
    return lambda text: code.encode_to_numpy(text, allowed_special="all")


def cut(ids: np.ndarray, size: int) -> Iterator[tuple[int, int, int]]:
    """(start, length, crc32) of each piece; the first takes what whole pieces leave."""
    first = len(ids) % size or min(size, len(ids))
    start, stop = 0, first
    while start < len(ids):
        yield start, stop - start, zlib.crc32(ids[start:stop])
        start, stop = stop, stop + size


def pieces(docs: DataFrame, text: str = "text", size: int = SIZE, end: int = END, vocabulary: str | None = None) -> DataFrame:
    """One bin for each piece of each document: its ids and ``end``, cut where longer than ``size``.

    A null text counts as empty and is the single id ``end``. Repeated rows and null ids are packed like any other.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        tail = np.array([end], np.uint32)
        for batch in batches:
            rows = []
            for doc, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.concatenate([encode(value.as_py() or "").astype("<u4", copy=False), tail]).astype("<u4", copy=False)
                rows += [(doc, i, *piece) for i, piece in enumerate(cut(ids, size))]
            columns = list(zip(*rows)) or [()] * 5
            flat = pa.StructArray.from_arrays(
                [pa.array(c, f.type) for c, f in zip([*columns, np.zeros(len(rows), np.int64)], _PIECE)], fields=list(_PIECE)
            )
            lengths = pa.array(columns[3], pa.int64())
            yield pa.RecordBatch.from_arrays([lengths, pc.greater_equal(lengths, size), pa.ListArray.from_arrays(pa.array(range(len(rows) + 1), pa.int32()), flat)], schema=_BIN)

    return docs.select(F.col("doc_id").cast("bigint"), text).mapInArrow(run, BIN)


def best_fit(lengths: np.ndarray, size: int) -> list[list[int]]:
    """Bins of item numbers: longest items first, each into the bin with the least room that holds it.

    ``room`` has a bit for every free length that some open bin has, so the tightest bin is its lowest set bit.
    """
    bins: list[list[int]] = []
    by_free: list[list[int]] = [[] for _ in range(size + 1)]
    room = 0
    for item in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[item])
        fits = room >> need
        if fits:
            free = need + (fits & -fits).bit_length() - 1
            at = by_free[free].pop()
            if not by_free[free]:
                room ^= 1 << free
            bins[at].append(item)
            left = free - need
        else:
            at, left = len(bins), size - need
            bins.append([item])
        if left:
            by_free[left].append(at)
            room |= 1 << left
    return bins


def _packed(items: pa.Table, size: int, slack: int) -> pa.RecordBatch:
    """The items of a chunk as bins, members in order with their offsets."""
    members = items.column("members").combine_chunks()
    bins = best_fit(items.column("total").to_numpy(), size)
    order = np.fromiter((i for b in bins for i in b), np.int64)
    taken = members.take(pa.array(order))
    counts = pc.list_value_length(taken).to_numpy()
    per_bin = np.add.reduceat(counts, np.cumsum([0, *map(len, bins)])[:-1])
    bounds = np.concatenate([[0], np.cumsum(per_bin)])
    flat = pc.list_flatten(taken)
    fields = [pc.struct_field(flat, f.name) for f in _PIECE]
    before = np.cumsum(fields[3].to_numpy()) - fields[3].to_numpy()
    fields[5] = pa.array(before - np.repeat(before[bounds[:-1]], per_bin))
    total = np.add.reduceat(fields[3].to_numpy(), bounds[:-1])
    out = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.StructArray.from_arrays(fields, fields=list(_PIECE)))
    return pa.RecordBatch.from_arrays([pa.array(total), pa.array(total >= size - slack), out], schema=_BIN)


def _round(items: DataFrame, size: int, slack: int, chunk: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            for start in range(0, batch.num_rows, chunk):
                part = batch.slice(start, chunk)
                if rows + part.num_rows > chunk:
                    yield _packed(pa.Table.from_batches(held), size, slack)
                    held, rows = [], 0
                held.append(part.cast(_BIN))
                rows += part.num_rows
        if rows:
            yield _packed(pa.Table.from_batches(held), size, slack)

    return items.mapInArrow(run, BIN)


def pack(docs: DataFrame, text: str = "text", size: int = SIZE, end: int = END, slack: int = SLACK, chunk: int = CHUNK, vocabulary: str | None = None) -> DataFrame:
    """Each piece with its sequence_id and its offset there.

    Pieces of full length are bins already. Each round is a written table, so the next reads it and nothing is packed
    twice. Rounds go on until what is open fits one chunk, which is packed last. An empty table gives no pieces.
    """
    bins = materialise(pieces(docs, text, size, end, vocabulary))
    done = [bins.filter("closed")]
    parts, last = None, False
    while True:
        items = bins.filter("NOT closed")
        if parts is not None:
            # neighbours in the tree are merged whole: what a few tasks left open meets in one
            items = items.repartition(parts)
        bins = materialise(_round(items, size, slack, chunk))
        if last:
            done.append(bins)
            break
        done.append(bins.filter("closed"))
        left = bins.filter("NOT closed").count()
        fewer = max(1, -(-left // chunk))
        last = fewer == 1 or (parts is not None and fewer >= parts)
        parts = fewer
    found = done[0]
    for more in done[1:]:
        found = found.unionByName(more)
    numbered = found.select("members", F.monotonically_increasing_id().alias("sequence_id"))
    opened = numbered.select("sequence_id", F.explode("members").alias("m"))
    return opened.select("m.doc_id", "m.piece", "m.start", "m.length", "m.ids_crc32", "sequence_id", "m.offset")
