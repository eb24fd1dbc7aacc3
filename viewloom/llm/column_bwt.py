"""Exact substring deduplication: pieces of many documents are sorted together one column, that is one symbol each, a round.

Every SPAN-byte window of a document has an anchor, the place of the least hash of its K-grams, and equal windows have
anchors with equal hashes at equal places. So windows are compared only under their anchors:

1. Chunks of documents send the distinct hashes of their anchors to buckets of hashes; a bucket answers with one bit each,
   whether the hash occurs in another document.
2. Chunks send what surrounds such anchors: pieces of at most 2 * SPAN - K bytes, with the anchor in the same column. Equal
   pieces of a chunk are one, under the smallest doc_id.
3. A bucket builds the sorted order of all its pieces' suffixes from the last column to the first: each round puts one
   symbol of every piece in front of its suffix and re-sorts stably by that symbol, which keeps the order of the round
   before, as in the construction of a collection's Burrows-Wheeler transform. Neighbours in that order share the longest
   prefixes; where neighbours share SPAN bytes, their windows are equal, and all but those of the smallest doc_id go.
4. Chunks remove what the buckets name.

Anchoring bounds the rounds by the length of a piece, however long documents are, and the files of each round are Spark's
shuffles. No piece, list or order of all documents is ever in one place. Texts are shuffled once, compressed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewloom.llm.common import query, row_tag, table

SPAN = 50
K = 12
FIRST = SPAN - K  # the anchor's column: it starts at most so far into a window
WIDTH = 2 * SPAN - K
#: Bytes of text in a chunk, and of all text for each bucket of hashes.
CHUNK_BYTES = 2 << 20
BUCKET_BYTES = 8 << 20
#: Windows whose hashes are held at once.
SLICE = 1 << 17
LAST = (1 << 63) - 1

U64 = np.uint64


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the K bytes from each place on, built from hashes of 1, 2, 4 and 8 bytes."""
    factor = 0x9E3779B97F4A7C15
    power = lambda n: U64(pow(factor, n, 1 << 64))
    one = data.astype(U64) + U64(1)
    two = one[:-1] * power(1) + one[1:]
    four = two[:-2] * power(2) + two[2:]
    eight = four[:-4] * power(4) + four[4:]
    h = eight[: len(data) - K + 1] * power(4) + four[8 : len(data) - K + 9]
    h ^= h >> U64(31)
    h *= U64(0xBF58476D1CE4E5B9)
    h ^= h >> U64(29)
    h *= U64(0x94D049BB133111EB)
    h ^= h >> U64(32)
    return h


def spread(hashes: np.ndarray) -> np.ndarray:
    """Other numbers for hashes, one to one. The least hashes of windows are all small, and would fall into few buckets."""
    h = hashes * U64(0xD6E8FEB86659FD93)
    h ^= h >> U64(32)
    return h * U64(0xD6E8FEB86659FD93)


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every `width` neighbours."""
    reach, least = 1, values
    while 2 * reach <= width:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(least[: len(least) - rest], least[rest:]) if rest else least


class Runs:
    """The runs of windows that share an anchor, of all documents of a chunk laid end to end."""

    def __init__(self, texts: list[bytes]):
        lengths = np.array([len(t) for t in texts], dtype=np.int64)
        self.begins = np.r_[0, np.cumsum(lengths)]
        self.data = np.frombuffer(b"".join(texts), dtype=np.uint8)
        n = len(self.data)
        ends = np.repeat(self.begins[1:], lengths)
        parts = [self._slice(at, min(at + SLICE, n - SPAN + 1), ends) for at in range(0, n - SPAN + 1, SLICE)]
        joined = [np.concatenate(x) for x in zip(*parts, strict=True)] if parts else [np.zeros(0, dtype=t) for t in (np.int64, np.int64, np.int64, U64)]
        self.first, self.last, self.anchor, self.hash = joined
        self.doc = np.searchsorted(self.begins, self.first, "right") - 1

    def _slice(self, low: int, high: int, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The runs of the windows that start in [low, high). A run that goes on beyond is two, which does no harm."""
        starts = np.flatnonzero(np.arange(low + SPAN, high + SPAN) <= ends[low:high])
        if not len(starts):
            return starts, starts, starts, np.zeros(0, dtype=U64)
        hashes = gram_hashes(self.data[low : high + SPAN - 1])
        packed = (hashes >> U64(32) << U64(32)) | np.arange(len(hashes), dtype=U64)  # of equal hashes the first is the least
        anchor = (sliding_least(packed, SPAN - K + 1)[starts] & U64(0xFFFFFFFF)).astype(np.int64)
        new = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
        return low + starts[new], low + starts[np.r_[new[1:] - 1, len(starts) - 1]], low + anchor[new], spread(hashes[anchor[new]])

    def distinct(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct hashes ascending, the number of each run's hash among them, and whether several documents have it."""
        order = np.lexsort((self.doc, self.hash))
        h, d = self.hash[order], self.doc[order]
        new = np.r_[True, h[1:] != h[:-1]] if len(h) else np.zeros(0, dtype=bool)
        number = np.cumsum(new) - 1
        inverse = np.empty(len(h), dtype=np.int64)
        inverse[order] = number
        several = np.zeros(int(new.sum()), dtype=bool)
        several[number[1:][(~new[1:]) & (d[1:] != d[:-1])]] = True
        return h[new], inverse, several


def buckets_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Ascending with the hash."""
    return ((hashes >> U64(32)) * U64(buckets) >> U64(32)).astype(np.int32)


def stretches(keys: np.ndarray) -> list[tuple[int, int, int]]:
    """(key, begin, end) of the runs of equal keys."""
    if not len(keys):
        return []
    at = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return list(zip(keys[at].tolist(), at.tolist(), [*at[1:].tolist(), len(keys)], strict=True))


def in_order(rows: pa.Table) -> tuple[list[bytes], np.ndarray, pa.Table]:
    """A chunk's texts and doc_ids in an order that every reading of the chunk gives again."""
    rows = rows.sort_by([("rank", "ascending"), ("tag", "ascending")])
    unpack = zstandard.ZstdDecompressor()
    return [unpack.decompress(z) for z in rows.column("packed").to_pylist()], rows.column("rank").to_numpy(), rows


def announce(buckets: int):
    """Of a chunk: for each bucket the distinct hashes of its anchors (6 bytes each) and whether several documents have them."""
    schema = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("hashes", pa.binary()), ("several", pa.binary())])

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        texts, _, _ = in_order(rows)
        hashes, _, several = Runs(texts).distinct()
        low = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
        out = [(b, key[0].as_py(), low[i:j].tobytes(), np.packbits(several[i:j]).tobytes()) for b, i, j in stretches(buckets_of(hashes, buckets))]
        return pa.Table.from_pylist([dict(zip(schema.names, x, strict=True)) for x in out], schema=schema)

    return run, "bucket int, chunk bigint, hashes binary, several binary"


def answer(key: tuple, rows: pa.Table) -> pa.Table:
    """Of a bucket: for each chunk one bit for each hash it announced, in its order: whether two documents have it."""
    parts = [np.frombuffer(h, dtype=np.uint8).reshape(-1, 6) for h in rows.column("hashes").to_pylist()]
    sizes = [len(p) for p in parts]
    wide = np.zeros((sum(sizes), 8), dtype=np.uint8)
    wide[:, :6] = np.concatenate(parts)
    values = wide.view("<u8").ravel()
    several = np.concatenate([np.unpackbits(np.frombuffer(s, dtype=np.uint8), count=n).astype(bool) for s, n in zip(rows.column("several").to_pylist(), sizes, strict=True)])
    order = np.argsort(values, kind="stable")
    v = values[order]
    same = v[1:] == v[:-1]
    shared = np.r_[same, False] | np.r_[False, same]
    bits = several.copy()
    bits[order[shared]] = True
    ends = np.cumsum(sizes)
    sent = [np.packbits(bits[e - n : e]).tobytes() for e, n in zip(ends, sizes, strict=True)]
    return pa.table({"chunk": rows.column("chunk"), "bucket": rows.column("bucket"), "bits": pa.array(sent, pa.binary())})


PIECE = np.dtype([("bucket", ">u4"), ("begin", "u1"), ("size", "u1"), ("bytes", "u1", (WIDTH,))])


def surround(buckets: int):
    """Of a chunk: for each bucket the distinct pieces around its shared anchors, each with the smallest doc_id and the
    places (document's number, first window's place in it, whether its doc_id is greater than the smallest)."""
    schema = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("pieces", pa.binary()), ("places", pa.binary())])

    def run(key: tuple, rows: pa.Table, bits: pa.Table) -> pa.Table:
        if not len(rows) or not len(bits):
            return schema.empty_table()
        texts, ranks, _ = in_order(rows)
        runs = Runs(texts)
        hashes, inverse, _ = runs.distinct()
        shared = np.zeros(len(hashes), dtype=bool)
        told = dict(zip(bits.column("bucket").to_pylist(), bits.column("bits").to_pylist(), strict=True))
        for b, i, j in stretches(buckets_of(hashes, buckets)):
            shared[i:j] = np.unpackbits(np.frombuffer(told[b], dtype=np.uint8), count=j - i).astype(bool)
        use = np.flatnonzero(shared[inverse])
        if not len(use):
            return schema.empty_table()
        first, last, doc = runs.first[use], runs.last[use], runs.doc[use]
        begin = FIRST - (runs.anchor[use] - first)
        size = last - first + SPAN
        pieces = np.zeros(len(use), dtype=PIECE)
        pieces["bucket"], pieces["begin"], pieces["size"] = buckets_of(runs.hash[use], buckets), begin, size
        column = np.arange(WIDTH)
        for at in range(0, len(use), 1 << 12):
            part = slice(at, at + (1 << 12))
            inside = (column >= begin[part, None]) & (column < (begin + size)[part, None])
            place = np.clip((first - begin)[part, None] + column, 0, len(runs.data) - 1)
            pieces["bytes"][part] = np.where(inside, runs.data[place], 0)
        blob = pieces.view(np.dtype((np.void, PIECE.itemsize)))
        _, number = np.unique(blob, return_inverse=True)
        order = np.lexsort((ranks[doc], number))
        number, doc, place = number[order], doc[order], (first - runs.begins[doc])[order]
        new = np.flatnonzero(np.r_[True, number[1:] != number[:-1]])
        counts = np.diff(np.r_[new, len(number)])
        least = ranks[doc[new]]
        greater = ranks[doc] > np.repeat(least, counts)
        own = pieces[order[new]]
        pack = zstandard.ZstdCompressor(level=3)
        out = []
        for b, i, j in stretches(own["bucket"].astype(np.int64)):
            one, own_counts = own[i:j], counts[i:j]
            lo, hi = new[i], new[j - 1] + counts[j - 1]
            body = one["bytes"].tobytes() + one["begin"].tobytes() + one["size"].tobytes() + least[i:j].astype("<i8").tobytes()
            listed = own_counts.astype("<u4").tobytes() + doc[lo:hi].astype("<u4").tobytes() + place[lo:hi].astype("<u4").tobytes() + greater[lo:hi].astype("u1").tobytes()
            out.append((b, key[0].as_py(), pack.compress(body), pack.compress(listed)))
        return pa.Table.from_pylist([dict(zip(schema.names, x, strict=True)) for x in out], schema=schema)

    return run, "bucket int, chunk bigint, pieces binary, places binary"


def repeats(pieces: np.ndarray, begin: np.ndarray, size: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """Which windows of the pieces also start in a piece of smaller rank: a boolean row of SPAN - K + 1 columns for each."""
    n = len(pieces)
    gone = np.zeros((n, FIRST + 1), dtype=bool)
    order = np.arange(n)
    columns = np.ascontiguousarray(pieces.T)
    for column in range(WIDTH - 1, -1, -1):
        # One symbol more for every piece: a stable sort by it alone, since the order so far is that of what follows it.
        order = order[np.argsort(columns[column][order], kind="stable")]
        if column > FIRST:
            continue
        whole = order[(begin[order] <= column) & (begin[order].astype(np.int64) + size[order] >= column + SPAN)]
        if len(whole) < 2:
            continue
        windows = pieces[whole, column : column + SPAN]
        new = np.flatnonzero(np.r_[True, (windows[1:] != windows[:-1]).any(axis=1)])  # neighbours with a shorter common prefix
        least = np.minimum.reduceat(ranks[whole], new)
        gone[whole, column] = np.repeat(least, np.diff(np.r_[new, len(whole)])) < ranks[whole]
    return gone


def sort_pieces(key: tuple, rows: pa.Table) -> pa.Table:
    """Of a bucket: for each chunk the windows to remove, as (document's number, first window, number of windows)."""
    unpack = zstandard.ZstdDecompressor()
    bodies, lists, chunks = [], [], rows.column("chunk").to_pylist()
    for body, listed in zip(rows.column("pieces").to_pylist(), rows.column("places").to_pylist(), strict=True):
        body, listed = unpack.decompress(body), unpack.decompress(listed)
        n = len(body) // (WIDTH + 10)
        at = [0, n * WIDTH, n * (WIDTH + 1), n * (WIDTH + 2), n * (WIDTH + 10)]
        kinds = [("u1", (n, WIDTH)), ("u1", (n,)), ("u1", (n,)), ("<i8", (n,))]
        bodies.append([np.frombuffer(body[a:b], dtype=t).reshape(s) for a, b, (t, s) in zip(at, at[1:], kinds, strict=False)])
        counts = np.frombuffer(listed[: 4 * n], dtype="<u4").astype(np.int64)
        m = int(counts.sum())
        lists.append((counts, np.frombuffer(listed[4 * n : 4 * n + 4 * m], "<u4"), np.frombuffer(listed[4 * (n + m) : 4 * (n + 2 * m)], "<u4"), np.frombuffer(listed[4 * (n + 2 * m) :], "u1")))
    gone = repeats(*[np.concatenate(x) for x in zip(*bodies, strict=True)])
    out, at = [], 0
    for chunk, (_, begin, size, _), (counts, doc, place, greater) in zip(chunks, bodies, lists, strict=True):
        own = gone[at : at + len(begin)]
        at += len(begin)
        of = np.repeat(np.arange(len(begin)), counts)
        # The windows of a piece are FIRST - its anchor's distance and so on; under a greater doc_id all of them go.
        columns = np.arange(FIRST + 1)
        whole = (columns >= begin[:, None]) & (columns + SPAN <= begin[:, None].astype(np.int64) + size[:, None])
        marks = np.where((greater == 1)[:, None], whole[of], own[of])
        edge = np.diff(np.pad(marks, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        which, start = np.nonzero(edge == 1)
        _, end = np.nonzero(edge == -1)
        if len(which):
            first = place[which].astype(np.int64) + start - begin[of[which]]
            sent = np.stack([doc[which].astype("<u4"), first.astype("<u4"), (end - start).astype("<u4")])
            out.append({"chunk": chunk, "marks": zstandard.compress(sent.tobytes(), 3)})
    return pa.Table.from_pylist(out, schema=pa.schema([("chunk", pa.int64()), ("marks", pa.binary())]))


def remove(key: tuple, rows: pa.Table, marks: pa.Table) -> pa.Table:
    """Of a chunk: each document's bytes, removed bytes, removed runs and what is left."""
    schema = pa.schema([("doc_id", pa.int64()), ("tag", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary())])
    if not len(rows):
        return schema.empty_table()
    texts, _, rows = in_order(rows)
    begins = np.r_[0, np.cumsum([len(t) for t in texts])].astype(np.int64)
    turns = np.zeros(int(begins[-1]) + 1, dtype=np.int64)
    for sent in marks.column("marks").to_pylist():
        doc, first, count = np.frombuffer(zstandard.decompress(sent), dtype="<u4").reshape(3, -1).astype(np.int64)
        np.add.at(turns, begins[doc] + first, 1)
        np.add.at(turns, begins[doc] + first + count - 1 + SPAN, -1)
    gone = np.cumsum(turns[:-1]) > 0
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    removed, spans, kept = [], [], []
    for a, b in zip(begins, begins[1:], strict=False):
        own = gone[a:b]
        n = int(own.sum())
        removed.append(n)
        spans.append(int(np.count_nonzero(own[1:] & ~own[:-1]) + (len(own) > 0 and own[0])) if n else 0)
        kept.append(data[a:b][~own].tobytes() if n else data[a:b].tobytes())
    arrays = [rows.column("doc_id"), rows.column("tag"), pa.array(np.diff(begins)), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, pa.binary())]
    return pa.table(arrays, schema=schema)


def packed(docs: DataFrame) -> DataFrame:
    """(doc_id, rank, tag, chunk, packed): texts as compressed bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            sent = [pack.compress(t.as_py().encode("utf-8", "surrogatepass")) for t in batch.column("text")]
            arrays = [batch.column(c) for c in ("doc_id", "rank", "tag", "chunk")] + [pa.array(sent, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "rank", "tag", "chunk", "packed"])

    return docs.mapInArrow(run, "doc_id bigint, rank bigint, tag bigint, chunk bigint, packed binary")


def dedup_substrings(docs: DataFrame) -> DataFrame:
    """(doc_id, tag, n_bytes, n_removed, n_spans, kept) for each row of `docs` (doc_id, text).

    Removed is every byte of the UTF-8 text that a SPAN-byte string covers which also starts in a document of smaller
    doc_id; strings are judged on the texts as given. `kept` is what remains, as bytes, since a character may lose a part.
    Null is empty text. Rows that share a doc_id don't remove from each other. A row without doc_id comes after all others
    and removes from none. An empty table gives an empty result.
    """
    text = F.coalesce("text", F.lit(""))
    total = docs.agg(F.sum(F.octet_length(text)).alias("n")).first()["n"] or 0
    chunks, buckets = int(-(-total // CHUNK_BYTES)) or 1, int(-(-total // BUCKET_BYTES)) or 1
    # The input partition is part of a chunk's key, so that even a row that repeats a million times is spread.
    keyed = docs.select("doc_id", F.coalesce("doc_id", F.lit(LAST)).alias("rank"), row_tag(text).alias("tag"), text.alias("text"))
    keyed = keyed.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "tag", F.spark_partition_id()), F.lit(chunks)))
    texts = packed(keyed.select("doc_id", "rank", "tag", "chunk", "text")).repartition("chunk")  # read three times, shuffled once
    sent = texts.groupBy("chunk").applyInArrow(*announce(buckets))
    bits = sent.groupBy("bucket").applyInArrow(answer, "chunk bigint, bucket int, bits binary")
    pieces = texts.groupBy("chunk").cogroup(bits.groupBy("chunk")).applyInArrow(*surround(buckets))
    marks = pieces.groupBy("bucket").applyInArrow(sort_pieces, "chunk bigint, marks binary")
    schema = "doc_id bigint, tag bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary"
    return texts.groupBy("chunk").cogroup(marks.groupBy("chunk")).applyInArrow(remove, schema)


@query("op10_column_bwt")
def op10_column_bwt(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup_substrings(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
