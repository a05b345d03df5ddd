"""Stretches that share a minimiser, and the packed rows in which they travel to their bucket.

Used by the two operators that find repeated windows of a fixed width. A window's minimiser is
the place inside it whose hash is smallest; consecutive windows with one minimiser are one
stretch, and equal windows have equal minimisers, so they meet in the bucket of its hash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import from_arrow_type

from salesmart.llm.common import python_tasks, texts
from salesmart.session import materialise

BUCKET_BYTES = 16 << 20
CELLS_PER_BUCKET = 16
PASSES = 3
PLACE_BITS = 26
BASE = 0x9E3779B97F4A7C15 | 1
ROWS = "bucket int, kind int, data binary"
SPANS = "_id long, _key long, from long, to long"
WIDTHS = ("<i1", "<i2", "<i4", "<i8")


class Powers:
    """Powers of an odd number modulo 2^64 and their inverses, as long as needed."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def reach(self, n: int) -> None:
        if len(self.up) < n:
            step = np.full(n, BASE, np.uint64)
            back = np.full(n, pow(BASE, -1, 1 << 64), np.uint64)
            step[0] = back[0] = 1
            self.up, self.down = np.cumprod(step), np.cumprod(back)


_POWERS = Powers()


def mixed(x: np.ndarray) -> np.ndarray:
    x = x >> np.uint64(31) ^ x
    x *= np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    x ^= x >> np.uint64(33)
    return x


def sums(values: np.ndarray) -> np.ndarray:
    """Running sums from which ``hashes`` makes the hash of any stretch of ``values``."""
    _POWERS.reach(len(values) + 1)
    out = np.zeros(len(values) + 1, np.uint64)
    out[1:] = values
    out[1:] += np.uint64(1)
    out[1:] *= _POWERS.up[: len(values)]
    return np.cumsum(out, out=out)


def hashes(running: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mixed((running[end] - running[begin]) * _POWERS.down[begin])


def hashes_of_width(running: np.ndarray, width: int) -> np.ndarray:
    n = len(running) - width
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = running[width:] - running[:n]
    out *= _POWERS.down[:n]
    return mixed(out)


def smallest_in_windows(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` consecutive values."""
    have = 1
    while 2 * have <= width:
        values = np.minimum(values[:-have], values[have:])
        have *= 2
    return np.minimum(values[: len(values) - (width - have)], values[width - have :]) if have < width else values


class Cells(NamedTuple):
    """What all tasks know of the cells of gram hashes: those whose grams give way to others, and
    those whose windows go to buckets of their own."""

    bits: int
    hot: np.ndarray = np.zeros(0, np.uint64)
    split: np.ndarray = np.zeros(0, np.uint64)

    def of(self, hash_: np.ndarray) -> np.ndarray:
        return hash_ >> np.uint64(64 - self.bits)


def stretches(hash_: np.ndarray, owner: np.ndarray, width: int, gram: int, cells: Cells):
    """First window, last window and minimiser place of every stretch.

    ``hash_`` holds the hashes of the grams of ``gram`` symbols, ``owner`` the document of each
    symbol. A gram whose cell is hot is a minimiser only where a window has no other. A window
    whose minimiser is in a split cell is a stretch by itself.
    """
    none = np.zeros(0, np.int64)
    if len(owner) < width:
        return none, none, none
    key = (hash_ >> np.uint64(1)) >> np.uint64(PLACE_BITS) << np.uint64(PLACE_BITS)
    key |= np.arange(len(key), dtype=np.uint64)
    if len(cells.hot):
        key[np.isin(cells.of(hash_), cells.hot)] |= np.uint64(1 << 63)
    places = smallest_in_windows(key, width - gram + 1) & np.uint64((1 << PLACE_BITS) - 1)
    whole = np.flatnonzero(owner[: len(owner) - width + 1] == owner[width - 1 :])
    if not len(whole):
        return none, none, none
    places = places[whole].astype(np.int64)
    turn = np.diff(places) != 0
    if len(cells.split):
        turn |= np.isin(cells.of(hash_[places[1:]]), cells.split)
    turn = np.flatnonzero(turn) + 1
    first, last = np.append(0, turn), np.append(turn, len(places)) - 1
    return whole[first], whole[last], places[first]


def keys(hash_: np.ndarray, running: np.ndarray, first: np.ndarray, width: int, cells: Cells) -> np.ndarray:
    """What decides the bucket of each stretch: its minimiser's hash, or in split cells its window's."""
    out = hash_.copy()
    if len(cells.split):
        apart = first[at := np.flatnonzero(np.isin(cells.of(hash_), cells.split))]
        out[at] = hashes(running, apart, apart + width)
    return out


def around(found: dict, cells: Cells) -> np.ndarray:
    """Hashes of the grams in windows whose minimiser would be hot, if hot ones did not give way."""
    hash_, (width, gram) = found["grams"], found["shape"]
    first, last, at = stretches(hash_, found["owner"], width, gram, Cells(cells.bits))
    touched = np.isin(cells.of(hash_[at]), cells.hot)
    size = len(hash_) + 1
    edge = np.bincount(first[touched], minlength=size) - np.bincount(last[touched] + width - gram + 1, minlength=size)
    return hash_[np.cumsum(edge)[:-1] > 0]


def packed(columns: list[np.ndarray], text: bytes) -> bytes:
    """Integer columns (of any lengths) and a text as one compressed string.

    Columns are kept as differences, in as few bytes as hold them all.
    """
    steps = [np.diff(c, prepend=0) for c in columns]
    steps = [s.astype(next(t for t in WIDTHS if (s.astype(t) == s).all())) for s in steps]
    head = [len(columns), *(x for s in steps for x in (len(s), s.itemsize))]
    return zstandard.ZstdCompressor(level=3).compress(
        b"".join([np.array(head, "<i8").tobytes(), *(s.tobytes() for s in steps), text])
    )


def unpacked(data: bytes) -> tuple[list[np.ndarray], bytes]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    n = int(np.frombuffer(raw, "<i8", 1)[0])
    head = np.frombuffer(raw, "<i8", 2 * n, 8).tolist()
    at, columns = 8 + 16 * n, []
    for length, width in zip(head[::2], head[1::2]):
        columns.append(np.cumsum(np.frombuffer(raw, f"<i{width}", length, at), dtype=np.int64))
        at += length * width
    return columns, raw[at:]


class Docs(NamedTuple):
    """Documents by number: doc_id and key of each. Numbers are in the order of (doc_id, key)."""

    ids: np.ndarray
    keys: np.ndarray

    @classmethod
    def of(cls, ids: np.ndarray, keys: np.ndarray) -> tuple[Docs, np.ndarray]:
        """The distinct documents of a list, and the number of each entry."""
        order = np.lexsort((keys, ids))
        ids_, keys_ = ids[order], keys[order]
        new = np.ones(len(order), bool)
        new[1:] = (ids_[1:] != ids_[:-1]) | (keys_[1:] != keys_[:-1])
        number = np.empty(len(order), np.int64)
        number[order] = np.cumsum(new) - 1
        return cls(ids_[new], keys_[new]), number


def merged(docs: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The spans of each document with those that overlap or touch made one."""
    if not len(docs):
        return docs, begin, end
    order = np.lexsort((begin, docs))
    docs, begin, end = docs[order], begin[order], end[order]
    out: list[list[int]] = []
    for i, a, b in zip(docs.tolist(), begin.tolist(), end.tolist()):
        if out and out[-1][0] == i and a <= out[-1][2]:
            if b > out[-1][2]:
                out[-1][2] = b
        else:
            out.append([i, a, b])
    made = np.array(out, np.int64)
    return made[:, 0], made[:, 1], made[:, 2]


def rows_of(batch_rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    buckets, kinds, data = zip(*batch_rows) if batch_rows else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(buckets, pa.int32()), pa.array(kinds, pa.int32()), pa.array(data, pa.binary())],
        names=["bucket", "kind", "data"],
    )


def spans_batch(docs: Docs, number: np.ndarray, begin: np.ndarray, end: np.ndarray) -> pa.Table:
    columns = {"_id": docs.ids[number], "_key": docs.keys[number], "from": begin, "to": end}
    return pa.table({name: pa.array(c, pa.int64()) for name, c in columns.items()})


Piece = tuple[int, int, int, bytes]  # id, key, place of its first symbol in the document, bytes
Chunk = list[Piece]


def chunks(batches: Iterator[pa.RecordBatch], size: int, cut: Callable[[bytes], Iterator[tuple[int, bytes]]]) -> Iterator[Chunk]:
    """The rows' pieces, by document, in chunks of about ``size`` bytes; long texts are cut by ``cut``."""
    have: Chunk = []
    used = 0
    for batch in batches:
        rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.binary()).to_pylist())
        for id_, key, text in rows:
            for at, piece in cut(text) if len(text) > size else [(0, text)]:
                have.append((id_, key, at, piece))
                used += len(piece) + 1
                if used >= size:
                    yield sorted(have, key=lambda p: p[:3])
                    have, used = [], 0
    if have:
        yield sorted(have, key=lambda p: p[:3])


def documents_of(chunk: Chunk) -> tuple[Docs, np.ndarray]:
    """The documents of a chunk, and the number of each piece's."""
    return Docs.of(np.array([p[0] for p in chunk], np.int64), np.array([p[1] for p in chunk], np.int64))


def identified(docs: DataFrame) -> DataFrame:
    """``doc_id, _id, _key, text``; rows with equal ``_id`` and ``_key`` are one document.

    The key is 0, or the hash of the text for rows without an id and for ids that different texts
    share. Texts are moved for that only if there are such ids and too many for a broadcast.
    """
    rows = texts(docs).withColumn("text", F.coalesce("text", F.lit("")))
    hashed = rows.filter("doc_id IS NOT NULL").select("_id", F.xxhash64("text").alias("_h"))
    shared = hashed.groupBy("_id").agg(F.min("_h").alias("_low"), F.max("_h").alias("_high")).filter("_low <> _high")
    shared = materialise(shared.select("_id"), "shared-ids")
    nameless = F.col("doc_id").isNull()
    if not shared.isEmpty():
        rows = rows.join(shared.withColumn("_shared", F.lit(True)), "_id", "left")
        nameless |= F.coalesce("_shared", F.lit(False))
    key = F.when(nameless, F.xxhash64("text")).otherwise(F.lit(0).cast("long"))
    return rows.select("doc_id", "_id", key.alias("_key"), "text")


def repeated_spans(
    rows: DataFrame,
    size: int,
    cut: Callable[[bytes], Iterator[tuple[int, bytes]]],
    prepare: Callable,
    send: Callable,
    meet: Callable[[pa.Table], pa.Table],
    passes: int = PASSES,
) -> DataFrame:
    """``_id, _key, spans`` (set of from, to) of the repeated windows of each document of ``rows``.

    ``prepare(chunk, cells)`` finds the chunk's stretches and returns them with the hashes of
    their minimisers; ``send(prepared, bucket of each stretch, buckets)`` makes the rows for the
    buckets; ``meet`` finds a bucket's spans.

    Before, a pass weighs the stretches of all documents by cells of minimiser hashes, a string
    once a chunk. Cells with more than a quarter of a bucket are hot, and their grams give way to
    others, so that a frequent phrase does not draw all its surroundings into one bucket. Then
    other grams of a longer passage may be hot: as long as there are any, and the bytes beyond
    that limit go down, the pass is repeated with the new list (at most ``passes`` in all), which
    then also gets the grams that are frequent around hot ones. The best list after the first pass
    counts. A cell that
    has more than a bucket with it (say, text of a few words only, all of them hot) is split: its
    windows are dealt one by one, by their own hash. A pass finds at most 4 hot cells and a
    frequent one to a bucket; these lists are what all tasks get.
    """
    spark = rows.sparkSession
    python_tasks(spark)
    source = rows.select("_id", "_key", "text")
    total = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-33 * total // (10 * BUCKET_BYTES)))
    limit = BUCKET_BYTES // 4

    def weigh(cells: Cells) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
        """Bytes beyond the limit, the cells that are too heavy, those of frequent grams around hot
        ones, and those with more than a whole bucket."""
        known = spark.sparkContext.broadcast(cells)

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            cells = known.value
            seen = np.zeros(0, np.uint64)
            weight = near = np.zeros(0, np.int64)
            for chunk in chunks(batches, size, cut):
                found = prepare(chunk, cells)
                _, once = np.unique(found["same"], return_index=True)
                here, bytes_ = cells.of(found["hash"][once]), found["bytes"][once]
                by = cells.of(around(found, cells)) if len(cells.hot) and len(once) else seen[:0]
                mean = int(bytes_.mean()) if len(once) else 0
                seen, at = np.unique(np.concatenate([seen, here, by]), return_inverse=True)
                none = np.zeros(len(by), np.int64)
                weight = np.bincount(at, np.concatenate([weight, bytes_, none]), len(seen)).astype(np.int64)
                near = np.bincount(at, np.concatenate([near, 0 * bytes_, none + mean]), len(seen)).astype(np.int64)
            columns = seen.astype(np.int64), weight, near
            for at in range(0, len(seen), 10_000):
                yield pa.RecordBatch.from_arrays([pa.array(c[at : at + 10_000]) for c in columns], names=["cell", "n", "near"])

        cells_ = (
            source.mapInArrow(count, "cell long, n long, near long")
            .groupBy("cell")
            .agg(F.sum("n").alias("n"), F.sum("near").alias("near"))
            .filter((F.col("n") > limit) | (F.col("near") > limit))
            .collect()
        )
        usual = 16 * sum(r.near for r in cells_) >> cells.bits
        heavy = [r.cell for r in cells_ if r.n > limit]
        frequent = [r.cell for r in cells_ if r.near > max(limit, usual)]
        large = [r.cell for r in cells_ if r.n > BUCKET_BYTES]
        return sum(max(0, r.n - limit) for r in cells_), *(np.array(sorted(c), np.uint64) for c in (heavy, frequent, large))

    cells = Cells((CELLS_PER_BUCKET * buckets - 1).bit_length())
    least, best = 0, cells
    for turn in range(passes):
        beyond, heavy, frequent, large = weigh(cells)
        if turn > 1 and beyond >= least:
            break
        least, best = beyond, cells._replace(split=large)
        new = np.setdiff1d(heavy, cells.hot)
        if not len(new):
            break
        cells = cells._replace(hot=np.union1d(np.union1d(cells.hot, new), frequent))
    shared = spark.sparkContext.broadcast(best if passes > 1 else cells)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, size, cut):
            found = prepare(chunk, shared.value)
            del found["grams"], found["owner"]
            bucket = (mixed(found["key"]) % np.uint64(buckets)).astype(np.int64)
            sent = send(found, bucket, buckets)
            for at in range(0, len(sent), 256):
                yield rows_of(sent[at : at + 256])

    return (
        source.mapInArrow(deal, ROWS)
        .groupBy("bucket")
        .applyInArrow(meet, SPANS)
        .groupBy("_id", "_key")
        .agg(F.collect_set(F.struct("from", "to")).alias("spans"))
    )


def without_spans(
    rows: DataFrame,
    spans: DataFrame,
    cut: Callable[[bytes, list[dict[str, int]]], tuple],
    columns: dict[str, pa.DataType],
) -> DataFrame:
    """``doc_id`` and the ``columns`` that ``cut(text, spans)`` gives, for every row of ``rows``.

    Texts meet their spans compressed, so the shuffle carries well under half of their bytes.
    """
    python_tasks(rows.sparkSession)

    def shrink(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        small = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            data = [small(t) for t in batch.column(3).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(data, pa.binary())], names=["doc_id", "_id", "_key", "data"]
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            made = [
                cut(whole(data), found or [])
                for data, found in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())
            ]
            values = list(zip(*made)) or [()] * len(columns)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *map(pa.array, values, columns.values())], names=["doc_id", *columns]
            )

    schema = T.StructType(
        [T.StructField("doc_id", T.LongType()), *(T.StructField(c, from_arrow_type(t)) for c, t in columns.items())]
    )

    return (
        rows.select("doc_id", "_id", "_key", "text")
        .mapInArrow(shrink, "doc_id long, _id long, _key long, data binary")
        .join(spans, ["_id", "_key"], "left")
        .select("doc_id", "data", "spans")
        .mapInArrow(run, schema)
    )


def repeated(values: np.ndarray) -> np.ndarray:
    """Positions of the values that stand at more than one position."""
    order = np.argsort(values)
    same = values[order][1:] == values[order][:-1]
    mark = np.zeros(len(values), bool)
    mark[order[1:][same]] = mark[order[:-1][same]] = True
    return np.flatnonzero(mark)


def parts(sizes: np.ndarray, limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of neighbours of at most ``limit`` together, or a single one."""
    ends, at = np.cumsum(sizes), 0
    while at < len(sizes):
        used = int(ends[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(ends, used + limit, "right")))
        yield at, to
        at = to


def grouped(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """The positions of each bucket's entries, in order."""
    order = np.argsort(bucket, kind="stable")
    edges = np.append(np.append(0, np.flatnonzero(np.diff(bucket[order])) + 1), len(order))
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        if b > a:
            yield int(bucket[order[a]]), order[a:b]


def span_rows(docs: Docs, number: np.ndarray, begin: np.ndarray, end: np.ndarray, buckets: int) -> list[tuple[int, int, bytes]]:
    """Spans that a task knows by itself, dealt to buckets by their document."""
    number, begin, end = merged(number, begin, end)
    ids, keys_ = docs.ids[number], docs.keys[number]
    where = (mixed((ids ^ keys_).astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)
    return [(b, 1, packed([ids[at], keys_[at], begin[at], end[at]], b"")) for b, at in grouped(where)]


def known_spans(table: pa.Table) -> list[np.ndarray]:
    """id, key, begin and end of the spans that came as such."""
    found = [unpacked(d)[0] for k, d in zip(table["kind"].to_pylist(), table["data"].to_pylist()) if k == 1]
    return [np.concatenate(c) for c in zip(*found)] if found else [np.zeros(0, np.int64)] * 4


def strings_of(table: pa.Table):
    """The bucket's distinct strings and all records.

    Returns the strings; per string: the further column; per record: string, id, key, begin.
    """
    known: dict[bytes, int] = {}
    which, ids, keys_, begins, extra = [], [], [], [], []
    for kind, data in zip(table["kind"].to_pylist(), table["data"].to_pylist()):
        if kind:
            continue
        (lengths, more, index, id_, key, begin), text = unpacked(data)
        place = []
        at = 0
        for length, x in zip(lengths.tolist(), more.tolist()):
            s = text[at : at + length]
            at += length
            n = known.setdefault(s, len(known))
            if n == len(extra):
                extra.append(x)
            place.append(n)
        which.append(np.array(place, np.int64)[index])
        ids.append(id_)
        keys_.append(key)
        begins.append(begin)
    none = [np.zeros(0, np.int64)]
    return list(known), np.array(extra, np.int64), *(np.concatenate(none + x) for x in (which, ids, keys_, begins))


def numbered(*lists: tuple[np.ndarray, np.ndarray]) -> tuple[Docs, list[np.ndarray]]:
    """The documents of several lists of (ids, keys), and their numbers list by list."""
    docs, number = Docs.of(*(np.concatenate(c) for c in zip(*lists)))
    return docs, np.split(number, np.cumsum([len(ids) for ids, _ in lists])[:-1])
