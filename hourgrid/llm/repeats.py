"""Removal of long strings that stand in an earlier document, by induced suffix sorting.

Suffixes are not all sorted. As in induced sorting by samples, a sample of places is named
first: the anchors, which are the places of the least hash in some window of as many short
strings as the length sought holds. Equal strings of that length have an anchor at the same
distance. Anchors whose short string is in one document only are left out by counts of
short names. The others are named by their context, all that strings around them can cover.
Where a context stands in an earlier document as it is, all of it goes; where no other
context has the anchor's string, nothing does; only the rest is sorted, in shards by the
anchor's string, see `induced_sort`. A string at so many places that one task should not sort
them all is left to the names alone: the strings of the length sought around its anchors are
named, those of a chunk once, and go where their names do.

Documents are kept in chunks by a hash, and every step that needs texts meets them there.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .induced_sort import context_kind, earlier_windows

#: Bytes of an anchor's string.
GRAM = 20
#: Bytes of text in a chunk of documents, about.
CHUNK = 1 << 23
#: Bytes whose anchors are found at once, and contexts taken at once.
AT_ONCE = 1 << 19
CONTEXTS = 1 << 16
#: Places of an anchor's string that one task sorts at most (260 MB of contexts, on disk).
OFTEN = 2_000_000
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
_LAST = 2 ** 63 - 1  # place in order of a null id


def _mixed(words: list[np.ndarray]) -> np.ndarray:
    total = np.zeros(len(words[0]), dtype=np.uint64)
    for turn, word in enumerate(words):
        total = total + word
        total *= _MIX[turn % 3]
        total ^= total >> np.uint64(29 + turn % 3)
    return total


def _sliding(values: np.ndarray, width: int, least) -> np.ndarray:
    """Minimum or maximum of each ``width`` values in a row."""
    reach = 1
    while reach * 2 <= width:
        values = least(values[:-reach], values[reach:])
        reach *= 2
    rest = width - reach
    return least(values[:-rest], values[rest:]) if rest else values


def anchors(data: np.ndarray, ends: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the anchors of the documents that end at ``ends``."""
    if len(data) < size:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    words = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))
    number = len(data) - GRAM + 1
    starts = [*range(0, GRAM - 8, 8), GRAM - 8]
    hashes = _mixed([words[s:s + number] for s in starts]) | np.uint64(1)
    width = size - GRAM + 1
    least = _sliding(hashes, width, np.minimum)  # by the start of a window
    for end, start in zip(ends, np.concatenate([[0], ends[:-1]])):
        least[max(int(start), int(end) - size + 1, 0):int(end)] = 0  # windows that cross an end
    edge = np.zeros(width - 1, dtype=np.uint64)
    most = _sliding(np.concatenate([edge, least, edge]), width, np.maximum)
    places = np.nonzero(hashes == most)[0]
    return places, hashes[places]


class Texts:
    """Documents in a row of bytes."""

    def __init__(self, texts: pa.Array):
        texts = texts.cast(pa.binary())
        lengths = np.array([len(t) if t is not None else 0 for t in texts.to_pylist()], dtype=np.int64) \
            if texts.null_count else np.diff(np.frombuffer(texts.buffers()[1], "<i4")[texts.offset:texts.offset + len(texts) + 1]).astype(np.int64)
        first = 0 if texts.null_count else int(np.frombuffer(texts.buffers()[1], "<i4")[texts.offset]) if len(texts) else 0
        self.ends = np.cumsum(lengths)
        self.starts = self.ends - lengths
        total = int(self.ends[-1]) if len(lengths) else 0
        if texts.null_count:
            body = b"".join(t or b"" for t in texts.to_pylist())
        else:
            body = memoryview(texts.buffers()[2])[first:first + total] if total else b""
        self.data = np.frombuffer(body, dtype=np.uint8)

    def contexts(self, of: np.ndarray, at: np.ndarray, reach: int, size: int):
        """Bytes before (nearest first) and after places, zero beyond the document, and how
        many there are."""
        before = np.minimum(at - self.starts[of], reach)
        after = np.minimum(self.ends[of] - at, size)
        left = self.data[np.maximum(at[:, None] - 1 - np.arange(reach), 0)]
        left[np.arange(reach) >= before[:, None]] = 0
        right = self.data[np.minimum(at[:, None] + np.arange(size), len(self.data) - 1)]
        right[np.arange(size) >= after[:, None]] = 0
        return left, before, right, after


def _regions(of: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Regions sorted by document and start, those that touch made one."""
    order = np.lexsort([start, of])
    of, start, stop = of[order], start[order], stop[order]
    reach = np.maximum.accumulate(stop + of * (1 << 40)) - of * (1 << 40)
    new = np.ones(len(of), dtype=bool)
    new[1:] = (of[1:] != of[:-1]) | (start[1:] > reach[:-1])
    first = np.nonzero(new)[0]
    return of[first], start[first], np.maximum.reduceat(stop, first) if len(first) else stop[:0]


def _strings(
    texts: Texts, of: np.ndarray, at: np.ndarray, reach: int, size: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Document, place and two names of each string of ``size`` bytes that begins at a place or
    up to ``reach`` bytes before it."""
    words = np.ndarray(max(len(texts.data) - 7, 0), "<u8", texts.data, strides=(1,))
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64))]
    step = CONTEXTS // (reach + 1)
    for a in range(0, len(at), step):
        some, here = of[a:a + step], at[a:a + step]
        low = np.maximum(here - reach, texts.starts[some])
        times = np.maximum(np.minimum(here, texts.ends[some] - size) - low + 1, 0)
        before = np.cumsum(times) - times
        place, one = np.unique(np.repeat(low - before, times) + np.arange(times.sum()), return_index=True)
        parts = [words[place + s] for s in [*range(0, size - 8, 8), size - 8]]
        found.append((np.repeat(some, times)[one], place, _mixed(parts), _mixed(parts[::-1])))
    return tuple(np.concatenate(column) for column in zip(*found))


def _earlier(gram: np.ndarray, name: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Which have both names of one of a smaller order."""
    by = np.lexsort([order, name, gram])
    new = np.ones(len(by), dtype=bool)
    new[1:] = (gram[by][1:] != gram[by][:-1]) | (name[by][1:] != name[by][:-1])
    least = order[by][np.maximum.accumulate(np.where(new, np.arange(len(by)), 0))]
    sure = np.zeros(len(by), dtype=bool)
    sure[by] = order[by] > least
    return sure


def _grams(texts: Texts, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places, hashes and document numbers of all anchors."""
    places, hashes, of = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    one = 0
    while one < len(texts.ends):  # documents of about AT_ONCE bytes at a time
        to = max(one + 1, int(np.searchsorted(texts.ends, texts.starts[one] + AT_ONCE, "right")))
        base, ends = int(texts.starts[one]), texts.ends[one:to]
        at, own = anchors(texts.data[base:int(ends[-1])], ends - base, size)
        places.append(at + base)
        hashes.append(own)
        of.append(one + np.searchsorted(ends - base, at, "right"))
        one = to
    return np.concatenate(places), np.concatenate(hashes), np.concatenate(of)


def _keys(hashes: np.ndarray, shards: int) -> np.ndarray:
    """A short name of a string: its shard, then 32 bits. Strings may share one by chance."""
    shard = (hashes >> np.uint64(32)) % np.uint64(shards)
    return (shard << np.uint64(32)) | (hashes & np.uint64(0xFFFFFFFF))


def _by_shard(keys: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Of sorted keys, the slice of each shard."""
    shard = keys >> np.uint64(32)
    first = np.nonzero(np.append(True, shard[1:] != shard[:-1]))[0] if len(keys) else []
    for a, b in zip(first, [*first[1:], len(keys)]):
        yield int(shard[a]), slice(int(a), int(b))


def _shared(texts: DataFrame, size: int, shards: int, often: int) -> DataFrame:
    """For each chunk of documents and shard, which of the chunk's anchor strings, by short
    name in order, may stand in more than one document of the corpus, and which at more than
    ``often`` places: packed bits. Names go to their shards in blocks of four bytes each, and
    so do the numbers of their places."""

    def send(chunk: pa.Table) -> pa.Table:
        own = Texts(chunk["text"].combine_chunks())
        order = chunk["order"].to_numpy()
        _, hashes, of = _grams(own, size)
        keys, which, places = np.unique(_keys(hashes, shards), return_inverse=True, return_counts=True)
        least, most = np.full(len(keys), _LAST), np.full(len(keys), -_LAST)
        np.minimum.at(least, which, order[of])
        np.maximum.at(most, which, order[of])
        several = least < most
        parts = list(_by_shard(keys))
        number = chunk["chunk"][0].as_py()
        return pa.table({
            "shard": pa.array([s for s, _ in parts], pa.int64()),
            "chunk": pa.array([number] * len(parts), pa.int64()),
            "names": pa.array([keys[p].astype("<u4").tobytes() for _, p in parts], pa.binary()),
            "several": pa.array([np.packbits(several[p]).tobytes() for _, p in parts], pa.binary()),
            "places": pa.array([places[p].astype("<u4").tobytes() for _, p in parts], pa.binary()),
        })

    def count(rows: pa.Table) -> pa.Table:
        blocks = [np.frombuffer(b, "<u4") for b in rows["names"].to_pylist()]
        sizes = [len(b) for b in blocks]
        marks = [np.unpackbits(np.frombuffer(b, np.uint8), count=n) for b, n in zip(rows["several"].to_pylist(), sizes)]
        _, which, times = np.unique(np.concatenate(blocks), return_inverse=True, return_counts=True)
        shared = times > 1
        shared[which[np.concatenate(marks) > 0]] = True
        places = np.concatenate([np.frombuffer(b, "<u4") for b in rows["places"].to_pylist()])
        hot = np.bincount(which, weights=places) > often

        def answers(by_name: np.ndarray) -> pa.Array:
            blocks = np.split(by_name[which], np.cumsum(sizes)[:-1])
            return pa.array([np.packbits(b).tobytes() for b in blocks], pa.binary())

        return pa.table(
            {"chunk": rows["chunk"], "shard": rows["shard"], "shared": answers(shared), "hot": answers(hot)}
        )

    sent = texts.groupBy("chunk").applyInArrow(
        send, "shard bigint, chunk bigint, names binary, several binary, places binary"
    )
    return sent.groupBy("shard").applyInArrow(count, "chunk bigint, shard bigint, shared binary, hot binary")


def _named(texts: DataFrame, size: int, shards: int, often: int) -> DataFrame:
    """Anchors whose string is shared, with the names of string and context. For those whose
    string is at more than ``often`` places, the strings of ``size`` bytes around them instead,
    with two names and ``stop``. And regions that stand in an earlier document of the same
    chunk, with ``stop`` and a null ``order``."""
    reach = size - GRAM
    schema = pa.schema([
        ("gram", pa.int64()), ("name", pa.int64()), ("order", pa.int64()), ("doc", pa.int64()),
        ("at", pa.int32()), ("stop", pa.int32()),
    ])

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left) or not len(right):
            return schema.empty_table()
        texts = Texts(left["text"].combine_chunks())
        order, doc = left["order"].to_numpy(), left["doc"].to_numpy()
        at, gram, of = _grams(texts, size)
        keys, which = np.unique(_keys(gram, shards), return_inverse=True)

        def answers(column: str) -> np.ndarray:
            answer = dict(zip(right["shard"].to_pylist(), right[column].to_pylist()))
            return np.concatenate([
                np.unpackbits(np.frombuffer(answer[s], np.uint8), count=p.stop - p.start) for s, p in _by_shard(keys)
            ])

        some = np.nonzero(answers("shared")[which])[0]
        hot = answers("hot")[which[some]] > 0
        at, gram, of = at[some], gram[some], of[some]
        width = -(-(reach + size + 2) // 8) * 8
        names = [np.zeros(0, np.uint64)]
        for a in range(0, len(at), CONTEXTS):
            before_bytes, before, after_bytes, after = texts.contexts(of[a:a + CONTEXTS], at[a:a + CONTEXTS], reach, size)
            row = np.zeros((len(before), width), dtype=np.uint8)
            row[:, :reach], row[:, reach:reach + size] = before_bytes, after_bytes
            row[:, -2], row[:, -1] = before, after
            names.append(_mixed(list(row.view("<u8").T)))
        name = np.concatenate(names)
        # one that stands earlier in the chunk is decided
        sure = _earlier(gram, name, order[of])
        rest, often_there = np.nonzero(~sure & ~hot)[0], np.nonzero(~sure & hot)[0]
        w_of, w_at, one, two = _strings(texts, of[often_there], at[often_there], reach, size)
        w_sure = _earlier(one, two, order[w_of])
        w = np.nonzero(~w_sure)[0]
        length = texts.ends - texts.starts
        local, w_local = at - texts.starts[of], w_at - texts.starts[w_of]
        r_of, r_start, r_stop = _regions(
            np.concatenate([of[sure], w_of[w_sure]]),
            np.concatenate([np.maximum(local[sure] - reach, 0), w_local[w_sure]]),
            np.concatenate([np.minimum(local[sure] + size, length[of[sure]]), w_local[w_sure] + size]),
        )
        all_of = np.concatenate([of[rest], w_of[w], r_of])
        row = np.arange(len(all_of))
        stop = np.concatenate([np.zeros(len(rest), np.int64), w_local[w] + size, r_stop])
        return pa.table(
            [
                pa.array(np.concatenate([gram[rest].view(np.int64), one[w].view(np.int64), doc[r_of]])),
                pa.array(np.concatenate([name[rest].view(np.int64), two[w].view(np.int64), doc[r_of]])),
                pa.array(order[all_of], mask=row >= len(rest) + len(w)), pa.array(doc[all_of]),
                pa.array(np.concatenate([local[rest], w_local[w], r_start]).astype(np.int32)),
                pa.array(stop.astype(np.int32), mask=row < len(rest)),
            ],
            schema=schema,
        )

    return texts.groupBy("chunk").cogroup(_shared(texts, size, shards, often).groupBy("chunk")).applyInArrow(
        work, "gram bigint, name bigint, order bigint, doc bigint, at int, stop int"
    )


def _judged(named: DataFrame) -> DataFrame:
    """What matters: regions, strings that stand in an earlier document, ``sure`` anchors, whose
    context stands in one, and the first of each context whose string has others."""
    by_name, by_gram = Window.partitionBy("gram", "name"), Window.partitionBy("gram")
    rows = (
        named.repartition("gram")
        .withColumn("first", F.min("order").over(by_name))
        .withColumn("least", F.min("order").over(by_gram))
        .withColumn("most", F.max("order").over(by_gram))
        .withColumn("several", F.min("name").over(by_gram) != F.max("name").over(by_gram))
        .withColumn("sure", F.coalesce(F.col("first") < F.col("order"), F.lit(False)))
    )
    matter = F.when(F.col("stop").isNotNull(), F.col("sure") | F.col("order").isNull()).otherwise(
        (F.col("least") < F.col("most")) & (F.col("sure") | F.col("several"))
    )
    open_ = ~F.col("sure") & F.col("stop").isNull()  # only these are named again
    return rows.filter(matter).select(
        F.when(open_, F.col("gram")).alias("gram"), F.when(open_, F.col("order")).alias("order"),
        "doc", "at", "stop", "sure",
    )


def remove_repeats(
    docs: DataFrame, *, id: str = "doc_id", text: str = "text", size: int = 50, often: int = OFTEN
) -> DataFrame:
    """What is left of every text without the strings of ``size`` bytes that also start in a
    document of a smaller id.

    Texts are UTF-8 bytes; each byte that such a string covers goes, judged on the input.
    Matches never cross documents. Returns one row per row of ``docs``: the id, ``n_bytes``,
    ``n_removed``, ``n_spans`` (runs of removed bytes), ``kept_sha256``, and ``spans``, the runs
    as (start, stop). Anchors' strings at more than ``often`` places are not sorted but named.

    A null text is an empty one. A null id is larger than any other; rows of equal ids, null
    ones too, are not earlier than one another. Texts shorter than ``size`` stay whole. An
    empty table gives no rows. Ids are whole numbers. ``size`` is from 21 to 255, as lengths
    are kept in a byte.
    """
    if not GRAM < size < 256:
        raise ValueError(f"size must be from {GRAM + 1} to 255, not {size}")
    reach = size - GRAM
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    chunks = max(1, -(-total // CHUNK))
    # what tells documents apart: the id, or a hash with the text where ids repeat or lack
    alone = docs.groupBy(F.col(id).cast("long").alias("id")).count().filter("count > 1 or id is null").isEmpty()
    rows = docs.select(
        F.col(id).alias("id"), (F.col(id).cast("long") if alone else F.xxhash64(id, text)).alias("doc"),
        F.coalesce(F.col(id).cast("long"), F.lit(_LAST)).alias("order"),
        F.col(text).cast("string").alias("text"),
    )
    chunk = F.pmod(F.xxhash64("doc"), F.lit(chunks)).alias("chunk")
    texts = rows.select(chunk, "id", "doc", "order", "text")
    judged = _judged(_named(texts, size, chunks, often)).select(chunk, "*")

    def contexts(left: pa.Table, right: pa.Table) -> pa.Table:
        """Regions of the chunk's documents, and the contexts that are to be sorted."""
        schema = pa.schema([
            ("shard", pa.int64()), ("doc", pa.int64()), ("order", pa.int64()), ("at", pa.int32()),
            ("stop", pa.int32()), ("context", pa.binary()),
        ])
        if not len(left) or not len(right):
            return schema.empty_table()
        docs_here, one = np.unique(left["doc"].to_numpy(), return_index=True)
        own = Texts(left["text"].combine_chunks())
        doc, at = right["doc"].to_numpy(), right["at"].to_numpy().astype(np.int64)
        of = one[np.searchsorted(docs_here, doc)]
        stop = right["stop"].to_numpy(zero_copy_only=False)
        region = ~np.isnan(stop.astype(np.float64))
        sure = right["sure"].to_numpy(zero_copy_only=False).astype(bool) & ~region
        length = own.ends[of] - own.starts[of]
        begin = np.where(region, at, np.maximum(at - reach, 0))
        finish = np.where(region, np.nan_to_num(stop.astype(np.float64)), np.minimum(at + size, length)).astype(np.int64)
        some = np.nonzero(region | sure)[0]
        r_of, r_start, r_stop = _regions(of[some], begin[some], finish[some])
        all_docs = left["doc"].to_numpy()
        tables = [pa.table(
            [
                pa.array(all_docs[r_of]), pa.array(all_docs[r_of]), pa.array(np.zeros(len(r_of), np.int64)),
                pa.array(r_start.astype(np.int32)), pa.array(r_stop.astype(np.int32)),
                pa.nulls(len(r_of), pa.binary()),
            ],
            schema=schema,
        )]
        rest = np.nonzero(~region & ~sure)[0]
        gram, order = (right[c].fill_null(0).to_numpy() for c in ("gram", "order"))
        for a in range(0, len(rest), CONTEXTS):
            some = rest[a:a + CONTEXTS]
            before_bytes, before, after_bytes, after = own.contexts(
                of[some], own.starts[of[some]] + at[some], reach, size
            )
            body = np.hstack([
                after_bytes, after[:, None].astype(np.uint8), before_bytes, before[:, None].astype(np.uint8)
            ])
            offsets = np.arange(0, (len(some) + 1) * body.shape[1], body.shape[1], dtype=np.int32)
            packed = pa.BinaryArray.from_buffers(
                pa.binary(), len(some), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(body))]
            )
            tables.append(pa.table(
                [
                    pa.array(gram[some]), pa.array(doc[some]), pa.array(order[some]),
                    pa.array(at[some].astype(np.int32)), pa.nulls(len(some), pa.int32()), packed,
                ],
                schema=schema,
            ))
        return pa.concat_tables(tables)

    dealt = texts.groupBy("chunk").cogroup(judged.groupBy("chunk")).applyInArrow(
        contexts, "shard bigint, doc bigint, order bigint, at int, stop int, context binary"
    )

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Regions pass; contexts become regions where a string of an earlier document is."""
        kind = context_kind(reach, size)
        place = np.dtype([("doc", np.int64), ("at", np.int32)])
        names = ["doc", "at", "stop"]
        number = 0
        with tempfile.TemporaryFile() as places:
            for_later = []  # regions come first to last with the contexts; they are few

            def read() -> Iterator[np.ndarray]:
                nonlocal number
                for batch in batches:
                    body = batch.column("context")
                    is_region = np.asarray(body.is_null())
                    if is_region.any():
                        for_later.append(batch.select(names).filter(pa.array(is_region)))
                    if is_region.all():
                        continue
                    some = batch.filter(pa.array(~is_region))
                    width = size + reach + 2
                    flat = np.frombuffer(b"".join(some.column("context").to_pylist()), np.uint8).reshape(-1, width)
                    out = np.empty(len(flat), dtype=kind)
                    out["right"], out["after"] = flat[:, :size], flat[:, size]
                    out["left"], out["before"] = flat[:, size + 1:-1], flat[:, -1]
                    out["order"] = some.column("order").to_numpy()
                    out["number"] = np.arange(number, number + len(flat))
                    number += len(flat)
                    where = np.empty(len(flat), dtype=place)
                    where["doc"], where["at"] = some.column("doc").to_numpy(), some.column("at").to_numpy()
                    places.write(where.tobytes())
                    yield out

            found = np.zeros((0, reach // 64 + 1), dtype=np.uint64)  # 64 distances in a number
            for distance, numbers in earlier_windows(read(), size):
                if len(found) < number:
                    found = np.zeros((number, reach // 64 + 1), dtype=np.uint64)
                found[numbers, distance // 64] |= np.uint64(1) << np.uint64(distance % 64)
            yield from for_later
            places.seek(0)
            for at in range(0, len(found), CONTEXTS):
                own = found[at:at + CONTEXTS]
                where = np.frombuffer(places.read(len(own) * place.itemsize), dtype=place)
                # distances in a row are one region, from the farthest to the nearest
                each = np.arange(reach + 1)
                bits = (own[:, each // 64] >> (each % 64).astype(np.uint64)) & np.uint64(1) > 0
                side = np.zeros((len(own), 1), dtype=bool)
                row, near = np.nonzero(bits & ~np.hstack([side, bits[:, :-1]]))
                _, far = np.nonzero(bits & ~np.hstack([bits[:, 1:], side]))
                if len(row):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(where["doc"][row]), pa.array((where["at"][row] - far).astype(np.int32)),
                            pa.array((where["at"][row] - near + size).astype(np.int32)),
                        ],
                        names,
                    )

    regions = dealt.repartition("shard").mapInArrow(sort, "doc bigint, at int, stop int").select(chunk, "*")

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        own = Texts(left["text"].combine_chunks()) if len(left) else None
        doc = left["doc"].to_numpy()
        # rows of one document (equal id and text) all get its regions
        order = np.argsort(doc, kind="stable")
        r_doc = right["doc"].to_numpy()
        low, high = np.searchsorted(doc[order], r_doc, "left"), np.searchsorted(doc[order], r_doc, "right")
        which = np.repeat(np.arange(len(r_doc)), high - low)
        of = order[np.arange(len(which)) - np.repeat(np.cumsum(high - low) - (high - low), high - low) + low[which]]
        start = right["at"].to_numpy().astype(np.int64)[which]
        stop = right["stop"].to_numpy().astype(np.int64)[which]
        of, start, stop = _regions(of, start, stop)
        ends = np.searchsorted(of, np.arange(len(doc) + 1))
        removed, spans, digests = [], [], []
        for row in range(len(doc)):
            digest, at, gone, runs = hashlib.sha256(), int(own.starts[row]), 0, []
            for a, b in zip(start[ends[row]:ends[row + 1]].tolist(), stop[ends[row]:ends[row + 1]].tolist()):
                digest.update(own.data[at:int(own.starts[row]) + a])
                at = int(own.starts[row]) + b
                gone += b - a
                runs.append({"start": a, "stop": b})
            digest.update(own.data[at:int(own.ends[row])])
            removed.append(gone)
            spans.append(runs)
            digests.append(digest.hexdigest())
        return pa.table({
            "id": left["id"], "n_bytes": pa.array(own.ends - own.starts), "n_removed": pa.array(removed, pa.int64()),
            "n_spans": pa.array([len(s) for s in spans], pa.int64()), "kept_sha256": pa.array(digests, pa.string()),
            "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
        })

    kind = rows.schema["id"].dataType.simpleString()
    return texts.groupBy("chunk").cogroup(regions.groupBy("chunk")).applyInArrow(
        cut, f"id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, "
        "spans array<struct<start: bigint, stop: bigint>>",
    ).withColumnRenamed("id", id)
