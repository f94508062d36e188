"""Sorting of suffixes by induction, on disk where they are too many.

A context is a place in a text with the bytes that stand before and after it. The suffixes
that begin at the places are sorted first, by distribution on one byte after another. The
order of those that begin one byte earlier follows from it: by that byte, then by the order
found, which a queue of first-in-first-out files, one for each byte, gives; and so on
backwards. With the order goes, for each suffix, the length of its common prefix with the
one before it: one more than the least such length since the last suffix of the same byte.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterable, Iterator

import numpy as np

#: Suffixes held in memory by a queue, or sorted there: about 50 MB of tuples.
HELD = 500_000
#: Suffixes handled at once.
BATCH = 131_072

Sorted = Iterator[tuple[np.ndarray, np.ndarray]]  # records, and their common prefixes


class Queue:
    """Records by a byte: pushed in any order, popped by byte and, for one byte, in the order
    they came. What exceeds ``HELD`` waits on disk, in the task's own temporary folder."""

    def __init__(self, kind: np.dtype):
        self.kind = kind
        self.parts: list[list[np.ndarray]] = [[] for _ in range(256)]
        self.files: dict = {}
        self.held = 0

    def push(self, keys: np.ndarray, records: np.ndarray) -> None:
        order = np.argsort(keys, kind="stable")
        ends = np.searchsorted(keys[order], np.arange(257))
        for key in np.nonzero(np.diff(ends))[0]:
            self.parts[key].append(records[order[ends[key]:ends[key + 1]]])
        self.held += len(records)
        if self.held > HELD:
            for key in range(256):
                parts, self.parts[key] = self.parts[key], []
                if parts and key not in self.files:
                    self.files[key] = tempfile.TemporaryFile()
                for part in parts:
                    self.files[key].write(part.tobytes())
            self.held = 0

    def pop(self, key: int) -> Iterator[np.ndarray]:
        file = self.files.pop(key, None)
        if file is not None:
            with file:
                file.seek(0)
                while data := file.read(BATCH * self.kind.itemsize):
                    yield np.frombuffer(data, dtype=self.kind)
        parts, self.parts[key] = self.parts[key], []
        yield from parts

    def keys(self) -> list[int]:
        return [key for key in range(256) if self.parts[key] or key in self.files]


def distribution_sort(batches: Iterable[np.ndarray], field: str, tie: str, depth: int = 0) -> Iterator[np.ndarray]:
    """Records by the bytes of ``field``, then by ``tie``, a number under 256. What fits is
    sorted in memory, the rest is dealt by its next byte and sorted bucket by bucket."""
    held, size, batches = [], 0, iter(batches)
    for batch in batches:
        held.append(batch)
        size += len(batch)
        if size > HELD:
            break
    if not held:
        return
    width = held[0].dtype[field].shape[0]
    if size <= HELD:
        rows = np.concatenate(held)
        padded = np.zeros((len(rows), -(-width // 8) * 8), dtype=np.uint8)
        padded[:, :width] = rows[field]
        words = padded.view(">u8").astype(np.uint64)
        rows = rows[np.lexsort([rows[tie], *words.T[::-1]])]
        for at in range(0, len(rows), BATCH):
            yield rows[at:at + BATCH]
        return

    def key(batch: np.ndarray) -> np.ndarray:
        return batch[field][:, depth] if depth < width else batch[tie]

    queue = Queue(held[0].dtype)
    while held:
        batch = held.pop(0)
        queue.push(key(batch), batch)
    for batch in batches:
        queue.push(key(batch), batch)
    for byte in queue.keys():
        if depth < width:
            yield from distribution_sort(queue.pop(byte), field, tie, depth + 1)
        else:  # equal in all bytes and in the tie
            yield from queue.pop(byte)


def with_prefixes(batches: Iterable[np.ndarray], field: str, limit: str) -> Sorted:
    """Sorted records with the common prefix of each and the one before it; ``limit`` says
    how many bytes of the field a record has."""
    last = None
    for rows in batches:
        own, most = rows[field], rows[limit].astype(np.int16)
        before, most_before = np.empty_like(own), np.empty_like(most)
        before[1:], most_before[1:] = own[:-1], most[:-1]
        before[0], most_before[0] = (own[0], 0) if last is None else last
        differ = own != before
        common = np.where(differ.any(axis=1), differ.argmax(axis=1), own.shape[1]).astype(np.int16)
        yield rows, np.minimum(np.minimum(common, most), most_before)
        last = own[-1].copy(), most[-1]


def induced(batches: Sorted, step: int, kind: np.dtype) -> Sorted:
    """The suffixes that begin one byte earlier, of those that have a byte there. ``left`` has
    the bytes before the place, nearest first, and ``before`` how many."""
    pair = np.dtype([("record", kind), ("common", np.int16)])
    queue = Queue(pair)
    none, far = -1, np.iinfo(np.int16).max
    least = np.full(256, none, dtype=np.int16)  # common prefix since the last of each byte
    for rows, common in batches:
        has = np.nonzero(rows["before"] > step)[0]
        byte = rows["left"][has, step]
        order = np.argsort(byte, kind="stable")
        ends = np.searchsorted(byte[order], np.arange(257))
        present = np.nonzero(np.diff(ends))[0]
        new = np.zeros(len(rows), dtype=np.int16)
        absent = least != none
        absent[present] = False
        least[absent] = np.minimum(least[absent], common.min())
        for key in present:
            at = has[order[ends[key]:ends[key + 1]]]
            if least[key] != none:
                new[at[0]] = min(least[key], common[: at[0] + 1].min()) + 1
            if len(at) > 1:
                new[at[1:]] = np.minimum.reduceat(common[: at[-1] + 1], at[:-1] + 1) + 1
            rest = common[at[-1] + 1:]
            least[key] = rest.min() if len(rest) else far
        pairs = np.empty(len(has), dtype=pair)
        pairs["record"], pairs["common"] = rows[has], new[has]
        queue.push(byte, pairs)
    for pairs in _in_batches(part for key in queue.keys() for part in queue.pop(key)):
        yield pairs["record"], pairs["common"]


def _in_batches(parts: Iterable[np.ndarray]) -> Iterator[np.ndarray]:
    """The same records in arrays of about ``BATCH``."""
    held, size = [], 0
    for part in parts:
        held.append(part)
        size += len(part)
        if size >= BATCH:
            yield np.concatenate(held)
            held, size = [], 0
    if held:
        yield np.concatenate(held)


def not_first(batches: Iterable[tuple[np.ndarray, np.ndarray]], size: int, found: list) -> Sorted:
    """Passes the suffixes on, and adds to ``found`` the numbers of those that share their
    first ``size`` bytes with one of a smaller ``order``."""
    orders, numbers = np.zeros(0, np.int64), np.zeros(0, np.int64)  # of the run that is open

    def close(starts: np.ndarray, orders: np.ndarray, numbers: np.ndarray) -> None:
        if len(starts):
            smallest = np.minimum.reduceat(orders, starts)
            sizes = np.diff(np.append(starts, len(orders)))
            later = orders > np.repeat(smallest, sizes)
            if later.any():
                found.append(numbers[later])

    for rows, common in batches:
        starts = np.nonzero(common < size)[0] + len(orders)
        orders = np.concatenate([orders, rows["order"]])
        numbers = np.concatenate([numbers, rows["number"]])
        if not len(orders):
            continue
        if not len(starts) or starts[0] > 0:
            starts = np.concatenate([[0], starts])
        last = starts[-1]
        close(starts[:-1], orders[:last], numbers[:last])
        orders, numbers = orders[last:], numbers[last:]
        yield rows, common
    if len(orders):
        close(np.array([0]), orders, numbers)


def earlier_windows(batches: Iterable[np.ndarray], size: int) -> Iterator[tuple[int, np.ndarray]]:
    """For contexts (`context_kind`), by distance before the place: the numbers of those whose
    ``size`` bytes from there also stand in a context of a smaller ``order``."""
    batches = iter(batches)
    first = next(batches, None)
    if first is None:
        return
    reach = first.dtype["left"].shape[0]
    kind = np.dtype([(name, first.dtype[name]) for name in ("left", "before", "order", "number")])

    def all_batches() -> Iterator[np.ndarray]:
        yield first
        yield from batches

    def slim(stream: Sorted) -> Sorted:
        for rows, common in stream:
            out = np.empty(len(rows), dtype=kind)
            for name in kind.names:
                out[name] = rows[name]
            yield out, common

    stream = slim(with_prefixes(distribution_sort(all_batches(), "right", "after"), "right", "after"))
    for distance in range(reach + 1):
        found: list[np.ndarray] = []
        stream = not_first(stream, size, found)
        if distance < reach:
            stream = induced_now(stream, distance, kind)
        else:
            for _ in stream:
                pass
        if found:
            yield distance, np.concatenate(found)


def induced_now(stream: Sorted, step: int, kind: np.dtype) -> Sorted:
    """`induced`, with the whole of ``stream`` read at once: a queue must be full before it
    gives anything back."""
    out = induced(stream, step, kind)
    head = next(out, None)

    def rest() -> Sorted:
        if head is not None:
            yield head
            yield from out

    return rest()


def context_kind(reach: int, size: int) -> np.dtype:
    return np.dtype([
        ("right", np.uint8, (size,)), ("after", np.uint8), ("left", np.uint8, (reach,)),
        ("before", np.uint8), ("order", np.int64), ("number", np.int64),
    ])
