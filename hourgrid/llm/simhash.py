"""SimHash fingerprints and the groups that small Hamming distances link.

Pairs are found with vantage points. A tree of vantage fingerprints and radii, built from a
bounded sample, deals all fingerprints into leaves: inside the radius or outside. By the
triangle inequality a fingerprint can be within d bits of one inside only if it is itself
within radius + d of the vantage, and of one outside only beyond radius - d. So those at
home inside, but beyond radius - d, also visit the leaves outside, as guests; a guest goes on
to every leaf that these bounds leave open. Those at home in a leaf are compared with each
other and with its guests, by the same rule inside the task. Whatever the sample, no pair is
lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import apart, components, dealt_join, forget, heavy_keys, stored

#: Fingerprints in the sample that the tree is built from, at most (512 KB).
SAMPLE = 65_536
#: Fingerprints at home in a leaf, about; with a full sample there are 4,096 leaves at most.
LEAF = 16_384
#: Fingerprints of a leaf that one task takes of either side (1 MB).
BLOCK = 131_072
#: Comparisons made at once.
AT_ONCE = 1 << 18
#: Hashes whose bits are counted at once.
HASHES = 1 << 16


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """The 64 bits set in over half of the shingles' hashes, as a signed number."""
    words = text.lower().split()  # bytes: A-Z only, ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1
    ends = np.cumsum(lengths)
    starts = ends - lengths
    width = min(shingle, len(words))
    counts = np.zeros(64, dtype=np.int64)
    number = len(words) - width + 1
    for at in range(0, number, HASHES):
        to = min(at + HASHES, number)
        pairs = zip(starts[at:to].tolist(), (ends[at + width - 1:to + width - 1] - 1).tolist())
        digest = xxhash.xxh64_intdigest
        hashes = np.array([digest(joined[a:b], 42) for a, b in pairs], dtype="<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
            axis=0, dtype=np.int64
        )
    return int(np.packbits(counts * 2 > number, bitorder="little").view("<i8")[0])


def simhash(docs: DataFrame, *, id: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """``id, body, fp`` for every row: the id, a hash of the text, the fingerprint. A null
    text is an empty one; without words the fingerprint is 0."""
    rows = docs.select(F.col(id).alias("id"), F.xxhash64(text).alias("body"), F.col(text).cast("string").alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            found = [fingerprint(t.as_py() or b"", shingle) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("body"), pa.array(found, pa.int64())], ["id", "body", "fp"]
            )

    return rows.mapInArrow(work, f"id {rows.schema['id'].dataType.simpleString()}, body bigint, fp bigint")


def distances(one: np.uint64, many: np.ndarray) -> np.ndarray:
    return np.bitwise_count(many ^ one).astype(np.int16)


def vantage_tree(sample: np.ndarray, depth: int) -> list[tuple[int, int, int, int]]:
    """Nodes (vantage, radius, inside, outside); children are node numbers, or, below zero,
    leaves: -1 is the first."""
    nodes: list = []
    leaves = 0

    def build(points: np.ndarray, depth: int) -> int:
        nonlocal leaves
        if depth > 0 and len(points) >= 16:
            tries = points[np.linspace(0, len(points) - 1, 8).astype(int)]
            vantage = max(tries, key=lambda p: float(distances(p, points).var()))
            far = distances(vantage, points)
            radius = int(np.median(far))
            inside = far <= radius
            if not inside.all():
                nodes.append(None)
                own = len(nodes) - 1
                nodes[own] = (
                    int(vantage), radius, build(points[inside], depth - 1), build(points[~inside], depth - 1)
                )
                return own
        leaves += 1
        return -leaves

    root = build(sample, depth)
    return nodes if root >= 0 else []


def visits(nodes: list, prints: np.ndarray, most: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For every leaf that any of ``prints`` visits: its number, which visit it, and which
    of those are at home there."""
    if not nodes:
        yield 0, np.arange(len(prints)), np.ones(len(prints), dtype=bool)
        return
    stack = [(0, np.arange(len(prints)), np.ones(len(prints), dtype=bool))]
    while stack:
        at, rows, home = stack.pop()
        if not len(rows):
            continue
        if at < 0:
            yield -at - 1, rows, home
            continue
        vantage, radius, inside, outside = nodes[at]
        far = distances(np.uint64(vantage), prints[rows])
        within = far <= radius
        take = np.where(home, within, far <= radius + most)
        stack.append((inside, rows[take], home[take]))
        take = far > radius - most
        stack.append((outside, rows[take], (home & ~within)[take]))


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same components with one link per node at most: to the smallest of its own."""
    nodes, both = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = both[: len(a)], both[len(a):]
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[a], label[b])
        new = label.copy()
        for at in (a, b, label[a], label[b]):
            np.minimum.at(new, at, least)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def close_pairs(
    home: np.ndarray, guests: np.ndarray, most: int, among: bool
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs at ``most`` bits or fewer of a guest and one at home, and, with ``among``, of two
    at home: by vantage points, then one by one."""
    stack = [(home, guests)]
    while stack:
        home, guests = stack.pop()
        if not len(home) or not (among or len(guests)):
            continue
        if len(home) > 512:
            vantage = home[len(home) // 2]
            far = distances(vantage, home)
            radius = int(np.median(far))
            inside = far <= radius
            if not inside.all():
                seen = distances(vantage, guests)
                over = [guests[seen > radius - most]]
                if among:
                    over.append(home[inside & (far > radius - most)])
                stack.append((home[inside], guests[seen <= radius + most]))
                stack.append((home[~inside], np.concatenate(over)))
                continue
        against = np.concatenate([home, guests]) if among else guests
        step = max(1, AT_ONCE // len(home))
        for at in range(0, len(against), step):
            some = against[at:at + step]
            near = np.bitwise_count(some[:, None] ^ home[None, :]) <= most
            guest, host = np.divmod(np.flatnonzero(near), len(home))
            apart = some[guest] != home[host]
            if apart.any():
                yield some[guest[apart]], home[host[apart]]


def _block(prints: np.ndarray, blocks: int) -> np.ndarray:
    return ((prints * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)) % np.uint64(blocks)


def near_fingerprints(prints: DataFrame, most: int) -> DataFrame:
    """Links ``u, v`` between the distinct fingerprints ``fp``: enough of those at ``most``
    bits or fewer to join the same ones as all would."""
    spark = prints.sparkSession
    number = prints.count()
    leaves = max(1, -(-number // LEAF))
    chosen = prints.orderBy(F.xxhash64("fp")).limit(min(SAMPLE, 64 * leaves)).collect() if leaves > 1 else []
    sample = np.array([row.fp for row in chosen], dtype=np.int64).view(np.uint64)
    tree = vantage_tree(sample, (leaves - 1).bit_length())

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            found = [
                (leaf, int((~home).sum()), int(home.sum())) for leaf, rows, home in visits(tree, values, most)
            ]
            if found:
                leaf, guests, homes = zip(*found)
                yield pa.RecordBatch.from_pydict({"leaf": leaf, "guests": guests, "homes": homes})

    totals = (
        prints.mapInArrow(sizes, "leaf bigint, guests bigint, homes bigint")
        .groupBy("leaf").agg(F.sum("guests").alias("guests"), F.sum("homes").alias("homes")).collect()
    )  # one row per leaf of the tree
    blocks = {}  # of guests and of homes; homes of more than one block are guests of each other
    for r in totals:
        homes = max(1, -(-r.homes // BLOCK))
        blocks[r.leaf] = max(1, -(-(r.guests + r.homes * (homes > 1)) // BLOCK)), homes

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            for leaf, rows, home in visits(tree, values, most):
                own = values[rows]
                of_guests, of_homes = blocks[leaf]
                guest, host = _block(own, of_guests), _block(own, of_homes)
                for g in range(of_guests):
                    for h in range(of_homes):
                        one = (guest == g) if of_homes > 1 else ~home & (guest == g)
                        other = home & (host == h)
                        take = one | other
                        if take.any():
                            kind = one[take] + (6 if of_homes == 1 and g == 0 else 2) * other[take]
                            yield pa.RecordBatch.from_pydict({
                                "leaf": pa.array(np.full(take.sum(), (leaf * of_guests + g) * of_homes + h)),
                                "part": pa.array(np.full(take.sum(), leaf)),
                                "fp": pa.array(own[take].view(np.int64)),
                                "kind": pa.array(kind.astype(np.int64)),  # 1 guest, 2 home, 4 compare homes
                            })

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        values = rows["fp"].to_numpy().astype(np.int64).view(np.uint64)
        kind = rows["kind"].to_numpy()
        u, v, held = [], [], 0
        home, guests = np.sort(values[kind & 2 > 0]), np.sort(values[kind & 1 > 0])
        for a, b in close_pairs(home, guests, most, bool((kind & 4).any())):
            u.append(a.view(np.int64))
            v.append(b.view(np.int64))
            held += len(a)
            if held > 4 * AT_ONCE:
                a, b = forest(np.concatenate(u), np.concatenate(v))
                u, v, held = [a], [b], 0
        if u:
            a, b = forest(np.concatenate(u), np.concatenate(v))
            return pd.DataFrame({"u": a, "v": b})
        return pd.DataFrame({"u": np.array([], np.int64), "v": np.array([], np.int64)})

    dealt = prints.mapInArrow(deal, "leaf bigint, part bigint, fp bigint, kind bigint")
    return dealt.groupBy("part", "leaf").applyInPandas(compare, "u bigint, v bigint")


def _classes(docs: DataFrame, id: str, text: str, shingle: int, most: int) -> tuple[DataFrame, DataFrame]:
    """Rows ``id, body, fp``; and for each fingerprint ``n``, its rows, and ``least``: of its
    component, the smallest (id, null last; body)."""
    rows = stored(simhash(docs, id=id, text=text, shingle=shingle))
    least = F.struct(F.col("id").isNull().alias("none"), "id", "body")
    prints = stored(rows.groupBy("fp").agg(F.min(least).alias("least"), F.count("*").alias("n")))
    found = components(near_fingerprints(prints.select("fp"), most))
    rooted = prints.join(found, F.col("fp") == F.col("node"), "left").select(
        "fp", "n", "least", F.coalesce("root", "fp").alias("root")
    )
    roots = stored(rooted.groupBy("root").agg(F.min("least").alias("least"), F.count("*").alias("prints")))
    heavy = heavy_keys(roots, "root", "prints")
    classes = dealt_join(rooted.drop("least"), roots.drop("prints"), heavy, "root", F.xxhash64("fp"))
    return rows, stored(classes.select("fp", "n", "least"))


def simhash_groups(
    docs: DataFrame, *, id: str = "doc_id", text: str = "text", shingle: int = 3, most: int = 3
) -> DataFrame:
    """Fingerprint and component of every row of ``docs``.

    Words are runs of anything but ASCII white space, A-Z lower-cased; shingles of
    ``shingle`` words, repeats included, are hashed (XXH64, seed 42); a text of fewer words
    is one shingle, one without words has fingerprint 0. Fingerprints at ``most`` bits or
    fewer are linked. Returns the id, ``fingerprint`` (16 hexadecimal digits) and
    ``component_id``, the smallest id that links reach.

    A null text is an empty one; equal fingerprints are one node, however many rows have
    them; null ids come last, and a component of null ids alone has a null ``component_id``.
    An empty table gives no rows.
    """
    rows, classes = _classes(docs, id, text, shingle, most)
    heavy = heavy_keys(classes, "fp", "n")  # of many copies
    return dealt_join(rows, classes.drop("n"), heavy, "fp", F.xxhash64("id", "body")).select(
        F.col("id").alias(id), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("least.id").alias("component_id"),
    )


def dedup_simhash(
    docs: DataFrame, *, id: str = "doc_id", text: str = "text", shingle: int = 3, most: int = 3
) -> DataFrame:
    """``docs`` with one document of each component: that of the smallest id. Rows that
    repeat its id and text stay once."""
    rows, classes = _classes(docs, id, text, shingle, most)
    of, least, body = apart(docs.columns, "of", "least", "body")
    keep = classes.select(F.col("least.id").alias(least), F.col("least.body").alias(body)).distinct()
    kept = docs.withColumn(of, F.xxhash64(text)).join(
        keep, F.col(id).eqNullSafe(F.col(least)) & (F.col(of) == F.col(body))
    )
    return kept.dropDuplicates([least, body]).select(*docs.columns)
