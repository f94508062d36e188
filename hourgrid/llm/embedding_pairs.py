"""Near-duplicate vectors by a subspace pigeonhole join.

Unit vectors are rotated and cut into blocks of few dimensions. If two are within squared
distance D, some block of theirs is within its share of D by dimensions. Each block is
range-joined under its share: a k-d tree over all its coordinates cuts it into cells, which are
the join keys, and who is within range of a cut is a guest beyond it. Tasks cut their cells
further in the same way. Candidates are verified by exact cosine. A pair is counted in the
first of the blocks that can find it, so once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, stored
from .simhash import forest
from .vectors import cosines, matrix, norms, usable

#: Dimensions of a block.
WIDTH = 8
#: Vectors of a cell that one task takes of either side (at 64 dimensions 32 MB).
PART = 65_536
#: About so many vectors, taken by a hash, place the cuts of the cells; all vectors are dealt.
#: A cell with fewer of them is not cut.
SAMPLE, LEAST = 10_000, 32
#: Vectors of a cell within a task, about, and the share of those below a cut that may be in
#: range of it: a cut in range of nearly all saves nothing.
LEAF, WORTH = 512, 0.95
#: Rows and columns compared at once.
ROWS, COLUMNS = 256, 2_048
#: Pairs verified at once.
VERIFY = 50_000
#: Slack, far above the error of single (candidates) and double (blocks) precision.
LOOSE, SLACK = 1e-5, 1e-9
SEED = 11


def grown(rows: np.ndarray, reach: float, most: float, least: int = 2) -> list[tuple[int, float, int, int] | None]:
    """A k-d tree over ``rows``, cut at medians down to cells of ``most`` rows: by node the
    coordinate, the cut, the nodes below and from it on, or None where the node is a cell.
    Each cut is along the coordinate in which the fewest rows below are in reach of it; a
    node with fewer than ``least`` rows, or no cut worth it, is a cell of any size."""
    nodes: list[tuple[int, float, int, int] | None] = []

    def add(some: np.ndarray) -> int:
        number = len(nodes)
        nodes.append(None)
        if len(some) > most and len(some) >= least:
            cuts = np.median(some, axis=0)
            below = some < cuts
            lows = below.sum(axis=0)
            waste = (below & (some >= cuts - reach)).sum(axis=0) / np.maximum(lows, 1)
            waste[(lows < len(some) / 4)] = 1  # many equal coordinates
            best = int(waste.argmin())
            if waste[best] < WORTH:
                low = below[:, best]
                nodes[number] = best, float(cuts[best]), add(some[low]), add(some[~low])
        return number

    add(rows)
    return nodes


def cells(
    nodes: list[tuple[int, float, int, int] | None], rows: np.ndarray, reach: float,
    home: np.ndarray, guests: np.ndarray, among: bool = True,
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """By cell the numbers of the ``rows`` that are at home in it and of its guests.

    A row is at home in one cell. Two rows at home on different sides of a cut meet on the
    upper side, where the lower one is a guest if in reach; guests go to each side that they
    reach. So two rows within reach in every coordinate meet in exactly one cell, one of
    them at home. Without ``among``, rows at home are no guests of each other."""
    stack = [(0, home, guests)]
    while stack:
        number, home, guests = stack.pop()
        if nodes[number] is None:
            yield number, home, guests
            continue
        coordinate, cut, low, high = nodes[number]
        at, of = rows[home, coordinate], rows[guests, coordinate]
        up = guests[of >= cut - reach]
        if among:
            up = np.concatenate([up, home[(at < cut) & (at >= cut - reach)]])
        stack.append((low, home[at < cut], guests[of < cut + reach]))
        stack.append((high, home[at >= cut], up))


class Blocks:
    """Rotation and blocks for vectors of ``dim`` dimensions within squared distance ``most``
    as unit vectors."""

    def __init__(self, dim: int, most: float):
        random = np.random.default_rng([SEED, dim])
        self.rotation = np.linalg.qr(random.standard_normal((dim, dim)))[0]
        self.cuts = [(a, min(a + WIDTH, dim)) for a in range(0, dim, WIDTH)]
        self.budgets = np.array([most * (b - a) / dim for a, b in self.cuts])
        self.reach = np.sqrt(self.budgets) + 1e-6

    def rotated(self, rows: np.ndarray) -> np.ndarray:
        # einsum sums each number alike wherever a row stands, so all tasks agree on blocks
        return np.einsum("ij,jk->ik", rows / norms(rows)[:, None], self.rotation)

    def first_close(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """The first block within its budget, by pair."""
        square = (x - y) ** 2
        own = np.stack([np.einsum("ij->i", square[:, a:b]) for a, b in self.cuts], axis=1)
        return (own <= self.budgets + SLACK).argmax(axis=1)

    def candidates(
        self, home: np.ndarray, guests: np.ndarray, block: int, among: bool
    ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs in the block's budget, as places in ``home`` followed by ``guests``: of one at
        home with a guest, or with ``among`` with another one at home."""
        a, b = self.cuts[block]
        # (-2x, |x|^2, 1) . (y, 1, |y|^2) = |x - y|^2
        def left(rows):
            x = rows[:, a:b].astype(np.float32)
            square = (x * x).sum(axis=1)[:, None]
            return np.hstack([-2 * x, square, np.ones_like(square)])

        def right(rows):
            x = rows[:, a:b].astype(np.float32)
            square = (x * x).sum(axis=1)[:, None]
            return np.hstack([x, np.ones_like(square), square])

        rows, bound = np.concatenate([home, guests]), np.float32(self.budgets[block] + LOOSE)
        tree = grown(home[:, a:b], self.reach[block], LEAF)
        some = np.arange(len(home)), np.arange(len(home), len(rows))
        for _, own, visits in cells(tree, rows[:, a:b], self.reach[block], *some, among):
            hosts = left(rows[own])
            for of, same in ((own, True), (visits, False)):
                if same and not among:
                    continue
                others = right(rows[of])
                for i in range(0, len(hosts), ROWS):
                    for j in range(i if same else 0, len(others), COLUMNS):
                        near = hosts[i:i + ROWS] @ others[j:j + COLUMNS].T <= bound
                        host, other = np.divmod(np.flatnonzero(near), near.shape[1])
                        host, other = host + i, other + j
                        if same:
                            later = other > host
                            host, other = host[later], other[later]
                        for at in range(0, len(host), VERIFY):
                            yield own[host[at:at + VERIFY]], of[other[at:at + VERIFY]]


def link_vectors(
    vectors: DataFrame, *, id: str = "vec_id", vector: str = "embedding", least: float = 0.9
) -> DataFrame:
    """Links between rows of cosine ``least`` or more, in double precision.

    Returns one row per row: the id, ``n_links`` (rows linked directly), ``component_id`` (the
    smallest id that links reach, its own included) and ``kept`` (id = component_id). All
    links count. Equal vectors are one class, which is compared once and counts as often
    as it has rows.

    Vectors that are null, zero, or hold null or non-finite components link with nothing;
    neither do those of different lengths. A null id is never smallest; a component of null
    ids alone has a null ``component_id``, and such rows are not ``kept``. Rows that repeat an
    id are rows of their own. An empty table gives no rows.
    """
    rows = vectors.select(F.col(id).alias("id"), F.when(usable(vector), F.col(vector)).alias("v"))
    part = rows.filter(F.col("v").isNotNull())
    classes = stored(
        stored(part.groupBy("v").agg(F.count("*").alias("copies"), F.min("id").alias("smallest")))
        .withColumn("node", F.monotonically_increasing_id())  # of stored rows, which keep their places
        .withColumn("dim", F.size("v"))
    )
    most = 2 - 2 * least
    nodes = classes.select("node", "copies", "dim", F.col("v").cast("array<double>").alias("v"))

    # a tree for each length of vector and block; its cuts only say which task compares what
    sizes_of = {r.dim: r.n for r in nodes.groupBy("dim").agg(F.count("*").alias("n")).collect()}
    every = max(1, sum(sizes_of.values()) // SAMPLE)
    trees = {}
    for dim, size in sizes_of.items():
        blocks = Blocks(dim, most)
        sample = np.zeros((0, dim))
        if size > PART:
            taken = nodes.filter((F.col("dim") == dim) & (F.pmod(F.xxhash64("node"), F.lit(every)) == 0))
            sample = blocks.rotated(matrix(taken.select("v").toPandas()["v"]).reshape(-1, dim))
        for block, (a, b) in enumerate(blocks.cuts):
            trees[dim, block] = grown(sample[:, a:b], blocks.reach[block], PART * len(sample) / size, LEAST)

    def placed(batch: pa.RecordBatch) -> Iterator[tuple[int, int, int, np.ndarray, np.ndarray]]:
        """For each length of vector, block and cell the rows at home there and the guests."""
        dims = batch.column("dim").to_numpy(zero_copy_only=False)
        lists = batch.column("v")
        for dim in np.unique(dims):
            at = np.nonzero(dims == dim)[0]
            blocks = Blocks(int(dim), most)
            turned = blocks.rotated(matrix(pd.Series(lists.take(pa.array(at)).to_pylist())))
            for block, (a, b) in enumerate(blocks.cuts):
                tree, all_rows = trees[int(dim), block], np.arange(len(at))
                for cell, home, guests in cells(tree, turned[:, a:b], blocks.reach[block], all_rows, all_rows[:0]):
                    if len(home) or len(guests):
                        yield int(dim), block, cell, at[home], at[guests]

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [(dim, block, cell, len(home), len(guests)) for dim, block, cell, home, guests in placed(batch)]
            if out:
                dim, block, cell, homes, guests = zip(*out)
                yield pa.RecordBatch.from_pydict(
                    {"dim": dim, "block": block, "cell": cell, "homes": homes, "guests": guests}
                )

    # one row per block and cell, of which the sample bounds the number
    parts = {}
    totals = nodes.mapInArrow(sizes, "dim bigint, block bigint, cell bigint, homes bigint, guests bigint")
    for r in totals.groupBy("dim", "block", "cell").agg(
        F.sum("homes").alias("homes"), F.sum("guests").alias("guests")
    ).collect():
        homes = max(1, -(-r.homes // PART))
        parts[r.dim, r.block, r.cell] = homes, max(1, -(-(r.guests + r.homes * (homes > 1)) // PART))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number = batch.column("node").to_numpy(zero_copy_only=False)
            mixed = (number * 0x9E3779B1 >> 7) & 0xFFFFFF
            for dim, block, cell, home, guests in placed(batch):
                of_homes, of_guests = parts[dim, block, cell]
                at = np.concatenate([home, guests])
                own = np.arange(len(at)) < len(home)
                visits = ~own | (of_homes > 1)
                for h in range(of_homes):
                    for g in range(of_guests):
                        hosts = own & (mixed[at] % of_homes == h)
                        others = visits & (mixed[at] // 64 % of_guests == g)
                        take = hosts | others
                        if take.any():
                            # 1 guest, 2 host, 4 compare hosts, 8 a guest that is at home here
                            kind = others[take] + (6 if of_homes == 1 and g == 0 else 2) * hosts[take]
                            kind = kind + 8 * (others & own)[take]
                            some = batch.take(pa.array(at[take]))
                            place = (cell * of_homes + h) * of_guests + g
                            yield pa.RecordBatch.from_arrays(
                                [
                                    *some.columns, pa.array(np.full(len(kind), block)),
                                    pa.array(np.full(len(kind), cell)),
                                    pa.array(np.full(len(kind), place)), pa.array(kind.astype(np.int64)),
                                ],
                                [*some.schema.names, "block", "cell", "place", "kind"],
                            )

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        kind, copies, node = (rows[c].to_numpy() for c in ("kind", "copies", "node"))
        block = int(rows["block"].iloc[0])
        order = np.concatenate([np.nonzero(kind & 2)[0], np.nonzero(kind & 1)[0]])
        hosts = int((kind & 2 > 0).sum())
        own = matrix(rows["v"])
        blocks = Blocks(own.shape[1], most)
        turned = blocks.rotated(own)
        links = np.zeros(len(rows), dtype=np.int64)
        u, v, held = [], [], 0
        among = bool((kind & 4).any())
        for a, b in blocks.candidates(turned[order[:hosts]], turned[order[hosts:]], block, among):
            a, b = order[a], order[b]
            # where those at home are guests of each other, a pair meets twice: once counts
            good = (kind[b] & 8 == 0) | (node[a] < node[b])
            good &= cosines(own[a], own[b]) >= least
            a, b = a[good], b[good]
            good = (blocks.first_close(turned[a], turned[b]) == block) & (node[a] != node[b])
            a, b = a[good], b[good]
            links += np.bincount(a, weights=copies[b], minlength=len(rows)).astype(np.int64)
            links += np.bincount(b, weights=copies[a], minlength=len(rows)).astype(np.int64)
            u.append(node[a])
            v.append(node[b])
            held += len(a)
            if held > 1_000_000:
                a, b = forest(np.concatenate(u), np.concatenate(v))
                u, v, held = [a], [b], 0
        linked = np.nonzero(links)[0]
        if not len(linked):
            return pd.DataFrame({"node": [], "links": [], "root": []})
        small, root = forest(np.concatenate(u), np.concatenate(v))
        roots = pd.Series(root, index=small)
        found = node[linked]
        return pd.DataFrame({"node": found, "links": links[linked], "root": roots.reindex(found, fill_value=-1).to_numpy()})

    dealt = nodes.mapInArrow(
        deal, "node bigint, copies bigint, dim int, v array<double>, block bigint, cell bigint, place bigint, kind bigint"
    )
    found = stored(
        dealt.groupBy("dim", "block", "cell", "place")
        .applyInPandas(compare, "node bigint, links bigint, root bigint")
    )
    roots = components(found.filter("root >= 0").select("node", "root"))
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    rooted = (
        classes.select("node", "copies", "smallest")
        .join(counts, "node", "left").join(roots, "node", "left")
        .select("node", "smallest", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links"),
                F.coalesce("root", "node").alias("root"))
    )
    least_ids = rooted.groupBy("root").agg(F.min("smallest").alias("component"))
    answer = stored(
        rooted.join(least_ids, "root").select("node", "links", "component")
        .join(classes.select("node", "v"), "node")
    ).select(F.col("v").alias("class"), "links", "component")
    return rows.join(answer, F.col("v") == F.col("class"), "left").select(
        F.col("id").alias(id), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("class").isNull(), F.col("id")).otherwise(F.col("component")).alias("component_id"),
        F.coalesce(F.col("id") == F.when(F.col("class").isNull(), F.col("id")).otherwise(F.col("component")),
                   F.lit(False)).alias("kept"),
    )
