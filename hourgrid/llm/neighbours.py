"""Approximate nearest neighbours by multiprobe p-stable hashing.

Each table keeps all rows of the index by buckets, the slots of all its functions. The first
functions alone make cells, of a few thousand rows each; a cell is what a task holds. A query
goes through two rounds. In the first it meets its own cell of each table and visits the
buckets of largest estimated success there. The least cosine of the ``k`` best found says how
far a better row can be; with that distance the second round visits perturbed cells in order
of estimated success until the share it wants is reached, and in each the buckets that such a
row is likely to lie in. Rows of the buckets visited are ranked by exact cosine, and what
tables and cells give is merged. More rows make nearer neighbours, so the share of rows that
a query visits falls as the index grows.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import erf, log

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import dealt_join, heavy_keys, stored
from .vectors import cosines, matrix, usable

#: Rows of the index in a cell, and queries in a block, about; larger ones are dealt.
SHARD = 4_096
BLOCK = 4_096
#: Hash tables; functions of each; width of their slots, for unit vectors.
TABLES, FUNCTIONS, WIDTH = 2, 48, 1.0
#: Buckets visited in the first round; chances that a row in reach is visited in the second, by
#: its cell and by its bucket.
PROBES, IN_CELL, IN_BUCKET = 128, 0.95, 0.75
#: Slots of a function that makes cells are wider; about so many of them are in use.
_CELL_WIDTH, _CELL_SLOTS = 2.0, 2.5
SEED = 7

_erf = np.vectorize(erf, otypes=[float])


class Tables:
    """p-stable functions floor((a . x + b) / width), a standard normal."""

    def __init__(self, dim: int, tables: int, functions: int, width: float, depth: int):
        random = np.random.default_rng([SEED, dim])
        self.lines = random.standard_normal((tables, dim, max(functions, depth)))
        self.shifts = random.uniform(0, 1, (tables, max(functions, depth)))
        self.functions, self.width, self.depth = functions, width, depth
        self.names = random.integers(-2 ** 62, 2 ** 62, (tables, depth + 1)) * 2 + 1

    def cells(self, units: np.ndarray, table: int) -> np.ndarray:
        """Names of the cells that rows lie in."""
        slots = np.floor(units @ self.lines[table][:, :self.depth] / _CELL_WIDTH + self.shifts[table][:self.depth])
        return slots.astype(np.int64) @ self.names[table, 1:] + self.names[table, 0]

    def visited(self, unit: np.ndarray, table: int, reach: float, chance: float) -> np.ndarray:
        """Names of the cells a row at the distance ``reach`` lies in, most likely first, until
        the chance is reached. Along each function such a row is normal around the query."""
        names, success = self.names[table, :1], np.ones(1)
        for function in range(self.depth):
            place = unit @ self.lines[table][:, function] / _CELL_WIDTH + self.shifts[table][function]
            far = 4 * reach / _CELL_WIDTH
            edges = np.arange(np.floor(place - far), np.floor(place + far) + 2)
            below = (1 + _erf((edges - place) * _CELL_WIDTH / max(reach, 1e-9) / np.sqrt(2))) / 2
            names = (names[:, None] + edges[:-1].astype(np.int64) * self.names[table, function + 1]).ravel()
            success = (success[:, None] * np.diff(below)).ravel()
            order = np.argsort(-success, kind="stable")
            total = np.cumsum(success[order])
            least = 1 - (1 - chance) * (function + 1) / self.depth
            keep = order[:np.searchsorted(total, min(least, total[-1])) + 1]
            names, success = names[keep], success[keep]
        return names[np.sort(np.unique(names, return_index=True)[1])]

    def places(self, units: np.ndarray, table: int) -> np.ndarray:
        return (units @ self.lines[table][:, :self.functions]).astype(np.float32)

    def centres(self, units: np.ndarray, table: int) -> np.ndarray:
        """Centre of the bucket that each row lies in."""
        shift = self.shifts[table][:self.functions].astype(np.float32)
        slots = np.floor(self.places(units, table) / np.float32(self.width) + shift)
        return (slots + np.float32(0.5) - shift) * np.float32(self.width)

    def radius(self, reach: np.ndarray, chance: float) -> np.ndarray:
        """Squared distance from a query to the centre of a row's bucket that is kept with this
        chance by rows at the distance ``reach``: chi-square, plus what rounding to the centre
        adds."""
        low, high = -6.0, 6.0
        for _ in range(60):
            z = (low + high) / 2
            low, high = (z, high) if (1 + erf(z / 2 ** 0.5)) / 2 < chance else (low, z)
        of_one = 2 / (9 * self.functions)
        quantile = self.functions * max(1 - of_one + z * of_one ** 0.5, 0) ** 3
        return reach ** 2 * quantile + self.functions * self.width ** 2 / 12


def best_of(
    rows: np.ndarray, ids: np.ndarray, asked: np.ndarray, asked_ids: np.ndarray, floor: np.ndarray, k: int,
    tables: Tables, table: int, probes: int | None, chance: float,
) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(number of the query, id, cosine) of the ``k`` best rows of the buckets that each query
    visits, and how many rows these hold. The buckets are the first ``probes`` or, without
    that, those in reach of rows of the cosine ``floor``, below which nothing is returned. Where
    ``floor`` is lower than any cosine all are visited."""
    units = rows / np.linalg.norm(rows, axis=1)[:, None]
    heads = asked / np.linalg.norm(asked, axis=1)[:, None]
    centres = tables.centres(units, table)
    squares = np.einsum("ij,ij->i", centres, centres)
    radius = tables.radius(np.sqrt(np.maximum(2 - 2 * floor, 0)), chance)
    radius[floor < -1] = np.inf
    of, found, scores, met = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)], 0
    repeated = len(ids) - len(np.unique(ids))
    for at in range(0, len(heads), 256):
        places = tables.places(heads[at:at + 256], table)
        away = np.einsum("ij,ij->i", places, places)[:, None] - 2 * places @ centres.T + squares
        for q, row in enumerate(away, at):
            own = ids == asked_ids[q]
            if probes is None:
                rest = np.nonzero((row <= radius[q]) & ~own)[0]
            else:
                row[own] = np.inf
                # rows of the last bucket all count, and rows that hold k ids for sure
                last = max(probes, k + repeated) - 1
                limit = np.partition(row, last)[last] if last < len(row) else np.inf
                rest = np.nonzero((row <= limit) & ~own)[0]
            met += len(rest)
            near = units[rest] @ heads[q]
            rest = rest[near >= floor[q] - 1e-9]
            if len(rest) > k + repeated:
                near = units[rest] @ heads[q]
                rest = rest[near >= np.partition(near, -k - repeated)[-k - repeated] - 1e-12]
            score = cosines(rows[rest], np.broadcast_to(asked[q], (len(rest), rows.shape[1])))
            best = np.lexsort((ids[rest], -score))
            best = best[np.sort(np.unique(ids[rest][best], return_index=True)[1])][:k]
            of.append(np.full(len(best), q))
            found.append(ids[rest][best])
            scores.append(score[best])
    return np.concatenate(of), np.concatenate(found), np.concatenate(scores), met


def nearest_neighbours(
    index: DataFrame, queries: DataFrame, *, id: str = "vec_id", vector: str = "embedding", k: int = 5,
    tables: int = TABLES, functions: int = FUNCTIONS, width: float = WIDTH, probes: int = PROBES,
    in_cell: float = IN_CELL, in_bucket: float = IN_BUCKET,
) -> DataFrame:
    """The ``k`` rows of ``index`` found nearest to each of ``queries`` by cosine.

    Returns ``query_id, rank`` (from 1), the id, ``score`` (the cosine in double precision),
    nearest first, ties to the smaller id; fewer than ``k`` rows if there are no more
    candidates. Rows of the query's own id are no candidates.

    ``probes`` buckets are visited in each of the query's own cells; what these give sets how
    far the second round looks, where a table visits a row at that distance with a chance of
    about ``in_cell`` times ``in_bucket``. Queries that find fewer than ``k`` rows meet all
    rows.

    Vectors that are null, zero, or hold null or non-finite components take no part, nor do
    rows without an id; only vectors of equal length are compared. Of rows that repeat an
    id, the one nearest to the query counts. An empty index or no queries give no rows.
    """
    def prepared(df: DataFrame, name: str) -> DataFrame:
        return df.filter(F.col(id).isNotNull() & usable(vector)).select(
            F.col(id).cast("long").alias(name), F.col(vector).cast("array<double>").alias("v"),
            F.size(vector).alias("dim"),
        )

    rows, asked = prepared(index, "id"), prepared(queries, "query")
    number = rows.count()
    depth = max(0, round(log(max(number, 1) / SHARD) / log(_CELL_SLOTS)))

    def hashed(dim: int) -> Tables:
        return Tables(dim, tables, functions, width, depth)

    def at_home(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The cell of each table that a row lies in."""
        for part in parts:
            for dim, some in part.groupby("dim"):
                own, units = hashed(dim), _units(some["v"])
                names = np.stack([own.cells(units, table) for table in range(tables)], axis=1)
                yield some.assign(cells=list(names))

    def around(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The cells a query visits, by table."""
        for part in parts:
            for dim, some in part.groupby("dim"):
                own, units = hashed(dim), _units(some["v"])
                reach = np.sqrt(np.maximum(2 - 2 * np.maximum(some["floor"].to_numpy(), -1), 0))
                yield some.assign(cells=[
                    [own.visited(unit, table, far, in_cell) for table in range(tables)]
                    for unit, far in zip(units, reach)
                ])

    def each_table(df: DataFrame) -> DataFrame:
        return df.select("*", F.posexplode("cells").alias("table", "name")).drop("cells")

    cell = F.xxhash64("dim", "table", "name").alias("cell")
    # of rows with the same id and vector one is enough, so no part of a cell outgrows the others
    placed = stored(
        rows.dropDuplicates(["id", "v"]).mapInPandas(at_home, "id bigint, v array<double>, dim int, cells array<bigint>")
    )
    kept = each_table(placed).select("id", "v", "dim", "table", cell)
    asked = asked.withColumn("floor", F.lit(-2.0))

    def met(sent: DataFrame, visit: int | None) -> DataFrame:
        """The best rows of the cells that queries are ``sent`` to. A cell of many rows or
        queries is dealt into parts of rows and blocks of queries."""
        sizes = kept.groupBy("cell").agg(F.count("*").alias("rows")).join(
            sent.groupBy("cell").agg(F.count("*").alias("asked")), "cell"
        )
        grid = sizes.select(
            "cell", F.ceil(F.col("rows") / SHARD).cast("int").alias("lots"),
            F.ceil(F.col("asked") / BLOCK).cast("int").alias("blocks"),
        )
        many_rows, many_asked = (heavy_keys(sizes, "cell", name) for name in ("rows", "asked"))
        lot = F.pmod(F.xxhash64("id", "v"), "lots").cast("int")
        block = F.pmod(F.xxhash64("query", "v"), "blocks").cast("int")
        here = dealt_join(kept, grid, many_rows, "cell", F.xxhash64("v", "id")).select(
            "cell", "table", "id", "v", lot.alias("lot"),
            F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
        )
        there = dealt_join(sent, grid, many_asked, "cell", F.xxhash64("v", "query")).select(
            "cell", "query", "v", "floor", block.alias("block"),
            F.explode(F.sequence(F.lit(0), F.col("lots") - 1)).alias("lot"),
        )

        def answer(some: pd.DataFrame, questions: pd.DataFrame) -> pd.DataFrame:
            if not len(some) or not len(questions):
                return pd.DataFrame({"query_id": [], "id": [], "score": []})
            own = matrix(some["v"])
            of, found, score, _ = best_of(
                own, some["id"].to_numpy(), matrix(questions["v"]), questions["query"].to_numpy(),
                questions["floor"].to_numpy(), k, hashed(own.shape[1]), int(some["table"].iloc[0]), visit, in_bucket,
            )
            return pd.DataFrame({"query_id": questions["query"].to_numpy()[of], "id": found, "score": score})

        keys = ["cell", "lot", "block"]
        return here.groupBy(*keys).cogroup(there.groupBy(*keys)).applyInPandas(
            answer, "query_id bigint, id bigint, score double"
        )

    def ranked(found: DataFrame) -> DataFrame:
        rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
        best = found.groupBy("query_id", "id").agg(F.max("score").alias("score"))
        return best.withColumn("rank", rank).filter(F.col("rank") <= k)

    home = each_table(asked.mapInPandas(
        at_home, "query bigint, v array<double>, dim int, floor double, cells array<bigint>"
    )).select("query", "v", "floor", cell)
    first = stored(ranked(met(home, probes)))
    floors = first.filter(F.col("rank") == k).select(F.col("query_id").alias("query"), F.col("score").alias("least"))
    nearer = asked.join(floors, "query", "left").select("query", "v", "dim", F.coalesce("least", "floor").alias("floor"))
    visits = each_table(nearer.mapInPandas(
        around, "query bigint, v array<double>, dim int, floor double, cells array<array<bigint>>"
    )).select("query", "v", "dim", "floor", "table", F.explode("name").alias("name"))
    both = stored(ranked(
        first.drop("rank").unionByName(met(visits.select("query", "v", "floor", cell), None))
    ))
    full = both.filter(F.col("rank") == k).select(F.col("query_id").alias("query"))
    short = asked.join(full, "query", "left_anti")
    if not short.isEmpty():  # too few there: all cells of one table
        everywhere = kept.filter("table = 0").select("dim", "cell").distinct()
        both = ranked(both.drop("rank").unionByName(
            met(short.join(everywhere, "dim").select("query", "v", "floor", "cell"), None)
        ))
    return both.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(id), "score")


def _units(vectors: pd.Series) -> np.ndarray:
    rows = matrix(vectors)
    return rows / np.linalg.norm(rows, axis=1)[:, None]
