"""Helpers that several operators share: shared folders, Arrow batches, components."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

#: A key is heavy where it holds more than one in so many of all rows, and more than so few.
HEAVY, FEW = 1_000, 1_000

#: Bytes of texts that a Python worker takes apart at once.
BYTES = 8 << 20

#: Applications whose Python workers have been sent this package.
_SHIPPED: set[str] = set()

#: What this Python worker remembers from one task to the next, under the name of its use.
_KEPT: dict = {}


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers of the session, once, unless it is on the path
    they get from the environment. Its dependencies must be installed where they run."""
    root = Path(__file__).resolve().parents[2]
    on_path = [Path(each).resolve() for each in os.environ.get("PYTHONPATH", "").split(os.pathsep) if each]
    context = spark.sparkContext
    if root in on_path or context.applicationId in _SHIPPED:
        return
    folder = Path(tempfile.mkdtemp(prefix="hourgrid-"))  # the driver's own: Spark sends the file from here
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    with zipfile.ZipFile(folder / "hourgrid.zip", "w") as package:
        for file in sorted(root.glob("hourgrid/**/*.py")):
            package.write(file, file.relative_to(root))
    context.addPyFile(str(folder / "hourgrid.zip"))
    _SHIPPED.add(context.applicationId)


def gone_at_exit(spark: SparkSession, folder: str) -> None:
    """Remove a folder of this application when the session's JVM ends."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(path)


def shared_folder(spark: SparkSession) -> None:
    """See that checkpoints go to the folder named in ``spark.checkpoint.dir``. A local
    session that names none gets a temporary one; a cluster must name one. Spark makes a
    folder of this application in it, which goes when the application ends."""
    context = spark.sparkContext
    if not context.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder all executors share")
            folder = tempfile.mkdtemp(prefix="hourgrid-")
            atexit.register(shutil.rmtree, folder, ignore_errors=True)
        context.setCheckpointDir(folder)
    gone_at_exit(spark, context.getCheckpointDir())


def apart(columns: list[str], *names: str) -> list[str]:
    """The names, changed where needed so that no column has one of them."""
    taken = {name.lower() for name in columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name = f"{name}_"
        taken.add(name.lower())
        found.append(name)
    return found


def kept(use, make: Callable):
    """What ``make`` gives, kept in this Python worker until another use is asked for: workers
    go on from operator to operator, and their memory holds what one of them remembers."""
    if use not in _KEPT:
        forget()
        _KEPT[use] = make()
    return _KEPT[use]


def forget() -> None:
    """Let go of what earlier operators remembered in this Python worker, and of the memory that
    Arrow has kept for further use."""
    _KEPT.clear()
    pa.default_memory_pool().release_unused()


def runs(texts: pa.Array, size: int | None = None) -> Iterator[pa.Array]:
    """The column in slices: those texts together that begin in the same ``BYTES``, or ``size``,
    so that a slice holds these and the rest of its last text."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy().astype(np.int64)
    cuts = np.flatnonzero(np.diff((np.cumsum(sizes) - sizes) // (size or BYTES))) + 1
    for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(texts)]):
        if end > start:
            yield texts.slice(start, end - start)


def distinct_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The words of texts, which are runs of anything but ASCII white space (null: none): the
    distinct ones, the place among them of each word of the texts in a row, and of each text
    the end in that row, after a 0."""
    split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    words = split.flatten().dictionary_encode()
    place, ends = words.indices.to_numpy(), split.offsets.to_numpy()
    ends = ends - ends[0]
    none = pc.index(words.dictionary, "").as_py()
    if none >= 0:  # from white space at a text's ends
        there = place != none
        place, ends = place[there], np.concatenate([[0], np.cumsum(there)])[ends]
    return words.dictionary, place, ends


def stored(df: DataFrame) -> DataFrame:
    """The rows of ``df``, computed once and read from the shared folder from then on."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def heavy_keys(counts: DataFrame, key: str, rows: str, total: int | None = None) -> DataFrame:
    """Keys of ``counts`` (one row per key, its ``rows``) that hold more than their part of
    ``total`` rows, or of the sum of ``rows``, and the ``parts`` to deal each into. As a
    heavy key has over one in ``HEAVY`` of the rows, there are fewer than ``HEAVY``."""
    if total is None:
        total = counts.agg(F.sum(rows)).first()[0] or 0
    most = max(FEW, -(-total // HEAVY))
    return counts.filter(F.col(rows) > most).select(
        F.col(key), F.ceil(F.col(rows) / F.lit(most)).cast("int").alias("parts")
    )


def dealt_join(rows: DataFrame, keyed: DataFrame, heavy: DataFrame, key: str, turn: Column) -> DataFrame:
    """``rows`` joined with ``keyed`` (one row per key) on ``key``. Rows of ``heavy`` keys are
    dealt by the hash ``turn`` into as many parts as these need, each of which meets a copy
    of the key's row; all other rows meet it under their key alone. What is broadcast is
    fewer than ``HEAVY`` keys."""
    parts = F.broadcast(heavy)
    part = F.when(F.col("parts") > 1, F.pmod(turn, F.col("parts"))).otherwise(0).cast("int")
    dealt = rows.join(parts, key, "left").withColumn("part", part).drop("parts")
    copies = F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1))
    return dealt.join(
        keyed.join(parts, key, "left").withColumn("part", copies).drop("parts"), [key, "part"]
    ).drop("part")


def components(edges: DataFrame) -> DataFrame:
    """Connected components by alternating stars.

    ``edges`` has two columns of longs, u and v, in any direction, repeats allowed. Returns
    ``node, root``: every node that has a link to another, with the smallest node that
    links reach from it. Each round turns every node's larger neighbours, then its smaller
    ones, to the smallest neighbour; the rounds end when the set of links stays the same.
    Links stay distributed, and each round is written to the shared folder. A node of many
    links is no single key: its links are dealt by their measured number.
    """
    u, v = edges.columns
    links = stored(
        edges.select(F.greatest(u, v).alias("hi"), F.least(u, v).alias("lo"))
        .filter("hi <> lo").distinct()
    )
    now, before = links.select(F.count("*"), F.lit(None)).first(), None
    while now != before:
        both = links.select(F.col("hi").alias("at"), F.col("lo").alias("to")).unionAll(
            links.select(F.col("lo").alias("at"), F.col("hi").alias("to"))
        )
        smallest = both.groupBy("at").agg(F.least(F.min("to"), F.first("at")).alias("least"), F.count("*").alias("n"))
        hubs = heavy_keys(smallest, "at", "n", 2 * now[0])
        large = (
            dealt_join(both.filter("to > at"), smallest.drop("n"), hubs, "at", F.xxhash64("to"))
            .select(F.col("to").alias("at"), F.col("least").alias("to")).filter("at <> to").distinct()
        )
        fewest = large.groupBy("at").agg(F.min("to").alias("least"), F.count("*").alias("n"))
        hubs = heavy_keys(fewest, "at", "n", now[0])
        small = dealt_join(large, fewest.drop("n"), hubs, "at", F.xxhash64("to"))
        links = stored(
            small.select(F.col("to").alias("hi"), F.col("least").alias("lo"))
            .unionAll(fewest.select(F.col("at").alias("hi"), F.col("least").alias("lo")))
            .filter("hi <> lo").distinct()
        )
        before = now
        now = links.select(F.count("*"), F.expr("sum(cast(xxhash64(hi, lo) as decimal(38, 0)))")).first()
    return links.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionAll(
        links.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct()
    )
