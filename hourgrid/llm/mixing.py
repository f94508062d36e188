"""Mixing sources to target weights, with DataFrame operations only.

Every document gets a random key by hashing. Keys are cut into equal ranges; sums of sizes
per source and range, and running sums over the ranges, give each range its offset, so that
the prefix sum of a document needs only the documents of its own range. No task holds a
whole source.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, apart, dealt_join, heavy_keys, stored

#: Hexadecimal digits of the key that name its range: 4,096 ranges per source.
RANGE_DIGITS = 3
#: Sources' cuts of this many bytes at most are broadcast; more are joined, large sources dealt.
BROADCAST_BYTES = 20_000_000


def word_count(text: Column) -> Column:
    """Number of words, runs of anything but ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _key(id: str, text: str, seed: int) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(id).cast("string"), F.col(text)))


def _source(source: str) -> Column:
    """The source as a key that is never null; '' stands for null."""
    return F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit(""))


def _before(rows: DataFrame, order: Sequence[Column], sums: dict[str, Column]) -> DataFrame:
    """Adds the sums over all rows that come earlier in ``order``: inside ranges of rows, and
    over the ranges' own sums, of which there are as many as shuffle partitions. The ranges
    are stored, so that no later step sees them drawn another way."""
    ranged = stored(rows.repartitionByRange(*order).withColumn("at", F.spark_partition_id()))
    of_range = Window.orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranged.groupBy("at").agg(*[F.sum(value).alias(f"{name}_of") for name, value in sums.items()]).select(
        "at", *[F.coalesce(F.sum(f"{name}_of").over(of_range), F.lit(0)).alias(f"{name}_of") for name in sums]
    )
    within = Window.partitionBy("at").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    found = {name: F.coalesce(F.sum(value).over(within), F.lit(0)) for name, value in sums.items()}
    return (
        ranged.withColumns(found).join(offsets, "at")
        .withColumns({name: F.col(name) + F.col(f"{name}_of") for name in sums})
        .drop("at", *[f"{name}_of" for name in sums])
    )


def _targets(sizes: DataFrame, weights: Sequence[float], cap: float, share: float) -> DataFrame:
    """Adds ``target`` to one row per source (``src, source_size``).

    Weights go round over the sources by code point, null last. With sources ordered by the
    level at which they are full, cap x size / weight, the level that remains for the k-th
    and all after it rises until the first source that is not full and falls from there on;
    its maximum is the level at which the shares add up to the whole. Sources are numbered
    and summed by ranges, as documents are; two numbers come to the driver, the words and
    weights of all and the level.
    """
    turn = (F.col("earlier") % len(weights) + 1).cast("int")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn)
    rows = (
        _before(sizes, [F.col("src") == "", F.col("src")], {"earlier": F.lit(1)})
        .withColumn("weight", weight)
        .withColumn("most", F.lit(float(cap)) * F.col("source_size"))
        .withColumn("full", F.col("most") / F.col("weight"))
    )
    rows = _before(
        rows.drop("earlier"), [F.col("full"), F.col("src") == "", F.col("src")],
        {"filled": F.col("most"), "passed": F.col("weight")},
    )
    words, heft = rows.agg(F.sum("source_size"), F.sum("weight")).first()
    remains = (F.lit(float(share)) * F.lit(words or 0) - F.col("filled")) / (F.lit(heft or 0.0) - F.col("passed"))
    level = rows.agg(F.max(remains)).first()[0] or 0.0
    return rows.select("src", F.least("most", F.lit(level) * F.col("weight")).alias("target"))


def _placed(
    docs: DataFrame, id: str, text: str, source: str, weights: Sequence[float], cap: float,
    share: float, seed: int,
) -> DataFrame:
    """Each document with its source's budget and the words of the same source before it."""
    key = _key(id, text, seed)
    sized = stored(
        docs.select(
            F.col(id).alias("id"), _source(source).alias("src"), key.alias("key"),
            F.substring(key, 1, RANGE_DIGITS).alias("range"), word_count(F.col(text)).alias("size"),
        )
    )
    ranges = sized.groupBy("src", "range").agg(F.sum("size").alias("range_size"))
    sizes = stored(ranges.groupBy("src").agg(F.sum("range_size").alias("source_size")))
    per_source = sizes.join(_targets(sizes, weights, cap, share), "src")
    before = Window.partitionBy("src").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranges.withColumn("offset", F.coalesce(F.sum("range_size").over(before), F.lit(0)))
        .drop("range_size").join(per_source, "src")
    )
    within = (
        Window.partitionBy("src", "range").orderBy("key", "id", "size")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        sized.withColumn("upto", F.sum("size").over(within))
        .join(offsets, ["src", "range"])
        .withColumn("before", F.col("offset") + F.col("upto") - F.col("size"))
        .withColumn("budget", F.floor("target").cast("long"))
        .withColumn("rounds", F.expr("coalesce(budget div nullif(source_size, 0), 0)"))
        .withColumn("rest", F.col("budget") - F.col("rounds") * F.col("source_size"))
    )


def mix_sources(
    docs: DataFrame, *, id: str = "doc_id", text: str = "text", source: str = "source",
    weights: Sequence[float] = (5, 2, 1), cap: float = 3.0, share: float = 1.0, seed: int = 1,
) -> DataFrame:
    """How many words of each document a mix of the sources takes.

    Returns one row per row of ``docs``: the id, ``size`` (its words), ``source_size``,
    ``target`` (its source's words in the mix) and ``taken``. Sources share ``share`` of all
    words by their weights; no target exceeds ``cap`` times its source's size, and what is
    over goes to the others by weight. A source is read in the order of the documents'
    random keys, as often as its target asks for, and cut at floor(target) words: every
    document is taken ``rounds`` times, those before the cut once more, the one at the cut
    in part. ``taken`` adds up to floor(target) per source. Reruns agree.

    A null text has size 0; a null source is a source of its own, last in order; a null id
    is an id like any other. Repeated rows count each; which of equal rows comes first does
    not show. An empty table gives no rows; sources without words have target 0.
    """
    rows = _placed(docs, id, text, source, weights, cap, share, seed)
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("before")))
    return rows.select(
        F.col("id").alias(id), "size", "source_size", "target",
        (F.col("rounds") * F.col("size") + part).cast("long").alias("taken"),
    )


def mixed_documents(
    docs: DataFrame, *, id: str = "doc_id", text: str = "text", source: str = "source",
    weights: Sequence[float] = (5, 2, 1), cap: float = 3.0, share: float = 1.0, seed: int = 1,
) -> DataFrame:
    """The mix itself: a row of ``docs`` for each time it is taken, columns as they were.

    A cut is known by its source's rounds and the key and words at which it falls, so that
    documents are copied where they are read, without a shuffle of texts. The document at
    the cut comes with its first words only. Documents taken 0 times do not appear; those
    without words come once for every full round, and once more before the cut. Rows that
    repeat the one at the cut exactly are cut alike, so that such a source may exceed its
    target by their words. A source without any words stays as it is.
    """
    placed = _placed(docs, id, text, source, weights, cap, share, seed)
    cut = F.when(F.col("before") + F.col("size") > F.col("rest"), F.struct("key", "before"))
    cuts = stored(
        placed.groupBy("src").agg(
            F.first("rounds").alias("rounds"), F.first("rest").alias("rest"), F.min(cut).alias("cut")
        )
    )
    src, rounds, last, words_left, take = apart(docs.columns, "src", "rounds", "last", "words_left", "take")
    plan = cuts.select(
        F.col("src").alias(src), F.col("rounds").alias(rounds),
        F.col("cut.key").alias(last), (F.col("rest") - F.col("cut.before")).alias(words_left),
    )
    here = _key(id, text, seed)
    full = F.col(rounds) + F.when(F.col(last).isNull() | (here < F.col(last)), 1).otherwise(0)
    part = F.when((here == F.col(last)) & (F.col(words_left) > 0), F.col(words_left))
    copies = F.concat(
        F.array_repeat(F.lit(-1).cast("long"), full.cast("int")),
        F.when(part.isNotNull(), F.array(part)).otherwise(F.array().cast("array<bigint>")),
    )
    held = cuts.agg(F.sum(F.octet_length("src") + F.lit(100))).first()[0] or 0  # 100: a row without its name
    if held <= BROADCAST_BYTES:
        rows = docs.withColumn(src, _source(source)).join(F.broadcast(plan), src)
    else:
        whole = docs.select(F.struct(*docs.columns).alias("row"), _source(source).alias(src))
        heavy = heavy_keys(whole.groupBy(src).agg(F.count("*").alias("n")), src, "n")
        rows = dealt_join(whole, plan, heavy, src, F.xxhash64(F.col("row")[id], F.col("row")[text])).select(
            "row.*", src, rounds, last, words_left
        )
    rows = rows.withColumn(take, F.explode(copies))
    words = F.slice(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), 1, F.col(take).cast("int"))
    gaps = F.slice(F.split(text, WORD, -1), 1, F.col(take).cast("int"))
    length = F.lit(0)
    for pieces in (words, gaps):
        length = length + F.aggregate(pieces, F.lit(0), lambda total, piece: total + F.length(piece))
    first_words = F.substring(F.col(text), F.lit(1), length)
    new_text = F.when(F.col(take) >= 0, first_words).otherwise(F.col(text))
    return rows.withColumn(text, new_text).select(*docs.columns)
