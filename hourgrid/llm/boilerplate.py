"""Lines that stand on many sites, found by merging sketches of the sites of each line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common
from .common import apart, dealt_join, heavy_keys, stored

#: Registers of a sketch, as a power of two; its standard error is about 1.6 %.
SKETCH_BITS = 12
#: Estimates within this share of the threshold, and one more, are counted exactly: over
#: five standard errors.
MARGIN = 0.1


def _lines(docs: DataFrame, id: str, text: str, site: str) -> DataFrame:
    """One row per line that is not blank: the document, the site, the line's place and
    digest."""
    rows = docs.select(
        F.col(id).alias("id"), F.xxhash64(text).alias("body"),
        F.coalesce(F.concat(F.lit("="), F.col(site).cast("string")), F.lit("")).alias("site"),
        F.posexplode(F.split(text, "\n", -1)).alias("turn", "line"),
    )
    return rows.filter(F.col("line").rlike(r"[^\x20\x09-\x0D]")).withColumn("line", F.md5("line"))


def _order() -> Column:
    """Places of lines in order: by id, null last, then by place."""
    return F.struct(F.col("id").isNull().alias("none"), "id", "body", "turn")


def _shared(docs: DataFrame, id: str, text: str, site: str, min_sites: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Lines on ``min_sites`` sites or more, the places of all lines that looked like it (both
    stored), and the lines that are heavy.

    A sketch of the sites is made for every line inside the map tasks and merged by the
    aggregation. Lines whose estimate is clear of the threshold are decided by it, those
    near it by an exact count of distinct sites.
    """
    margin = MARGIN * min_sites + 1
    spread = stored(
        _lines(docs, id, text, site)
        .groupBy("line")
        .agg(
            F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(SKETCH_BITS))).alias("sites"),
            F.min(_order()).alias("first"), F.count("*").alias("places"),
        )
        .filter((F.col("sites") >= min_sites - margin) | (F.col("places") > common.FEW))
    )
    heavy = heavy_keys(spread, "line", "places")
    wanted = spread.filter(F.col("sites") >= min_sites - margin).drop("places")
    places = stored(dealt_join(
        _lines(docs, id, text, site), wanted.select("line", (F.col("sites") <= min_sites + margin).alias("near")),
        heavy, "line", F.xxhash64("id", "body", "turn"),
    ))
    exact = (
        places.filter("near").select("line", "site").distinct()
        .groupBy("line").agg(F.count("*").alias("exact"))
    )
    lines = (
        wanted.join(exact, "line", "left")
        .withColumn("sites", F.coalesce("exact", "sites")).drop("exact")
        .filter(F.col("sites") >= min_sites)
    )
    return lines, places, heavy


def boilerplate_lines(
    docs: DataFrame, *, id: str = "doc_id", text: str = "text", site: str = "source", min_sites: int = 5
) -> DataFrame:
    """Lines (their md5) that stand on ``min_sites`` sites or more, and where each is first:
    ``line, sites, first``. No line gives no rows."""
    return _shared(docs, id, text, site, min_sites)[0]


def dedup_lines(
    docs: DataFrame, *, id: str = "doc_id", text: str = "text", site: str = "source", min_sites: int = 5
) -> DataFrame:
    """``docs`` without the lines that stand on ``min_sites`` sites or more.

    Each such line stays once, where it is first by id; so nothing goes that is not found
    elsewhere. Lines end at a line feed; blank ones stay. Lines are the same if their
    bytes are. Adds ``n_lines`` and ``n_removed`` to the columns of ``docs``, in
    place of any of these names.

    A null text stays null and has no lines; a null site is a site of its own; a null id
    comes last. Rows of the same id and text are treated alike. A document may become empty,
    its row stays. An empty table gives no rows.
    """
    shared, places, heavy = _shared(docs, id, text, site, min_sites)
    of, body, turns = apart(docs.columns, "of", "body", "turns")
    removed = (
        dealt_join(places, shared.select("line", "first"), heavy, "line", F.xxhash64("id", "body", "turn"))
        .filter(_order() > F.col("first"))
        .groupBy(F.col("id").alias(of), F.col("body").alias(body))
        .agg(F.collect_set("turn").alias(turns))
    )
    lines = F.split(text, "\n", -1)
    gone = F.map_from_arrays(turns, F.transform(turns, lambda _: F.lit(True)))
    rows = docs.join(
        removed, F.col(id).eqNullSafe(F.col(of)) & (F.xxhash64(text) == F.col(body)), "left"
    )
    left = F.array_join(F.filter(lines, lambda _, turn: F.element_at(gone, turn).isNull()), "\n")
    return rows.select(
        *[
            F.when(F.col(turns).isNull(), F.col(text)).otherwise(left).alias(text) if c == text else F.col(c)
            for c in docs.columns if c not in ("n_lines", "n_removed")
        ],
        F.when(F.col(text).isNull(), 0).otherwise(F.size(lines)).cast("long").alias("n_lines"),
        F.when(F.col(turns).isNull(), 0).otherwise(F.size(turns)).cast("long").alias("n_removed"),
    )
