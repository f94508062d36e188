"""Secrets in texts, and how many repositories and owners share each, without Python code
on the executors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import dealt_join, heavy_keys, stored

#: The patterns asked for, by kind in order. The value of a match is the group
#: named here; a value shorter than the length given is no match.
BASE_KINDS = {
    "assign": (
        r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        12,
    ),
    "access": (r"AKIA[A-Z0-9]+", 0, 18),
    "hex": (r"[0-9a-f]+", 0, 16),
}
#: Added by the method, where one owner alone has it: a long run of the characters of
#: keys, with letters and digits.
TOKEN = "token"
TOKEN_PATTERN = r"[A-Za-z0-9+/_-]{20,}"
#: Kinds whose matches are runs of one class: their least length can go into the pattern,
#: as a run too short holds no other match.
RUNS = {"access": r"AKIA[A-Z0-9]{14,}", "hex": r"[0-9a-f]{16,}"}
KINDS = [*BASE_KINDS, TOKEN]
PIECES = "array<struct<kind:int,turn:int,gap:int,long:int,value:string>>"


def _row_of(number: int):
    return lambda x, turn: F.struct(
        F.lit(number).alias("kind"), turn.alias("turn"), F.length(x["gap"]).alias("gap"),
        F.length(x["match"]).alias("long"), x["value"].alias("value"),
    )


def _pieces(docs: DataFrame, id: str, text: str, repo: str, owner: str) -> DataFrame:
    """One row per match: its number, its length, that of the text since the one before."""
    content = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(id).alias("id"), F.xxhash64(content).alias("body"), F.col(repo).alias("repo"),
        F.col(owner).alias("owner"), content.alias("content"),
    )
    patterns = {kind: (RUNS.get(kind, rule), group) for kind, (rule, group, _) in BASE_KINDS.items()}
    patterns[TOKEN] = (TOKEN_PATTERN, 0)
    for kind, (rule, _) in patterns.items():
        rows = rows.withColumn(kind, F.regexp_extract_all("content", F.lit(rule), F.lit(0)))
    rows = rows.filter(" or ".join(f"size({kind}) > 0" for kind in patterns))
    parts = []
    for number, (kind, (rule, group)) in enumerate(patterns.items()):
        found = F.col(kind)
        values = found if group == 0 else F.regexp_extract_all("content", F.lit(rule), F.lit(group))
        gaps = F.split("content", rule, -1)
        zipped = F.arrays_zip(
            found.alias("match"), values.alias("value"), F.slice(gaps, F.lit(1), F.size(found)).alias("gap")
        )
        part = F.transform(zipped, _row_of(number))
        parts.append(F.when(F.size(found) > 0, part).otherwise(F.array().cast(PIECES)))
    return rows.select("id", "body", "repo", "owner", F.inline(F.concat(*parts)))


def _counts(spans: DataFrame) -> DataFrame:
    """Distinct repositories and owners per value. Pairs are made distinct before they are
    counted, and both counts are summed inside the map tasks, so that a value of any
    number of rows is no hot key."""
    def distinct(what: str, name: str) -> DataFrame:
        pairs = spans.select("digest", F.col(what).alias("of")).distinct()
        return pairs.groupBy("digest").agg(F.count("*").alias(name))

    return distinct("repo", "repos").join(distinct("owner", "owners"), "digest")


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(kind) for kind in KINDS])
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))
        ),
        ",",
    )


def scan_secrets(
    docs: DataFrame, *, id: str = "doc_id", text: str = "text", repo: str = "doc_id",
    owner: str = "source", max_repos: int = 3, max_owners: int = 1,
) -> DataFrame:
    """Secrets of every text, and whether their values look live or copied.

    Finds the matches of ``BASE_KINDS`` and, as candidates, long tokens of letters and
    digits. The values of all are counted over the corpus by distinct ``repo`` and
    ``owner``: at most ``max_repos`` and ``max_owners`` make a value live-looking, more
    make it a copied example. Base matches stay in any case; tokens are kept if they look
    live and overlap no base match.

    Returns one row per row of ``docs``: the id, ``n_assign``, ``n_access``, ``n_hex``,
    ``base_sha256`` over the base spans, ``spans`` (all, by start, kind and end, in code
    points, end exclusive), ``n_token``, ``n_live``, ``n_copied`` (of the spans listed).

    A null text is an empty one. A null repo or owner is one like any other. Rows of the
    same id and text are scanned once and both shown. An empty table gives no rows.
    """
    at = ["id", "body"]
    run = Window.partitionBy(*at, "kind").orderBy("turn").rowsBetween(Window.unboundedPreceding, 0)
    least = F.create_map(*[
        x for number, (_, _, length) in enumerate(BASE_KINDS.values()) for x in (F.lit(number), F.lit(length))
    ])
    token = len(BASE_KINDS)
    valid = F.when(
        F.col("kind") == token, F.col("value").rlike("[0-9]") & F.col("value").rlike("[A-Za-z]")
    ).otherwise(F.length("value") >= least[F.col("kind")])
    # texts are matched once; what is written is the places of matches and digests of values
    found = stored(
        _pieces(docs, id, text, repo, owner)
        .withColumns({"valid": valid, "digest": F.sha2("value", 256)}).drop("value")
    )
    spans = found.dropDuplicates([*at, "repo", "owner", "kind", "turn"])
    located = (
        spans.dropDuplicates([*at, "kind", "turn"])
        .withColumn("end", F.sum(F.col("gap") + F.col("long")).over(run))
        .withColumn("start", F.col("end") - F.col("long"))
    )
    counts = _counts(spans.filter("valid").select("digest", "repo", "owner"))
    valued = found.filter("valid")
    heavy = heavy_keys(valued.groupBy("digest").agg(F.count("*").alias("n")), "digest", "n", valued.count())
    judged = (
        dealt_join(located.filter("valid"), counts, heavy, "digest", F.xxhash64("id", "body", "kind", "turn"))
        .withColumn("live", (F.col("repos") <= max_repos) & (F.col("owners") <= max_owners))
    )
    by_start = Window.partitionBy(*at).orderBy("start", "kind", "end")
    base = F.col("kind") < token
    seen = F.max(F.when(base, F.col("end"))).over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    next_base = F.min(F.when(base, F.col("start"))).over(by_start.rowsBetween(1, Window.unboundedFollowing))
    overlaps = (F.coalesce(seen, F.lit(-1)) > F.col("start")) | (
        F.coalesce(next_base, F.col("end")) < F.col("end")
    )
    kept = judged.withColumn("overlaps", overlaps).filter(base | (F.col("live") & ~F.col("overlaps")))
    per_doc = kept.groupBy(*at).agg(
        F.sort_array(F.collect_list(F.struct("start", "kind", "end"))).alias("all"),
        *[F.count(F.when(F.col("kind") == n, 1)).alias(f"n_{kind}") for n, kind in enumerate(KINDS)],
        F.count(F.when(F.col("live"), 1)).alias("n_live"),
        F.count(F.when(~F.col("live"), 1)).alias("n_copied"),
    )
    numbers = [*[f"n_{kind}" for kind in KINDS], "n_live", "n_copied"]
    digests = per_doc.select(
        F.col("id").alias("found_id"), F.col("body").alias("found_body"), *numbers,
        F.sha2(_joined(F.filter("all", lambda s: s["kind"] < token)), 256).alias("base_sha256"),
        _joined(F.col("all")).alias("spans"),
    )
    rows = docs.select(
        F.col(id).alias("id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("body")
    )
    return rows.join(
        digests, F.col("id").eqNullSafe(F.col("found_id")) & (F.col("body") == F.col("found_body")), "left"
    ).select(
        F.col("id").alias(id), *[F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in numbers[:3]],
        F.coalesce("base_sha256", F.sha2(F.lit(""), 256)).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"),
        *[F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in numbers[3:]],
    )
