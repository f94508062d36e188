import random

from pyspark.sql import functions as F

from hourgrid.operators import (
    HourRange,
    child_count_by_hour,
    event_leg,
    events_by_hour,
    hourly_sums,
    state_seconds_by_hour,
)

CLASSES = {"run": ["sorting"], "down": ["planned", "unplanned"], "stuck": ["blocked"]}
KEYS = ["site", "machine"]


def by_bucket(df, *names):
    rows = df.select("site", "machine", F.unix_seconds("bucket").alias("b"), *names).collect()
    found = {(row.site, row.machine, row.b): tuple(row)[3:] for row in rows}
    assert len(found) == len(rows)
    return found


def states(spark, rows):
    df = spark.createDataFrame(rows, "site string, machine string, s long, e long, state string")
    return df.select(
        "site", "machine", "state",
        F.timestamp_seconds("s").alias("start"), F.timestamp_seconds("e").alias("end"),
    )


def test_states_are_exact_and_null_without_rows(spark):
    log = states(spark, [
        ("A", "M", 0, 100, "sorting"), ("A", "M", 100, 150, "planned"),
        ("A", "M", 150, 160, "unplanned"), ("A", "M", 160, 170, "Sorting"),
        ("A", "M", 170, 180, "idle"), ("A", "M", 180, 190, None),
        ("A", "N", 3600, 3605, "blocked"), ("A", "O", 0, 5, "idle"),
    ])
    hourly = state_seconds_by_hour(
        log, CLASSES, keys=KEYS, start="start", end="end", state="state"
    )
    assert by_bucket(hourly, "run", "down", "stuck") == {
        ("A", "M", 0): (100, 60, None), ("A", "N", 3600): (None, None, 5),
    }


def test_overlaps_add_up(spark):
    log = states(spark, [("A", "M", 0, 3600, "sorting"), ("A", "M", 600, 3600, "sorting")])
    hourly = state_seconds_by_hour(log, CLASSES, keys=KEYS, start="start", end="end", state="state")
    assert by_bucket(hourly, "run") == {("A", "M", 0): (6600,)}


def events(spark, rows):
    df = spark.createDataFrame(rows, "site string, machine string, s long, id string, outcome string")
    return df.withColumn("ts", F.timestamp_seconds("s"))


EVENTS = [
    ("A", "M", 0, "a", "complete"), ("A", "M", 3599, "b", "partial"), ("A", "M", 3600, "c", "partial"),
    ("A", "M", 7200, None, "complete"), (None, "M", 0, "d", "complete"), ("A", "M", None, "e", "complete"),
]


def test_events_count_at_their_start(spark):
    hourly = events_by_hour(events(spark, EVENTS), keys=KEYS, ts="ts", id="id", name="n")
    assert by_bucket(hourly, "n") == {
        ("A", "M", 0): (2,), ("A", "M", 3600): (1,), ("A", "M", 7200): (0,),
        (None, "M", 0): (1,), ("A", "M", None): (1,),
    }
    complete = F.col("outcome") == "complete"
    hourly = events_by_hour(events(spark, EVENTS), keys=KEYS, ts="ts", id="id", where=complete, name="n")
    assert by_bucket(hourly, "n") == {
        ("A", "M", 0): (1,), ("A", "M", 7200): (0,), (None, "M", 0): (1,), ("A", "M", None): (1,),
    }


def test_merged_counts_keep_null_apart_from_zero(spark):
    log = events(spark, EVENTS)
    complete = F.col("outcome") == "complete"
    leg = event_leg(log, {"n": None, "ok": complete}, keys=KEYS, ts="ts", id="id")
    merged = by_bucket(hourly_sums(leg, KEYS), "n", "ok")
    total = by_bucket(events_by_hour(log, keys=KEYS, ts="ts", id="id", name="n"), "n")
    part = by_bucket(events_by_hour(log, keys=KEYS, ts="ts", id="id", where=complete, name="ok"), "ok")
    assert merged == {key: (n, part.get(key, (None,))[0]) for key, (n,) in total.items()}
    assert merged["A", "M", 3600] == (1, None) and merged["A", "M", 7200] == (0, 0)


def test_events_in_range(spark):
    hours = HourRange.between("1970-01-01 00:00", "1970-01-01 01:00")
    hourly = events_by_hour(events(spark, EVENTS), keys=KEYS, ts="ts", id="id", name="n", hours=hours)
    assert by_bucket(hourly, "n") == {
        ("A", "M", 0): (2,), ("A", "M", 3600): (1,), (None, "M", 0): (1,),
    }


def family(spark, parents, children):
    parents = spark.createDataFrame(parents, "site string, machine string, uid string, s long")
    children = spark.createDataFrame(children, "site string, machine string, uid string, item string")
    return parents.withColumn("ts", F.timestamp_seconds("s")), children


def plain_join_counts(parents, children):
    """The definition: join row by row, then count."""
    joined = parents.join(children, ["site", "machine", "uid"], "left")
    return joined.groupBy(
        "site", "machine", F.timestamp_seconds(F.col("s") - F.col("s") % 3600).alias("bucket")
    ).agg(F.count("item").alias("n"))


def child_counts(parents, children, **more):
    return child_count_by_hour(
        parents, children, on=["site", "machine", "uid"], keys=KEYS, ts="ts", item="item",
        name="n", **more,
    )


def test_children(spark):
    parents, children = family(
        spark,
        [("A", "M", "1", 0), ("A", "M", "2", 10), ("A", "M", "3", 3600), ("A", None, "4", 0), ("B", "M", "1", 0)],
        [("A", "M", "1", "x"), ("A", "M", "1", "y"), ("A", "M", "2", None), ("A", "M", "9", "orphan"),
         ("A", None, "4", "z"), ("A", "M", "01", "other text")],
    )
    counts = by_bucket(child_counts(parents, children), "n")
    assert counts == {
        ("A", "M", 0): (2,), ("A", "M", 3600): (0,), ("A", None, 0): (0,), ("B", "M", 0): (0,),
    }
    assert counts == by_bucket(plain_join_counts(parents, children), "n")


def test_children_with_a_hot_and_a_repeated_parent(spark):
    pick = random.Random(3)
    machine = lambda: pick.choice(["M", "M", "N", None])
    parents = [("A", machine(), str(pick.randrange(60)), pick.randrange(20_000)) for _ in range(400)]
    parents += [("A", "M", "hot", pick.randrange(20_000)) for _ in range(200)]
    children = [("A", machine(), str(pick.randrange(80)), f"i{i}") for i in range(600)]
    children += [("A", "M", "hot", f"h{i}") for i in range(300)]
    parents, children = family(spark, parents, children)
    counts = by_bucket(child_counts(parents, children), "n")
    assert counts == by_bucket(plain_join_counts(parents, children), "n")
    assert counts == by_bucket(child_counts(parents, children, unique_parents=True), "n")
    hours = HourRange.between("1970-01-01 01:00", "1970-01-01 03:00")
    inside = by_bucket(child_counts(parents, children, hours=hours), "n")
    assert inside == {key: n for key, n in counts.items() if hours.lower <= key[2] < hours.upper}
