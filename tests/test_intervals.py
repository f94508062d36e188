import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from hourgrid.functions import epoch_to_ts, hour_bucket
from hourgrid.operators import BUCKET, HourRange, interval_rejects, split_intervals


def log_of(spark, rows):
    """rows: (id, start, end) with epochs as text, number or None."""
    text = [(i, *(None if v is None else str(v) for v in pair)) for i, *pair in rows]
    log = spark.createDataFrame(text, "id long, start string, end string")
    return log.withColumns({c: epoch_to_ts(F.col(c)) for c in ("start", "end")})


def pieces_of(df):
    """{(id, bucket epoch or None): (seconds, minutes)}; every pair must be unique."""
    rows = df.select("id", F.unix_seconds(BUCKET).alias("b"), "seconds", "minutes").collect()
    pieces = {(row.id, row.b): (row.seconds, row.minutes) for row in rows}
    assert len(pieces) == len(rows)
    return pieces


def seconds_of(df):
    return {key: value[0] for key, value in pieces_of(df).items()}


EDGES = [
    ("empty", 100, 100, {}),
    ("one full hour", 0, 3600, {0: 3600}),
    ("across the hour", 3599, 3601, {0: 1, 3600: 1}),
    ("several hours", 1800, 12600, {0: 1800, 3600: 3600, 7200: 3600, 10800: 1800}),
    ("within an hour", 4000, 4061, {3600: 61}),
    ("ends on the hour", 7000, 7200, {3600: 200}),
    ("no start", None, 100, {}),
    ("no end", 100, None, {}),
    ("bad start", "abc", 100, {}),
    ("reversed", 5000, 4000, {}),
    ("reversed over hours", 9000, 1000, {}),
    ("before 1970", -3601, 1, {-7200: 1, -3600: 3600, 0: 1}),
    ("fractions round down", "16.9", "18.1", {0: 2}),
    ("a fraction of a second", "16.2", "16.9", {}),
]


@pytest.fixture(scope="module")
def edges(spark):
    log = log_of(spark, [(i, start, end) for i, (_, start, end, _) in enumerate(EDGES)])
    pieces = seconds_of(split_intervals(log, start="start", end="end"))
    rejects = interval_rejects(log, start="start", end="end").collect()
    return pieces, {row.id: row.reject_reason for row in rejects}


@pytest.mark.parametrize("i", range(len(EDGES)), ids=[edge[0] for edge in EDGES])
def test_edges(edges, i):
    pieces, _ = edges
    assert {b: seconds for (id, b), seconds in pieces.items() if id == i} == EDGES[i][3]


def test_rejects(edges):
    _, rejects = edges
    assert {EDGES[i][0]: reason for i, reason in rejects.items()} == {
        "no start": "no start",
        "no end": "no end",
        "bad start": "no start",
        "reversed": "reversed",
        "reversed over hours": "reversed",
    }


@pytest.mark.parametrize(
    "text, expected",
    [
        ("1668988800", 1668988800.0), ("16.5", 16.5), ("-1.5", -1.5), (" 12 ", 12.0),
        ("abc", None), ("", None), (None, None), ("null", None), ("NaN", None),
        ("Infinity", None), ("1e300", None), ("253402300800", None),
        ("253402300799", 253402300799.0), ("1668988800000", None),
    ],
)
@pytest.mark.parametrize("ansi", ["true", "false"])
def test_epochs(spark, text, expected, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = spark.createDataFrame([(text,)], "e string")
        row = df.select((F.unix_micros(epoch_to_ts(F.col("e"))) / 1e6).alias("s")).first()
        assert row.s == expected
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def random_rows(n=400, span=60_000, seed=7):
    pick = random.Random(seed)
    rows = []
    for i in range(n):
        start = pick.randrange(span)
        if pick.random() < 0.3:
            start -= start % 3600
        end = start + pick.choice([0, 1, 59, 60, 3599, 3600, 3601, pick.randrange(40_000)])
        if pick.random() < 0.3:
            end += -end % 3600
        rows.append((i, start, end))
    return rows


def per_second(rows):
    """Brute force: put every second of every interval into its hour."""
    return Counter(
        (i, second - second % 3600) for i, start, end in rows for second in range(start, end)
    )


def test_random_intervals_against_every_second(spark):
    rows = random_rows()
    pieces = pieces_of(split_intervals(log_of(spark, rows), start="start", end="end"))
    expected = per_second(rows)
    assert pieces == {key: (seconds, seconds // 60) for key, seconds in expected.items()}


HOURS = HourRange.between("1970-01-01 03:00", "1970-01-01 07:00")


def test_range_gives_the_same_pieces_inside(spark):
    rows = random_rows(seed=8)
    part = split_intervals(log_of(spark, rows), start="start", end="end", hours=HOURS)
    expected = {
        key: n for key, n in per_second(rows).items() if HOURS.lower <= key[1] < HOURS.upper
    }
    assert seconds_of(part) == expected


def test_outside_seconds_are_kept_on_request(spark):
    rows = random_rows(seed=9)
    pieces = split_intervals(
        log_of(spark, rows), start="start", end="end", hours=HOURS, keep_outside=True
    )
    expected = Counter()
    for (i, b), n in per_second(rows).items():
        expected[i, b if HOURS.lower <= b < HOURS.upper else None] += n
    assert seconds_of(pieces) == expected


def test_range_boundaries_with_fractions(spark):
    lower, upper = HOURS.lower, HOURS.upper
    rows = [
        (0, lower - 10, f"{lower}.5"), (1, f"{upper - 1}.5", upper + 10), (2, upper, upper + 5),
        (3, lower - 5, lower), (4, f"{lower - 1}.9", lower + 1),
    ]
    part = split_intervals(log_of(spark, rows), start="start", end="end", hours=HOURS)
    assert seconds_of(part) == {(1, upper - 3600): 1, (4, lower): 1}


def test_open_end_costs_only_the_range(spark):
    rows = [(0, 0, 253402300799)]
    for keep in (False, True):
        pieces = seconds_of(
            split_intervals(
                log_of(spark, rows), start="start", end="end", hours=HOURS, keep_outside=keep
            )
        )
        inside = {(0, b): 3600 for b in range(HOURS.lower, HOURS.upper, 3600)}
        outside = {(0, None): 253402300799 - 5 * 3600} if keep else {}
        assert pieces == inside | outside


def test_long_intervals_without_a_range(spark):
    end = 86_400 * 365 * 40 + 5
    log = log_of(spark, [(0, 1, end), (1, 0, 1024 * 3600), (2, 0, 1024 * 3600 + 1)])
    pieces = split_intervals(log, start="start", end="end")
    rows = pieces.groupBy("id").agg(
        F.count("*"), F.countDistinct(BUCKET), F.sum("seconds"), F.max("seconds")
    )
    assert sorted(map(tuple, rows.collect())) == [
        (0, 365 * 40 * 24 + 1, 365 * 40 * 24 + 1, end - 1, 3600),
        (1, 1024, 1024, 1024 * 3600, 3600),
        (2, 1025, 1025, 1024 * 3600 + 1, 3600),
    ]


def test_range_before_1970(spark):
    hours = HourRange.between("1969-12-31 20:00", "1969-12-31 22:00")
    rows = [(0, -20_000, 5), (1, -10_801, -10_799)]
    for keep in (False, True):
        pieces = seconds_of(
            split_intervals(
                log_of(spark, rows), start="start", end="end", hours=hours, keep_outside=keep
            )
        )
        inside = {(0, -14400): 3600, (0, -10800): 3600, (0, -7200): 3600, (1, -14400): 1, (1, -10800): 1}
        assert pieces == inside | ({(0, None): 20_005 - 10_800} if keep else {})


def test_columns_are_kept(spark):
    log = log_of(spark, [(1, 0, 10)]).withColumn("state", F.lit("x"))
    assert split_intervals(log, start="start", end="end").columns == [
        *log.columns, "bucket", "seconds", "minutes",
    ]


def test_hour_bucket(spark):
    df = spark.sql("SELECT timestamp_micros(x) AS ts FROM VALUES (-1), (0), (3599999999) AS t(x)")
    rows = df.select(F.unix_seconds(hour_bucket(F.col("ts"))).alias("b")).collect()
    assert [row.b for row in rows] == [-3600, 0, 0]
