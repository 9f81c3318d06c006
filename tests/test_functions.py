import xxhash
from pyspark.sql import functions as F

from stargrain.functions import (
    guarded_ratio,
    match_key,
    match_result,
    person_name,
    points,
    ratio,
    surrogate_key,
    verdict,
    winner,
)


def test_key_ignores_case_and_outer_spaces(frame):
    df = frame("name string", ("Spain",), ("  spain ",), ("SPAIN",))
    assert df.select(surrogate_key("name").alias("k")).distinct().count() == 1


def test_key_value_is_the_hash_of_the_normalised_text(frame):
    (key,) = frame("a string, b int", (" x ", 7)).select(surrogate_key("a", "b")).first()
    assert key == xxhash.xxh64_intdigest(b"X||7", seed=42) - (
        2**64 if xxhash.xxh64_intdigest(b"X||7", seed=42) >= 2**63 else 0
    )


def test_q2_missing_part_gives_no_key(frame):
    df = frame("a string, b string", ("x", None), (None, None), ("x", "y"))
    keys = [r.k for r in df.select(surrogate_key("a", "b").alias("k")).collect()]
    assert keys[0] is None and keys[1] is None and keys[2] is not None
    kept = df.select(surrogate_key("a", optional=("b",)).alias("k")).collect()
    assert kept[0].k is not None and kept[1].k is None


def test_match_key_is_three_part(frame):
    df = frame("h string, a string, d string", ("A", "B", "2026-06-11"))
    row = df.select(match_key("h", "a", F.col("d").cast("date")).alias("x"), surrogate_key("h", "a", "d").alias("y")).first()
    assert row.x == row.y


def test_q3_blank_names_are_missing(frame):
    df = frame("g string, f string", (None, None), ("", " "), ("Ana", None), ("Ana", "Lima"))
    assert [r.n for r in df.select(person_name("g", "f").alias("n")).collect()] == [None, None, "Ana", "Ana Lima"]


MATCHES = (
    (2, 1, None, None),
    (1, 1, None, None),
    (1, 1, 5, 4),
    (0, 0, 3, 4),
    (1, 1, 3, 3),  # Q6: level shoot-out
    (None, 1, None, None),  # Q5: not played
)


def test_results_points_and_winner(frame):
    df = frame("h int, a int, hp int, ap int", *MATCHES)
    result = match_result("h", "a", "hp", "ap")
    away = match_result("a", "h", "ap", "hp")
    got = df.select(result, points(result), winner(result, F.lit("home"), F.lit("away")), away).collect()
    assert [tuple(r) for r in got] == [
        ("W", 3, "home", "L"),
        ("D", 1, None, "D"),
        ("W", 3, "home", "L"),  # Q4: decided by the shoot-out
        ("L", 0, "away", "W"),
        ("D", 1, None, "D"),
        (None, None, None, None),
    ]


def test_two_kinds_of_ratio(frame):
    df = frame("n double, d double", (1.0, 2.0), (1.0, 0.0), (1.0, None), (None, 2.0), (1.0, -2.0))
    got = [tuple(r) for r in df.select(ratio("n", "d"), guarded_ratio("n", "d")).collect()]
    assert got == [(0.5, 0.5), (None, 0.0), (None, 0.0), (None, None), (-0.5, 0.0)]


def test_verdict(frame):
    df = frame("h int, a int, hp double, ap double", (2, 0, 88.0, 5.0), (0, 1, 60.0, 20.0), (1, 1, 60.0, 20.0), (0, 3, 10.0, 70.0))
    assert [r.v for r in df.select(verdict("h", "a", "hp", "ap").alias("v")).collect()] == [
        "fav_won", "upset", "draw", "fav_won",
    ]
