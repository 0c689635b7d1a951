"""The skew-safe consecutive-pairs operator against a brute-force lead."""

import random
from collections import Counter

from rankwalk.operators.sequence import consecutive_pairs


def brute_force(rows):
    out = Counter()
    by_group = {}
    for g, o1, o2, v in rows:
        by_group.setdefault(g, []).append((o1, o2, v))
    for items in by_group.values():
        items.sort()
        for a, b in zip(items, items[1:]):
            out[(a[2], b[2])] += 1
    return out


def test_pairs_match_brute_force_with_a_hot_group(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(3000):
        # group 0 holds about a third of all rows
        g = 0 if i % 3 == 0 else rnd.randint(1, 200)
        rows.append((g, rnd.randint(0, 50), i, f"s{rnd.randint(0, 6)}"))
    df = spark.createDataFrame(rows, "g long, o1 int, o2 int, v string")
    for parts in (1, 5, 16):
        got = {(r["src"], r["dst"]): r["cnt"]
               for r in consecutive_pairs(df, "g", ["o1", "o2"], "v", partitions=parts).collect()}
        assert got == dict(brute_force(rows)), parts


def test_single_group_spread_over_all_partitions(spark):
    rows = [(1, i, 0, f"x{i % 4}") for i in range(500)]
    df = spark.createDataFrame(rows, "g long, o1 int, o2 int, v string")
    got = {(r["src"], r["dst"]): r["cnt"]
           for r in consecutive_pairs(df, "g", ["o1", "o2"], "v", partitions=8).collect()}
    assert sum(got.values()) == 499
    assert got == dict(brute_force(rows))


def test_null_values_keep_their_place_and_exchange_reuse_does_not_matter(spark):
    rows = [(1, 1, 0, "a"), (1, 2, 0, None), (1, 3, 0, "b"), (1, 4, 0, "c"), (None, 1, 0, "x"), (None, 2, 0, "y")]
    df = spark.createDataFrame(rows, "g long, o1 int, o2 int, v string")
    many = spark.createDataFrame([(i // 500, i, 0, f"x{i % 3}") for i in range(4000)], "g long, o1 int, o2 int, v string")
    for reuse in ("true", "false"):
        spark.conf.set("spark.sql.exchange.reuse", reuse)
        try:
            for parts in (1, 3, 7):
                got = consecutive_pairs(df, "g", ["o1", "o2"], "v", partitions=parts).collect()
                assert [tuple(r) for r in got] == [("b", "c", 1)]
                assert sum(r["cnt"] for r in consecutive_pairs(many, "g", ["o1", "o2"], "v", partitions=parts).collect()) == 4000 - 8
        finally:
            spark.conf.unset("spark.sql.exchange.reuse")
