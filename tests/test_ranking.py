"""The bucketed ordered helpers against plain Python."""

import random

from pyspark.sql import functions as F

from docforge.operators import ranking as R


def _data(spark, n=800, keys=3, seed=5):
    rnd = random.Random(seed)
    rows = [(rnd.randint(0, keys - 1), i, rnd.choice([None, rnd.randint(0, 50)]), rnd.randint(0, 9))
            for i in range(n)]
    rnd.shuffle(rows)
    return rows, spark.createDataFrame(rows, "k long, pos long, v long, w long")


def test_row_numbers_running_sums_and_fills(spark):
    rows, df = _data(spark)
    width = 37   # many small buckets per key
    rn = {(r.k, r.pos): r.row_no for r in R.row_number_by_buckets(
        df, [F.col("pos")], F.floor(F.col("pos") / width), partition=["k"]).collect()}
    rs = {(r.k, r.pos): r.cum_w for r in R.running_sum(df, ["k"], "pos", ["w"], width).collect()}
    ff = {(r.k, r.pos): r.last_v for r in R.forward_fill(df, ["k"], "pos", "v", "last_v", width).collect()}
    for k in range(3):
        mine = sorted(r for r in rows if r[0] == k)
        mine.sort(key=lambda r: r[1])
        total, last = 0, None
        for i, (_, pos, v, w) in enumerate(mine, 1):
            total += w
            last = v if v is not None else last
            assert rn[(k, pos)] == i and rs[(k, pos)] == total and ff[(k, pos)] == last


def test_sorted_positions_and_next_after(spark):
    rows, df = _data(spark, seed=9)
    got = {r.pos: r.position for r in R.sorted_positions(df, [F.col("w"), F.col("pos")]).collect()}
    exp = {pos: i for i, (_, pos, _, _) in enumerate(sorted(rows, key=lambda r: (r[3], r[1])), 1)}
    assert got == exp
    pts = df.select("k", F.col("pos").alias("ts"))
    probes = spark.createDataFrame([(k, t) for k in range(3) for t in range(-1, 801, 17)], "k long, at long")
    nxt = {(r.k, r.at): r.nxt for r in R.next_after(pts, ["k"], "ts", probes, "at", "nxt", 50).collect()}
    for (k, at), v in nxt.items():
        later = [p for (kk, p, _, _) in rows if kk == k and p > at]
        assert v == (min(later) if later else None)
