import math
import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from roadpulse.functions.numeric import fixed_text, round_exact, steady_avg
from roadpulse.functions.times import before, instant, iso_text

TIES = [0.125, 0.375, 0.345, 0.705, 2.675, 1.005, 0.15, 0.25, 0.35, 43.25, 1e-7, 0.0, 30.0561235]


def _check_rounding(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = df.select(
        "x",
        round_exact("x", 1).alias("r1"),
        round_exact("x", 2).alias("r2"),
        round_exact("x", 6).alias("r6"),
        fixed_text("x", 1).alias("t1"),
        fixed_text("x", 2).alias("t2"),
    ).collect()
    for r in got:
        assert (r.r1, r.r2, r.r6) == (round(r.x, 1), round(r.x, 2), round(r.x, 6)), r
        assert (r.t1, r.t2) == (f"{r.x:.1f}", f"{r.x:.2f}"), r


def test_rounding_matches_correctly_rounded_decimals(spark):
    rnd = random.Random(7)
    ratios = [a / b for a in range(0, 400, 7) for b in (3, 8, 16, 200, 312, 1110)]
    _check_rounding(spark, TIES + ratios + [rnd.uniform(0, 1000) for _ in range(2000)])


@settings(max_examples=5, deadline=None)
@given(st.lists(st.floats(min_value=0, max_value=1e6, allow_nan=False), min_size=1, max_size=200))
def test_rounding_property(spark, values):
    _check_rounding(spark, values)


def test_rounding_keeps_odd_values(spark):
    df = spark.createDataFrame([(float("nan"),), (float("inf"),), (None,), (1e300,)], "x double")
    got = [r[0] for r in df.select(round_exact("x", 2)).collect()]
    assert math.isnan(got[0]) and got[1] == float("inf") and got[2] is None and got[3] == 1e300


def test_average_does_not_depend_on_order(spark):
    rnd = random.Random(3)
    values = [rnd.choice([0.1, 0.2, 0.7, 1.3, 33.3]) for _ in range(5000)]
    seen = set()
    for parts in (1, 3, 8):
        rnd.shuffle(values)
        df = spark.createDataFrame([(v,) for v in values], "x double").repartition(parts)
        seen.add(df.agg(steady_avg("x")).first()[0])
    assert len(seen) == 1
    assert math.isclose(seen.pop(), math.fsum(values) / len(values), rel_tol=1e-12)


def test_average_on_a_threshold_stays_there(spark):
    df = spark.createDataFrame([(0.7,)] * 10, "x double")
    assert df.agg(steady_avg("x")).first()[0] == 0.7


def test_average_of_odd_values_leaves_nothing_out(spark):
    def mean(*values):
        df = spark.createDataFrame([(v,) for v in values], "x double")
        return df.agg(steady_avg("x")).first()[0]

    assert mean(1.0, None, 2.0) == 1.5
    assert mean(None, None) is None
    assert math.isnan(mean(1.0, float("nan")))
    assert mean(1.0, float("inf")) == float("inf")
    assert mean(1e12, 3e12) == 2e12
    # five values whose integer sum leaves 64 bits
    assert math.isclose(mean(*[8.9e9] * 5), 8.9e9)
    assert mean(-1.5, -2.5) == -2.0


def test_moments_are_utc(spark):
    one = spark.range(1).select(
        instant("2024-01-31 00:00:00").cast("string"),
        before("2024-01-31", days=1, hours=2, secs=5).cast("string"),
        iso_text(instant("2024-01-31T01:02:03.000450")),
        iso_text(instant("2024-01-31T01:02:03")),
    )
    assert tuple(one.first()) == (
        "2024-01-31 00:00:00",
        "2024-01-29 21:59:55",
        "2024-01-31T01:02:03.000450Z",
        "2024-01-31T01:02:03Z",
    )
    assert spark.range(1).select(instant()).first()[0] is not None
    assert spark.range(1).select(instant(F.current_timestamp())).first()[0] is not None
