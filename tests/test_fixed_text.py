import random

from timeloom.functions.scalar import ci_format, fixed_text


def test_text_is_that_of_the_exact_value(spark):
    rnd = random.Random(1)
    values = [0.8125, 0.9375, 0.0625, 0.1875, 0.0005, 0.0015, 0.0025, 1.0005, 2.5, 0.0, -0.0, -0.0001, -0.8125, 1e-320, 1e-12, 123456.0625, 2.0 ** 30 + 0.0625,
              0.9995, 0.99949999999999994, 1 / 3]
    values += [rnd.random() for _ in range(400)] + [round(rnd.random(), 4) for _ in range(600)] + [rnd.uniform(-500, 500) for _ in range(200)]
    values += [round(rnd.uniform(0, 3), 3) + 0.0005 for _ in range(600)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    got = {r.i: (r.a, r.b) for r in df.select("i", fixed_text("v").alias("a"), fixed_text("v", 1).alias("b")).collect()}
    for i, v in enumerate(values):
        assert got[i] == (f"{v:.3f}", f"{v:.1f}"), v


def test_no_text_without_a_finite_value(spark):
    df = spark.createDataFrame([(None,), (float("nan"),), (float("inf"),), (-float("inf"),)], "v double")
    assert [r[0] for r in df.select(fixed_text("v")).collect()] == [None] * 4


def test_interval_ties_to_even(spark):
    df = spark.createDataFrame([(0.75, 0.875), (0.875, 0.75)], "lo double, hi double")
    assert [r[0] for r in df.select(ci_format("lo", "hi")).collect()] == ["0.812 (±0.062)"] * 2
