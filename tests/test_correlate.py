import numpy as np
import pytest

from airshed.operators import daily_weather, exposure_weather_corr, hourly_weather, safe_corr


def corr_of(spark, xs, ys):
    df = spark.createDataFrame(list(zip(xs, ys)), "x double, y double")
    return df.agg(safe_corr("x", "y").alias("c")).first().c


def test_safe_corr_degenerate_inputs_are_null(spark):
    assert corr_of(spark, [1.0, 1.0, 1.0], [1.0, 2.0, 3.0]) is None   # constant x
    assert corr_of(spark, [1.0], [2.0]) is None                       # one row
    assert corr_of(spark, [None, 2.0], [1.0, None]) is None           # no complete pair
    empty = spark.createDataFrame([], "x double, y double")
    assert empty.agg(safe_corr("x", "y")).first()[0] is None


def test_safe_corr_matches_pearson_on_complete_pairs(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=200)
    y = 0.3 * x + rng.normal(size=200)
    xs = [float(v) for v in x] + [None, 5.0]
    ys = [float(v) for v in y] + [1.0, None]
    assert corr_of(spark, xs, ys) == pytest.approx(float(np.corrcoef(x, y)[0, 1]), rel=1e-12)


def test_two_level_weather_rollup_is_average_of_averages(spark):
    rows = [("2022-04-01 02:00:00", "L", 1.0, None), ("2022-04-01 02:00:00", "L", 3.0, 2.0),
            ("2022-04-01 03:00:00", "L", 8.0, None)]
    w = spark.createDataFrame(rows, "time_date string, location_name string, "
                                    "weather_wind_speed double, weather_precipitation double")
    r = daily_weather(hourly_weather(w)).first()
    assert r.avg_wind_speed == pytest.approx((2.0 + 8.0) / 2)   # not (1+3+8)/3
    assert r.total_precipitation == 2.0                         # NULL hour counts 0


def test_exposure_weather_corr_brute_force(spark):
    rng = np.random.default_rng(11)
    days = [f"2022-04-{d:02d}" for d in range(1, 21)]
    p_rows, w_rows = [], []
    for d in days:
        for h in range(3):
            p_rows.append((f"{d} {h:02d}:00:00", "C", float(rng.integers(1, 50)), int(rng.integers(1, 9))))
            p_rows.append((f"{d} {h:02d}:00:00", "other", 1.0, 1))
            w_rows.append((f"{d} {h:02d}:00:00", "C", float(rng.random() * 10), float(rng.random())))
    p = spark.createDataFrame(p_rows, "time_date string, location_name string, "
                                      "measurement_pm25Atmo double, tourist_estimate int")
    w = spark.createDataFrame(w_rows, "time_date string, location_name string, "
                                      "weather_wind_speed double, weather_precipitation double")
    got = exposure_weather_corr(p, w, "C").first()
    exp_e, exp_w, exp_r = [], [], []
    for d in days:
        seen = {(r[2], r[3]) for r in p_rows if r[0].startswith(d) and r[1] == "C"}
        exp_e.append(sum(a * b for a, b in seen))
        ws = [r for r in w_rows if r[0].startswith(d)]
        exp_w.append(np.mean([r[2] for r in ws]))
        exp_r.append(sum(r[3] for r in ws))
    assert got.corr_exposure_wind == pytest.approx(np.corrcoef(exp_e, exp_w)[0, 1], rel=1e-9)
    assert got.corr_exposure_rain == pytest.approx(np.corrcoef(exp_e, exp_r)[0, 1], rel=1e-9)


def test_corr_plan_filters_both_sides(spark):
    p = spark.createDataFrame([("2022-04-01 00:00:00", "C", 1.0, 1)],
                              "time_date string, location_name string, measurement_pm25Atmo double, "
                              "tourist_estimate int")
    w = spark.createDataFrame([("2022-04-01 00:00:00", "C", 1.0, 1.0)],
                              "time_date string, location_name string, weather_wind_speed double, "
                              "weather_precipitation double")
    plan = exposure_weather_corr(p, w, "C")._jdf.queryExecution().optimizedPlan().toString()
    # the city predicate is inferred for the weather side as well
    assert plan.count("location_name") >= 2 and plan.count("= C") >= 2
