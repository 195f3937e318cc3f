import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from eocube.cube import Datacube
from eocube.errors import DatacubeOperationError
from eocube.functions import freq, query_lang
from eocube.operators import ops, temporal, whittaker


def daily(cube, n=30):
    return cube([(f"2024-01-{d:02d} 10:00:00", 0.0, float(x), float(d * (x + 1))) for d in range(1, n + 1) for x in range(2)], ["b"])


def test_labels(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-02-14 10:30:00' AS t, timestamp_ntz'2024-01-31 00:00:00' AS o")
    want = {"1ME": "2024-02-29", "MS": "2024-02-01", "1W": "2024-02-18", "W-WED": "2024-02-14", "QE": "2024-03-31", "YE": "2024-12-31", "7D": "2024-02-14", "10D": "2024-02-10", "1D": "2024-02-14", "6H": "2024-02-14 06:00:00", "2ME": "2024-02-29"}
    for f, label in want.items():
        origin = F.col("o") if freq.needs_origin(f) else None
        assert str(df.select(freq.bucket(F.col("t"), f, origin)).first()[0]) == label, f
    for bad in ("", "5", "1XX"):
        with pytest.raises(ValueError):
            freq.parse(bad)


@pytest.mark.parametrize(("method", "want"), [("mean", 15.5), ("median", 15.5), ("min", 1), ("max", 30), ("sum", 465), ("var", np.var(np.arange(1, 31))), ("std", np.std(np.arange(1, 31)))])
def test_methods(cube, method, want):
    out = temporal.temporal_aggregate(daily(cube), method).where("x = 0").collect()
    assert [str(r.time) for r in out] == ["2024-01-31"] and out[0].b == pytest.approx(want)


def test_missing_values_are_skipped_and_gaps_filled(cube):
    df = cube([("2024-01-05", 0.0, 0.0, 1.0), ("2024-01-06", 0.0, 0.0, float("nan")), ("2024-04-01", 0.0, 0.0, 5.0)], ["b"])
    out = Datacube(df).temporal_aggregate("mean").df
    assert sorted((str(r.time), r.b) for r in out.collect()) == [("2024-01-31", 1.0), ("2024-04-30", 5.0)]
    filled = temporal.temporal_aggregate(Datacube(df).df, "mean", fill_gaps=True)
    assert [r.b for r in filled.orderBy("time").collect()] == [1.0, None, None, 5.0]


def test_errors(cube):
    df = daily(cube, 2)
    with pytest.raises(ValueError):
        temporal.temporal_aggregate(df, "most")
    with pytest.raises(ValueError):
        temporal.temporal_aggregate(df, groupby="time.month")
    with pytest.raises(DatacubeOperationError):
        temporal.temporal_aggregate(df.drop("time"))
    with pytest.raises(DatacubeOperationError, match="2024-01-01"):
        ops.select_time(df, "2030", "2031", check=True)


def test_select_time_ends(cube):
    df = daily(cube)
    assert ops.select_time(df, "2024-01-03", "2024-01-04").select("time").distinct().count() == 2
    assert ops.select_time(df) is df


def test_dates_only_change_where_one_repeats(cube):
    one = cube([("2024-01-01 10:00:00", 0.0, 0.0, 1.0), ("2024-01-02 11:00:00", 0.0, 0.0, 3.0)], ["b"])
    two = one.union(cube([("2024-01-02 12:00:00", 0.0, 0.0, 5.0)], ["b"]))
    assert {str(r.time) for r in temporal.by_date_if_repeated(one).collect()} == {"2024-01-01 10:00:00", "2024-01-02 11:00:00"}
    assert {(str(r.time), r.b) for r in temporal.by_date_if_repeated(two).collect()} == {("2024-01-01 00:00:00", 1.0), ("2024-01-02 00:00:00", 4.0)}


@pytest.mark.parametrize(("m", "beta"), [(5, 1.0), (10, 1000.0), (100, 2000.0)])
def test_penalty_is_the_product_of_differences(m, beta):
    d = np.diff(np.eye(m), 3, axis=0)
    full, band = beta * d.T @ d, whittaker.penalty(m, beta)
    for k in range(-3, 4):
        for i in range(max(0, -k), min(m, m - k)):
            assert band[3 + k, i] == pytest.approx(full[i, i + k])
    assert not whittaker.penalty(m, 0).any()


def test_solver_against_dense(rng=np.random.default_rng(3)):
    m = 40
    y, w = rng.normal(size=(6, m)), (rng.random((6, m)) < 0.5).astype(float)
    d = np.diff(np.eye(m), 3, axis=0)
    z = whittaker.solve(y, w, 50.0)
    for i in range(6):
        want = np.linalg.solve(np.diag(w[i]) + 50.0 * d.T @ d, w[i] * y[i])
        assert z[i] == pytest.approx(want, abs=1e-6)
    assert whittaker.solve(y, np.zeros((6, m)), 1.0) == pytest.approx(y)


def test_smoother_on_a_cube(cube):
    df = cube([(f"2024-01-{d:02d}", 0.0, float(x), None if x == 2 or d == 9 else 3.0 * d + x) for d in range(1, 20, 2) for x in range(3)], ["b"])
    out = {(r.x, r.day.day): r.b for r in whittaker.smooth(df, 100.0).collect()}
    assert out[0.0, 5] == pytest.approx(15.0, abs=1e-4) and out[1.0, 9] == pytest.approx(28.0, abs=1e-3)  # a line stays a line, a gap is bridged
    assert out[2.0, 5] is None or np.isnan(out[2.0, 5])


def test_ranges():
    p = query_lang.parse_range
    assert p("2024-02")[1] == dt.datetime(2024, 2, 29, 23, 59, 59, 999999)
    assert p("../2024")[0] is None and p(("2024-01-01", None))[1] is None
    chunks = query_lang.split_range("2024-01-01/2024-01-10", 3)
    assert chunks[0][1] == dt.datetime(2024, 1, 10, 23, 59, 59, 999999) and chunks[-1][0] == dt.datetime(2024, 1, 1)
    assert all(a[0] - b[1] == dt.timedelta(microseconds=1) for a, b in zip(chunks, chunks[1:], strict=False))
    for bad in (("2024-01-01/..", 3), ("2024-01-01/2024-01-10", 0), ("2024-01-10/2024-01-01", 3)):
        with pytest.raises(ValueError):
            query_lang.split_range(*bad)


def test_gap_fill_and_as_of(spark):
    df = spark.sql("SELECT * FROM VALUES (1, date'2024-01-01', 1D), (1, date'2024-01-05', 9D), (2, date'2024-01-03', 4D) AS t(p, time, v)")
    out = sorted((r.p, r.day.day, r.v) for r in temporal.gap_fill(df, "v", ["p"]).collect())
    assert out == [(1, 1, 1.0), (1, 2, 3.0), (1, 3, 5.0), (1, 4, 7.0), (1, 5, 9.0), (2, 3, 4.0)]
    asked = spark.sql("SELECT * FROM VALUES (1, date'2024-01-04'), (2, date'2024-01-01') AS t(p, time)")
    assert {(r.p, r.v) for r in temporal.fill_dates(df, asked, "v", ["p"]).collect()} == {(1, 1.0), (2, None)}
    assert {(r.p, r.v) for r in temporal.fill_dates(df, asked, "v", ["p"], "bfill").collect()} == {(1, 9.0), (2, 4.0)}
