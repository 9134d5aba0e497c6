"""Hand-checked cases and comparisons with brute force on small fixtures."""

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from dustline.functions import geo
from dustline.functions import scalars as S
from dustline.functions.quantiles import conformal_quantile, exact_quantiles
from dustline.operators import calibration, clusters, exposure, fires, kriging, lattice, learning, neighbours, qc, spatial, tables
from dustline.plans import experiments
from dustline.sinks import products
from dustline.sources import ground


def one(spark, expr):
    return spark.range(1).select(expr.alias("x")).first()[0]


def hours(spark, values, start="2024-01-01"):
    t0 = pd.Timestamp(start)
    rows = [("s", (t0 + pd.Timedelta(hours=k)).to_pydatetime(), float(v)) for k, v in enumerate(values)]
    return spark.createDataFrame(rows, "site_id string, hour timestamp, pm25 double")


def test_stuck_run(spark):
    out = qc.flag_stuck(hours(spark, [5] * 7 + [7])).orderBy("hour").collect()
    assert [r["stuck"] for r in out] == [False] * 5 + [True, True, False]


def test_spike_needs_distance_and_scale(spark):
    out = qc.flag_spike(hours(spark, [10] * 12 + [100] + [10] * 12)).orderBy("hour").collect()
    assert [k for k, r in enumerate(out) if r["spike"]] == [12]


@pytest.mark.parametrize("hs,kept", [(range(12), False), ([0, 1, 2, 6, 7, 8, 12, 13, 14, 18, 19, 20], True)])
def test_daily_completeness(spark, hs, kept):
    rows = [("s", dt.datetime(2024, 1, 1, h), 1.0) for h in hs]
    d = qc.daily_mean(spark.createDataFrame(rows, "site_id string, hour timestamp, pm25 double")).collect()
    assert bool(d) is kept
    if kept:
        assert (d[0]["n_hours"], d[0]["min_block_hours"]) == (12, 3)


def test_scalars(spark):
    assert one(spark, geo.haversine_km(F.lit(5.6037), F.lit(-0.1870), F.lit(6.6885), F.lit(-1.6244))) == pytest.approx(199.506199, abs=1e-5)
    assert one(spark, F.degrees(S.wind_from_angle(F.lit(-2.0), F.lit(1.0)))) == pytest.approx(116.565051, abs=1e-5)
    aqi = [one(spark, S.aqi_value(F.lit(v))) for v in (0.0, 9.0, 9.05, 12.0, 35.4, 35.45, 55.5, 150.0, 400.0)]
    assert aqi == [0, 50, 50, 56, 100, 100, 151, 225, 500]
    day = F.lit("2024-01-10").cast("date")
    assert [one(spark, S.product_tier(F.date_sub(day, k), day)) for k in (-1, 0, 1, 6, 7)] == ["forecast", "nowcast", "nrt", "nrt", "final"]
    assert one(spark, S.clip(F.lit(None).cast("double"), 1.0, 2.0)) is None


def test_grid_axes(spark):
    g = spark.range(650 * 455).select(F.floor(F.col("id") / 455).alias("r"), (F.col("id") % 455).alias("c"))
    b = g.agg(F.min(geo.row_lat(F.col("r"))), F.max(geo.row_lat(F.col("r"))), F.min(geo.col_lon(F.col("c"))), F.max(geo.col_lon(F.col("c")))).first()
    assert list(b) == [4.705, 11.195, -3.295, 1.245]


def test_packing(spark):
    d = spark.createDataFrame([(12.34, 1), (0.25, 0), (None, 1)], "pm25 double, inside_aoa int").withColumns(
        {"lower90": F.col("pm25") * 0.5, "upper90": F.col("pm25") * 2, "cams_pm25": F.lit(3.2)})
    rows = products.decode_day(products.encode_day(d)).collect()
    assert [(r["hi"], r["lo"], r["code"], r["pm25_d"]) for r in rows] == [(0, 123, 2, 12.3), (0, 2, 1, 0.2), (0, 0, 0, None)]


@pytest.mark.parametrize("n", [7, 999, 20_000])
def test_exact_quantiles(spark, n):
    rng = np.random.default_rng(n)
    v = np.where(rng.random(n) < 0.4, 3.0, rng.lognormal(size=n) * 10)
    df = spark.createDataFrame(pd.DataFrame({"k": np.arange(n) % 2, "v": v}))
    probs = {"a": 0.02, "b": 0.5, "c": 0.9, "d": 0.995}
    for row in exact_quantiles(df, ["k"], F.col("v"), probs).collect():
        part = v[np.arange(n) % 2 == row["k"]]
        assert [row[p] for p in probs] == pytest.approx([np.percentile(part, 100 * q) for q in probs.values()])
    whole = exact_quantiles(df, [], F.col("v"), probs).first()
    assert whole["c"] == pytest.approx(np.percentile(v, 90))


def test_conformal(spark):
    df = spark.createDataFrame([(float(k),) for k in range(1, 11)], "s double")
    assert tuple(conformal_quantile(df, [], F.col("s"), {"x": 0.1, "y": 0.32}).first()) == (10.0, 8.0)


def test_bilinear_renormalises(spark):
    d = dt.date(2024, 1, 1)
    nodes = spark.createDataFrame([(0.0, 0.0, d, 10.0), (1.0, 0.0, d, 20.0), (1.0, 1.0, d, 40.0), (0.0, 1.0, d, None)], "lat double, lon double, date date, v double")
    shape = lattice.LatticeShape(0.0, 0.0, 1.0, 1.0, 2, 2)
    pts = spark.createDataFrame([(1, 0.5, 0.5, d), (2, -3.0, 0.0, d), (3, 0.5, 0.5, dt.date(2024, 1, 2))], "id int, lat double, lon double, date date")
    got = {r["id"]: (r["v"], r["v_lag1"]) for r in lattice.sample(pts, nodes, shape, ["v"], {"v": (1,)}).collect()}
    assert got[1] == (pytest.approx(70 / 3), None)
    assert got[2][0] == pytest.approx(10.0)
    assert got[3] == (None, pytest.approx(70 / 3))


def _cloud(n, seed):
    rng = np.random.default_rng(seed)
    hot = rng.random(n) < 0.4  # a dense town
    lat = np.where(hot, 5.6 + rng.normal(size=n) * 0.02, rng.uniform(4, 13, n))
    lon = np.where(hot, -0.2 + rng.normal(size=n) * 0.02, rng.uniform(-9, 9, n))
    return lat, lon


def test_nearest_matches_brute_force(spark):
    tl, to = _cloud(150, 1)
    sl, so = _cloud(40, 2)
    t = spark.createDataFrame(pd.DataFrame({"t": range(150), "lat": tl, "lon": to}))
    s = spark.createDataFrame(pd.DataFrame({"s": range(40), "src_lat": sl, "src_lon": so}))
    d = kriging._haversine(tl[:, None], to[:, None], sl[None], so[None])
    got = {r["t"]: (r["s"], r["dist_km"]) for r in neighbours.nearest(t, s, ["t"], "s").collect()}
    assert {k: v[0] for k, v in got.items()} == dict(enumerate(d.argmin(1)))
    near = neighbours.within_km(t, s, 25.0, right_at=("src_lat", "src_lon")).select("t", "s").collect()
    assert {tuple(r) for r in near} == {(i, j) for i, j in zip(*np.nonzero(d <= 25))}


def test_fire_kernels_match_brute_force(spark):
    rng = np.random.default_rng(3)
    d = dt.date(2024, 1, 5)
    f = pd.DataFrame({"date": [d - dt.timedelta(days=int(k % 3)) for k in range(60)], "latitude": rng.uniform(4, 12, 60),
                      "longitude": rng.uniform(-4, 3, 60), "frp": rng.uniform(1, 50, 60)})
    t = pd.DataFrame({"id": range(5), "date": [d] * 5, "lat": rng.uniform(5, 11, 5), "lon": rng.uniform(-3, 1, 5), "u10": rng.normal(size=5), "v10": rng.normal(size=5)})
    got = fires.kernel_features(spark.createDataFrame(t), spark.createDataFrame(f), ["id"]).orderBy("id").toPandas()
    use = f[f.date >= d - dt.timedelta(days=1)]
    la, lo = np.round(use.latitude / 0.05) * 0.05, np.round(use.longitude / 0.05) * 0.05
    for k, r in t.iterrows():
        dx, dy = (r.lon - lo) * 111.32 * np.cos(np.radians(r.lat)), (r.lat - la) * 111.32
        dist = np.hypot(dx, dy) + 1e-3
        up = np.clip((dx * r.u10 + dy * r.v10) / (dist * (np.hypot(r.u10, r.v10) + 1e-6)), 0, None) * np.exp(-dist / 150) * (dist < 500)
        want = [np.log1p((use.frp * w).sum()) for w in (np.exp(-dist ** 2 / 200), np.exp(-dist ** 2 / 5000), up)]
        assert got.loc[k, ["frp_25km", "frp_100km", "fire_upwind"]].tolist() == pytest.approx(want, abs=1e-9)


def test_kriging_group(spark):
    rng = np.random.default_rng(4)
    sl, so, res = rng.uniform(5, 8, 12), rng.uniform(-2, 1, 12), rng.normal(size=12) * 0.3
    t = pd.DataFrame({"cell": range(6), "date": [1, 1, 1, 1, 2, 2], "lat": rng.uniform(5, 8, 6), "lon": rng.uniform(-2, 1, 6)})
    s = pd.DataFrame({"date": [1] * 12, "lat": sl, "lon": so, "resid": res})
    c0, length, var = 0.6, 50.0, 0.1
    got = kriging.krige(spark.createDataFrame(t), spark.createDataFrame(s), ["cell"], ["date"], c0, length, var).orderBy("cell").toPandas()
    cov = c0 * var * np.exp(-kriging._haversine(sl[:, None], so[:, None], sl, so) / length) + ((1 - c0) * var + 1e-6 * var) * np.eye(12)
    c = c0 * var * np.exp(-(d := kriging._haversine(t.lat.to_numpy()[:4, None], t.lon.to_numpy()[:4, None], sl, so)) / length) * (d <= 300)
    assert got.rk_mean[:4].to_numpy() == pytest.approx(c @ np.linalg.solve(cov, res))
    assert got.rk_var[:4].to_numpy() == pytest.approx(np.maximum(var - np.einsum("ij,jk,ik->i", c, np.linalg.inv(cov), c), (1 - c0) * var))
    assert got.rk_mean[4:].tolist() == [0, 0] and got.rk_var[4:].tolist() == pytest.approx([var, var])


def test_pair_bins_do_not_depend_on_blocks(spark, monkeypatch):
    lat, lon = _cloud(90, 5)
    df = spark.createDataFrame(pd.DataFrame({"site_id": range(90), "date": np.arange(90) % 2, "lat": lat, "lon": lon, "resid": np.sin(np.arange(90))}))
    whole = {r["bin"]: (r["n_pairs"], round(r["sum_prod"], 9)) for r in kriging.pair_bins(df).collect()}
    monkeypatch.setattr(kriging, "PAIR_BLOCK", 7)
    assert {r["bin"]: (r["n_pairs"], round(r["sum_prod"], 9)) for r in kriging.pair_bins(df).collect()} == whole


def test_exponential_fit():
    pts = [{"km": k, "corr": 0.7 * np.exp(-k / 60), "n_pairs": 100} for k in (1.0, 3.5, 7.5, 15.0, 42.0, 87.0, 175.0)]
    c0, length = kriging.fit_exponential(pts)
    assert (c0, length) == (pytest.approx(0.7, abs=1e-3), pytest.approx(60, rel=1e-3))


def test_complete_linkage_matches_definition(spark):
    rng = np.random.default_rng(6)
    lat, lon = 5.6 + rng.normal(size=30) * 0.2, -0.2 + rng.normal(size=30) * 0.2
    df = spark.createDataFrame(pd.DataFrame({"site_id": range(30), "lat": lat, "lon": lon}))
    got = {r["site_id"]: r["cluster"] for r in clusters.site_clusters(df).collect()}
    assert [got[k] for k in range(30)] == clusters.linkage_by_definition(lat, lon, 30.0).tolist()


def test_fold_packing_keeps_groups_whole(spark):
    df = spark.createDataFrame([(g, k) for g in range(10) for k in range(6)], "g int, k int")
    out = learning.group_folds(df, "g", 5)
    assert out.groupBy("g").agg(F.count_distinct("fold").alias("n")).where("n > 1").count() == 0
    assert {r["count"] for r in out.groupBy("fold").count().collect()} == {12}


def test_sample_weight_offset_and_circle(spark):
    df = spark.createDataFrame([(k, "c", 0.1) for k in range(4)], "site_id int, cluster string, cal_sigma_log double")
    assert learning.sample_weights(df).first()["weight"] == pytest.approx(0.5)
    r = spark.createDataFrame([("s", 1.0)] * 5, "site_id string, resid double")
    assert kriging.site_offsets(r).first()["offset"] == 0.25


def test_nnls_recovers_weights(spark):
    rng = np.random.default_rng(7)
    p = rng.normal(3, 1, size=(400, 4))
    df = pd.DataFrame(p, columns=["lgbm", "xgb_ratio", "catboost", "extratrees"]).assign(y=0.3 * p[:, 0] + 0.7 * p[:, 1], weight=1.0, fold=np.arange(400) % 4)
    st = learning.stack_weights(spark.createDataFrame(df))
    assert list(st["weights"].values()) == pytest.approx([0.3, 0.7, 0, 0], abs=1e-6)
    nested = learning.nested_stack(spark.createDataFrame(df)).agg(F.max(F.abs(F.col("stack") - F.col("y")))).first()[0]
    assert nested < 1e-6


def test_huber_resists_outliers(spark):
    rng = np.random.default_rng(8)
    x, rh = rng.uniform(1, 4, 600), rng.uniform(40, 90, 600)
    y = 0.4 + 0.8 * x + 0.5 * rh / 100 + rng.normal(size=600) * 0.05
    y[:30] += 4
    df = spark.createDataFrame(pd.DataFrame({"key": "k", "x": x, "y": y, "rh": rh}))
    m = calibration.huber_fit(df, ["key"]).first()
    assert (m["b"], m["c"]) == (pytest.approx(0.8, abs=0.03), pytest.approx(0.5, abs=0.1))


def test_scale_model_and_applicability(spark):
    rng = np.random.default_rng(9)
    x = rng.uniform(0, 1, 800)
    df = spark.createDataFrame(pd.DataFrame({"id": range(800), "fold": np.arange(800) % 4, "x": x, "z": rng.normal(size=800), "e": np.abs(rng.normal(size=800)) * (0.1 + x)}))
    m = learning.ScaleModel.fit(df, F.col("e"), ["x", "z"])
    s = m.predict(df).toPandas()
    assert s[s.x > 0.8].sigma.mean() > 2 * s[s.x < 0.2].sigma.mean()
    assert s.sigma.mean() == pytest.approx(s.e.mean(), rel=0.05)
    a = learning.Applicability.fit(df, ["x", "z"], [2.0, 1.0], ["id"])
    far = df.limit(2).withColumn("x", F.col("x") + 50)
    assert a.score(far).agg(F.max("inside_aoa")).first()[0] == 0
    assert a.score(df).agg(F.max("aoa_di")).first()[0] == pytest.approx(0, abs=1e-12)


def test_upsert_is_idempotent(spark):
    old = spark.createDataFrame([("s", 1, 5.0)], "site string, d int, v double")
    new = spark.createDataFrame([("s", 1, 7.0)], "site string, d int, v double")
    once = tables.upsert(old, new, ["site", "d"])
    assert [tuple(r) for r in tables.upsert(once, new, ["site", "d"]).collect()] == [("s", 1, 7.0)]


def test_trailing_mean(spark):
    rows = [(dt.date(2024, 1, k + 1), float(k)) for k in range(6)]
    df = spark.createDataFrame(rows, "date date, v double").withColumn("g", F.lit(1))
    got = [r["m"] for r in exposure.trailing_mean(df, ["g"], "v", 7, 4, "m").orderBy("date").collect()]
    assert got == [None, None, None, 1.5, 2.0, 2.5]


def test_rain_scaling(spark):
    def total(n):
        t0 = pd.Timestamp("2024-01-01")
        rows = [("w", (t0 + pd.Timedelta(minutes=5 * k)).to_pydatetime(), "pr", 10.0 / n) for k in range(n)]
        return qc.weather_daily(spark.createDataFrame(rows, "code string, time timestamp, variable string, value double")).first()["precip"]

    assert total(240) == pytest.approx(12.0)
    assert total(215) is None


def test_smoothing_matches_direct_filter(spark):
    rng = np.random.default_rng(10)
    a = rng.uniform(size=(30, 20))
    df = spark.createDataFrame(pd.DataFrame({"row": np.repeat(np.arange(30), 20), "col": np.tile(np.arange(20), 30), "v": a.ravel()}))
    w = np.array(spatial.gaussian_weights(3.0 / 1.1132))
    rad = len(w) // 2
    want = a.copy()
    for axis in (0, 1):
        pad = np.pad(want, [(rad, rad) if k == axis else (0, 0) for k in (0, 1)], mode="edge")
        want = np.apply_along_axis(lambda v: np.convolve(v, w, "valid"), axis, pad)
    got = spatial.gaussian_smooth(df, ["v"], 3.0, 30, 20, block=8).orderBy("row", "col").toPandas().v.to_numpy().reshape(30, 20)
    assert got == pytest.approx(want, abs=1e-9)


# ---- folds, lines, dates, humidity -------------------------------------------
def test_group_folds_equal_greedy_packing_beyond_any_number_of_groups(spark):
    rng = np.random.default_rng(3)
    sizes = {g: int(n) for g, n in enumerate(rng.choice([1, 1, 1, 2, 3, 7, 40], 6000))} | {9000: 2500, 9001: 30}
    loads, want = [0] * 5, {}
    for g, n in sorted(sizes.items(), key=lambda x: (-x[1], x[0])):
        want[g] = loads.index(min(loads))
        loads[want[g]] += n
    df = spark.createDataFrame([(g,) for g, n in sizes.items() for _ in range(n)], "g long")
    got = {r["g"]: r["fold"] for r in learning.group_folds(df, "g", 5).distinct().collect()}
    assert got == want


def test_every_point_has_a_distance_to_the_lines(spark):
    points = spark.createDataFrame([(1, 0.0, 0.0), (2, 0.0, 0.6), (3, 0.0, 25.0), (4, -60.0, -170.0)], "cell long, lat double, lon double")
    lines = spark.createDataFrame([(0.0, -1.0, 0.0, 1.0)], "x1 double, y1 double, x2 double, y2 double")
    got = {r["cell"]: r["dist_line_km"] for r in spatial.distance_to_lines(points, lines, ["cell"], 0.0).collect()}
    assert got[1] == 0 and abs(got[2] / 111.32 - 0.6) < 1e-6 and abs(got[3] / 111.32 - 25) < 1e-6
    assert abs(got[4] / 111.32 - math.hypot(170, 59)) < 1e-6
    none = spatial.distance_to_lines(points, lines.limit(0), ["cell"], 0.0).collect()
    assert len(none) == 4 and all(r["dist_line_km"] is None for r in none)


def test_archive_dates_come_only_from_the_end_of_a_name(spark, tmp_path):
    import gzip
    folder = tmp_path / "locationid=7" / "year=2024" / "month=01"
    folder.mkdir(parents=True)
    head = "location_id,sensors_id,location,datetime,lat,lon,parameter,units,value\n"
    names = {"part-00000-12345678-1111-2222-3333-444444444444.c000.csv.gz": 1.0, "location-7-20240105.csv.gz": 2.0, "location-7-20240115.csv.gz": 3.0}
    for name, value in names.items():
        with gzip.open(folder / name, "wt") as f:
            f.write(head + f"7,9,x,2024-01-20T00:00:00+00:00,5.0,0.0,pm25,ug,{value}\n")
    got = sorted(r["value"] for r in ground.read_archive(spark, str(tmp_path), "2024-01-11").collect())
    assert got == [1.0, 3.0]
    for year, month in ((2023, "12"), (2024, "02"), (2025, "01")):
        folder = tmp_path / "locationid=7" / f"year={year}" / f"month={month}"
        folder.mkdir(parents=True)
        with gzip.open(folder / f"location-7-{year}{month}03.csv.gz", "wt") as f:
            f.write(head + f"7,9,x,2024-01-20T00:00:00+00:00,5.0,0.0,pm25,ug,{year % 100}\n")
    df = ground.read_archive(spark, str(tmp_path), "2024-01-11")
    assert sorted(r["value"] for r in df.collect()) == [1.0, 3.0, 24.0, 25.0]
    assert len(df.inputFiles()) == 4  # the others were never listed for the scan
    assert ground.read_archive(spark, str(tmp_path), "2026-01-01").count() == 0


def test_humidity_source_matters_for_the_log_linear_correction(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(240):
        rh, x = float(rng.uniform(20, 95)), float(rng.uniform(5, 80))
        rows.append((f"s{i % 4}", "net", dt.date(2023, 1 + i % 12, 1 + i % 28), x, x * float(np.exp(-0.8 * rh / 100 + 0.05 * rng.standard_normal())), rh, float(rng.uniform(20, 95))))
    df = spark.createDataFrame(rows, "site_id string, network string, date date, pm25 double, pm25_ref double, good double, noise double")
    got = {(r["kind"], r["humidity"]): r["rmse"] for r in experiments.humidity_comparison(df, ["good", "noise"]).where("key = 'net'").collect()}
    assert set(got) == {("identity", "none"), ("ratio", "good"), ("ratio", "noise"), ("loglinear", "good"), ("loglinear", "noise")}
    assert got[("loglinear", "good")] < got[("loglinear", "noise")] < got[("identity", "none")]


def test_upsert_log_compacts_itself(spark, tmp_path):
    from dustline.streaming.ingest import UpsertLog
    log = UpsertLog(spark, str(tmp_path / "log"), ["k"], compact_every=3)
    for i in range(7):
        log.write(spark.createDataFrame([(0, i), (i + 10, i)], "k int, v int"), i)
    log.write(spark.createDataFrame([(0, 99)], "k int, v int"), 1)  # a late replay changes nothing
    assert log._finished("base") == [(0, 2), (0, 5)]
    assert log._pending() == ((0, 5), [(0, 6)])
    assert {r["k"]: r["v"] for r in log.read().collect()} == {0: 6, **{i + 10: i for i in range(7)}}
