"""Distributed mechanisms against plain computations: ranks, selection, metric and cube joins, blocks, state with timers."""

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from dustline import params as P
from dustline.functions import quantiles, ranking
from dustline.operators import fires, kriging, metric, neighbours, qc, spatial


def haversine(a, b, c, d):
    return kriging._haversine(np.asarray(a), np.asarray(b), np.asarray(c), np.asarray(d))


# ---- ranks and selection -------------------------------------------------------
def test_numbered_equals_a_ranking_window(spark):
    rng = np.random.default_rng(1)
    g = np.where(rng.random(3000) < 0.4, 0, rng.integers(1, 400, 3000))  # one group with 40 % of the rows
    df = spark.createDataFrame(pd.DataFrame({"g": [None if x == 7 else f"k{x:03d}" for x in g], "v": rng.permutation(3000)})).repartition(7)
    got = ranking.numbered(df, ["g"], ["v"], first="f").toPandas()
    frame = df.toPandas()
    key = frame["g"].fillna("")
    frame["e"] = frame.groupby(key)["v"].rank().astype(int) - 1
    frame["n"] = key.map(key.value_counts())
    both = got.merge(frame[["v", "e", "n"]], on="v")
    assert (both["row"] == both["e"]).all() and (both["size"] == both["n"]).all()
    first = got.groupby(got["g"].fillna(""))["f"].agg(["min", "max"])
    assert (first["min"] == first["max"]).all() and first["min"].is_monotonic_increasing and first["min"].is_unique
    assert ranking.numbered(df.limit(0), ["g"], ["v"]).count() == 0
    plan = ranking.numbered(df, ["g"], ["v"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window") == plan.count("Window [") and "row_number" not in plan  # sums over partitions, no ranking of rows


@pytest.mark.parametrize("limit", [20, 100])
def test_brackets_shrink_until_they_are_small(spark, monkeypatch, limit):
    monkeypatch.setattr(quantiles, "BRACKET_ROWS", limit)
    rng = np.random.default_rng(3)
    values = np.concatenate([rng.lognormal(2, 2, 30000), np.full(5000, 3.5), [-1e9, 1e9]])
    group = np.where(rng.random(len(values)) < 0.9, "big", "small")
    df = spark.createDataFrame(pd.DataFrame({"g": group, "v": values}))
    probs = {"q1": 0.25, "q5": 0.5, "q9": 0.9, "q0": 0.0, "top": 1.0}
    for row in quantiles.exact_quantiles(df, ["g"], F.col("v"), probs).collect():
        own = values[group == row["g"]]
        assert {k: row[k] for k in probs} == pytest.approx({k: np.quantile(own, p) for k, p in probs.items()}, rel=1e-12)
    whole = quantiles.exact_quantiles(df, [], F.col("v"), probs).first()
    assert {k: whole[k] for k in probs} == pytest.approx({k: np.quantile(values, p) for k, p in probs.items()}, rel=1e-12)


def test_selection_in_unions_of_parts(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "BINS", 16)
    rng = np.random.default_rng(5)
    frame = pd.DataFrame({"part": rng.integers(0, 5, 4000), "v": np.round(rng.normal(size=4000), 2)})
    members = [(p, t) for p in range(5) for t in range(5) if p != t] + [(2, 9)]
    got = quantiles.select_in_unions(spark.createDataFrame(frame), "part", F.col("v"), spark.createDataFrame(members, "part long, target long"),
                                     {"median": lambda n: 0.5 * (n - 1), "c90": quantiles.conformal_rank(0.1)}).collect()
    assert {r["target"] for r in got} == {0, 1, 2, 3, 4, 9}
    for r in got:
        own = np.sort(frame[frame["part"].isin([p for p, t in members if t == r["target"]])]["v"].to_numpy())
        assert r["median"] == pytest.approx(np.median(own))
        assert r["c90"] == own[min(math.ceil((len(own) + 1) * 0.9), len(own)) - 1]


# ---- metric join ----------------------------------------------------------------
@pytest.mark.parametrize("dims,clusters", [(2, 1), (6, 5)])
def test_nearest_vector_equals_brute_force(spark, monkeypatch, dims, clusters):
    monkeypatch.setattr(metric, "BLOCK", 50)
    rng = np.random.default_rng(dims)
    centres = rng.normal(size=(clusters, dims)) * 4
    train = centres[rng.integers(0, clusters, 900)] + rng.normal(size=(900, dims))
    train[:20] = train[0]  # repeated vectors
    fold = np.where(train[:, 0] > np.quantile(train[:, 0], 0.5), 0, rng.integers(0, 3, 900))  # half of space holds one fold only
    t = spark.createDataFrame([(i, int(f), z.tolist()) for i, (f, z) in enumerate(zip(fold, train))], "id long, fold int, z array<double>")
    d = metric.distances(train, train)
    got = {r["id"]: r["d"] for r in metric.nearest_vector(t, t.select("fold", "z"), ["id"], "fold").collect()}
    want = np.where(fold[:, None] == fold[None], np.inf, d).min(axis=1)
    assert np.array([got[i] for i in range(900)]) == pytest.approx(want, abs=1e-12)
    far = rng.normal(size=(60, dims)) * 30
    q = spark.createDataFrame([(i, z.tolist()) for i, z in enumerate(far)], "id long, z array<double>")
    got = {r["id"]: r["d"] for r in metric.nearest_vector(q, t.select("z"), ["id"]).collect()}
    assert np.array([got[i] for i in range(60)]) == pytest.approx(metric.distances(far, train).min(axis=1))
    alone = metric.nearest_vector(t, t.select(F.lit(1).alias("fold"), "z").limit(3), ["id"], "fold")
    assert {r["id"] for r in alone.collect()} == {int(i) for i in np.flatnonzero(fold != 1)}
    assert metric.nearest_vector(q, t.select("z").limit(0), ["id"]).count() == 0


# ---- neighbours on the sphere ----------------------------------------------------
def globe(n, seed, around=None):
    rng = np.random.default_rng(seed)
    if around:
        return around[0] + rng.normal(size=n) * 0.6, around[1] + rng.normal(size=n) * 0.6 / max(0.02, math.cos(math.radians(around[0])))
    return np.degrees(np.arcsin(rng.uniform(-1, 1, n))), rng.uniform(-180, 180, n)


@pytest.mark.parametrize("around", [None, (5.6, -0.2), (10.0, 180.0), (89.2, 40.0)])
def test_neighbours_and_counts_anywhere(spark, around):
    lat, lon = globe(150, 1, around)
    lon = (lon + 180) % 360 - 180
    lat = np.clip(lat, -90, 90)
    s_lat, s_lon = globe(200, 2, around)
    s_lon, s_lat = (s_lon + 180) % 360 - 180, np.clip(s_lat, -90, 90)
    fold, s_fold = np.arange(150) % 3, np.arange(200) % 3
    t = spark.createDataFrame(pd.DataFrame({"t": range(150), "day": np.arange(150) % 2, "fold": fold, "lat": lat, "lon": lon}))
    s = spark.createDataFrame(pd.DataFrame({"s": range(200), "day": np.arange(200) % 2, "fold": s_fold, "src_lat": s_lat, "src_lon": s_lon}))
    d = haversine(lat[:, None], lon[:, None], s_lat[None], s_lon[None])
    d = np.where((np.arange(150) % 2)[:, None] == (np.arange(200) % 2)[None], d, np.inf)
    got = neighbours.nearest_and_count(t, s.drop("fold"), ["t"], "s", ["day"], cap_km=1e9).toPandas().set_index("t").sort_index()
    assert got["dist_nearest_km"].to_numpy() == pytest.approx(d.min(axis=1), abs=1e-6)
    assert got["n_obs_100km"].tolist() == (d < 100).sum(axis=1).tolist()
    other = np.where(fold[:, None] == s_fold[None], np.inf, d)
    got = neighbours.nearest_and_count(t, s, ["t"], "s", ["day"], cap_km=1e9, unlike="fold").toPandas().set_index("t").sort_index()
    assert got["dist_nearest_km"].to_numpy() == pytest.approx(other.min(axis=1), abs=1e-6)
    assert got["n_obs_100km"].tolist() == (other < 100).sum(axis=1).tolist()


def test_whole_cubes_are_summed_not_compared(spark):
    """Dense sources: nearly all within the radius come from count tables, so border pairs stay a small share."""
    lat, lon = globe(400, 3, (6.0, 0.0))
    df = spark.createDataFrame(pd.DataFrame({"lat": lat, "lon": lon})).select("lat", "lon", *neighbours._cubes(F.col("lat"), F.col("lon"), 100.0 / 16))
    inner, border, edge = neighbours.cube_pairs(df.select("_x", "_y", "_z").distinct(), df.select("_x", "_y", "_z").distinct(), 100.0)
    t = df.withColumnsRenamed({c: n for c, n in zip(("_x", "_y", "_z"), neighbours._cube_names("t"))})
    s = df.select(*[F.col(c).alias(n) for c, n in zip(("_x", "_y", "_z"), neighbours._cube_names("s"))])
    compared = t.join(border, neighbours._cube_names("t")).join(s, neighbours._cube_names("s")).count()
    near = (haversine(lat[:, None], lon[:, None], lat[None], lon[None]) < 100).sum()
    assert compared < 0.5 * near


# ---- polygons ---------------------------------------------------------------------
def ring(rng, n, x, y, r):
    angle = np.sort(rng.uniform(0, 2 * np.pi, n))
    radius = r * rng.uniform(0.3, 1.0, n)
    px, py = x + radius * np.cos(angle), y + radius * np.sin(angle)
    return list(zip(px, py, np.roll(px, -1), np.roll(py, -1)))


def inside(edges, lat, lon):
    x1, y1, x2, y2 = np.array(edges).T[:, :, None]
    with np.errstate(divide="ignore", invalid="ignore"):
        cross = ((y1 > lat) != (y2 > lat)) & (lon < x1 + (lat - y1) * (x2 - x1) / (y2 - y1))
    return cross.sum(axis=0) % 2 == 1


@pytest.mark.parametrize("band,tile", [(0.05, 0.05), (0.3, 0.07), (5.0, 5.0)])
def test_polygons_by_tile_parity(spark, band, tile):
    rng = np.random.default_rng(8)
    features = {1: ring(rng, 400, 0.2, 6.0, 1.0), 2: ring(rng, 5, -0.5, 6.3, 0.8), 3: ring(rng, 60, 0.0, 6.0, 0.2) + ring(rng, 7, 1.0, 5.5, 0.3),
                4: [(-1.0, 5.0, 1.0, 5.0), (1.0, 5.0, 1.0, 7.0), (1.0, 7.0, -1.0, 7.0), (-1.0, 7.0, -1.0, 5.0)]}  # an upright box on cell borders
    lat, lon = rng.uniform(4.5, 7.5, 1500), rng.uniform(-1.5, 1.8, 1500)
    lat[:4], lon[:4] = [5.0, 6.0, 7.0, 5.05], [0.0, -1.0, 0.0, 0.05]
    points = spark.createDataFrame(pd.DataFrame({"p": range(1500), "lat": lat, "lon": lon}))
    edges = spark.createDataFrame([(k, *map(float, e)) for k, es in features.items() for e in es], "feature_id int, x1 double, y1 double, x2 double, y2 double")
    got = {(r["p"], r["feature_id"]) for r in spatial.polygon_cells(points, edges, ["p"], band=band, tile=tile).collect()}
    assert got == {(int(p), k) for k, es in features.items() for p in np.flatnonzero(inside(es, lat, lon))}
    if band > 0.1:
        return
    local, east = spatial.polygon_index(edges, "feature_id", band, tile)
    placed = points.select("p", F.floor(F.col("lat") / band).alias("_b"), F.floor(F.col("lon") / tile).alias("_t"))
    met = placed.join(local, ["_b", "_t"]).count() + placed.join(east, ["_b", "_t"]).count()
    along = placed.join(local.select("_b", "feature_id", "x1", "y1").distinct(), "_b").count()
    assert met < 4 * len(points.columns) * 1500 and met < along / 5


# ---- grids ------------------------------------------------------------------------
@pytest.mark.parametrize("block", [4, 16, 256])
def test_distance_transform_equals_brute_force(spark, block):
    rng = np.random.default_rng(2)
    cells = [(r, c) for r in range(40) for c in range(-5, 33) if rng.random() < 0.9]
    hits = [(3, 3), (17, 30), (39, -5), (60, 10), (18, 30)]
    make = lambda rows: spark.createDataFrame(rows, "row long, col long")
    got = {(x["row"], x["col"]): x["dist_road"] for x in spatial.nearest_occupied_cell(make(cells), make(hits), cap_km=12.0, cell_km=1.0, block=block).collect()}
    assert got == {(r, c): pytest.approx(min(12.0, min(math.hypot(r - a, c - b) for a, b in hits))) for r, c in cells}
    empty = spatial.nearest_occupied_cell(make(cells[:5]), make(hits).limit(0), cap_km=12.0, cell_km=1.0).collect()
    assert [x["dist_road"] for x in empty] == [12.0] * 5


# ---- correlogram and kriging -------------------------------------------------------
def test_far_blocks_do_not_meet(spark, monkeypatch):
    monkeypatch.setattr(kriging, "PAIR_BLOCK", 20)
    lat = np.concatenate([globe(100, i, (i * 9.0, 0.0))[0] for i in range(5)])
    lon = np.concatenate([globe(100, i, (i * 9.0, 0.0))[1] for i in range(5)])
    resid = np.sin(np.arange(500))
    df = spark.createDataFrame(pd.DataFrame({"site_id": range(500), "date": 1, "lat": lat, "lon": lon, "resid": resid}))
    blocks = kriging.space_blocks(df, "site_id", ["date"], 20)
    assert blocks.groupBy("_b").count().agg(F.max("count")).first()[0] <= 20
    assert kriging.near_blocks(blocks, ["date"], 400.0).count() < 0.4 * (25 * 26 / 2)  # clusters are 1000 km apart
    d = haversine(lat[:, None], lon[:, None], lat[None], lon[None])
    i, j = np.triu_indices(500, 1)
    edges = np.asarray(P.CORRELOGRAM_BINS, float)
    k = np.digitize(d[i, j], edges) - 1
    ok = (k >= 0) & (k < len(edges) - 1)
    n = np.bincount(k[ok], minlength=len(edges) - 1)
    s = np.bincount(k[ok], weights=(resid[i] * resid[j])[ok], minlength=len(edges) - 1)
    got = {r["bin"]: (r["n_pairs"], r["sum_prod"]) for r in kriging.pair_bins(df).collect()}
    assert got == {b: (int(n[b]), pytest.approx(s[b])) for b in np.flatnonzero(n).tolist()}


def test_one_factor_serves_all_parts(spark, monkeypatch):
    rng = np.random.default_rng(6)
    lower = np.tril(rng.normal(size=(700, 700))) + 30 * np.eye(700)
    assert kriging.lower_inverse(lower, 64) @ lower == pytest.approx(np.eye(700), abs=1e-9)
    lat, lon = globe(120, 7, (6.0, 0.0))
    resid = rng.normal(size=120) * 0.3
    s = spark.createDataFrame(pd.DataFrame({"date": 1, "lat": lat, "lon": lon, "resid": resid}))
    t = spark.createDataFrame(pd.DataFrame({"cell": range(120), "date": 1, "lat": lat, "lon": lon}))
    args = ["cell"], ["date"], 1 - 1e-9, 40.0, 0.1
    whole = kriging.krige(t, s, *args).orderBy("cell").toPandas()
    assert whole["rk_mean"].to_numpy() == pytest.approx(resid, abs=1e-3)  # no nugget: residuals come back at the stations
    assert whole["rk_var"].max() < 1e-5
    monkeypatch.setattr(kriging, "PART_CELLS", 1000)
    monkeypatch.setattr(kriging, "TARGETS_PER_TASK", 30)
    monkeypatch.setattr(kriging, "BLOCK_CELLS", 900)
    cut = kriging.krige(t, s, *args).orderBy("cell").toPandas()
    assert cut["rk_mean"].to_numpy() == pytest.approx(whole["rk_mean"].to_numpy(), abs=1e-9)
    assert cut["rk_var"].to_numpy() == pytest.approx(whole["rk_var"].to_numpy(), abs=1e-9)


def test_probe_sample_takes_every_nth_in_order(spark):
    rows = [(d, f"g{i:04d}") for d in (1, 2) for i in range(130)]
    df = spark.createDataFrame(rows[::-1], "day int, key string")
    got = sorted((r["day"], r["key"]) for r in fires.probe_sample(df).collect())
    assert got == [(d, f"g{i:04d}") for d in (1, 2) for i in (0, 50, 100)]


# ---- stream state -----------------------------------------------------------------
HOURS = "site_id string, hour timestamp, pm25 double"


def stuck_batches(spark, tmp_path, batches, lateness, idle):
    from dustline.streaming import ingest, stateful
    src, state = str(tmp_path / "hours"), str(tmp_path / "state")
    got = []
    for batch in batches:
        spark.createDataFrame(batch, HOURS).write.mode("append").parquet(src)
        s = stateful.stuck_stream(ingest.file_stream(spark, src, HOURS), lateness, idle)
        ingest.run_available(s, lambda df, i: got.extend(tuple(r) for r in df.collect()), "append", state)
    kept = spark.read.format("statestore").option("stateVarName", "run").load(state)
    return got, {r["key"][0] for r in kept.collect()}


def test_late_hours_and_idle_sites(spark, tmp_path):
    start = dt.datetime(2024, 1, 1)
    rng = np.random.default_rng(4)
    rows = [(f"s{k}", start + dt.timedelta(hours=h), float(v)) for k in range(3) for h, v in enumerate(rng.integers(0, 2, 60).repeat(4)[:120])]
    late = {i for i in range(len(rows)) if rng.random() < 0.3}
    first = [r for i, r in enumerate(rows) if r[1] < start + dt.timedelta(hours=60) and i not in late]
    second = [r for i, r in enumerate(rows) if r not in first]
    rng.shuffle(second)
    clock = lambda h: [(None, start + dt.timedelta(hours=h), None)]
    got, kept = stuck_batches(spark, tmp_path, [first, second, clock(400), clock(401)], "200 hours", 24 * 30)
    want = qc.flag_stuck(spark.createDataFrame(rows, HOURS)).select("site_id", "hour", "pm25", "stuck").collect()
    assert sorted(got) == sorted(tuple(r) for r in want)
    assert kept == {"s0", "s1", "s2"}


def test_idle_sites_leave_the_state_store(spark, tmp_path):
    start = dt.datetime(2024, 1, 1)
    at = lambda site, h: (site, start + dt.timedelta(hours=h), 5.0)
    got, kept = stuck_batches(spark, tmp_path, [[at("gone", h) for h in range(8)] + [at("stays", h) for h in range(8)], [at("stays", 100)], [(None, start + dt.timedelta(hours=130), None)], [(None, start + dt.timedelta(hours=131), None)]],
                              "10 hours", 48)
    assert kept == {"stays"}
    assert len(got) == 17 and sorted(h for s, h, _, stuck in got if s == "gone" and stuck) == [start + dt.timedelta(hours=h) for h in (5, 6, 7)]


def test_upsert_log_survives_a_new_checkpoint_and_an_empty_source(spark, tmp_path):
    from dustline.streaming.ingest import UpsertLog
    path = str(tmp_path / "log")
    assert UpsertLog(spark, path, ["k"], "k int, v int").read().collect() == []
    with pytest.raises(ValueError):
        UpsertLog(spark, path, ["k"]).read()
    row = lambda k, v: spark.createDataFrame([(k, v)], "k int, v int")
    old = UpsertLog(spark, path, ["k"], run="a", compact_every=2)
    for i in range(5):
        old.write(row(i, i), i)
    new = UpsertLog(spark, path, ["k"], run="b", compact_every=2)  # ids start at 0 again
    new.write(row(0, 100), 0)
    new.write(row(0, 100), 0)
    assert {r["k"]: r["v"] for r in new.read().collect()} == {0: 100, 1: 1, 2: 2, 3: 3, 4: 4}
    for i in range(1, 6):
        new.write(row(1, 200 + i), i)
    assert {r["k"]: r["v"] for r in new.read().collect()} == {0: 100, 1: 205, 2: 2, 3: 3, 4: 4}
    assert len(new._finished("base")) <= 2 and len(new._finished("batch_id")) <= 4  # replaced folders go with the next base
