"""Vector and raster geometry: polygons, nearest lines, roads, block statistics, smoothing, tiles."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dustline import params as P
from dustline.functions import geo
from dustline.session import shared_dir, spread


# ---------------------------------------------------------------- polygons
def _tiled_edges(edges: DataFrame, feature: str, band: float, tile: float) -> DataFrame:
    """Edges by the latitude bands they touch: (feature, edge, _b, _from, _to), from and to which tile of the band the edge runs."""
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    listed = (edges.where(F.col("y1") != F.col("y2")).select(feature, "x1", "y1", "x2", "y2")
              .withColumn("_b", F.explode(F.sequence(F.floor(low / band), F.floor(high / band)))))

    def x_at(y: Column) -> Column:
        return F.col("x1") + (y - F.col("y1")) * (F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1"))

    # only the part of the edge within the band, with room for rounding
    ends = [x_at(F.greatest(low, F.col("_b") * band)), x_at(F.least(high, (F.col("_b") + 1) * band))]
    room = tile * 1e-6
    return (listed.withColumn("_from", F.floor((F.least(*ends) - room) / tile))
            .withColumn("_to", F.floor((F.greatest(*ends) + room) / tile)))


def polygon_index(edges: DataFrame, feature: str, band: float, tile: float) -> tuple[DataFrame, DataFrame]:
    """(local, east): edges by the tiles (band ``_b``, ``_t``) they touch, and per tile what lies wholly east of it.

    Edges east of a tile cross a latitude as often, modulo 2, as endpoints of them lie above it: the
    two ends of an edge that crosses are on different sides, those of any other are not. Endpoints that
    two such edges share cancel. So ``east`` keeps ``_odd`` (endpoints above the band, modulo 2) and
    ``_ys``, the endpoints within the band that do not cancel: there is one only where a ring passes
    from the tile's own column into the columns east of it. No geometry is needed and nothing is rounded.
    """
    listed = _tiled_edges(edges, feature, band, tile)
    local = listed.withColumn("_t", F.explode(F.sequence("_from", "_to"))).select(feature, "_b", "_t", "x1", "y1", "x2", "y2")
    # an endpoint in a band above lies above every latitude of this one, as rounding keeps order
    higher = [(F.floor(F.col(y) / band) > F.col("_b")).cast("int") for y in ("y1", "y2")]
    column = listed.groupBy(feature, "_b", "_from").agg(F.sum(higher[0] + higher[1]).alias("_n"))
    # windows over the edge columns of one feature's band: not over points
    east_first = W.partitionBy(feature, "_b").orderBy(F.desc("_from"))
    before = east_first.rowsBetween(W.unboundedPreceding, -1)
    steps = column.select(feature, "_b", "_from", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n"), F.lag("_from").over(east_first).alias("_next"))
    # tiles from one edge column up to the next one to the east have the same edges east of them
    odd = (steps.where((F.col("_n") % 2 == 1) & F.col("_next").isNotNull())
           .select(feature, "_b", F.explode(F.sequence("_from", F.col("_next") - 1)).alias("_t"), F.lit(1).alias("_odd"), F.lit(None).cast("double").alias("_y")))
    ends = listed.select(feature, "_b", "_from", F.explode(F.array("y1", "y2")).alias("_y"))
    met = ends.where(F.floor(F.col("_y") / band) == F.col("_b")).groupBy(feature, "_b", "_y", "_from").agg(F.count(F.lit(1)).alias("_n"))
    by_y = W.partitionBy(feature, "_b", "_y").orderBy(F.desc("_from"))
    met = met.select(feature, "_b", "_y", "_from", F.coalesce(F.sum("_n").over(by_y.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_n"),
                     F.lag("_from").over(by_y).alias("_next"))
    loose = (met.where((F.col("_n") % 2 == 1) & F.col("_next").isNotNull())
             .select(feature, "_b", F.explode(F.sequence("_from", F.col("_next") - 1)).alias("_t"), F.lit(0).alias("_odd"), "_y"))
    east = odd.unionByName(loose).groupBy(feature, "_b", "_t").agg(F.sum("_odd").alias("_odd"), F.collect_list("_y").alias("_ys"))
    return local, east


def polygon_cells(points: DataFrame, edges: DataFrame, keys: Sequence[str], feature: str = "feature_id",
                  band: float = 0.05, tile: float = 0.05) -> DataFrame:
    """Even-odd point-in-polygon: each point with every feature that contains it.

    A point counts the edges that cross its latitude east of it. Edges that touch its own tile are
    compared one by one; all others to the east come as one number per feature (``polygon_index``),
    so a point meets the edges of one tile and the features over that tile, however long its band is.
    """
    keys = list(keys)
    local, east = polygon_index(edges, feature, band, tile)
    placed = points.select(*dict.fromkeys([*keys, "lat", "lon"]), F.floor(F.col("lat") / band).alias("_b"), F.floor(F.col("lon") / tile).alias("_t"))
    crossing = F.col("x1") + (F.col("lat") - F.col("y1")) * (F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1"))
    hits = (placed.join(local, ["_b", "_t"])
            .where(((F.col("y1") > F.col("lat")) != (F.col("y2") > F.col("lat"))) & (F.col("lon") < crossing))
            .select(*keys, feature, F.lit(1).alias("_n")))
    above = F.aggregate("_ys", F.col("_odd").cast("int"), lambda n, y: n + (y > F.col("lat")).cast("int"))
    beyond = placed.join(east, ["_b", "_t"]).select(*keys, feature, above.alias("_n"))
    return (hits.unionByName(beyond).groupBy(*keys, feature).agg(F.sum("_n").alias("_n"))
            .where(F.col("_n") % 2 == 1).select(*keys, feature))


def assign_polygon(points: DataFrame, edges: DataFrame, keys: Sequence[str], out: str,
                   feature: str = "feature_id") -> DataFrame:
    """Feature index per point, -1 outside; where polygons overlap the later feature wins.

    Points at one spot have one answer, so only distinct spots meet edges.
    """
    spot = ["lat", "lon"]
    inside = polygon_cells(points.select(*spot).distinct(), edges, spot, feature).groupBy(*spot).agg(F.max(feature).alias(out))
    return points.join(inside, spot, "left").fillna({out: -1}).select(*dict.fromkeys([*keys, *points.columns]), out)


# ---------------------------------------------------------------- nearest polyline
def distance_to_lines(points: DataFrame, segments: DataFrame, keys: Sequence[str], mean_lat: float,
                      first_km: float = 60.0) -> DataFrame:
    """Distance (km) to the nearest segment; NULL only where there is no segment at all.

    Flat coordinates scaled at ``mean_lat``. Segments are listed in every cell of their padded
    bounding box, so a point meets all segments within a cell's size. Points that have none so
    near go on to cells twice as large, starting from ``first_km``, until all have met one.
    Points at one spot have one answer, so only distinct spots meet segments.
    """
    shared_dir(points.sparkSession)
    spot, k = ["lat", "lon"], math.cos(math.radians(mean_lat))
    xs = segments.select((F.col("x1") * k).alias("ax"), F.col("y1").alias("ay"), (F.col("x2") * k).alias("bx"),
                         F.col("y2").alias("by"))
    left = points.select(*spot, (F.col("lon") * k).alias("_px"), F.col("lat").alias("_py")).distinct().checkpoint()
    vx, vy = F.col("bx") - F.col("ax"), F.col("by") - F.col("ay")
    along = F.try_divide((F.col("_px") - F.col("ax")) * vx + (F.col("_py") - F.col("ay")) * vy, vx * vx + vy * vy)
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(along, F.lit(0.0))))
    d = F.hypot(F.col("_px") - (F.col("ax") + t * vx), F.col("_py") - (F.col("ay") + t * vy)) * P.KM_PER_DEG
    found, reach_km = None, first_km
    while True:
        size = reach_km / P.KM_PER_DEG
        whole = size > 720  # wider than any two points: everything is near

        def cell(x: Column) -> Column:
            return F.lit(0).cast("long") if whole else F.floor(x / size).cast("long")

        listed = (xs.withColumn("_ci", F.explode(F.sequence(cell(F.least("ay", "by") - size), cell(F.greatest("ay", "by") + size))))
                  .withColumn("_cj", F.explode(F.sequence(cell(F.least("ax", "bx") - size), cell(F.greatest("ax", "bx") + size)))))
        placed = left.withColumn("_ci", cell(F.col("_py"))).withColumn("_cj", cell(F.col("_px")))
        best = placed.join(listed, ["_ci", "_cj"]).groupBy(*spot).agg(F.min(d).alias("_d"))
        best = (best if whole else best.where(F.col("_d") <= reach_km)).checkpoint()
        found = best if found is None else found.unionByName(best)
        left = left.join(best.select(*spot), spot, "left_anti").where("_px is not null and _py is not null")
        if whole or left.isEmpty():
            return points.join(found, spot, "left").select(*dict.fromkeys([*keys, *points.columns]), F.col("_d").alias("dist_line_km"))
        reach_km *= 2


# ---------------------------------------------------------------- roads
def road_length(segments: DataFrame, west: float, north: float, rows: int, cols: int,
                res: float = P.GRID_RES, step_km: float = 0.05) -> DataFrame:
    """Length (km) per grid cell: segments are cut into pieces of about 50 m, binned by midpoint."""
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    length = F.hypot(dx * P.KM_PER_DEG * F.cos(F.radians("y1")), dy * P.KM_PER_DEG)
    pieces = F.greatest(F.lit(1), F.floor(F.col("_len") / step_km).cast("int"))
    cut = (segments.withColumn("_len", length).withColumn("_k", pieces)
           .withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("_k") - 1)))
           .withColumn("_t", (F.col("_o") + 0.5) / F.col("_k")))
    x, y = F.col("x1") + dx * F.col("_t"), F.col("y1") + dy * F.col("_t")
    binned = cut.select(F.floor((F.lit(north) - y) / res).alias("row"), F.floor((x - west) / res).alias("col"),
                        (F.col("_len") / F.col("_k")).alias("_part"))
    inside = F.col("row").between(0, rows - 1) & F.col("col").between(0, cols - 1)
    return binned.where(inside).groupBy("row", "col").agg(F.sum("_part").alias("length_km"))


def tiles_around(row: str, col: str, halo: int, block: int) -> Column:
    """Tiles of ``block`` by ``block`` cells whose area, widened by ``halo``, holds the cell: one struct (_ti, _tj) per row."""
    span = lambda c: F.sequence(F.floor((F.col(c) - halo) / block), F.floor((F.col(c) + halo) / block))
    return F.explode(F.flatten(F.transform(span(row), lambda i: F.transform(span(col), lambda j: F.struct(i.alias("_ti"), j.alias("_tj"))))))


def squared_gaps(hits: np.ndarray, reach: int) -> np.ndarray:
    """Squared distance in cells to the nearest true cell of a matrix with a border of ``reach``, for the cells inside the border; infinite
    beyond the reach. Exact and separable: gaps along lines by carrying the last hit forward and back, then the least sum across lines."""
    rows, cols = hits.shape
    at = np.where(hits, np.arange(cols), -np.inf)
    before = np.arange(cols) - np.maximum.accumulate(at, axis=1)
    at = np.where(hits, np.arange(cols), np.inf)
    after = np.minimum.accumulate(at[:, ::-1], axis=1)[:, ::-1] - np.arange(cols)
    gap = np.minimum(before, after)[:, reach:cols - reach] ** 2
    best = np.full((rows - 2 * reach, gap.shape[1]), np.inf)
    for k in range(2 * reach + 1):
        np.minimum(best, gap[k:k + len(best)] + (k - reach) ** 2, out=best)
    return best


def nearest_occupied_cell(cells: DataFrame, occupied: DataFrame, cap_km: float = 100.0,
                          cell_km: float = P.GRID_RES * P.KM_PER_DEG, block: int = 256) -> DataFrame:
    """Distance (km) from each grid cell to the nearest occupied one, capped.

    The grid is cut into square tiles. Occupied cells also go to the tiles within the cap, so a tile
    knows all it needs, and lines of any length span many tasks.
    """
    reach = math.ceil(cap_km / cell_km)
    own = cells.select("row", "col").distinct().select("row", "col", F.floor(F.col("row") / block).alias("_ti"), F.floor(F.col("col") / block).alias("_tj"))
    # new names: both sides may come from one table
    hits = occupied.select("row", "col").distinct().select(F.col("row").alias("y"), F.col("col").alias("x"), tiles_around("row", "col", reach, block).alias("_t")) \
        .select("y", "x", "_t._ti", "_t._tj")

    def run(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left):
            return pd.DataFrame({"row": np.zeros(0, dtype=np.int64), "col": np.zeros(0, dtype=np.int64), "dist_road": np.zeros(0)})
        top, west = int(key[0]) * block - reach, int(key[1]) * block - reach
        seen = np.zeros((block + 2 * reach,) * 2, dtype=bool)
        y, x = left["row"].to_numpy(np.int64), left["col"].to_numpy(np.int64)
        if len(right):
            seen[right["y"].to_numpy(np.int64) - top, right["x"].to_numpy(np.int64) - west] = True
        squared = squared_gaps(seen, reach)[y - top - reach, x - west - reach]
        return pd.DataFrame({"row": y, "col": x, "dist_road": np.minimum(np.sqrt(squared) * cell_km, cap_km)})

    tile = ["_ti", "_tj"]
    return spread(own, *tile).groupBy(*tile).cogroup(spread(hits, *tile).groupBy(*tile)).applyInPandas(run, "row long, col long, dist_road double")


# ---------------------------------------------------------------- block statistics
def block_statistics(pixels: DataFrame, factor: int, value: str = "value") -> DataFrame:
    """Mean and population spread of fine pixels per coarse cell; partial edge blocks are kept out
    by the caller's extent."""
    return pixels.groupBy(F.floor(F.col("y") / factor).alias("row"), F.floor(F.col("x") / factor).alias("col")).agg(
        F.avg(value).alias("mean"), F.stddev_pop(value).alias("sd"), F.count(value).alias("n"))


def class_fractions(pixels: DataFrame, factor: int, classes: dict[int, str], code: str = "code",
                    empty_class: str = "water") -> DataFrame:
    """Share of each class among valid (code > 0) pixels per coarse cell; no valid pixel means water."""
    valid = F.count(F.when(F.col(code) > 0, F.lit(1)))
    out = []
    for value, name in classes.items():
        share = F.count(F.when(F.col(code) == value, F.lit(1))) / F.greatest(valid, F.lit(1))
        blank = F.lit(1.0 if name == empty_class else 0.0)
        out.append(F.when(valid > 0, share).otherwise(blank).alias(f"lc_{name}"))
    return pixels.groupBy(F.floor(F.col("y") / factor).alias("row"), F.floor(F.col("x") / factor).alias("col")).agg(*out)


def coarse_mean(cells: DataFrame, value: str, rows: int, cols: int, factor: int = 5,
                keys: Sequence[str] = ("date",)) -> DataFrame:
    """Mean of the valid cells per block; trailing partial blocks are dropped."""
    full = (F.col("row") < (rows // factor) * factor) & (F.col("col") < (cols // factor) * factor)
    return (cells.where(full)
            .groupBy(*keys, F.floor(F.col("row") / factor).alias("brow"), F.floor(F.col("col") / factor).alias("bcol"))
            .agg(F.avg(value).alias(value)))


def overlay_max(layers: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Largest value where rasters overlap."""
    return layers.groupBy(*keys).agg(F.max(value).alias(value))


# ---------------------------------------------------------------- smoothing
def gaussian_weights(sigma_cells: float, truncate: float = 4.0) -> list[float]:
    r = int(truncate * sigma_cells + 0.5)
    w = [math.exp(-0.5 * (k / sigma_cells) ** 2) for k in range(-r, r + 1)]
    total = sum(w)
    return [x / total for x in w]


def smoothed(grid: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Separable symmetric kernel over a matrix, for the cells at least half its width from the border."""
    width = len(weights)
    down = sum(w * grid[k:len(grid) - width + 1 + k] for k, w in enumerate(weights))
    return sum(w * down[:, k:down.shape[1] - width + 1 + k] for k, w in enumerate(weights))


def gaussian_smooth(cells: DataFrame, values: Sequence[str], sigma_km: float, rows: int, cols: int,
                    block: int = 256) -> DataFrame:
    """Separable Gaussian neighbourhood mean on a complete (row, col) grid, the edge value repeated outside.

    Square tiles with a border of the kernel's reach: one shuffle for both directions, and a line of any
    length spans many tasks. A missing value makes the cells within its reach missing.
    """
    weights = np.array(gaussian_weights(sigma_km / (P.GRID_RES * P.KM_PER_DEG)))
    r, names = len(weights) // 2, list(values)
    dealt = cells.select("row", "col", *[F.col(v).cast("double").alias(v) for v in names], tiles_around("row", "col", r, block).alias("_t")) \
        .select("row", "col", *names, "_t._ti", "_t._tj").where((F.col("_ti") * block < rows) & (F.col("_tj") * block < cols) & (F.col("_ti") >= 0) & (F.col("_tj") >= 0))

    def run(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        top, west = int(key[0]) * block, int(key[1]) * block
        low, right = min(top + block, rows), min(west + block, cols)
        ys, xs = np.clip(np.arange(top - r, low + r), 0, rows - 1), np.clip(np.arange(west - r, right + r), 0, cols - 1)
        first_y, first_x = ys[0], xs[0]
        out = {}
        for v in names:
            known = np.full((ys[-1] - first_y + 1, xs[-1] - first_x + 1), np.nan)
            known[part["row"].to_numpy() - first_y, part["col"].to_numpy() - first_x] = part[v].to_numpy(float)
            out[v] = smoothed(known[np.ix_(ys - first_y, xs - first_x)], weights).reshape(-1)
        y, x = np.mgrid[top:low, west:right]
        return pd.DataFrame({"row": y.reshape(-1), "col": x.reshape(-1), **out})

    fields = "".join(f", {v} double" for v in names)
    return spread(dealt, "_ti", "_tj").groupBy("_ti", "_tj").applyInPandas(run, f"row long, col long{fields}")


# ---------------------------------------------------------------- tiles
def station_tiles(stations: DataFrame, cell: float = 0.5, margin: float = 0.15) -> DataFrame:
    """Distinct padded tiles covering stations outside the main grid."""
    inside = (F.col("lon").between(P.GRID_LON_MIN + margin, P.GRID_LON_MAX - margin)
              & F.col("lat").between(P.GRID_LAT_MIN + margin, P.GRID_LAT_MAX - margin))
    tiles = stations.where(~inside).select(F.floor(F.col("lon") / cell).alias("tx"),
                                           F.floor(F.col("lat") / cell).alias("ty")).distinct()
    return tiles.select(
        F.concat_ws("_", F.lit("tile"), "tx", "ty").alias("name"),
        (F.col("tx") * cell - margin).alias("lon_min"), ((F.col("tx") + 1) * cell + margin).alias("lon_max"),
        (F.col("ty") * cell - margin).alias("lat_min"), ((F.col("ty") + 1) * cell + margin).alias("lat_max"))


def deepest_box(points: DataFrame, boxes: DataFrame, keys: Sequence[str], size: float = 1.0) -> DataFrame:
    """The containing box whose nearest edge is farthest from the point; ties to the first name.

    Boxes are listed in the ``size`` degree cells they cover, points meet them on the cell.
    """
    def span(lo: str, hi: str) -> Column:
        return F.explode(F.sequence(F.floor(F.col(lo) / size), F.floor(F.col(hi) / size)))

    listed = boxes.withColumn("_ci", span("lat_min", "lat_max")).withColumn("_cj", span("lon_min", "lon_max"))
    placed = (points.withColumn("_ci", F.floor(F.col("lat") / size)).withColumn("_cj", F.floor(F.col("lon") / size)))
    inside = F.col("lon").between(F.col("lon_min"), F.col("lon_max")) & F.col("lat").between(F.col("lat_min"), F.col("lat_max"))
    edge = F.least(F.col("lon") - F.col("lon_min"), F.col("lon_max") - F.col("lon"),
                   F.col("lat") - F.col("lat_min"), F.col("lat_max") - F.col("lat"))
    found = placed.join(listed, ["_ci", "_cj"]).where(inside).withColumn("edge", edge)
    best = found.groupBy(*keys).agg(F.min(F.struct((-F.col("edge")).alias("e"), F.col("name").alias("n"))).alias("_b"))
    return best.select(*keys, F.col("_b.n").alias("box"), (-F.col("_b.e")).alias("edge"))


def population(density: Column, lat: Column) -> Column:
    return density * geo.cell_area_km2(lat)
