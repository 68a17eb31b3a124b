"""Pitch analytics (C1-C6): pass vectors, position heatmaps, shot maps, top-n.

The heatmap is one aggregation and one projection. A group's state is a bounded
array, a count for each of the grid's cells, which every task merges before the
shuffle: a player holding a third of all events leaves a task as one such array.
Gaussian smoothing is then a separable convolution of that array with array
functions, inside the row: no join, and no second shuffle.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from touchline.functions.columns import coord

# Pitch and heatmap settings of the source client (the common
# pitch of 120 x 80, 25 x 25 bins, Gaussian sigma 1 truncated at 4 sigma,
# reflected edges), and its shot-map frame (centre 40, x limits 32..47).
PITCH_LENGTH = 120.0
PITCH_WIDTH = 80.0
HEATMAP_BINS = (25, 25)
HEATMAP_SIGMA = 1.0
HEATMAP_TRUNCATE = 4.0
SHOT_MAP_CENTER = 40.0
SHOT_MAP_X_MIN = 32.0
SHOT_MAP_X_MAX = 47.0

# Decimals of a smoothed density.
SMOOTH_SCALE = 6


def pass_vectors(passes: DataFrame) -> DataFrame:
    """Pass start / end as x, y columns and a completed flag (from P3)."""
    return passes.select(
        "team_name",
        "team_id",
        "player_name",
        "player_id",
        coord("start_location", 0).alias("start_x"),
        coord("start_location", 1).alias("start_y"),
        coord("end_location", 0).alias("end_x"),
        coord("end_location", 1).alias("end_y"),
        (F.col("outcome") == "Completed").alias("completed"),
    )


def _bin(value, bins: int, extent: float):
    return F.least(
        F.greatest(F.floor(value * bins / extent), F.lit(0)), F.lit(bins - 1)
    ).cast("int")


def heatmap_counts(
    positions: DataFrame,
    group_cols: tuple[str, ...] = ("player_id",),
    bins: tuple[int, int] = HEATMAP_BINS,
    pitch: tuple[float, float] = (PITCH_LENGTH, PITCH_WIDTH),
    location: str = "location",
) -> DataFrame:
    """C2 step 1: located events counted into half-open bins per group.

    Bin ``i`` of ``n`` over length ``L`` holds ``i*L/n <= x < (i+1)*L/n``; the
    far edge falls into the last bin.
    """
    return _binned(positions, group_cols, bins, pitch, location).groupBy(*group_cols, "bin_x", "bin_y").agg(F.count(F.lit(1)).alias("n"))


def _binned(positions: DataFrame, group_cols: tuple[str, ...], bins: tuple[int, int], pitch: tuple[float, float], location: str) -> DataFrame:
    """The bins of every located event."""
    x = coord(location, 0)
    y = coord(location, 1)
    return positions.filter(x.isNotNull() & y.isNotNull()).select(
        *group_cols, _bin(x, bins[0], pitch[0]).alias("bin_x"), _bin(y, bins[1], pitch[1]).alias("bin_y")
    )


def _mirror(p: int, n: int) -> int:
    """Mirror an index at the grid edges, edge cell included (d c b a | a b c d)."""
    return -1 - p if p < 0 else (2 * n - 1 - p if p > n - 1 else p)


def gaussian_taps(sigma: float = HEATMAP_SIGMA, truncate: float = HEATMAP_TRUNCATE) -> list[float]:
    """The ``2r+1`` weights of a 1-D Gaussian filter, ``r = truncate * sigma``.

    The centre's weight takes the rounding remainder of the others, so they sum to 1.
    """
    radius = int(truncate * sigma + 0.5)
    taps = [math.exp(-0.5 * (a / sigma) ** 2) for a in range(-radius, radius + 1)]
    norm = math.fsum(taps)
    taps = [t / norm for t in taps]
    taps[radius] = 1.0 - math.fsum(taps[:radius] + taps[radius + 1 :])
    return taps


def _radius(taps: list[float], bins: int) -> int:
    if len(taps) // 2 >= bins:
        raise ValueError("kernel radius must be smaller than the grid")
    return len(taps) // 2


def gaussian_axis_kernel(
    spark: SparkSession,
    bins: int,
    sigma: float = HEATMAP_SIGMA,
    truncate: float = HEATMAP_TRUNCATE,
) -> DataFrame:
    """Rows (src, tgt, w) of the filter with reflected edges: the share of source
    bin ``src`` that lands in target bin ``tgt``, at most ``bins * (2r+1)`` rows."""
    taps = gaussian_taps(sigma, truncate)
    radius = _radius(taps, bins)
    share: dict[tuple[int, int], list[float]] = {}
    for target in range(bins):
        for a, w in enumerate(taps):
            share.setdefault((_mirror(target + a - radius, bins), target), []).append(w)
    return spark.createDataFrame([(src, tgt, math.fsum(ws)) for (src, tgt), ws in sorted(share.items())], "src int, tgt int, w double")


def _let(value: Column, then) -> Column:
    """``then(value)`` with ``value`` computed once, also when it is used inside a lambda."""
    return F.transform(F.array(value), then)[0]


def _smoothed_rows(grids: DataFrame, group_cols: tuple[str, ...], bins: tuple[int, int], sigma: float, truncate: float) -> DataFrame:
    """A row per group and cell of the smoothed grid.

    ``cells`` is an array of ``(cell, count)`` structs with ``cell = bin_x * bins[1] + bin_y``,
    each cell at most once. The filter is separable. Along x it works on the whole grid: the
    grid, widened by its mirrored edges, is shifted ``2r+1`` times by a row and the copies are
    added, each with its weight. Along y it is a sum of ``2r+1`` elements for each cell listed.
    Sums have a fixed order: equal counts give equal digits however events were partitioned.
    """
    nx, ny = bins
    taps = gaussian_taps(sigma, truncate)
    rx, ry = _radius(taps, nx), _radius(taps, ny)
    inside = [_mirror(x, nx) * ny + y for x in range(-rx, nx + rx) for y in range(ny)]
    widened = lambda m: F.transform(F.lit(inside), lambda i: F.coalesce(F.try_element_at(m, i), F.lit(0)).cast("double"))

    def plus(weight: float):
        return lambda s, v: s + v * weight

    def along_x(g: Column) -> Column:
        out = F.transform(F.slice(g, 1, nx * ny), lambda v: v * taps[0])
        for a, weight in enumerate(taps[1:], 1):
            out = F.zip_with(out, F.slice(g, a * ny + 1, nx * ny), plus(weight))
        return out

    smooth_x = _let(_let(F.map_from_entries("cells"), widened), along_x)
    listed = grids.select(*group_cols, smooth_x.alias("grid")).select(*group_cols, "grid", F.explode(F.sequence(F.lit(0), F.lit(nx * ny - 1))).alias("cell"))
    x, y = F.floor(F.col("cell") / ny).cast("int"), (F.col("cell") % ny).cast("int")
    mirrored = F.lit([_mirror(y, ny) for y in range(-ry, ny + ry)])
    density = sum((F.col("grid")[x * ny + mirrored[y + b]] * weight for b, weight in enumerate(taps)), F.lit(0.0))
    return listed.select(*group_cols, x.alias("bin_x"), y.alias("bin_y"), F.round(density, SMOOTH_SCALE).alias("density"))


def heatmap(
    positions: DataFrame,
    group_cols: tuple[str, ...] = ("player_id",),
    bins: tuple[int, int] = HEATMAP_BINS,
    pitch: tuple[float, float] = (PITCH_LENGTH, PITCH_WIDTH),
    location: str = "location",
    sigma: float = HEATMAP_SIGMA,
    truncate: float = HEATMAP_TRUNCATE,
) -> DataFrame:
    """Gaussian-smoothed position counts, all ``bins[0] * bins[1]`` cells of every group.

    One aggregation state per group counts its cells: Spark's frequent-items state,
    with room for every cell of the grid. It only estimates once there are more
    distinct items than it tracks, which can't happen here, so the counts are exact. States
    merge in each task, so one shuffle moves at most one bounded array per group and task.
    """
    n = bins[0] * bins[1]
    cell = (F.col("bin_x") * bins[1] + F.col("bin_y")).alias("cell")
    cells = _binned(positions, group_cols, bins, pitch, location).select(*group_cols, cell)
    grids = cells.groupBy(*group_cols).agg(F.expr(f"approx_top_k(cell, {n}, {n})").alias("cells"))
    return _smoothed_rows(grids, group_cols, bins, sigma, truncate)


def heatmap_smooth(
    counts: DataFrame,
    group_cols: tuple[str, ...] = ("player_id",),
    bins: tuple[int, int] = HEATMAP_BINS,
    sigma: float = HEATMAP_SIGMA,
    truncate: float = HEATMAP_TRUNCATE,
) -> DataFrame:
    """C2 step 2 by itself: the same from bin counts, one row per group and bin.

    At most ``bins[0] * bins[1]`` rows of a group are gathered into its array.
    """
    entry = F.struct((F.col("bin_x") * bins[1] + F.col("bin_y")).alias("cell"), F.col("n").cast("bigint").alias("n"))
    return _smoothed_rows(counts.groupBy(*group_cols).agg(F.collect_list(entry).alias("cells")), group_cols, bins, sigma, truncate)


def three_dimensional(shots: DataFrame) -> DataFrame:
    """C4: shots whose end location has a height (3 coordinates)."""
    return shots.filter(F.size("end_location") == 3)


def shot_map(shots: DataFrame) -> DataFrame:
    """Goal-mouth view of 3-D shot ends: across (element 1), height (element 2)."""
    return three_dimensional(shots).select(
        "team_name",
        "team_id",
        "player_name",
        "player_id",
        coord("end_location", 1).alias("x"),
        coord("end_location", 2).alias("y"),
        "is_goal",
    )


def shot_map_bounds(points: DataFrame, group_cols: tuple[str, ...] = ("team_id", "player_id")) -> DataFrame:
    """Per-group frame of a shot map: extent, farthest distance from the
    centre, axis limits clamped to the goal area, goals and misses."""
    c = F.lit(SHOT_MAP_CENTER)
    agg = points.groupBy(*group_cols).agg(
        F.min("x").alias("x_min"),
        F.max("x").alias("x_max"),
        F.max("y").alias("y_max"),
        F.count_if(F.col("is_goal") == 1).alias("goals"),
        F.count_if(F.col("is_goal") != 1).alias("misses"),
    )
    dist = F.greatest(F.abs(c - F.col("x_max")), F.abs(c - F.col("x_min")))
    return agg.withColumn("max_x_dist", dist).withColumns(
        {
            "x_lo": F.greatest(c - F.col("max_x_dist"), F.lit(SHOT_MAP_X_MIN)),
            "x_hi": F.least(c + F.col("max_x_dist"), F.lit(SHOT_MAP_X_MAX)),
        }
    )


def top_players(
    df: DataFrame, column: str, n: int, partition_by: tuple[str, ...] = (), tie: str = "player_id"
) -> DataFrame:
    """The ``n`` largest rows by ``column``, overall or per partition.

    Per partition this is ``row_number() <= n``, which Spark runs with a
    partial per-task limit before the shuffle (window group limit), so a large
    group ships at most ``n`` rows per task. Overall it is a take-ordered.
    Ties go by all key columns, so the result is defined.
    """
    keys = [tie, *(k for k in ("team_id", "team_name", "player_name", "player_number") if k in df.columns)]
    order = [F.col(column).desc(), *[F.col(k).asc() for k in keys]]
    if not partition_by:
        return df.orderBy(*order).limit(n)
    w = Window.partitionBy(*partition_by).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def team_complete_rows(df: DataFrame, team_id: int) -> DataFrame:
    """One team's rows with no null in any column."""
    return df.filter(F.col("team_id") == F.lit(team_id)).na.drop("any")
