"""k nearest points for every point, exact, by great-circle distance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forecourt import refdata
from forecourt.functions.geo import MORTON_BITS, haversine_km, morton, squared_chord, unit_vector
from forecourt.session import materialise, materialise_seen

DISTANCE = "dist, km"
DISTANCE_DIGITS = 6  # a millimetre; nearer than that is a tie, decided by the id
MARGIN = 1e-9  # chord length; covers that rounding and double arithmetic
WHOLE_SPHERE = 2.0
DEEPEST = MORTON_BITS  # levels of cells
LEAF_SPOTS = 32
STRIDE = 2  # levels between a node and its children
TILE_ROWS, MOST_TILE_ROWS = 16_384, 500_000
AXES = ("x", "y", "z")


def _spots(points: DataFrame, keep: int) -> DataFrame:
    """Distinct coordinates with the ``keep`` lowest ids there, in order.

    Points at one spot are equally far from anything, so no other id of the spot can be
    among the nearest ``keep`` of any point. The ranked filter is applied before the shuffle
    too, so a spot that holds a large part of all points stays small.
    """
    at_spot = Window.partitionBy("lat", "lon").orderBy("id")
    return (
        points.withColumn("_n", F.row_number().over(at_spot))
        .where(F.col("_n") <= keep)
        .groupBy("lat", "lon")
        .agg(F.array_sort(F.collect_list("id")).alias("ids"))
    )


def _tiles(spots: DataFrame, edge: int, tile_rows: int) -> DataFrame:
    """Spots in the order of the Z-order curve, cut into about equal tiles, whatever the density.

    Each tile also has the last ``edge`` spots of the tile before and the first ones of the tile after
    (``own`` is false for these), so that what is read off the curve does not end with a tile.
    """
    x, y, z = unit_vector(F.col("lat"), F.col("lon"))
    placed = spots.select("lat", "lon", "ids", x.alias("x"), y.alias("y"), z.alias("z")).withColumn(
        "curve", morton(F.col("x"), F.col("y"), F.col("z"))
    )
    placed, seen = materialise_seen(placed, "spots-placed", n=F.count(F.lit(1)))
    count = seen["n"] or 0
    parallel = int(spots.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tiles = max(1, min(count // max(tile_rows, 4 * edge), max(parallel, count // MOST_TILE_ROWS)))
    along = Window.partitionBy("tile").orderBy("curve", "lat", "lon")
    if tiles == 1:
        whole = placed.withColumn("tile", F.lit(0).cast("bigint")).withColumn("in_tile", F.col("tile")).withColumn("own", F.lit(True))
        return whole.withColumn("position", (F.row_number().over(along) - 1).cast("bigint"))
    cut = placed.repartitionByRange(tiles, "curve", "lat", "lon").withColumn("tile", F.spark_partition_id().cast("bigint"))
    cut = materialise(cut.withColumn("position", (F.row_number().over(along) - 1).cast("bigint")), "tiles")
    # one row per tile
    order = Window.orderBy("tile")
    around = cut.groupBy("tile").agg(F.count(F.lit(1)).alias("size"))
    around = around.withColumn("before", F.lag("tile").over(order)).withColumn("after", F.lead("tile").over(order))
    here = F.struct(F.col("tile").alias("in_tile"), F.lit(True).alias("own"))
    back = F.when(F.col("position") < edge, F.struct(F.col("before").alias("in_tile"), F.lit(False).alias("own")))
    ahead = F.when(
        F.col("position") >= F.col("size") - edge, F.struct(F.col("after").alias("in_tile"), F.lit(False).alias("own"))
    )
    copies = F.explode(F.array_compact(F.array(here, back, ahead))).alias("copy")
    return cut.join(F.broadcast(around), "tile").select("*", copies).where("copy.in_tile is not null").select(
        "tile", "position", "lat", "lon", "ids", *AXES, "curve", "copy.in_tile", "copy.own"
    )


def _code(curve: Column, level: Column) -> Column:
    """Number of the cell of a level: its part of the curve behind a leading 1."""
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), 3 * level).bitwiseOR(
        F.call_function("shiftright", curve, 3 * (DEEPEST - level))
    )


def _above(code: Column, levels: Column) -> Column:
    """The cell so many levels up that holds a cell."""
    return F.call_function("shiftrightunsigned", code, 3 * levels)


def _leaves(spots: DataFrame, keep: int, tile_rows: int, leaf_spots: int) -> DataFrame:
    """Every spot with the leaf it is in and a bound for the distance of its keep-th nearest spot.

    A leaf is the largest cell with ``leaf_spots`` spots or fewer. A cell holds more if two spots so many
    places apart on the curve are both in it, so the level of a leaf is one more than the longest prefix that
    two such spots around it share. Leaves are disjoint; only a finest cell with more spots is
    cut by position. Written out once, because both sides of the later joins read it.
    """
    tiles = _tiles(spots, max(keep, leaf_spots), tile_rows)
    along = Window.partitionBy("in_tile").orderBy("curve", "lat", "lon")
    here = F.struct(*AXES)
    near = F.collect_list(here).over(along.rowsBetween(1 - keep, keep - 1))
    differ = F.col("curve").bitwiseXOR(F.lead("curve", leaf_spots).over(along))
    shared = F.when(differ == 0, DEEPEST).otherwise(F.floor((3 * DEEPEST - F.length(F.bin(differ))) / 3)).cast("int")
    deepest_shared = F.max("shared").over(along.rowsBetween(-leaf_spots, 0))
    read = tiles.withColumn("near", near).withColumn("shared", shared).withColumn("crowded", deepest_shared).where("own")
    chords = F.array_sort(F.transform("near", lambda p: squared_chord(p, here)))
    reach = F.coalesce(F.sqrt(F.try_element_at(chords, F.lit(keep))), F.lit(WHOLE_SPHERE)) + MARGIN
    level = F.least(F.greatest(F.col("crowded") + 1, F.lit(1)), F.lit(DEEPEST))
    part = F.shiftleft("tile", 32).bitwiseOR((F.col("position") / leaf_spots).cast("bigint"))
    leaf = read.withColumn("level", F.coalesce(level, F.lit(1)))
    return leaf.select(
        F.shiftleft("tile", 32).bitwiseOR(F.col("position")).alias("spot"),
        "level",
        _code(F.col("curve"), F.col("level")).alias("node"),
        F.when(F.col("level") == DEEPEST, part).otherwise(F.lit(0).cast("bigint")).alias("part"),
        *("lat", "lon", "ids", *AXES),
        (reach * reach).alias("reach2"),
    )


def _tree(data: DataFrame) -> DataFrame:
    """Boxes over the leaves and, every ``STRIDE`` levels, over the cells that hold them, each with its parent.

    A node has 64 children at most, for spots on a sphere some 16; the top node is cell 1.
    """
    box = [f(a).alias(f"{a}_{f.__name__}") for a in AXES for f in (F.min, F.max)]
    leaves = data.groupBy("node", "part", "level").agg(*box, F.count(F.lit(1)).alias("n"))
    up = F.col("level") - STRIDE * F.floor((F.col("level") - 1) / STRIDE)
    stops = F.explode(F.sequence(F.lit(STRIDE), F.col("level") - 1, F.lit(STRIDE))).alias("stop")
    cells = leaves.where(F.col("level") > STRIDE).select("*", stops)
    cells = cells.withColumn("node", _above(F.col("node"), F.col("level") - F.col("stop")))
    both = [f(f"{a}_{f.__name__}").alias(f"{a}_{f.__name__}") for a in AXES for f in (F.min, F.max)]
    cells = cells.groupBy("node").agg(*both, F.sum("n").alias("n"))
    names = ["node", "part", "open", "n", *(f"{a}_{m}" for a in AXES for m in ("min", "max"))]
    leaves = leaves.withColumn("open", F.lit(False)).select(_above(F.col("node"), up).alias("parent"), "level", *names)
    cells = cells.withColumn("open", F.lit(True)).withColumn("part", F.lit(0).cast("bigint"))
    cells = cells.select(_above(F.col("node"), F.lit(STRIDE)).alias("parent"), F.lit(0).alias("level"), *names)
    return leaves.union(cells)


def _descend(rows: DataFrame, children: DataFrame, keep: int) -> DataFrame:
    """From nodes that a spot may have to visit to their children that it may; leaves stay.

    The counts and boxes of all nodes still in question bound the distance of the keep-th nearest spot, so the
    reach shrinks on the way and with it the number of nodes, however wide it was at first.
    """
    kids = children.select(
        F.lit(True).alias("is_open"), F.col("parent").alias("of"), *(F.col(c).alias(f"kid_{c}") for c in children.columns if c != "level")
    )
    # a leaf's key matches nothing and is as well spread as the spots
    key = F.when(F.col("open"), F.col("node")).otherwise(F.col("spot"))
    met = rows.withColumn("key", key).join(kids, (F.col("open") == F.col("is_open")) & (F.col("key") == F.col("of")), "left")
    apart = [F.greatest(F.col(f"kid_{a}_min") - F.col(a), F.col(a) - F.col(f"kid_{a}_max"), F.lit(0.0)) for a in AXES]
    across = [F.greatest(F.col(a) - F.col(f"kid_{a}_min"), F.col(f"kid_{a}_max") - F.col(a)) for a in AXES]
    kid = F.col("kid_node").isNotNull()
    found = {
        "max2": F.when(kid, sum((d * d for d in across), F.lit(0.0))).otherwise(F.col("max2")),
        "min2": F.when(kid, sum((d * d for d in apart), F.lit(0.0))).otherwise(F.col("min2")),
        **{c: F.when(kid, F.col(f"kid_{c}")).otherwise(F.col(c)) for c in ("n", "node", "part", "open")},
    }
    about = ("lat", "lon", *AXES, "reach2")
    seen = met.select("spot", *about, *(value.alias(name) for name, value in found.items())).where("min2 <= reach2")
    grouped = seen.groupBy("spot").agg(*(F.first(c).alias(c) for c in about), F.array_sort(F.collect_list(F.struct(*found))).alias("nodes"))
    start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(4.0).alias("far2"))
    enough = lambda a, v: F.when(a["n"] >= keep, a).otherwise(F.struct((a["n"] + v["n"]).alias("n"), v["max2"].alias("far2")))
    far = F.aggregate("nodes", start, enough, lambda a: F.when(a["n"] >= keep, F.sqrt(a["far2"]) + MARGIN))
    tight = F.least(F.col("reach2"), F.col("far") * F.col("far"))
    shrunk = grouped.withColumn("far", far).withColumn("reach2", tight)
    left = F.explode(F.filter("nodes", lambda v: v["min2"] <= F.col("reach2"))).alias("v")
    return shrunk.select("spot", *about, left).select("spot", *about, "v.*")


def nearest_spots(data: DataFrame, depth: int, keep: int, radius_km: float = refdata.EARTH_RADIUS_KM) -> DataFrame:
    """(lat, lon, point2, distance, rank): the ``keep`` nearest ids of every spot; ``depth`` is the level of the deepest leaf.

    From the top of the tree down to the leaves within reach, then to their spots. Only equi joins; a
    leaf is small, and a spot asks for few.
    """
    tree = materialise(_tree(data), "tree")
    rows = data.select(
        *("spot", "lat", "lon", *AXES, "reach2"), F.lit(4.0).alias("max2"), F.lit(0.0).alias("min2"),
        F.lit(0).cast("bigint").alias("n"), _above(F.col("node"), F.col("level")).alias("node"), F.lit(0).cast("bigint").alias("part"), F.lit(True).alias("open"),
    )
    for level in range(0, depth, STRIDE):
        # 72 cells at most below the top one
        rows = _descend(rows, tree if level else F.broadcast(tree.where("parent = 1")), keep)
    offered = data.select(
        F.col("node").alias("leaf"), F.col("part").alias("leaf_part"), F.struct(*AXES).alias("there"),
        F.col("lat").alias("lat2"), F.col("lon").alias("lon2"), "ids",
    )
    here = F.struct(*AXES)
    km = haversine_km(F.col("lat"), F.col("lon"), F.col("lat2"), F.col("lon2"), radius_km)
    order = Window.partitionBy("spot").orderBy(F.round(DISTANCE, DISTANCE_DIGITS), "point2")
    return (
        rows.join(offered, (F.col("node") == F.col("leaf")) & (F.col("part") == F.col("leaf_part")))
        .where(squared_chord(here, F.col("there")) <= F.col("reach2"))
        .select("spot", "lat", "lon", km.alias(DISTANCE), F.explode("ids").alias("point2"))
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= keep)
        .select("lat", "lon", "point2", DISTANCE, "rank")
    )


def knn_pairs(
    points: DataFrame,
    k: int,
    radius_km: float = refdata.EARTH_RADIUS_KM,
    include_self: bool = True,
    leaf_spots: int = LEAF_SPOTS,
    tile_rows: int = TILE_ROWS,
) -> DataFrame:
    """(point1, point2, rank, 'dist, km') of the k nearest points of every point.

    ``points`` has (id, lat, lon) with unique ids. The point itself counts as its own
    neighbour unless ``include_self`` is off. Distances are as computed; those equal to a millimetre
    go by point2.
    """
    if k < 1:
        raise ValueError("k must be positive")
    keep = k if include_self else k + 1
    points = points.select("id", "lat", "lon")
    data, seen = materialise_seen(_leaves(_spots(points, keep), keep, tile_rows, leaf_spots), "spots", depth=F.max("level"))
    near = nearest_spots(data, seen["depth"] or 0, keep, radius_km)
    pairs = points.withColumnRenamed("id", "point1").join(near, ["lat", "lon"])
    if not include_self:
        order = Window.partitionBy("point1").orderBy("rank")
        pairs = (
            pairs.where(F.col("point1") != F.col("point2"))
            .withColumn("rank", F.row_number().over(order))
            .where(F.col("rank") <= k)
        )
    return pairs.select("point1", "point2", "rank", DISTANCE)


def wide_to_long(wide: DataFrame) -> DataFrame:
    """(point1, neighbours, distances), two arrays in step, to one row per neighbour."""
    return wide.select(
        "point1", F.posexplode(F.arrays_zip("neighbours", "distances")).alias("position", "pair")
    ).select("point1", F.col("pair.neighbours").alias("point2"), "position", F.col("pair.distances").alias(DISTANCE))


def long_to_wide(pairs: DataFrame) -> DataFrame:
    """One row per point with its k neighbours and distances in order."""
    rows = F.array_sort(F.collect_list(F.struct("rank", "point2", F.col(f"`{DISTANCE}`").alias("km"))))
    return (
        pairs.groupBy("point1")
        .agg(rows.alias("r"))
        .select("point1", F.col("r.point2").alias("neighbours"), F.col("r.km").alias("distances"))
    )
