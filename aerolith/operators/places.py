"""The nearest of many centroids, by boxes of squares that are compared from coarse to fine.

Squares come in sizes that double.  A square of points and the squares of centroids that may hold a nearest one are
known by the boxes around what lies in them.  A centroid square whose least distance from the points' box exceeds
another one's greatest can't hold the nearest centroid of any of its points and is left out; of what is left, the
next finer squares are compared.  So a square of points meets the few around its nearest ones at every size, whether
it lies among the centroids or far from all of them.  It is done when few centroids are left.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolith.functions.geo import planar_distance_sq
from aerolith.session import materialize

#: Squares' numbers stay exact far beyond any coordinates.
_MOST_LEVELS = 40
_MOST_NUMBER = 2**62
#: An index of so many squares, some kilobytes each at most, is broadcast; a larger one is joined by shuffle.
_MOST_SQUARES = 20_000
#: So many pairs of squares are compared at the coarsest size.
_MOST_PAIRS = 1_000_000
#: A square of points with so many centroids left isn't divided any more.
_FEW = 24
#: The finest squares hold no more centroids, as far as halving their sides can bring it about.
_MOST_IN_SQUARE, _MOST_HALVINGS = 32, 30
_BOX = ("low_lat", "high_lat", "low_lon", "high_lon")


def _square(value: Column, side: float) -> Column:
    return F.floor(value / F.lit(side)).cast("bigint")


def _boxed(squares: DataFrame, *keys: str) -> DataFrame:
    """What lies in squares, by ``keys``: the number and the box."""
    ends = [(F.min if c.startswith("low") else F.max)(c).alias(c) for c in _BOX]
    return squares.groupBy(*keys).agg(F.sum("n").alias("n"), *ends)


def _in_squares(rows: DataFrame) -> DataFrame:
    """x, y, n and the box of each of the finest squares; ``rows``: x, y, lat, lon."""
    lat, lon = F.col("lat"), F.col("lon")
    ends = {"low_lat": lat, "high_lat": lat, "low_lon": lon, "high_lon": lon}
    return _boxed(rows.select("x", "y", F.lit(1).cast("bigint").alias("n"), *[c.alias(name) for name, c in ends.items()]), "x", "y")


def _all_levels(squares: DataFrame, levels: int) -> DataFrame:
    """The squares and those of 2, 4 ... times the side that they lie in."""
    up = squares.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(levels))))
    up = up.withColumns({"x": F.expr("shiftright(x, level)"), "y": F.expr("shiftright(y, level)")})
    return materialize(_boxed(up, "level", "x", "y"))


def _least(low_lat, high_lat, low_lon, high_lon, other) -> Column:
    """Least squared distance between two boxes."""
    zero = F.lit(0.0)
    apart = [
        F.greatest(low - other[f"high_{c}"], other[f"low_{c}"] - high, zero)
        for c, low, high in (("lat", low_lat, high_lat), ("lon", low_lon, high_lon))
    ]
    return planar_distance_sq(*apart, zero, zero)


def _most(low_lat, high_lat, low_lon, high_lon, other) -> Column:
    """Greatest squared distance between two boxes."""
    zero = F.lit(0.0)
    apart = [
        F.greatest(high - other[f"low_{c}"], other[f"high_{c}"] - low)
        for c, low, high in (("lat", low_lat, high_lat), ("lon", low_lon, high_lon))
    ]
    return planar_distance_sq(*apart, zero, zero)


def _can_win(candidates: str) -> Column:
    """Those of an array of boxes that may hold the nearest centroid of a point in the row's box."""
    own = [F.col(c) for c in _BOX]
    bound = F.array_min(F.transform(candidates, lambda c: _most(*own, c)))
    # Rounding keeps the order of differences, squares and sums: the bounds hold for distances as they are computed.
    # The bound is a lambda's variable, so that it is computed once a row; inside the filter it would be for every candidate.
    return F.transform(F.array(bound), lambda b: F.filter(candidates, lambda c: _least(*own, c) <= b))[0]


def _parents(squares: DataFrame) -> DataFrame:
    return squares.withColumns({"_px": F.expr("shiftright(x, 1)"), "_py": F.expr("shiftright(y, 1)")})


def _as_box(*more: str) -> Column:
    return F.struct(*more, *_BOX)


def grid_index(squares: DataFrame, centroids: DataFrame, levels: int) -> DataFrame:
    """x, y, near: for each finest square of points the centroids that can be nearest to one of them.

    ``squares``: x, y, n and the box of each.  ``centroids``: x, y (the finest squares that they lie in), place (order
    on ties), name, lat, lon, no two at one place on the plane.
    """
    asked, held = _all_levels(squares, levels), _all_levels(_in_squares(centroids), levels)
    counts = [{r.level: r.n for r in df.groupBy("level").agg(F.count("*").alias("n")).collect()} for df in (asked, held)]
    level = next((k for k in range(levels + 1) if counts[0].get(k, 0) * counts[1].get(k, 0) <= _MOST_PAIRS), levels)

    def at(df: DataFrame, k: int) -> DataFrame:
        return df.filter(F.col("level") == k).drop("level")

    every = F.broadcast(at(held, level).select(_as_box("x", "y", "n").alias("_c")))
    pairs = at(asked, level).crossJoin(every)
    bound = pairs.groupBy("x", "y").agg(F.min(_most(*[F.col(c) for c in _BOX], F.col("_c"))).alias("_bound"))
    pairs = pairs.join(bound, ["x", "y"]).filter(_least(*[F.col(c) for c in _BOX], F.col("_c")) <= F.col("_bound"))
    open_ = materialize(pairs.groupBy("x", "y").agg(F.collect_list("_c").alias("_near")))
    found = None
    while True:
        left = F.aggregate("_near", F.lit(0).cast("bigint"), lambda n, c: n + c["n"])
        few = F.lit(True) if level == 0 else left <= _FEW
        # Done: the centroids themselves, for the finest squares that lie in this one.
        inner = centroids.select(
            F.shiftright("x", level).alias("_cx"), F.shiftright("y", level).alias("_cy"),
            F.struct(
                "place", "name", "lat", "lon", F.col("lat").alias("low_lat"), F.col("lat").alias("high_lat"),
                F.col("lon").alias("low_lon"), F.col("lon").alias("high_lon"),
            ).alias("_c"),
        )
        done = open_.filter(few).select("x", "y", F.explode("_near").alias("_c"))
        done = done.select("x", "y", F.col("_c.x").alias("_cx"), F.col("_c.y").alias("_cy")).join(inner, ["_cx", "_cy"])
        done = done.groupBy(F.col("x").alias("_px"), F.col("y").alias("_py")).agg(F.collect_list("_c").alias("_near"))
        fine = squares.withColumns({"_px": F.shiftright("x", level), "_py": F.shiftright("y", level)})
        settled = fine.join(done, ["_px", "_py"]).select("x", "y", _can_win("_near").alias("_near"))
        settled = settled.select("x", "y", F.transform("_near", lambda c: F.struct(c["place"], c["name"], c["lat"], c["lon"])).alias("near"))
        found = settled if found is None else found.unionByName(settled)
        rest = open_.filter(~few)
        if level == 0 or rest.isEmpty():
            return found
        level -= 1
        # Half the side: the squares within those left, for the squares of points within this one.
        below = _parents(at(held, level)).select("_px", "_py", _as_box("x", "y", "n").alias("_c"))
        wide = rest.select("x", "y", F.explode("_near").alias("_p"))
        wide = wide.select("x", "y", F.col("_p.x").alias("_px"), F.col("_p.y").alias("_py")).join(below, ["_px", "_py"])
        wide = wide.groupBy(F.col("x").alias("_px"), F.col("y").alias("_py")).agg(F.collect_list("_c").alias("_near"))
        open_ = materialize(_parents(at(asked, level)).join(wide, ["_px", "_py"]).select("x", "y", _can_win("_near").alias("_near")))


def nearest_of_many(
    points: DataFrame, centroids: DataFrame, latitude: str = "latitude", longitude: str = "longitude", out: str = "region",
) -> DataFrame:
    """``points`` with the name of the nearest centroid; on a tie the one of smaller ``place``.

    ``centroids``: place, name, lat, lon; those without coordinates don't count.  Points without coordinates, and all
    points if there is no centroid, get NULL.  Distances are those of ``nearest_region``, on the plane.
    """
    known = centroids.filter(F.col("lat").isNotNull() & F.col("lon").isNotNull() & ~F.isnan("lat") & ~F.isnan("lon"))
    known = known.select("place", "name", F.col("lat").cast("double"), F.col("lon").cast("double"))
    # Of several at one place on the plane, only the first can be an answer.
    known = known.groupBy("lat", "lon").agg(F.min(F.struct("place", "name")).alias("first"))
    known = materialize(known.select("first.place", "first.name", "lat", "lon"))
    box = known.agg(*[f(c).alias(f"{f.__name__}_{c}") for c in ("lat", "lon") for f in (F.min, F.max)], F.count("*").alias("n")).first()
    if not box.n:
        return points.withColumn(out, F.lit(None).cast(known.schema["name"].dataType))
    spans = [box.max_lat - box.min_lat, box.max_lon - box.min_lon]
    # About one centroid a square, were they spread evenly over their box; smaller squares where they lie close.
    side = max(spans) / max(1.0, math.sqrt(box.n)) or 1.0
    for _ in range(0, _MOST_HALVINGS, 3):
        held = known.groupBy(_square(F.col("lat"), side), _square(F.col("lon"), side)).count()
        if held.agg(F.max("count")).first()[0] <= _MOST_IN_SQUARE:
            break
        side /= 8
    missing = F.lit(None).cast("double")
    lat, lon = F.nanvl(F.col(latitude).cast("double"), missing), F.nanvl(F.col(longitude).cast("double"), missing)
    placed = points.withColumns({"_x": _square(lat, side), "_y": _square(lon, side), "_lat": lat, "_lon": lon})
    asked = placed.select(F.col("_x").alias("x"), F.col("_y").alias("y"), F.col("_lat").alias("lat"), F.col("_lon").alias("lon"))
    # Infinitely far from all centroids, or too far for a square's number: near none.
    numbered = (F.abs("x") < _MOST_NUMBER) & (F.abs("y") < _MOST_NUMBER)
    squares = materialize(_in_squares(asked.filter(numbered)))
    fixed = known.withColumns({"x": _square(F.col("lat"), side), "y": _square(F.col("lon"), side)})
    # Sizes up to one square over everything.
    reach = squares.agg(*[f(c) for c in ("x", "y") for f in (F.min, F.max)]).first()
    ends = [math.floor(v / side) for v in (box.min_lat, box.max_lat, box.min_lon, box.max_lon)]
    span = max((max(reach[i + 1], ends[i + 1]) - min(reach[i], ends[i]) for i in (0, 2)), default=0) if reach[0] is not None else 0
    levels = min(_MOST_LEVELS, (span + 1).bit_length())
    index = materialize(grid_index(squares, fixed, levels)).select(F.col("x").alias("_x"), F.col("y").alias("_y"), "near")
    if index.count() <= _MOST_SQUARES:
        index = F.broadcast(index)
    here = F.col("_lat"), F.col("_lon")
    distance = lambda c: F.struct(planar_distance_sq(*here, c["lat"], c["lon"]).alias("d"), c["place"], c["name"])
    nearest = F.array_min(F.transform("near", distance))["name"]
    return placed.join(index, ["_x", "_y"], "left").select(*points.columns, nearest.alias(out))
