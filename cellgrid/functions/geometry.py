"""Column expressions on boxes and polygon rings, and point-in-polygon joins.

A ring is an array of vertex structs. Tests multiply instead of dividing, so that they are exact for integer coordinates.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def boxes_overlap(a: str, b: str) -> Column:
    """Whether boxes ``x, y, w, h`` with prefixes a and b share area; touching edges do not."""
    c = lambda p, n: F.col(f"{p}{n}")
    along = lambda at, size: (c(a, at) < c(b, at) + c(b, size)) & (c(b, at) < c(a, at) + c(a, size))
    return along("x", "w") & along("y", "h")


def corners(x: Column, y: Column, w: Column, h: Column) -> Column:
    """The corners of a box in (row, col): top left, top right, bottom right, bottom left."""
    at = lambda r, c: F.struct(r.cast("double").alias("row"), c.cast("double").alias("col"))
    return F.array(at(y, x), at(y, x + w), at(y + h, x + w), at(y + h, x))


def polygon_bbox(ring: Column) -> Column:
    """``row_start, row_stop, column_start, column_stop`` of a ring in (row, col), cut to integers."""
    of = lambda f, n: f(F.transform(ring, lambda v: v[n])).cast("int")
    return F.struct(
        of(F.array_min, "row").alias("row_start"), of(F.array_max, "row").alias("row_stop"),
        of(F.array_min, "col").alias("column_start"), of(F.array_max, "col").alias("column_stop"),
    )


def rescale(ring: Column, level: int) -> Column:
    """Vertices cut to integers, then multiplied by 2**level."""
    k = 1 << level
    at = lambda v: (v.cast("int") * k).cast("double")
    return F.transform(ring, lambda v: F.struct(at(v["row"]).alias("row"), at(v["col"]).alias("col")))


def edges(ring: Column) -> Column:
    """Pairs ``a, b`` of vertices in a row, the last with the first."""
    shifted = F.concat(F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, 1, 1))
    return F.zip_with(ring, shifted, lambda a, b: F.struct(a.alias("a"), b.alias("b")))


def covers(ring: Column, px: Column, py: Column, x: str = "x", y: str = "y") -> Column:
    """Whether a ring holds a point; its edges count as inside."""

    def side(e: Column) -> Column:
        return (e["b"][x] - e["a"][x]) * (py - e["a"][y]) - (e["b"][y] - e["a"][y]) * (px - e["a"][x])

    def on(e: Column) -> Column:
        within = lambda p, n: p.between(F.least(e["a"][n], e["b"][n]), F.greatest(e["a"][n], e["b"][n]))
        return (side(e) == 0) & within(px, x) & within(py, y)

    def crosses(e: Column) -> Column:
        up = e["b"][y] > e["a"][y]
        return ((e["a"][y] > py) != (e["b"][y] > py)) & F.when(up, side(e) > 0).otherwise(side(e) < 0)

    es = edges(ring)
    return F.exists(es, on) | (F.size(F.filter(es, crosses)) % 2 == 1)


def _half(ring: list[tuple[float, float]], axis: int, limit: float, sign: int) -> list[list[tuple[float, float]]]:
    """The parts of a simple ring with ``(vertex[axis] - limit) * sign > 0``.

    Chains of vertices inside run from one crossing of the line to the next. Along the line, crossings by which the ring
    enters and leaves alternate, so that the n-th entry and the n-th exit bound the same piece of it: a chain goes on with
    the chain that enters where its own exit's piece ends.
    """
    inside = [(v[axis] - limit) * sign > 0 for v in ring]
    if all(inside):
        return [ring]
    if not any(inside):
        return []
    n, chains = len(ring), []
    for i in range(n):
        if inside[i] and not inside[i - 1]:  # a chain begins
            points, j = [_crossing(ring[i - 1], ring[i], axis, limit)], i
            while inside[j % n]:
                points.append(ring[j % n])
                j += 1
            chains.append([*points, _crossing(ring[j % n], ring[(j - 1) % n], axis, limit)])
    along = 1 - axis
    entries = sorted(range(len(chains)), key=lambda c: chains[c][0][along])
    exits = sorted(range(len(chains)), key=lambda c: chains[c][-1][along])
    after = {c: entries[k] for k, c in enumerate(exits)}
    parts, left = [], set(range(len(chains)))
    while left:
        c, part = min(left), []
        while c in left:
            left.remove(c)
            part += chains[c]
            c = after[c]
        part = list(dict.fromkeys(part))
        if len(part) > 2:
            parts.append(part)
    return parts


def _crossing(out: tuple[float, float], in_: tuple[float, float], axis: int, limit: float) -> tuple[float, float]:
    t = (limit - out[axis]) / (in_[axis] - out[axis])
    other = out[1 - axis] + t * (in_[1 - axis] - out[1 - axis])
    return (limit, other) if axis == 0 else (other, limit)


def clip_ring(ring: list[tuple[float, float]], height: float, width: float) -> list[list[tuple[float, float]]]:
    """The parts of a simple ring of (row, col) within [0, height] x [0, width]."""
    parts = [list(dict.fromkeys(ring))]
    for axis, limit, sign in ((0, 0.0, 1), (0, height, -1), (1, 0.0, 1), (1, width, -1)):
        parts = [p for part in parts for p in _half(part, axis, limit, sign)]
    return [p for p in parts if len(p) > 2]


def clip_rings(df: DataFrame, height: Column, width: Column, ring: str = "ring") -> DataFrame:
    """Rings (simple ones) clipped to [0, height] x [0, width]: a row for each ``part`` (0 and up) of what is left.

    A ring that the frame cuts in several gives as many rows; one of which no area is left gives none.
    """

    @F.pandas_udf("array<array<struct<row:double,col:double>>>")
    def clipped(rings: pd.Series, heights: pd.Series, widths: pd.Series) -> pd.Series:
        out = []
        for r, h, w in zip(rings, heights, widths):
            parts = clip_ring([(float(v["row"]), float(v["col"])) for v in r], h, w) if r is not None else []
            out.append([[{"row": y, "col": x} for y, x in part] for part in parts])
        return pd.Series(out, dtype=object)

    parts = clipped(F.col(ring), height.cast("double"), width.cast("double"))
    others = [c for c in df.columns if c not in (ring, "part")]
    return df.select(*others, F.posexplode(parts).alias("part", ring))


def cells(ring: Column, cell: float, x: str = "x", y: str = "y") -> Column:
    """Grid cells ``cx, cy`` that a ring's bounding box touches."""
    span = lambda n: F.sequence(
        F.floor(F.array_min(F.transform(ring, lambda v: v[n])) / cell), F.floor(F.array_max(F.transform(ring, lambda v: v[n])) / cell)
    )
    return F.flatten(F.transform(span(x), lambda cx: F.transform(span(y), lambda cy: F.struct(cx.alias("cx"), cy.alias("cy")))))


def points_in(points: DataFrame, polygons: DataFrame, on: list[str], ring: str = "ring", x: str = "x", y: str = "y", cell: float = 64.0) -> DataFrame:
    """Pairs of points (columns ``x, y``) and polygons that cover them: an equi-join on grid cells and ``on``.

    A point lies in one cell, so no pair comes twice.
    """
    p = points.withColumns({"__cx": F.floor(F.col(x) / cell), "__cy": F.floor(F.col(y) / cell)})
    q = polygons.withColumn("__cell", F.explode(cells(F.col(ring), cell))).withColumns({"__cx": F.col("__cell.cx"), "__cy": F.col("__cell.cy")})
    found = p.join(q.drop("__cell"), [*on, "__cx", "__cy"])
    return found.where(covers(F.col(ring), F.col(x), F.col(y))).drop("__cx", "__cy")
