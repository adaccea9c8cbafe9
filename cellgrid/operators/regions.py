"""Morphology of labelled objects ``[slide,] roi, element, y, x, label``: aggregates by ``[slide,] roi, mask, label``.

Properties that only add up over pixels are hash aggregates. Hulls and holes take an object row by row (its extremes and
gaps), in kernels that work on many objects a batch.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellgrid.functions.keys import roi_key, typed_key
from cellgrid.operators.segment import min_labels
from cellgrid.operators.tiles import halo_tiles, moved, whole_groups
from cellgrid.sources.storage import stored

SIDES = [(-1, 0), (1, 0), (0, -1), (0, 1)]
DIAGONALS = [(-1, -1), (-1, 1), (1, -1), (1, 1)]


def object_key(df: DataFrame) -> list[str]:
    """What tells objects apart."""
    return [*roi_key(df), "mask", "label"]


def _objects(labels: DataFrame) -> DataFrame:
    return labels.select(*roi_key(labels), F.col("element").alias("mask"), "label", "y", "x").where("label <> 0")


def _moments() -> dict[str, Column]:
    y, x = F.col("y").cast("bigint"), F.col("x").cast("bigint")
    return {"n": F.count("*"), "sy": F.sum(y), "sx": F.sum(x), "syy": F.sum(y * y), "sxx": F.sum(x * x), "sxy": F.sum(x * y)}


def _axes() -> dict[str, Column]:
    """Central second moments, and the larger and smaller eigenvalue of the inertia tensor."""
    n = F.col("n")
    var = lambda s2, a, b: (F.col(s2) * n - F.col(a) * F.col(b)) / (n * n)  # noqa: E731  exact up to the division
    yy, xx, xy = var("syy", "sy", "sy"), var("sxx", "sx", "sx"), var("sxy", "sx", "sy")
    root = F.sqrt((yy - xx) * (yy - xx) + 4 * xy * xy)
    return {"mu_yy": yy, "mu_xx": xx, "mu_xy": xy, "l1": (yy + xx + root) / 2, "l2": F.greatest((yy + xx - root) / 2, F.lit(0.0))}


def basic(labels: DataFrame) -> DataFrame:
    """Area, centroid, bounding box, extent, equivalent diameter, inertia, axes, eccentricity, orientation."""
    box = {"y0": F.min("y"), "x0": F.min("x"), "y1": F.max("y") + 1, "x1": F.max("x") + 1}
    agg = _objects(labels).groupBy(*object_key(labels)).agg(*[c.alias(n) for n, c in (_moments() | box).items()])
    agg = agg.withColumns(_axes())
    area_box = (F.col("y1") - F.col("y0")) * (F.col("x1") - F.col("x0"))
    turn = 0.5 * F.atan2(2 * F.col("mu_xy"), F.col("mu_xx") - F.col("mu_yy"))
    # the angle between the row axis and the major axis; a diagonal tensor gives 0 or a right angle
    turn = F.when((F.col("mu_xx") == F.col("mu_yy")) & (F.col("mu_xy") == 0), F.lit(math.pi / 4)).otherwise(F.lit(math.pi / 2) - turn)
    turn = F.when(turn > math.pi / 2, turn - math.pi).otherwise(turn)
    return agg.select(
        *object_key(labels), F.col("n").alias("area"), F.col("n").alias("num_pixels"), (F.col("sy") / F.col("n")).alias("centroid-0"), (F.col("sx") / F.col("n")).alias("centroid-1"),
        F.col("y0").alias("bbox-0"), F.col("x0").alias("bbox-1"), F.col("y1").alias("bbox-2"), F.col("x1").alias("bbox-3"),
        area_box.alias("area_bbox"), (F.col("n") / area_box).alias("extent"), F.sqrt(4 * F.col("n") / math.pi).alias("equivalent_diameter_area"),
        F.col("mu_xx").alias("inertia_tensor-0-0"), (-F.col("mu_xy")).alias("inertia_tensor-0-1"), (-F.col("mu_xy")).alias("inertia_tensor-1-0"), F.col("mu_yy").alias("inertia_tensor-1-1"),
        F.col("l1").alias("inertia_tensor_eigvals-0"), F.col("l2").alias("inertia_tensor_eigvals-1"),
        (4 * F.sqrt("l1")).alias("axis_major_length"), (4 * F.sqrt("l2")).alias("axis_minor_length"),
        F.when(F.col("l1") == 0, 0.0).otherwise(F.sqrt(1 - F.col("l2") / F.col("l1"))).alias("eccentricity"), turn.alias("orientation"),
    )


def moments(labels: DataFrame) -> DataFrame:
    """``m, mu, nu, hu``: raw (from the box corner), central and normalised moments up to order 3, and Hu's seven."""
    key = object_key(labels)
    box = _objects(labels).groupBy(*key).agg(F.min("y").alias("y0"), F.min("x").alias("x0"))
    local = _objects(labels).join(box, object_key(labels)).withColumns({"v": (F.col("y") - F.col("y0")).cast("bigint"), "u": (F.col("x") - F.col("x0")).cast("bigint")})
    power = lambda c, k: [F.lit(1).cast("bigint"), F.col(c), F.col(c) * F.col(c), F.col(c) * F.col(c) * F.col(c)][k]
    raw = local.groupBy(*object_key(labels)).agg(*[F.sum(power("v", p) * power("u", q)).cast("double").alias(f"m{p}{q}") for p in range(4) for q in range(4)])
    grid = [(p, q) for p in range(4) for q in range(4)]
    columns = [*[f"m{p}{q}" for p, q in grid], *[f"mu{p}{q}" for p, q in grid], *[f"nu{p}{q}" for p, q in grid if p + q > 1], *[f"hu{i}" for i in range(7)], "centroid_local-0", "centroid_local-1"]

    def derived(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = {f"m{p}{q}": pdf[f"m{p}{q}"] for p, q in grid}
            cy, cx = out["m10"] / out["m00"], out["m01"] / out["m00"]
            for p, q in grid:
                out[f"mu{p}{q}"] = sum(math.comb(p, i) * math.comb(q, j) * (-cy) ** (p - i) * (-cx) ** (q - j) * out[f"m{i}{j}"] for i in range(p + 1) for j in range(q + 1))
                if p + q > 1:
                    out[f"nu{p}{q}"] = out[f"mu{p}{q}"] / out["m00"] ** (1 + (p + q) / 2)
            n = lambda p, q: out[f"nu{p}{q}"]  # noqa: B023, E731
            a, b = n(3, 0) + n(1, 2), n(2, 1) + n(0, 3)
            c, d = n(3, 0) - 3 * n(1, 2), 3 * n(2, 1) - n(0, 3)
            e = n(2, 0) - n(0, 2)
            hu = [
                n(2, 0) + n(0, 2), e * e + 4 * n(1, 1) * n(1, 1), c * c + d * d, a * a + b * b,
                c * a * (a * a - 3 * b * b) + d * b * (3 * a * a - b * b), e * (a * a - b * b) + 4 * n(1, 1) * a * b,
                d * a * (a * a - 3 * b * b) - c * b * (3 * a * a - b * b),
            ]
            out |= {f"hu{i}": h for i, h in enumerate(hu)} | {"centroid_local-0": cy, "centroid_local-1": cx}
            yield pd.concat([pdf[key], pd.DataFrame(out)[columns]], axis=1)

    # a kernel on columns of many objects: as expressions, each moment would hold all those below it
    return raw.mapInPandas(derived, f"{typed_key(key[:-1])}, label int, " + ", ".join(f"`{c}` double" for c in columns))


# What a border pixel adds to the perimeter, by 1 + 2 per adjacent and 10 per diagonal border pixel.
PERIMETER = {1.0: (5, 7, 15, 17, 25, 27), math.sqrt(2): (21, 33), (1 + math.sqrt(2)) / 2: (13, 23)}


def perimeter(labels: DataFrame, tile: int = 256) -> DataFrame:
    """Perimeter of the border pixels' centre line, with 4-neighbourhoods.

    Tiles with a halo of two pixels count their border pixels by kind; the counts of an object's tiles are added up.
    """
    key = object_key(labels)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        first = pdf.iloc[0]
        area = np.zeros((tile + 4, tile + 4), np.int64)
        area[pdf.y.to_numpy() - int(first.ty) * tile + 2, pdf.x.to_numpy() - int(first.tx) * tile + 2] = pdf.label.to_numpy()
        border = np.zeros(area.shape, bool)
        for y, x in SIDES:
            border |= moved(area, y, x) != area
        own = np.where(border, area, 0)
        code = np.ones(area.shape, np.int64)
        for step, offsets in ((2, SIDES), (10, DIAGONALS)):
            for y, x in offsets:
                code += step * (moved(own, y, x) == own)
        y, x = np.nonzero(own[2:-2, 2:-2])
        return pd.DataFrame({**{k: first[k] for k in key[:-1]}, "label": own[y + 2, x + 2], "code": code[y + 2, x + 2]}).groupby([*key, "code"], as_index=False).size()

    tiles = halo_tiles(_objects(labels), 2, tile).groupBy(*key[:-1], "ty", "tx")
    counted = tiles.applyInPandas(run, f"{typed_key(key[:-1])}, label int, code int, size bigint")
    # whole counts first, so that the sum doesn't depend on the order of tiles
    count = lambda codes: F.sum(F.when(F.col("code").isin(*codes), F.col("size")).otherwise(0))
    total = sum((count(codes) * w for w, codes in PERIMETER.items()), F.lit(0.0))
    return counted.groupBy(*object_key(labels)).agg(total.alias("perimeter"))


def _quads(labels: DataFrame) -> DataFrame:
    """Each object's 2 x 2 patterns: bits 1, 2, 4, 8 for top left, top right, bottom left, bottom right."""
    corner = {(0, 0): 1, (0, -1): 2, (-1, 0): 4, (-1, -1): 8}
    table = F.array(*[F.struct(F.lit(y).alias("dy"), F.lit(x).alias("dx"), F.lit(b).alias("bit")) for (y, x), b in corner.items()])
    parts = _objects(labels).withColumn("o", F.explode(table))
    return parts.groupBy(*object_key(labels), (F.col("y") + F.col("o.dy")).alias("qy"), (F.col("x") + F.col("o.dx")).alias("qx")).agg(F.bit_or("o.bit").alias("p"))


def euler_number(labels: DataFrame) -> DataFrame:
    """Objects less holes, with 8-neighbourhoods, from counts of 2 x 2 patterns (Gray, 1971)."""
    count = lambda *ps: F.sum(F.when(F.col("p").isin(*ps), 1).otherwise(0))
    euler = (count(1, 2, 4, 8) - count(7, 11, 13, 14) - 2 * count(6, 9)) / 4
    return _quads(labels).groupBy(*object_key(labels)).agg(euler.cast("int").alias("euler_number"))


def perimeter_crofton(labels: DataFrame) -> DataFrame:
    """Perimeter from line intersections in four directions (Crofton's formula), on 2 x 2 patterns."""
    flips = lambda a, b: F.sum(F.when((F.col("p").bitwiseAND(a) != 0) != (F.col("p").bitwiseAND(b) != 0), 1).otherwise(0))
    across, down = flips(1, 2), flips(1, 4)
    diagonal = flips(1, 8) + flips(2, 4)
    length = math.pi / 4 * (across + down + diagonal / math.sqrt(2)) / 2
    return _quads(labels).groupBy(*object_key(labels)).agg(length.alias("perimeter_crofton"))


def _by_rows(df: DataFrame, keys: list[str], kernel: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """``kernel`` on batches of whole groups of rows that have ``y``, each group in order of ``y``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in whole_groups(batches, keys):
            yield kernel(whole)

    return df.repartition(*keys).sortWithinPartitions(*keys, "y").mapInPandas(run, schema)


def _starts(pdf: pd.DataFrame, keys: list[str]) -> np.ndarray:
    """Where groups begin."""
    new = np.zeros(len(pdf), bool)
    for k in keys:
        values = pdf[k].to_numpy()
        new[1:] |= values[1:] != values[:-1]
    new[:1] = True
    return np.flatnonzero(new)


def _chain(points: list[tuple[int, int]], side: int) -> list[tuple[int, int]]:
    """The convex chain on the left (-1) or right (1) of points with ascending first coordinate (Andrew, 1979)."""
    out: list[tuple[int, int]] = []
    for p in points:
        while len(out) > 1 and side * ((out[-1][0] - out[-2][0]) * (p[1] - out[-2][1]) - (out[-1][1] - out[-2][1]) * (p[0] - out[-2][0])) >= 0:
            out.pop()
        out.append(p)
    return out


def _widest(ring: list[tuple[int, int]]) -> int:
    """The largest squared distance of two corners of a convex ring, by rotating calipers (Shamos, 1978)."""
    n, j, best = len(ring), 1, 0
    far = lambda a, b: (a[0] - b[0]) ** 2 + (a[1] - b[1]) ** 2
    for i in range(n):
        a, b = ring[i], ring[(i + 1) % n]
        off = lambda p: abs((b[0] - a[0]) * (p[1] - a[1]) - (b[1] - a[1]) * (p[0] - a[0]))  # noqa: B023, E731
        for _ in range(n):
            if off(ring[(j + 1) % n]) <= off(ring[j]):
                break
            j = (j + 1) % n
        best = max(best, *(far(p, ring[k % n]) for p in (a, b) for k in (j, j + 1)))
    return best


def hull(labels: DataFrame) -> DataFrame:
    """``area, area_convex, solidity, feret_diameter_max``: pixels in the convex hull of the pixel diamonds.

    Each row of an object gives its extremes. The hull's left and right chains come from those, in twice the coordinates,
    so that all is exact: a diamond's corners are the middles of its pixel's sides.
    """
    key = object_key(labels)
    rows = _objects(labels).groupBy(*key, "y").agg(F.min("x").alias("lo"), F.max("x").alias("hi"), F.count("*").alias("n"))

    def kernel(pdf: pd.DataFrame) -> pd.DataFrame:
        starts = _starts(pdf, key)
        ys, los, his = (pdf[c].to_numpy(np.int64) for c in ("y", "lo", "hi"))
        convex, feret = [], []
        for begin, end in zip(starts, [*starts[1:], len(pdf)]):
            left: dict[int, int] = {}
            right: dict[int, int] = {}
            for y, lo, hi in zip(ys[begin:end].tolist(), los[begin:end].tolist(), his[begin:end].tolist()):
                for at, l_, r_ in ((2 * y - 1, 2 * lo, 2 * hi), (2 * y, 2 * lo - 1, 2 * hi + 1), (2 * y + 1, 2 * lo, 2 * hi)):
                    left[at] = min(left.get(at, l_), l_)
                    right[at] = max(right.get(at, r_), r_)
            sides = [_chain(sorted(c.items()), s) for c, s in ((left, -1), (right, 1))]
            # for each row, the chains' places at its middle
            at = np.arange(2 * ys[begin], 2 * ys[end - 1] + 1, 2)
            ends = []
            for points in sides:
                p = np.array(points)
                k = np.clip(np.searchsorted(p[:, 0], at, "right") - 1, 0, len(p) - 2)
                (ay, ax), (by, bx) = p[k].T, p[k + 1].T
                ends.append((ax * (by - ay) + (at - ay) * (bx - ax), 2 * (by - ay)))
            (l_, lw), (r_, rw) = ends
            convex.append(int(np.maximum(0, r_ // rw + -l_ // lw + 1).sum()))
            ring = list(dict.fromkeys([*sides[0], *sides[1][::-1]]))
            feret.append(math.sqrt(_widest(ring)) / 2)
        first = pdf.iloc[starts][key].reset_index(drop=True)
        return first.assign(area=np.add.reduceat(pdf.n.to_numpy(), starts), area_convex=convex, feret_diameter_max=feret)

    found = _by_rows(rows, key, kernel, f"{typed_key(key[:-1])}, label int, area bigint, area_convex bigint, feret_diameter_max double")
    return found.withColumn("solidity", F.col("area") / F.col("area_convex"))


def _components(rows: list[tuple[int, int, int, list[tuple[int, int]]]]) -> tuple[list[list[int]], list[int], list[bool]]:
    """Components of the gaps of consecutive rows ``y, lo, hi, gaps (begin, end)`` of an object: of each gap, their sizes, whether open.

    Gaps of neighbouring rows that overlap are one. A gap that reaches beyond the object's extremes in a neighbouring row,
    or has no row of the object beside it, is open; the first and last row are not known to be (their neighbours are elsewhere).
    """
    root: list[int] = []
    size: list[int] = []
    open_: list[bool] = []
    at: list[list[int]] = []

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = i = root[root[i]]
        return i

    for r, (y, _, _, gaps) in enumerate(rows):
        at.append(list(range(len(root), len(root) + len(gaps))))
        for begin, end in gaps:
            root.append(len(root))
            size.append(end - begin)
            beside = [rows[k] if 0 <= k < len(rows) and rows[k][0] == y + k - r else None for k in (r - 1, r + 1)]
            inner = [k for k in (0, 1) if (r > 0, r + 1 < len(rows))[k]]
            open_.append(any(beside[k] is None or begin < beside[k][1] or end > beside[k][2] + 1 for k in inner))
        if r and rows[r - 1][0] == y - 1:
            i = j = 0
            up = rows[r - 1][3]
            while i < len(up) and j < len(gaps):
                if up[i][0] < gaps[j][1] and gaps[j][0] < up[i][1]:
                    a, b = find(at[r - 1][i]), find(at[r][j])
                    if a != b:
                        root[max(a, b)] = min(a, b)
                i, j = (i + 1, j) if up[i][1] < gaps[j][1] else (i, j + 1)
    sizes, opens = [0] * len(root), [False] * len(root)
    for i in range(len(root)):
        sizes[find(i)] += size[i]
        opens[find(i)] |= open_[i]
    return [[find(i) for i in own] for own in at], sizes, opens


def filled(labels: DataFrame, strip: int = 1024) -> DataFrame:
    """Area with the holes filled: gaps in an object's rows that no way through neighbouring gaps leads out of.

    A kernel takes an object's rows in strips of ``strip`` rows, so that an object of any size is in bounded pieces. Gaps at
    a strip's edges are compared with the row beyond, and components of several strips joined.
    """
    if strip < 2:
        raise ValueError("a strip has two rows at least")
    key = object_key(labels)
    xs = F.col("xs")
    before = F.filter(xs, lambda x, i: (i + 1 < F.size(xs)) & (F.get(xs, i + 1) > x + 1))
    after = F.filter(xs, lambda x, i: (i > 0) & (F.get(xs, i - 1) < x - 1))
    rows = _objects(labels).groupBy(*key, "y").agg(F.sort_array(F.collect_list("x")).alias("xs"))
    rows = rows.select(*key, F.floor(F.col("y") / strip).alias("strip"), "y", F.get("xs", F.lit(0)).alias("lo"), F.element_at("xs", -1).alias("hi"), F.size("xs").alias("n"), before.alias("before"), after.alias("after"))
    group = [*key, "strip"]

    def kernel(pdf: pd.DataFrame) -> pd.DataFrame:
        starts = _starts(pdf, group)
        ys, los, his, ns = (pdf[c].tolist() for c in ("y", "lo", "hi", "n"))
        gaps = [[(b + 1, e) for b, e in zip(*pair)] for pair in zip(map(list, pdf.before), map(list, pdf.after))]
        out: dict[str, list] = {c: [] for c in ("row", "area", "component", "size", "open", "y", "lo", "hi", "begin", "end")}

        def add(*values) -> None:
            for c, v in zip(out, values):
                out[c].append(v)

        for begin, end in zip(starts.tolist(), [*starts[1:].tolist(), len(pdf)]):
            mine = list(zip(ys[begin:end], los[begin:end], his[begin:end], gaps[begin:end]))
            at, sizes, opens = _components(mine)
            # an edge row of the object that is not one of the strip has nothing beyond: its gaps are open
            for r in {0, len(mine) - 1}:
                inside = ys[begin + r] % strip not in ((0,) if r == 0 else (strip - 1,)) or (len(mine) == 1 and strip > 1)
                if inside:
                    for c in at[r]:
                        opens[c] = True
            seam = {c for r in {0, len(mine) - 1} for c in at[r]}
            closed = sum(s for c, s in enumerate(sizes) if s and not opens[c] and c not in seam)
            add(begin, sum(ns[begin:end]) + closed, None, 0, False, None, None, None, None, None)
            for c in sorted(seam):
                if sizes[c] and not opens[c]:
                    add(begin, 0, c, sizes[c], False, None, None, None, None, None)
            for r in {0, len(mine) - 1}:
                if ys[begin + r] % strip in (0, strip - 1):
                    for c, (b, e) in zip(at[r], mine[r][3]):
                        add(begin, 0, c, 0, opens[c], *mine[r][:3], b, e)
                    add(begin, 0, None, 0, False, *mine[r][:3], None, None)
        keys = pdf.iloc[out.pop("row")][group].reset_index(drop=True)
        return pd.concat([keys, pd.DataFrame({c: pd.array(v, "boolean" if c == "open" else "Int64") for c, v in out.items()})], axis=1)

    schema = f"{typed_key(key[:-1])}, label int, strip bigint, area bigint, component bigint, size bigint, open boolean, y bigint, lo bigint, hi bigint, begin bigint, end bigint"
    found = stored(_by_rows(rows, group, kernel, schema))
    inside = found.groupBy(*key).agg(F.sum("area").alias("area"))
    # components at edges of strips: what lies beyond each of their gaps
    node = F.struct("strip", "component")
    edge = found.where("begin is not null").select(*key, node.alias("a"), "y", "begin", "end", "open")
    beyond = F.when(F.col("y") % strip == 0, F.col("y") - 1).otherwise(F.col("y") + 1)
    next_rows = found.where("y is not null and begin is null").select(*key, F.col("y").alias("by"), F.col("lo").alias("blo"), F.col("hi").alias("bhi"))
    seen = edge.withColumn("by", beyond).join(next_rows, [*key, "by"], "left")
    leaks = F.col("blo").isNull() | (F.col("begin") < F.col("blo")) | (F.col("end") > F.col("bhi") + 1)
    outside = seen.where(leaks | F.col("open")).select(*key, F.col("a").alias("node")).distinct()
    other = edge.select(*key, F.col("y").alias("by"), F.col("a").alias("b"), F.col("begin").alias("bbegin"), F.col("end").alias("bend"))
    links = edge.withColumn("by", beyond).join(other, [*key, "by"]).where("begin < bend and bbegin < end").select(*key, "a", "b")
    holes = found.where("component is not null and size > 0").select(*key, node.alias("node"), "size")
    if links.isEmpty():
        holes, leaking = holes.withColumnRenamed("node", "root"), outside.withColumnRenamed("node", "root")
    else:
        whole = F.struct(*key)
        named = links.select(F.lit("objects").alias("roi"), F.struct(whole.alias("o"), F.col("a").alias("n")).alias("a"), F.struct(whole.alias("o"), F.col("b").alias("n")).alias("b"))
        joined = min_labels(named).select(F.col("node.o.*"), F.col("node.n").alias("node"), F.col("label.n").alias("root"))
        holes = holes.join(joined, [*key, "node"], "left").withColumn("root", F.coalesce("root", "node"))
        leaking = outside.join(joined, [*key, "node"], "left").select(*key, F.coalesce("root", "node").alias("root")).distinct()
    more = holes.join(leaking, [*key, "root"], "left_anti").groupBy(*key).agg(F.sum("size").alias("more"))
    return inside.join(more, key, "left").select(*key, (F.col("area") + F.coalesce("more", F.lit(0))).alias("area_filled"))


def coords(labels: DataFrame) -> DataFrame:
    """The pixels of each object, in order."""
    return _objects(labels).groupBy(*object_key(labels)).agg(F.sort_array(F.collect_list(F.struct("y", "x"))).alias("coords"))


def moment_columns(labels: DataFrame) -> DataFrame:
    """:func:`moments` under the names of the object table."""
    m = moments(labels)
    grid = [(p, q) for p in range(4) for q in range(4)]
    named = {f"moments-{p}-{q}": F.col(f"m{p}{q}") for p, q in grid} | {f"moments_central-{p}-{q}": F.col(f"mu{p}{q}") for p, q in grid}
    named |= {f"moments_normalized-{p}-{q}": F.col(f"nu{p}{q}") for p, q in grid if p + q > 1} | {f"moments_hu-{i}": F.col(f"hu{i}") for i in range(7)}
    return m.select(*object_key(labels), *[c.alias(n) for n, c in named.items()], "`centroid_local-0`", "`centroid_local-1`")


_GRID = [(p, q) for p in range(4) for q in range(4)]

#: Properties by name: the columns, and what computes them. ``label`` is a column of every table.
PROPERTIES: dict[str, tuple[tuple[str, ...], Callable[[DataFrame], DataFrame]]] = {
    "label": ((), basic),
    **{c: ((c,), basic) for c in ("area", "num_pixels", "area_bbox", "extent", "equivalent_diameter_area", "axis_major_length", "axis_minor_length", "eccentricity", "orientation")},
    "centroid": (("centroid-0", "centroid-1"), basic), "bbox": (("bbox-0", "bbox-1", "bbox-2", "bbox-3"), basic),
    "inertia_tensor": (("inertia_tensor-0-0", "inertia_tensor-0-1", "inertia_tensor-1-0", "inertia_tensor-1-1"), basic),
    "inertia_tensor_eigvals": (("inertia_tensor_eigvals-0", "inertia_tensor_eigvals-1"), basic),
    **{c: ((c,), hull) for c in ("area_convex", "solidity", "feret_diameter_max")},
    "perimeter": (("perimeter",), perimeter), "perimeter_crofton": (("perimeter_crofton",), perimeter_crofton),
    "euler_number": (("euler_number",), euler_number), "area_filled": (("area_filled",), filled), "coords": (("coords",), coords),
    "moments": (tuple(f"moments-{p}-{q}" for p, q in _GRID), moment_columns), "moments_central": (tuple(f"moments_central-{p}-{q}" for p, q in _GRID), moment_columns),
    "moments_normalized": (tuple(f"moments_normalized-{p}-{q}" for p, q in _GRID if p + q > 1), moment_columns),
    "moments_hu": (tuple(f"moments_hu-{i}" for i in range(7)), moment_columns), "centroid_local": (("centroid_local-0", "centroid_local-1"), moment_columns),
}

DEFAULT = ("label", "area", "centroid", "eccentricity", "solidity", "perimeter", "euler_number")


def properties(labels: DataFrame, names: Sequence[str] = DEFAULT) -> DataFrame:
    """``[slide,] roi, mask, label`` and the columns of the named properties."""
    if unknown := [n for n in names if n not in PROPERTIES]:
        raise ValueError(f"unknown properties {unknown}; there are {sorted(PROPERTIES)}")
    key = object_key(labels)
    wanted: dict[Callable, list[str]] = {}
    for n in names:
        columns, of = PROPERTIES[n]
        wanted.setdefault(of, []).extend(columns)
    if len(wanted) > 1 and not wanted.get(basic, True):
        del wanted[basic]  # asked for nothing but the label, which all have
    parts = [of(labels).select(*key, *[F.col(f"`{c}`") for c in dict.fromkeys(columns)]) for of, columns in wanted.items()]
    return functools.reduce(lambda a, b: a.join(b, key), parts)
