"""Problem 1: points near other points, and the region that holds a point.

Points near points. Cells of a latitude/longitude grid are at least four radii wide at every latitude. One side of the
join stays in its own cell, the other visits every cell its circle touches (one to four), so each pair meets in exactly
one cell; distances are then exact. Equal positions are one row until the end, so a position that a third of all rows
share costs one row per source in the join. The join is an equi-join on the cell, which AQE splits where a cell is hot.

Regions. Rings are cut into triangles by ear clipping, each ring in a task. A bounding-volume hierarchy over the triangles is
descended by all points of a batch at once, which leaves for each point the few triangles whose box holds it; these are tested
exactly, and a point within rounding error of an edge is settled by the even-odd rule on its rings, so that points on the
shared edge of two triangles (or two regions) get one answer; of several features the smallest order wins. Up to
``BROADCAST_CORNERS`` there is one hierarchy, which is broadcast; beyond that the triangles are rows that are spread over the
cells of a grid, each cell with a hierarchy of its own, and the even-odd rule joins points with ring edges by latitude band.
"""

from __future__ import annotations

import math
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidemill.functions.identity import trimmed
from tidemill.session import Scratch

#: Metres; mean radius of the earth.
EARTH = 6_371_008.8
#: Regions of up to this many ring corners in all (24 bytes each) are broadcast.
BROADCAST_CORNERS = 2_000_000
#: Degrees of a cell of the region grid that is used beyond it (at most 64,800 cells), of a band of ring edges, and distinct
#: positions of a cell that are placed in one task.
REGION_CELL, BAND, CELL_POINTS = 1.0, 0.01, 1 << 18
#: Degrees from an edge within which a point is settled by the even-odd rule.
EDGE = 1e-7


def usable(lat: Column, lon: Column) -> Column:
    """lat in [-90, 90], lon in [-180, 360], both numbers, not exactly 0/0. NaN and null are not usable."""
    ok = ~F.isnan(lat) & ~F.isnan(lon) & lat.between(-90, 90) & lon.between(-180, 360) & ~((lat == 0) & (lon == 0))
    return F.coalesce(ok, F.lit(False))


def meridian(lon: Column) -> Column:
    """Longitude in [-180, 180)."""
    return F.when(lon >= 180, lon - 360).otherwise(lon)


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in metres."""
    a, b = F.radians(lat2 - lat1) / 2, F.radians(lon2 - lon1) / 2
    h = F.pow(F.sin(a), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(b), 2)
    return 2 * EARTH * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


class Grid:
    """Bands of equal latitude, each cut into as many cells as fit at its narrower edge."""

    def __init__(self, radius: float):
        self.radius = radius
        self.reach = math.degrees(radius / EARTH) * (1 + 1e-9) + 1e-12  # degrees of latitude
        self.height = 4 * self.reach

    def band(self, lat: Column) -> Column:
        return F.floor((lat + 90) / self.height)

    def cells_of_band(self, band: Column) -> Column:
        edge = F.greatest(F.abs(band * self.height - 90), F.abs((band + 1) * self.height - 90))
        around = 360 * F.cos(F.radians(F.least(edge, F.lit(90.0)))) / self.height
        return F.greatest(F.floor(around), F.lit(1))

    def cell(self, band: Column, lon: Column) -> Column:
        n = self.cells_of_band(band)
        at = F.floor((lon + 180) / 360 * n)
        return band * 1_000_000_000 + F.pmod(at, n)

    def own(self, lat: Column, lon: Column) -> Column:
        return self.cell(self.band(lat), lon)

    def touched(self, lat: Column, lon: Column) -> Column:
        """Cells (each once) that hold a point within the radius."""
        far = F.greatest(F.abs(lat - self.reach), F.abs(lat + self.reach))
        ratio = F.sin(F.lit(math.radians(self.reach))) / F.cos(F.radians(F.least(far, F.lit(90.0))))
        turn = F.when((far >= 90) | (ratio >= 1), F.lit(180.0)).otherwise(F.degrees(F.asin(F.least(ratio, F.lit(1.0)))) * (1 + 1e-9) + 1e-12)
        bands = F.sequence(self.band(F.greatest(lat - self.reach, F.lit(-90.0))), self.band(F.least(lat + self.reach, F.lit(90.0))))

        def of(band: Column) -> Column:
            n = self.cells_of_band(band)
            low, high = F.floor((lon - turn + 180) / 360 * n), F.floor((lon + turn + 180) / 360 * n)
            high = F.least(high, low + n - 1)
            return F.transform(F.sequence(low, high), lambda i: band * 1_000_000_000 + F.pmod(i, n))

        return F.array_distinct(F.flatten(F.transform(bands, of)))


def within(left: DataFrame, right: DataFrame, radius: float) -> DataFrame:
    """Pairs of rows (as l.*, r.*) at most ``radius`` metres apart; both have lat, lon (in [-180, 180))."""
    grid = Grid(radius)
    left = left.withColumn("cell", grid.own(F.col("lat"), F.col("lon"))).alias("l")
    right = right.withColumn("cell", F.explode(grid.touched(F.col("lat"), F.col("lon")))).alias("r")
    met = left.join(right, F.col("l.cell") == F.col("r.cell"))
    return met.filter(haversine(F.col("l.lat"), F.col("l.lon"), F.col("r.lat"), F.col("r.lon")) <= radius)


# --- regions ---------------------------------------------------------------------------------------------------------


def ear_clip(ring: np.ndarray) -> tuple[np.ndarray, bool]:
    """Triangles (n, 3, 2), all in one direction, of a ring (k, 2), closed or not, in either direction, and whether they are
    exactly its inside.

    Repeated and collinear corners are left out. Corners wait in a queue; one is an ear if no reflex corner lies in its
    triangle, for which only those in the grid cells around it are looked at, so that the work grows little faster than the
    number of corners. Where a self-crossing leaves no ear, the corner of least area is cut: then the triangles cover the
    inside and perhaps more, and the even-odd rule has to settle every point in them.
    """
    p = np.asarray(ring, float)
    p = p[np.r_[True, (np.diff(p, axis=0) != 0).any(1)]]
    if len(p) > 1 and (p[0] == p[-1]).all():
        p = p[:-1]
    if len(p) < 3:
        return np.empty((0, 3, 2)), True
    u, v = p.T
    if (u * np.roll(v, -1) - np.roll(u, -1) * v).sum() < 0:
        p = p[::-1]
    x, y, n = p[:, 0].tolist(), p[:, 1].tolist(), len(p)
    before, after = [n - 1, *range(n - 1)], [*range(1, n), 0]
    turn = lambda a, b, c: (x[b] - x[a]) * (y[c] - y[a]) - (y[b] - y[a]) * (x[c] - x[a])
    low, span = p.min(0), np.maximum(np.ptp(p, axis=0), 1e-300)
    side = max(1, int(math.sqrt(n)))
    where = lambda a, b: (min(side - 1, int((a - low[0]) / span[0] * side)), min(side - 1, int((b - low[1]) / span[1] * side)))
    low, span = low.tolist(), span.tolist()
    reflex: dict[tuple[int, int], set[int]] = {}
    bent = [False] * n

    def mark(i: int) -> None:
        now = turn(before[i], i, after[i]) < 0
        if now != bent[i]:
            cell = where(x[i], y[i])
            if now:
                reflex.setdefault(cell, set()).add(i)
            else:
                reflex[cell].discard(i)
            bent[i] = now

    def blocked(a: int, b: int, c: int) -> bool:
        west, south = where(min(x[a], x[b], x[c]), min(y[a], y[b], y[c]))
        east, north = where(max(x[a], x[b], x[c]), max(y[a], y[b], y[c]))
        many = (east - west + 1) * (north - south + 1)
        cells = reflex if many > len(reflex) else [(i, j) for i in range(west, east + 1) for j in range(south, north + 1)]
        corners = {(x[a], y[a]), (x[b], y[b]), (x[c], y[c])}
        for cell in cells:
            for q in reflex.get(cell, ()):
                if turn(a, b, q) >= 0 and turn(b, c, q) >= 0 and turn(c, a, q) >= 0 and (x[q], y[q]) not in corners:
                    return True
        return False

    for i in range(n):
        mark(i)
    out, gone, sure, left, failed = [], [False] * n, True, n, 0
    queue, waits = deque(range(n)), [True] * n
    while left > 3:
        if not queue or failed > left:  # no ear is left
            alive = [i for i in range(n) if not gone[i]]
            queue, waits, sure, failed = deque(alive), [True] * n, False, 0
            i = min(alive, key=lambda j: abs(turn(before[j], j, after[j])))
        else:
            i = queue.popleft()
            waits[i] = False
            if gone[i]:
                continue
            if bent[i] or (turn(before[i], i, after[i]) != 0 and blocked(before[i], i, after[i])):
                if not bent[i]:
                    queue.append(i)
                    waits[i] = True
                    failed += 1
                continue
        a, c = before[i], after[i]
        if turn(a, i, c) != 0:
            out.append((a, i, c))
        after[a], before[c], gone[i], left, failed = c, a, True, left - 1, 0
        if bent[i]:
            reflex[where(x[i], y[i])].discard(i)
        for j in (a, c):
            mark(j)
            if not waits[j]:
                queue.append(j)
                waits[j] = True
    rest = [i for i in range(n) if not gone[i]]
    if turn(*rest) != 0:
        out.append(tuple(rest))
    sure = sure and all(turn(*t) > 0 for t in out)
    return p[np.array([t if turn(*t) > 0 else t[::-1] for t in out], int).reshape(-1, 3)], sure


class Boxes:
    """A bounding-volume hierarchy: triangles halved by the median of the wider axis, down to ``LEAF`` of them."""

    LEAF = 4

    def __init__(self, triangles: np.ndarray, owner: np.ndarray):
        self.triangles, self.owner = triangles, owner
        self.low, self.high, self.kids, self.items = [], [], [], []
        if len(triangles):
            self._build(np.arange(len(triangles)), triangles.min(1), triangles.max(1))
        self.low, self.high = np.array(self.low).reshape(-1, 2) - EDGE, np.array(self.high).reshape(-1, 2) + EDGE

    def _build(self, items: np.ndarray, low: np.ndarray, high: np.ndarray) -> int:
        at = len(self.kids)
        self.low.append(low[items].min(0))
        self.high.append(high[items].max(0))
        self.kids.append(None)
        self.items.append(items)
        if len(items) > self.LEAF:
            middle = (low[items] + high[items]) / 2
            order = items[np.argsort(middle[:, np.argmax(np.ptp(middle, axis=0))], kind="stable")]
            half = len(order) // 2
            self.kids[at] = (self._build(order[:half], low, high), self._build(order[half:], low, high))
        return at

    def candidates(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(point, triangle) of all whose leaf box holds the point: all points descend together."""
        found_p, found_t = [], []
        stack = [(0, np.arange(len(points)))] if self.kids else []
        while stack:
            node, who = stack.pop()
            q = points[who]
            who = who[((q >= self.low[node]) & (q <= self.high[node])).all(1)]
            if not len(who):
                continue
            if self.kids[node]:
                stack += [(k, who) for k in self.kids[node]]
            else:
                items = self.items[node]
                found_p.append(np.repeat(who, len(items)))
                found_t.append(np.tile(items, len(who)))
        none = np.empty(0, np.int64)
        return (np.concatenate(found_p), np.concatenate(found_t)) if found_p else (none, none)


def even_odd(points: np.ndarray, ring: np.ndarray) -> np.ndarray:
    """Whether the ring holds each point, by the even-odd rule on the plane (a crossing counts its lower end)."""
    a, b = ring, np.roll(ring, -1, axis=0)
    x, y = points[:, :1], points[:, 1:]
    with np.errstate(divide="ignore", invalid="ignore"):
        cut = a[:, 0] + (y - a[:, 1]) * (b[:, 0] - a[:, 0]) / (b[:, 1] - a[:, 1])
    return ((((a[:, 1] > y) != (b[:, 1] > y)) & (x < cut)).sum(1) % 2).astype(bool)


class Regions:
    """Triangles of rings and the hierarchy over them. owner: the ring of each triangle; order, sure: of each ring."""

    def __init__(self, triangles: np.ndarray, owner: np.ndarray, order: np.ndarray, sure: np.ndarray):
        self.tree, self.order, self.sure = Boxes(triangles, owner), order, sure

    def hits(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(point, ring, near) of each (lon, lat) and the rings with a triangle that holds it; near says that the even-odd rule
        must settle it, because it lies beside an edge or the triangles are not sure."""
        who, tri = self.tree.candidates(points)
        t, q = self.tree.triangles[tri], points[who]
        side, near = [], np.zeros(len(who), bool)
        for i in range(3):
            a, b = t[:, i], t[:, (i + 1) % 3]
            d = b - a
            c = d[:, 0] * (q[:, 1] - a[:, 1]) - d[:, 1] * (q[:, 0] - a[:, 0])
            side.append(c)
            near |= np.abs(c) <= EDGE * np.maximum(np.hypot(d[:, 0], d[:, 1]), 1e-12)
        inside = (np.array(side).reshape(3, -1) > 0).all(0)
        ring = self.tree.owner[tri]
        near |= inside & ~self.sure[ring]
        ok = inside | near
        return who[ok], ring[ok], near[ok]

    def locate(self, points: np.ndarray, rings: list[np.ndarray]) -> np.ndarray:
        """For each (lon, lat) the smallest order of a feature with a ring that holds it, or -1."""
        none = np.iinfo(np.int64).max
        best = np.full(len(points), none)
        who, ring, near = self.hits(points)
        np.minimum.at(best, who[~near], self.order[ring[~near]])
        if near.any():  # the ring itself decides, once per point and ring
            asked = np.unique(np.stack([who[near], ring[near]], 1), axis=0)
            for r in np.unique(asked[:, 1]):
                p = asked[asked[:, 1] == r, 0]
                p = p[even_odd(points[p], rings[r])]
                np.minimum.at(best, p, self.order[r])
        return np.where(best == none, -1, best)


def _rings(outlines: DataFrame) -> DataFrame:
    """(ring, feature_ord, lon array, lat array), repeated rings once; rings with null or too few corners hold nothing."""
    good = outlines.filter("feature_ord is not null and size(ring) >= 3 and not exists(ring, p -> p is null or p.lon is null or p.lat is null or isnan(p.lon) or isnan(p.lat))")
    good = good.selectExpr("cast(feature_ord as bigint) feature_ord", "transform(ring, p -> double(p.lon)) lon", "transform(ring, p -> double(p.lat)) lat").distinct()
    return good.select(F.xxhash64("feature_ord", "lon", "lat").alias("ring"), "feature_ord", "lon", "lat")


CORNERS = ["ax", "ay", "bx", "by", "cx", "cy"]


def triangles(rings: DataFrame) -> DataFrame:
    """(ring, feature_ord, sure, ax, ay, bx, by, cx, cy): every triangle of every ring, each ring clipped in a task."""

    def clip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for ring, order, lon, lat in zip(*(b.column(c) for c in ("ring", "feature_ord", "lon", "lat")), strict=True):
                t, sure = ear_clip(np.stack([lon.values.to_numpy(), lat.values.to_numpy()], 1))
                fixed = [pa.array(np.full(len(t), v.as_py())) for v in (ring, order)] + [pa.array(np.full(len(t), sure))]
                yield pa.RecordBatch.from_arrays([*fixed, *(pa.array(c) for c in t.reshape(-1, 6).T.copy())], ["ring", "feature_ord", "sure", *CORNERS])

    return rings.mapInArrow(clip, "ring bigint, feature_ord bigint, sure boolean, " + ", ".join(f"{c} double" for c in CORNERS))


def _regions(table: pa.Table) -> tuple[Regions, np.ndarray]:
    """Hierarchy over a table of triangles, and the ring ids by number."""
    ring, at, owner = np.unique(table.column("ring").to_numpy(), return_index=True, return_inverse=True)
    corners = np.stack([table.column(c).to_numpy() for c in CORNERS], 1).reshape(-1, 3, 2)
    order, sure = table.column("feature_ord").to_numpy()[at], table.column("sure").to_numpy(zero_copy_only=False)[at]
    return Regions(corners, owner, order, sure), ring


def locate(spark: SparkSession, points: DataFrame, outlines: DataFrame, most: int | None = None) -> DataFrame:
    """points (lat, lon in [-180, 180) and more) with ``feature_ord`` of the feature holding each; the others drop out.

    Region sets of more than ``most`` corners (BROADCAST_CORNERS) are spread over a grid instead of being broadcast.
    """
    rings = _rings(outlines)
    corners = rings.agg(F.sum(F.size("lon"))).first()[0] or 0
    if corners > (BROADCAST_CORNERS if most is None else most):
        return _locate_by_cell(spark, points, rings)
    schema = StructType([*points.schema.fields, StructField("feature_ord", LongType())])
    regions, ids = _regions(triangles(rings).toArrow())
    outline = {r["ring"]: np.stack([r["lon"], r["lat"]], 1) for r in rings.toLocalIterator()}
    shared = spark.sparkContext.broadcast((regions, [outline[i] for i in ids.tolist()]))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, outlines = shared.value
        for b in batches:
            at = np.stack([b.column("lon").to_numpy(zero_copy_only=False), b.column("lat").to_numpy(zero_copy_only=False)], 1)
            own = known.locate(at, outlines)
            out = pa.RecordBatch.from_arrays([*b.columns, pa.array(own)], [*b.schema.names, "feature_ord"])
            yield out.filter(pa.array(own >= 0))

    return points.mapInArrow(place, schema)


def _locate_by_cell(spark: SparkSession, points: DataFrame, rings: DataFrame) -> DataFrame:
    """``locate`` for any number of regions: positions and triangles meet by grid cell, one hierarchy per cell.

    Equal positions are one row. A cell with more than CELL_POINTS positions is cut into pieces, to each of which its triangles
    go. What lies beside an edge meets the edges of that ring in its latitude band.
    """
    scratch = Scratch(spark, "regions")
    rings = scratch.keep(rings)
    grid = lambda c: F.floor(c / REGION_CELL).cast("int")
    spots = points.select("lat", "lon").distinct().withColumns({"gx": grid(F.col("lon")), "gy": grid(F.col("lat"))})
    spots = scratch.keep(spots)
    hot = spots.groupBy("gx", "gy").count().filter(F.col("count") > CELL_POINTS)
    hot = F.broadcast(hot.select("gx", "gy", F.ceil(F.col("count") / CELL_POINTS).cast("int").alias("pieces")))  # at most as many as the grid has cells
    pieces = F.coalesce("pieces", F.lit(1))
    spots = spots.join(hot, ["gx", "gy"], "left").withColumn("piece", F.pmod(F.xxhash64("lat", "lon"), pieces).cast("int")).drop("pieces")
    reach = lambda of, names, sign: grid(of(*names) + sign * EDGE)
    cover = lambda names: F.explode(F.sequence(reach(F.least, names, -1), reach(F.greatest, names, 1)))
    parts = triangles(rings).withColumn("gx", cover(CORNERS[::2])).withColumn("gy", cover(CORNERS[1::2]))
    parts = parts.join(hot, ["gx", "gy"], "left").withColumn("piece", F.explode(F.sequence(F.lit(0), pieces - 1))).drop("pieces")

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["lat", "lon", "ring", "feature_ord", "near"]
        if not len(left) or not len(right):
            return pa.table({n: pa.array([], t) for n, t in zip(names, (pa.float64(), pa.float64(), pa.int64(), pa.int64(), pa.bool_()), strict=True)})
        regions, ids = _regions(right)
        lat, lon = left.column("lat").to_numpy(), left.column("lon").to_numpy()
        who, ring, near = regions.hits(np.stack([lon, lat], 1))
        return pa.table(dict(zip(names, (lat[who], lon[who], ids[ring], regions.order[ring], near), strict=True)))

    key = ["gx", "gy", "piece"]
    hits = spots.groupBy(*key).cogroup(parts.groupBy(*key)).applyInArrow(meet, "lat double, lon double, ring bigint, feature_ord bigint, near boolean")
    hits = scratch.keep(hits.distinct())
    band = lambda c: F.floor(c / BAND).cast("int")
    ends = F.transform("lon", lambda c, i: F.struct(c.alias("x1"), F.get("lat", i).alias("y1"), F.get("lon", (i + 1) % F.size("lon")).alias("x2"), F.get("lat", (i + 1) % F.size("lon")).alias("y2")))
    edges = rings.select("ring", F.explode(ends).alias("e")).select("ring", "e.*").filter("y1 <> y2")
    edges = edges.withColumn("band", F.explode(F.sequence(band(F.least("y1", "y2")), band(F.greatest("y1", "y2")))))
    beside = hits.groupBy("lat", "lon", "ring", "feature_ord").agg(F.min("near").alias("near")).filter("near").withColumn("band", band(F.col("lat")))
    crosses = ((F.col("y1") > F.col("lat")) != (F.col("y2") > F.col("lat"))) & (F.col("lon") < F.col("x1") + (F.col("lat") - F.col("y1")) * (F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1")))
    settled = beside.join(edges, ["ring", "band"]).filter(crosses).groupBy("lat", "lon", "ring", "feature_ord").count().filter("count % 2 = 1")
    inside = hits.filter("not near").select("lat", "lon", "feature_ord").union(settled.select("lat", "lon", "feature_ord"))
    first = inside.groupBy("lat", "lon").agg(F.min("feature_ord").alias("feature_ord"))
    return points.join(first, ["lat", "lon"]).select(*points.columns, "feature_ord")


# --- the problem -----------------------------------------------------------------------------------------------------


def positions(rows: DataFrame, *keep: Column | str) -> DataFrame:
    """The usable positions of rows: ``keep``, lat, lon in [-180, 180)."""
    rows = rows.filter(usable(F.col("lat"), F.col("lon")))
    return rows.select(*keep, F.col("lat").cast("double").alias("lat"), meridian(F.col("lon").cast("double")).alias("lon"))


def found(spark: SparkSession, metadata: DataFrame, sites: DataFrame, outlines: DataFrame, site_m: float = 300, image_m: float = 20) -> DataFrame:
    """(kind, row_id, other): sites near images, images of other sources near images, and the region of each image.

    ``site``: a row that is not location_generalized, a site at most ``site_m`` away (other = site_id). ``image``: two such
    rows of different source_id at most ``image_m`` apart (row_id the smaller, other the larger). ``region``: any usable
    row and the feature holding it (other = feature_ord). Unusable positions match nothing; a null location_generalized
    counts as not generalized; null source_ids are no source and match nothing; null site_ids are no site. Repeated sites
    count once.
    """
    scratch = Scratch(spark, "nearby")
    rows = scratch.keep(positions(metadata, "row_id", "source_id", F.coalesce("location_generalized", F.lit(False)).alias("vague")))
    exact = rows.filter("not vague")
    site = positions(sites.withColumn("site_id", F.nullif(trimmed(F.col("site_id")), F.lit(""))).filter("site_id is not null"), "site_id").distinct()
    # positions first here too: one row per place, however many images lie there
    by_site = within(exact.select("lat", "lon").distinct(), site, site_m).select("l.lat", "l.lon", F.col("r.site_id").alias("other")).distinct()
    by_site = exact.join(by_site, ["lat", "lon"]).select(F.lit("site").alias("kind"), "row_id", "other").distinct()

    # positions first: one row per place and source, however many images share it
    where = exact.filter("source_id is not null").withColumn("place", F.struct(F.xxhash64("lat", "lon", "source_id"), F.xxhash64("source_id", "lon", "lat")))
    spots = where.groupBy("place", "lat", "lon", "source_id").agg(F.count("*").alias("n"))
    near = within(spots, spots, image_m).filter((F.col("l.source_id") != F.col("r.source_id")) & (F.col("l.place") < F.col("r.place")))
    near = scratch.keep(near.select(F.col("l.place").alias("a"), F.col("r.place").alias("b")))
    ids = near.select(F.explode(F.array("a", "b")).alias("place")).distinct()
    there = where.select("row_id", "place").join(ids, "place", "left_semi")
    a, b = there.select(F.col("place").alias("a"), F.col("row_id").alias("i")), there.select(F.col("place").alias("b"), F.col("row_id").alias("j"))
    by_image = near.join(a, "a").join(b, "b").select(F.lit("image").alias("kind"), F.least("i", "j").alias("row_id"), F.greatest("i", "j").cast("string").alias("other"))
    region = locate(spark, rows.select("row_id", "lat", "lon"), outlines)
    by_region = region.select(F.lit("region").alias("kind"), "row_id", F.col("feature_ord").cast("string").alias("other"))
    return by_site.union(by_image).union(by_region)
