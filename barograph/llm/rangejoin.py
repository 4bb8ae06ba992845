"""Embedding near-dedup: an exact metric range join of unit vectors around pivots.

Cosine of ``least`` or more is a Euclidean distance of r = sqrt(2 - 2 least) or less between unit vectors. Rows with one
vector are one class before the join. Pivots come from a bounded sample of classes, none within r of another.
Every class belongs to the cell of its nearest pivot. A pair of cells is settled in one of the two, its host: there a
class of the other cell comes as a visitor if it may be within r of a member,

* by the triangle inequality: no farther from the host's pivot than the cell's radius and r together, and
* by the plane between the two pivots: no farther from it than r.

Members within r / 2 of their pivot are linked with each other, by the triangle inequality again: they are counted,
not compared, so thousands of near copies around a pivot cost no pairs. They meet only what is within 1.5 r of the pivot.

All that meets in a cell is cut into blocks of ``rows`` classes, and each pair of blocks is a tile of its own, so a
crowded cell spreads over many tasks. A tile multiplies in float32 and recomputes what lies within the error bound of
the limit in double precision. It returns one row per class with a link: the rows linked with, and one class of the
same group, so that links never leave a tile pair by pair.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, components

#: What rounding may add to a distance between unit vectors.
ROUNDING = 1e-7


@dataclass(frozen=True)
class Range:
    """Cosine of ``least`` or more; ``sample`` classes to choose up to ``pivots`` pivots from, one per
    ``cell`` classes; blocks of ``rows``."""

    least: float = 0.95
    sample: int = 4096
    pivots: int = 1024
    cell: int = 4096
    rows: int = 8192

    @property
    def radius(self) -> float:
        return math.sqrt(max(0.0, 2 - 2 * self.least))


def usable(vector: str = "embedding") -> Column:
    """The vector as doubles; null if it is null, empty, zero or holds null or non-finite components."""
    number = F.col(vector).cast("array<double>")
    bad = F.exists(number, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return F.when((F.size(number) > 0) & ~bad & F.exists(number, lambda c: c != 0), number)


def _flat(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def units(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled by their largest entry first, so that squares neither overflow nor vanish."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0, 2 - 2 * (a @ b.T)))


def spread_pivots(sample: np.ndarray, apart: float, most: int) -> np.ndarray:
    """The first ``most`` rows of the sample that lie farther than ``apart`` from all chosen before."""
    chosen: list[int] = []
    near = np.full(len(sample), np.inf)
    for i in range(len(sample)):
        if near[i] > apart:
            chosen.append(i)
            if len(chosen) == most:
                break
            np.minimum(near, distances(sample, sample[i : i + 1])[:, 0], out=near)
    return sample[chosen]


@dataclass(frozen=True)
class Cells:
    """The pivots of one vector length; once counted: radius, members and visitors per cell.

    counts: per cell the members in the inner ball, the other members, the visitors.
    """

    pivots: np.ndarray
    reach: float
    rows: int
    radius: np.ndarray | None = None
    counts: np.ndarray | None = None

    def homes(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(distances to all pivots, cell, distance to its pivot)."""
        if not len(self.pivots):
            return np.zeros((len(unit), 1)), np.zeros(len(unit), np.int64), np.full(len(unit), np.inf)
        far = distances(unit, self.pivots)
        home = far.argmin(axis=1)
        return far, home, far[np.arange(len(unit)), home]

    def inner(self, near: np.ndarray) -> np.ndarray:
        return near <= self.reach / 2 - ROUNDING

    def visits(self, far: np.ndarray, home: np.ndarray, near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, cell) for every cell a class visits."""
        if not len(self.pivots):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        cell = np.arange(len(self.pivots))
        between = distances(self.pivots, self.pivots)
        low, high = np.minimum(home[:, None], cell), np.maximum(home[:, None], cell)
        host = np.where((low + high) % 2 == 0, low, high)
        may = (host == cell) & (home[:, None] != cell)
        may &= far <= self.radius + self.reach + ROUNDING
        may &= far**2 - near[:, None] ** 2 <= 2 * between[home] * (self.reach + ROUNDING) + ROUNDING
        return np.nonzero(may)

    def blocks(self) -> np.ndarray:
        return np.maximum(1, -(-self.counts // self.rows))


CELLS = "width int, cell int, inner long, outer long, copies long, first long, radius double"


def _sizes(cells: dict[int, Cells]):
    """Members of the cells, as far as a task has met them."""

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[int, int], list] = {}
        for gid, copies, unit in _by_width(batches):
            own = cells[unit.shape[1]]
            _, home, near = own.homes(unit)
            inside = own.inner(near)
            for cell in np.unique(home):
                here = home == cell
                ball = here & inside
                new = [ball.sum(), (here & ~inside).sum(), copies[ball].sum(), gid[ball].min() if ball.any() else 1 << 62,
                       near[here].max()]
                old = found.get((unit.shape[1], int(cell)), [0, 0, 0, 1 << 62, 0.0])
                found[unit.shape[1], int(cell)] = [
                    old[0] + new[0], old[1] + new[1], old[2] + new[2], min(old[3], new[3]), max(old[4], new[4])
                ]
        rows = [(*key, *value) for key, value in found.items()]
        names = ["width", "cell", "inner", "outer", "copies", "first", "radius"]
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64()]
        columns = list(zip(*rows, strict=True)) or [()] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return sizes


def _by_width(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(gid, copies, unit vectors) of rows with one vector length, 2,048 at most."""
    for batch in batches:
        lengths = batch.column(2).value_lengths().to_numpy(zero_copy_only=False)
        for width in np.unique(lengths):
            places = np.flatnonzero(lengths == width)
            for at in range(0, len(places), 2048):
                part = batch.take(pa.array(places[at : at + 2048]))
                yield (
                    part.column(0).to_numpy(), part.column(1).to_numpy(), units(_flat(part.column(2), int(width)))
                )


VISITS = "width int, cell int, visitors long"


def _visitors(cells: dict[int, Cells]):
    def visitors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = {width: np.zeros(max(1, len(own.pivots)), np.int64) for width, own in cells.items()}
        for _, _, unit in _by_width(batches):
            own = cells[unit.shape[1]]
            _, cell = own.visits(*own.homes(unit))
            np.add.at(found[unit.shape[1]], cell, 1)
        for width, counts in found.items():
            some = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(some), width, np.int32)), pa.array(some.astype(np.int32)), pa.array(counts[some])],
                names=["width", "cell", "visitors"],
            )

    return visitors


#: A tile is known by vector length, cell, the kinds of its two sides and their blocks.
PLACED = "width int, cell int, tile int, i int, j int, side int, gid long, copies long, unit binary"
INNER, OUTER, VISITOR = 0, 1, 2
#: Kinds of the two sides of the tiles of a cell.
MEET = ((INNER, OUTER), (INNER, VISITOR), (OUTER, OUTER), (OUTER, VISITOR))


def _placed(cells: dict[int, Cells]):
    """A row for each tile that a class takes part in."""

    def copies_of(own: Cells, cell, kind: int, close, block) -> Iterator[tuple[np.ndarray, ...]]:
        """(rows, tile, i, j, side) for classes of one kind in the given cells."""
        blocks = own.blocks()
        for tile, (first, second) in enumerate(MEET):
            for side, (mine, other) in enumerate(((first, second), (second, first))):
                if mine != kind or own.counts[:, other].max(initial=0) == 0:
                    continue
                some = np.flatnonzero((own.counts[cell, other] > 0) & (close | (INNER not in (mine, other))))
                times = blocks[cell[some], other]
                row = np.repeat(some, times)
                across = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
                down = block[row] % blocks[cell[row], kind]
                i, j = (down, across) if side == 0 else (across, down)
                keep = (i <= j) if first == second else np.ones(len(row), bool)
                # In a tile of one block with itself both sides are the same rows: they come once.
                keep &= ~((i == j) & (side == 1)) if first == second else True
                yield row[keep], tile, i[keep], j[keep], side

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for gid, copies, unit in _by_width(batches):
            width = unit.shape[1]
            own = cells[width]
            far, home, near = own.homes(unit)
            data = np.ascontiguousarray(unit).view(f"V{8 * width}")[:, 0]
            block = (gid.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64)
            inside = own.inner(near)
            guest, cell = own.visits(far, home, near)
            close = own.reach * 1.5 + ROUNDING
            groups = [
                (np.flatnonzero(inside), INNER, home, near), (np.flatnonzero(~inside), OUTER, home, near),
                (guest, VISITOR, cell, far[guest, cell] if len(guest) else near[:0]),
            ]
            for rows, kind, at, distance in groups:
                if kind != VISITOR:
                    at, distance = at[rows], distance[rows]
                for row, tile, i, j, side in copies_of(own, at, kind, distance <= close, block[rows]):
                    for k in range(0, len(row), 4096):
                        part = row[k : k + 4096]
                        n, who = len(part), rows[part]
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(np.full(n, width, np.int32)), pa.array(at[part].astype(np.int32)),
                                pa.array(np.full(n, tile, np.int32)), pa.array(i[k : k + 4096].astype(np.int32)),
                                pa.array(j[k : k + 4096].astype(np.int32)), pa.array(np.full(n, side, np.int32)),
                                pa.array(gid[who]), pa.array(copies[who]), pa.array(data[who].tolist(), pa.binary()),
                            ],
                            names=["width", "cell", "tile", "i", "j", "side", "gid", "copies", "unit"],
                        )

    return placed


def linked(a: np.ndarray, b: np.ndarray, least: float) -> np.ndarray:
    """Which rows of a and b (unit vectors in double precision) have a cosine of ``least`` or more."""
    rough = a.astype(np.float32) @ b.astype(np.float32).T
    slack = (a.shape[1] + 8) * 2.0**-22
    sure = rough >= least + slack
    i, j = np.nonzero((rough >= least - slack) & ~sure)
    for at in range(0, len(i), 100_000):
        x, y = i[at : at + 100_000], j[at : at + 100_000]
        sure[x, y] = np.einsum("ij,ij->i", a[x], b[y]) >= least
    return sure


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest node connected with each of n nodes over edges (a, b)."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


FOUND = "gid long, links long, root long"


def _tile(least: float):
    def tile(table: pa.Table) -> pa.Table:
        width = table.column("width")[0].as_py()
        side = table.column("side").to_numpy()
        gid, copies = table.column("gid").to_numpy(), table.column("copies").to_numpy()
        unit = np.frombuffer(b"".join(table.column("unit").to_pylist()), np.float64).reshape(-1, width)
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        # Tile 2 with i = j holds one block, to be compared with itself.
        own = table.column("tile")[0].as_py() == 2 and table.column("i")[0].as_py() == table.column("j")[0].as_py()
        if own:
            right = left
        links = np.zeros(len(gid), np.int64)
        edges = []
        for at in range(0, len(left), 512):
            some = left[at : at + 512]
            found = linked(unit[some], unit[right], least)
            if own:
                found[np.arange(len(some)), np.arange(at, at + len(some))] = False
            links[some] += found @ copies[right]
            if not own:
                links[right] += copies[some] @ found
            x, y = np.nonzero(found)
            edges.append((some[x], right[y]))
        a, b = (np.concatenate(x) if edges else np.empty(0, int) for x in (zip(*edges, strict=True) if edges else ((), ())))
        root = gid[roots(len(gid), a, b)]
        some = links > 0
        return pa.table({"gid": gid[some], "links": links[some], "root": root[some]})

    return tile


def near_vectors(rows: DataFrame, limits: Range = Range()) -> DataFrame:
    """One row per row of ``rows``: vec_id, n_links (other rows with a cosine of ``least`` or more), component_id (the
    smallest id reachable over links, its own included) and kept (vec_id = component_id).

    ``rows`` has vec_id and embedding; other columns are ignored. Vectors that are null, empty, zero or hold null or
    non-finite components link with nothing; vectors of different lengths neither. Rows that repeat an id are rows of
    their own. A row without id takes part in links and components but never names one: its component_id is null if
    no id is reachable, and it isn't kept. Distances on the limit count as links.
    """
    spark = rows.sparkSession
    work, last = Scratch(spark), Scratch(spark)
    all_rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), usable().alias("vector"))
    live = all_rows.where("vector is not null")
    classes = live.groupBy("vector").agg(F.count("*").alias("copies"), F.min("vec_id").alias("least"))
    classes = last.table(classes.select(F.monotonically_increasing_id().alias("gid"), "copies", "vector", "least"), "range-classes")
    slim = classes.select("gid", "copies", "vector")

    widths = {row["width"]: row["n"] for row in classes.groupBy(F.size("vector").alias("width")).agg(F.count("*").alias("n")).collect()}
    n = sum(widths.values())
    share = min(1.0, 2.0 * limits.sample / max(n, 1))
    picked = classes.where(F.pmod(F.xxhash64("gid"), F.lit(1 << 20)) < max(1, math.ceil(share * (1 << 20))))
    picked = picked.orderBy(F.xxhash64("gid", F.lit(1))).limit(limits.sample).select("vector").collect()
    cells = {}
    for width, many in widths.items():
        sample = [r["vector"] for r in picked if len(r["vector"]) == width]
        sample = units(np.array(sample)) if sample else np.empty((0, width))
        most = max(1, min(limits.pivots, many // limits.cell))
        cells[width] = Cells(spread_pivots(sample, limits.radius, most), limits.radius, limits.rows)

    sizes = slim.mapInArrow(_sizes(cells), CELLS).groupBy("width", "cell").agg(
        F.sum("inner").alias("inner"), F.sum("outer").alias("outer"), F.sum("copies").alias("copies"),
        F.min("first").alias("first"), F.max("radius").alias("radius"),
    ).collect()  # one row per cell
    for width, own in cells.items():
        counts, radius = np.zeros((max(1, len(own.pivots)), 3), np.int64), np.zeros(len(own.pivots))
        for row in (r for r in sizes if r["width"] == width):
            counts[row["cell"], :2] = row["inner"], row["outer"]
            if len(radius):
                radius[row["cell"]] = row["radius"]
        cells[width] = Cells(own.pivots, own.reach, own.rows, radius, counts)
    visits = slim.mapInArrow(_visitors(cells), VISITS).groupBy("width", "cell").agg(F.sum("visitors").alias("visitors"))
    for row in visits.collect():  # one row per cell
        cells[row["width"]].counts[row["cell"], VISITOR] = row["visitors"]

    placed = slim.mapInArrow(_placed(cells), PLACED)
    found = placed.groupBy("width", "cell", "tile", "i", "j").applyInArrow(_tile(limits.least), FOUND)
    ball = [(r["width"], r["cell"], r["inner"], r["copies"], r["first"]) for r in sizes if r["inner"] > 1]
    found = work.table(found.union(slim.mapInArrow(_balls(cells, ball), FOUND)), "range-found")

    links = found.groupBy("gid").agg(F.sum("links").alias("links"))
    root = components(found.select(F.col("gid").alias("a"), F.col("root").alias("b")), work)
    named = classes.select("gid", "least").join(root.toDF("gid", "root"), "gid", "left")
    named = named.select("gid", "least", F.coalesce("root", "gid").alias("root"))
    lowest = named.groupBy("root").agg(F.min("least").alias("component_id"))
    result = named.join(lowest, "root").join(links, "gid", "left").select(
        "gid", "component_id", F.coalesce("links", F.lit(0)).alias("links")
    )
    result = last.table(classes.join(result, "gid").select("vector", "copies", "component_id", "links"), "range-result")
    work.drop()
    linked_rows = live.join(result, "vector").select(
        "vec_id", (F.col("links") + F.col("copies") - 1).alias("n_links"), "component_id"
    )
    others = all_rows.where("vector is null").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    out = linked_rows.union(others)
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def _balls(cells: dict[int, Cells], found: list[tuple[int, int, int, int, int]]):
    """Links inside the inner balls: each class with all others of its ball, and the ball's first class as its root."""
    known = {(width, cell): (copies, first) for width, cell, _, copies, first in found}

    def balls(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for gid, copies, unit in _by_width(batches):
            own = cells[unit.shape[1]]
            _, home, near = own.homes(unit)
            inside = own.inner(near)
            for cell in np.unique(home[inside]):
                if (unit.shape[1], int(cell)) in known:
                    total, first = known[unit.shape[1], int(cell)]
                    some = inside & (home == cell)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(gid[some]), pa.array(total - copies[some]), pa.array(np.full(some.sum(), first))],
                        names=["gid", "links", "root"],
                    )

    return balls
