"""What comes near the outlines of a group of cells: whole columns of pairs at a time, and a count per outline.

A cell of dense tables holds thousands of pieces beside hundreds of outlines. Their pairs are compared as arrays in one task and
only the counts leave it, so no pair becomes a row. Blocks bound the pairs that are held at once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Pairs of a block, whose columns stay in a core's cache; pairs of a cell from which it is compared by itself, as a table of its
#: outlines and pieces.
BLOCK_PAIRS = 1 << 16
DENSE_PAIRS = 1 << 12
TINY = 1e-300


def _columns(table: pa.Table, order: np.ndarray, names: tuple[str, ...]) -> dict[str, np.ndarray]:
    return {name: table.column(name).to_numpy()[order] for name in names}


def _ragged(first: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each i the numbers from ``first[i]``, ``n[i]`` of them: every i as often, and these numbers."""
    i = np.repeat(np.arange(len(n)), n)
    return i, np.arange(len(i)) + np.repeat(first - (np.cumsum(n) - n), n)


class Outlines:
    """Outlines in the order of their cells, with their edges, and for each the places of what its cell holds."""

    def __init__(self, table: pa.Table, cells: np.ndarray, names: tuple[str, ...]):
        own = table.column("cell").to_numpy()
        order = own.argsort(kind="stable")
        first, last = (np.searchsorted(cells, own[order], side=side) for side in ("left", "right"))
        met = last > first
        self.rows, self.first, self.n = order[met], first[met], (last - first)[met]
        self.at = _columns(table, self.rows, ("west", "south", "east", "north", "mid_lon", "mid_lat", "in_sq", "out_sq", *names))
        edges = table.column("_edges").combine_chunks()
        n = pc.fill_null(pc.list_value_length(edges), 0).to_numpy()
        self.first_edge, self.n_edges = (np.cumsum(n) - n)[self.rows], n[self.rows]
        held = edges.flatten()
        self.edges = {c: held.field(c).to_numpy() for c in ("ax", "ay", "bx", "by")}

    def blocks(self) -> Iterator[tuple[int, int, bool]]:
        """Ranges of outlines with a bounded number of pairs, and whether a range lies in one cell."""
        starts = np.flatnonzero(np.r_[True, self.first[1:] != self.first[:-1]]) if len(self.first) else []
        begin = held = 0
        for a, b in zip(starts, [*starts[1:], len(self.first)]):
            n = int(self.n[a])
            if (b - a) * n < DENSE_PAIRS:
                held += (b - a) * n
                if held > BLOCK_PAIRS:
                    yield begin, b, False
                    begin, held = b, 0
                continue
            if begin < a:
                yield begin, a, False
            step = max(1, BLOCK_PAIRS // n)
            for i in range(a, b, step):
                yield i, min(i + step, b), True
            begin, held = b, 0
        if begin < len(self.first):
            yield begin, len(self.first), False

    def pairs(self, begin: int, end: int, dense: bool, test: Callable[[dict[str, np.ndarray], slice | np.ndarray], np.ndarray], names: tuple[str, ...]) -> tuple[np.ndarray, np.ndarray]:
        """Outlines and places of all pairs of a block that pass ``test``, which gets columns of outlines and the places."""
        if dense:
            places = slice(int(self.first[begin]), int(self.first[begin] + self.n[begin]))
            passed = test({c: self.at[c][begin:end, None] for c in names}, places)
            o = np.repeat(np.arange(end - begin), np.count_nonzero(passed, axis=1))
            return o + begin, np.flatnonzero(passed) + (places.start - o * passed.shape[1])
        o, k = _ragged(self.first[begin:end], self.n[begin:end])
        o += begin
        passed = np.flatnonzero(test({c: self.at[c][o] for c in names}, k))
        return o[passed], k[passed]

    def edge_pairs(self, o: np.ndarray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
        """For pairs with the outlines ``o``: the number of the pair and the edge, for every edge."""
        i, e = _ragged(self.first_edge[o], self.n_edges[o])
        return i, {c: v[e] for c, v in self.edges.items()}


def _odd(i: np.ndarray, e: dict[str, np.ndarray], lon: np.ndarray, lat: np.ndarray, n: int) -> np.ndarray:
    """Whether the point of each of ``n`` pairs is inside its outline (as :func:`geo.crosses_ray`)."""
    left = (lon - e["ax"]) * (e["by"] - e["ay"]) < (e["bx"] - e["ax"]) * (lat - e["ay"])
    crossed = ((e["ay"] > lat) != (e["by"] > lat)) & (left == (e["by"] > e["ay"]))
    return np.bincount(i[crossed], minlength=n) % 2 == 1


def _to_segment_sq(x: np.ndarray, y: np.ndarray, ax: np.ndarray, ay: np.ndarray, dx: np.ndarray, dy: np.ndarray, sq: np.ndarray) -> np.ndarray:
    t = ((x - ax) * dx + (y - ay) * dy) / np.maximum(sq, TINY)
    np.clip(t, 0, 1, out=t)
    ex, ey = x - (ax + t * dx), y - (ay + t * dy)
    return ex * ex + ey * ey


def _segments_near(a: list[np.ndarray], b: list[np.ndarray], buffer_deg: float) -> np.ndarray:
    """Segments that cross or come within the buffer of each other (as :func:`geo.segments_near`)."""

    def side(s: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return (s[2] - s[0]) * (y - s[1]) - (s[3] - s[1]) * (x - s[0])

    def foot(s: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> np.ndarray:
        dx, dy = s[2] - s[0], s[3] - s[1]
        sq = dx * dx + dy * dy
        far = np.where(sq > 0, buffer_deg * np.sqrt(sq), -1)
        return (np.abs(2 * (dx * (x - s[0]) + dy * (y - s[1])) - sq) <= sq) & (np.abs(side(s, x, y)) <= far)

    near, left = np.zeros(len(a[0]), dtype=bool), np.arange(len(a[0]))
    for test in (
        lambda a, b: np.logical_or.reduce([(a[i] - b[j]) ** 2 + (a[i + 1] - b[j + 1]) ** 2 <= buffer_deg * buffer_deg for i in (0, 2) for j in (0, 2)]),
        lambda a, b: foot(b, *a[:2]) | foot(b, *a[2:]) | foot(a, *b[:2]) | foot(a, *b[2:]),
        lambda a, b: ((side(a, *b[:2]) < 0) != (side(a, *b[2:]) < 0)) & ((side(b, *a[:2]) < 0) != (side(b, *a[2:]) < 0)),
    ):
        found = test([c[left] for c in a], [c[left] for c in b])
        near[left[found]] = True
        left = left[~found]
    return near


def counts_schema(outlines: DataFrame) -> T.StructType:
    return T.StructType([outlines.schema["buildingid"], T.StructField("n", T.LongType())])


BOX = ("west", "south", "east", "north")


def count_points(points: pa.Table, outlines: pa.Table, buffer_deg: float) -> pa.Table:
    """``(buildingid, n)``: points, each ``n`` times, inside or within ``buffer_deg`` of each outline of their cell."""
    cells = points.column("cell").to_numpy()
    order = cells.argsort(kind="stable")
    own, p = Outlines(outlines, cells[order], ()), _columns(points, order, ("lon", "lat", "n"))
    total = np.zeros(len(own.rows), dtype=np.int64)

    def boxed(o: dict[str, np.ndarray], k: slice | np.ndarray) -> np.ndarray:
        lon, lat = p["lon"][k], p["lat"][k]
        return (lon >= o["west"]) & (lon <= o["east"]) & (lat >= o["south"]) & (lat <= o["north"])

    for begin, end, dense in own.blocks():
        o, k = own.pairs(begin, end, dense, boxed, BOX)
        x, y = p["lon"][k], p["lat"][k]
        gap = (x - own.at["mid_lon"][o]) ** 2 + (y - own.at["mid_lat"][o]) ** 2
        near = gap <= own.at["in_sq"][o]
        rest = np.flatnonzero(~near & (gap <= own.at["out_sq"][o]))
        i, e = own.edge_pairs(o[rest])
        x, y = x[rest][i], y[rest][i]
        dx, dy = e["bx"] - e["ax"], e["by"] - e["ay"]
        close = _to_segment_sq(x, y, e["ax"], e["ay"], dx, dy, dx * dx + dy * dy) <= buffer_deg * buffer_deg
        near[rest] = _odd(i, e, x, y, len(rest)) | (np.bincount(i[close], minlength=len(rest)) > 0)
        np.add.at(total, o[near], p["n"][k[near]])
    return _result(outlines, own, total)


def _result(outlines: pa.Table, own: Outlines, total: np.ndarray) -> pa.Table:
    some = np.flatnonzero(total)
    return pa.table({"buildingid": outlines.column("buildingid").take(pa.array(own.rows[some])), "n": pa.array(total[some], pa.int64())})


def count_shapes(pieces: pa.Table, outlines: pa.Table, buffer_deg: float) -> pa.Table:
    """``(buildingid, n)``: shapes that meet the outlines of their cell grown by ``buffer_deg``, less the areas that hold the cell's centre.

    A shape meets an outline if a piece of it comes near or begins inside, or if it is an area and the way from the cell's centre to the
    outline's first corner ``(x, y)``, along the centre line and then north or south, leads into it. ``centre`` tells whether the area
    holds the centre.
    """
    cells, shapes = pieces.column("cell").to_numpy(), pieces.column("shape").to_numpy()
    order = np.lexsort((shapes, cells))
    cells, shapes = cells[order], shapes[order]
    p = _columns(pieces, order, ("n", "is_area", "centre", "ax", "ay", "bx", "by", "px", "py", "qx", "qy"))
    own = Outlines(outlines, cells, ("x", "y", "_mid", "_centre"))
    new = np.r_[True, (cells[1:] != cells[:-1]) | (shapes[1:] != shapes[:-1])] if len(cells) else np.zeros(0, dtype=bool)
    shape = np.cumsum(new) - 1  # of each piece, numbered from 0, anew in each cell
    n, centre = p["n"][new], p["centre"][new].astype(np.int8)
    dx, dy = p["qx"] - p["px"], p["qy"] - p["py"]
    sq = dx * dx + dy * dy
    low_x, high_x, low_y, high_y = np.minimum(p["px"], p["qx"]), np.maximum(p["px"], p["qx"]), np.minimum(p["py"], p["qy"]), np.maximum(p["py"], p["qy"])
    total = np.zeros(len(own.rows), dtype=np.int64)
    if not len(own.rows):
        return _result(outlines, own, total)
    first_shape = shape[own.first]
    n_shapes = shape[own.first + own.n - 1] - first_shape + 1

    def boxed(o: dict[str, np.ndarray], k: slice | np.ndarray) -> np.ndarray:
        return (low_x[k] <= o["east"]) & (o["west"] <= high_x[k]) & (low_y[k] <= o["north"]) & (o["south"] <= high_y[k])

    # Where an area's edge meets the centre line of its cell; NaN, which passes no comparison, where a piece does not.
    firsts = np.flatnonzero(np.r_[True, own.first[1:] != own.first[:-1]])
    which, k = _ragged(own.first[firsts], own.n[firsts])
    mid, middle = (own.at[c][firsts][which] for c in ("_mid", "_centre"))
    on_line, west_of_centre = np.full(len(shape), np.nan), np.zeros(len(shape), dtype=bool)
    met = p["is_area"][k] & ((p["py"][k] > mid) != (p["qy"][k] > mid))
    k, ay = k[met], p["ay"][k[met]]
    on_line[k] = p["ax"][k] + (mid[met] - ay) * (p["bx"][k] - p["ax"][k]) / (p["by"][k] - ay)
    west_of_centre[k] = on_line[k] <= middle[met]
    area_px, area_qx = (np.where(p["is_area"], p[c], np.nan) for c in ("px", "qx"))

    def spans_lon(o: dict[str, np.ndarray], k: slice | np.ndarray) -> np.ndarray:
        return (area_px[k] > o["x"]) != (area_qx[k] > o["x"])

    def flips_along(o: dict[str, np.ndarray], k: slice | np.ndarray) -> np.ndarray:
        return (on_line[k] <= o["x"]) != west_of_centre[k]

    for begin, end, dense in own.blocks():
        sizes = n_shapes[begin:end]
        # One place per outline and shape of its cell.
        starts = np.cumsum(sizes) - sizes
        base = starts - first_shape[begin:end]
        hit = np.zeros(int(sizes.sum()), dtype=bool)
        o, k = own.pairs(begin, end, dense, boxed, BOX)
        gap = _to_segment_sq(own.at["mid_lon"][o], own.at["mid_lat"][o], p["px"][k], p["py"][k], dx[k], dy[k], sq[k])
        place = base[o - begin] + shape[k]
        held = gap <= own.at["in_sq"][o]
        hit[place[held]] = True
        rest = np.flatnonzero(~held & (gap <= own.at["out_sq"][o]) & ~hit[place])
        hit[place[rest][_pieces_near(own, o[rest], [p[c][k[rest]] for c in ("px", "py", "qx", "qy")], buffer_deg)]] = True
        turns = np.zeros(len(hit), dtype=np.uint8)  # their parity is all that counts
        o, k = own.pairs(begin, end, dense, flips_along, ("x",))
        np.add.at(turns, base[o - begin] + shape[k], np.uint8(1))
        o, k = own.pairs(begin, end, dense, spans_lon, ("x",))
        ax, ay = p["ax"][k], p["ay"][k]
        lat = ay + (own.at["x"][o] - ax) * (p["by"][k] - ay) / (p["bx"][k] - ax)
        crossed = (lat <= own.at["_mid"][o]) != (lat <= own.at["y"][o])
        np.add.at(turns, base[o - begin] + shape[k], crossed.astype(np.uint8))
        _, which = _ragged(first_shape[begin:end], sizes)
        around = centre[which]
        meets = hit | ((turns + around) % 2 == 1)
        total[begin:end] = np.add.reduceat(n[which] * (meets.view(np.int8) - around), starts)
    return _result(outlines, own, total)


def _pieces_near(own: Outlines, o: np.ndarray, piece: list[np.ndarray], buffer_deg: float) -> np.ndarray:
    """Whether each piece begins inside its outline or comes near one of its edges."""
    i, e = own.edge_pairs(o)
    px, py, qx, qy = (c[i] for c in piece)
    near = _odd(i, e, px, py, len(o))
    spare = buffer_deg * 1.000001
    close = np.flatnonzero(
        (np.minimum(px, qx) <= np.maximum(e["ax"], e["bx"]) + spare) & (np.minimum(e["ax"], e["bx"]) <= np.maximum(px, qx) + spare)
        & (np.minimum(py, qy) <= np.maximum(e["ay"], e["by"]) + spare) & (np.minimum(e["ay"], e["by"]) <= np.maximum(py, qy) + spare)
        & ~near[i]
    )
    found = _segments_near([c[close] for c in (px, py, qx, qy)], [e[c][close] for c in ("ax", "ay", "bx", "by")], buffer_deg)
    near[i[close[found]]] = True
    return near
