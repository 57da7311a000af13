"""Pairs of outlines and what comes near them, compared as arrays: blocks, dense cells and split cells give the same counts."""

import random
from functools import partial

import pytest

from linkscout.operators import near, rank, shapes, skew
from tests.test_shapes import BUFFER, LICENCES, frames, inside, closed, gap, meets, world


@pytest.fixture(scope="module")
def crowd(spark):
    """Lines, areas and points of which a third lie in one cell, and the count by comparing every pair."""
    outlines, licences = world(8, 10.0)
    draw = random.Random(2)
    licences += [("line", [[(10 + draw.uniform(0, 1e-3), 10 + draw.uniform(0, 1e-3)) for _ in range(2)]]) for _ in range(300)]
    outlines |= {900 + i: [(10 + i * 1e-4, 10.0), (10.001 + i * 1e-4, 10.0), (10.001 + i * 1e-4, 10.001)] for i in range(5)}
    spots = [(10 + draw.uniform(0, 3e-3), 10 + draw.uniform(0, 3e-3)) for _ in range(400)]
    own, shaped = frames(spark, outlines, licences)
    points = spark.createDataFrame([(i, "point", x, y, None) for i, (x, y) in enumerate(spots)], LICENCES)
    want = {}
    for i, ring in outlines.items():
        n = sum(meets(ring, kind, paths) for kind, paths in licences)
        n += sum(inside(p, closed(ring)) or any(gap(p, a, b) <= BUFFER for a, b in closed(ring)) for p in spots)
        if n:
            want[i] = n
    return own, shaped.union(points), want


@pytest.mark.parametrize("rows", [20, 100_000])
def test_split_cells(crowd, monkeypatch, rows):
    for module in (shapes, rank):
        monkeypatch.setattr(module, "cogrouped", partial(skew.cogrouped, rows_per_group=rows))
    own, licences, want = crowd
    found = {r.buildingid: r.n for r in rank.licence_counts(own, licences, BUFFER).collect()}
    assert found == want and max(want.values()) > 300


def tables(draw, n_cells):
    import pyarrow as pa

    outlines, pieces = [], []
    for c in range(n_cells):
        for _ in range(draw.randrange(4)):
            x, y, r = draw.random(), draw.random(), draw.uniform(0.01, 0.1)
            ring = [(x - r, y - r), (x + r, y - r), (x, y + r)]
            edges = [dict(zip(("ax", "ay", "bx", "by"), (*a, *b))) for a, b in closed(ring)]
            outlines.append(dict(cell=c, buildingid=len(outlines), x=x - r, y=y - r, west=x - r - 0.01, east=x + r + 0.01, south=y - r - 0.01,
                                 north=y + r + 0.01, mid_lon=x, mid_lat=y, in_sq=-1.0, out_sq=(1.5 * r + 0.02) ** 2, _mid=0.5, _centre=0.5, _edges=edges))
        for k in range(draw.randrange(9)):
            a, b = [(draw.random(), draw.random()) for _ in range(2)]
            pieces.append(dict(cell=c, shape=k // 2, n=1 + k // 2, is_area=False, centre=0, ax=a[0], ay=a[1], bx=b[0], by=b[1], px=a[0], py=a[1], qx=b[0], qy=b[1]))
    return pa.Table.from_pylist(pieces), pa.Table.from_pylist(outlines)


@pytest.mark.parametrize("pairs, dense", [(1 << 16, 1 << 12), (7, 1 << 12), (1 << 16, 1), (3, 1)])
def test_blocks(monkeypatch, pairs, dense):
    monkeypatch.setattr(near, "BLOCK_PAIRS", pairs)
    monkeypatch.setattr(near, "DENSE_PAIRS", dense)
    pieces, outlines = tables(random.Random(3), 60)
    out = near.count_shapes(pieces, outlines, 0.01)
    monkeypatch.setattr("tests.test_shapes.BUFFER", 0.01)
    want = {}
    for o in outlines.to_pylist():
        ring = [(e["ax"], e["ay"]) for e in o["_edges"]]
        hit = {p["shape"]: p["n"] for p in pieces.to_pylist() if p["cell"] == o["cell"] and meets(ring, "line", [[(p["px"], p["py"]), (p["qx"], p["qy"])]])}
        if hit:
            want[o["buildingid"]] = sum(hit.values())
    assert dict(zip(out["buildingid"].to_pylist(), out["n"].to_pylist())) == want and len(want) > 15


def test_nothing_to_compare():
    pieces, outlines = tables(random.Random(3), 20)
    assert near.count_shapes(pieces.slice(0, 0), outlines, 0.01).num_rows == 0
    assert near.count_shapes(pieces, outlines.slice(0, 0), 0.01).num_rows == 0
