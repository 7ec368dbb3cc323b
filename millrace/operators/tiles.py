"""Exact cover of web tiles by geometries, and the part of each geometry in each tile.

Corners are projected to the web's Mercator, and lines are straight there.  A
geometry goes down the pyramid of tiles in steps of ``STEP`` zoom levels; each
step cuts what a tile holds into its smaller tiles, so that regions without
geometry cost nothing, and between steps the pieces are dealt out again: one
geometry over many tiles is the work of many tasks.  Geometries of an Arrow
batch are cut, written and measured together, in numpy.
"""

from __future__ import annotations

import functools
import math
import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Zoom levels of one step; a row gives at most 4 ** STEP rows in one.
STEP = 4
#: Pieces that a cut leaves thinner than this (in tiles of the step) come from rounding and are no parts of a tile.
TINY = 1e-9
POINT, LINE, OUTER, HOLE = range(4)
#: A tile that lies wholly inside.
FULL = b"full"
_WORLD = np.array([[0.0, 0.0], [1.0, 0.0], [1.0, 1.0], [0.0, 1.0]])
_GEOMETRY = re.compile(r"(MULTI)?(POINT|LINESTRING|POLYGON)\s*(?:ZM|Z|M)?\s*(EMPTY|\()")
_PIECE = re.compile(r"[()]|[^()]+")
_NUMBER = r"[-+]?[0-9]+(\.[0-9]*)?([eE][-+]?[0-9]+)?"
_PAIRS = f"{_NUMBER} {_NUMBER}(, ?{_NUMBER} {_NUMBER})*"
#: Texts of one ring, which are read together; all others are read one by one.
_ONE_RING = rf"^(POINT \({_NUMBER} {_NUMBER}\)|LINESTRING \({_PAIRS}\)|POLYGON \(\({_PAIRS}\)\))$"
_BLANKS = bytes.maketrans(b"(),", b"   ")
#: Rows and bytes that are cut together, so that what lies between fits a processor's caches.
_TOGETHER = 1024, 1 << 19
#: A kind of ring and its corners; an OUTER is followed by its HOLEs.  Rings are open.
Ring = tuple[int, np.ndarray]


class Rings(NamedTuple):
    """Rings of many values: the value, the kind and the number of corners of each, and all corners one after another."""

    row: np.ndarray
    kind: np.ndarray
    size: np.ndarray
    xy: np.ndarray


class Parts(NamedTuple):
    """Polygons cut to squares: the ring that each comes from, its square and the number of its rings, then sizes, areas and corners of all rings."""

    ring: np.ndarray
    x: np.ndarray
    y: np.ndarray
    rings: np.ndarray
    size: np.ndarray
    area: np.ndarray
    xy: np.ndarray


class Tiles(NamedTuple):
    """What tiles hold, in order of rows: the row, the place and the number of rings of each, 0 if it lies wholly inside; then all rings, in the tile's units."""

    row: np.ndarray
    x: np.ndarray
    y: np.ndarray
    rings: np.ndarray
    kind: np.ndarray
    size: np.ndarray
    xy: np.ndarray


def _corners(text: str) -> np.ndarray:
    try:
        return np.array([[float(v) for v in p.split()[:2]] for p in text.split(",")]).reshape(-1, 2)
    except ValueError:
        raise ValueError(f"no coordinates: {text[:60]}") from None


def parse_wkt(wkt: str) -> list[Ring]:
    """Points, paths and rings of a geometry of any kind, collections too; a ring without area is a path, a path without length a point."""
    out: list[Ring] = []
    upper = wkt.upper()
    if "(" not in upper and "EMPTY" not in upper:
        raise ValueError(f"no geometry: {wkt[:60]}")
    for m in _GEOMETRY.finditer(upper):
        if m[3] == "EMPTY":
            continue
        polygon, depth, first = (2 if m[1] else 1), 0, True
        for p in _PIECE.finditer(upper, m.end() - 1):
            if p[0] == "(":
                depth += 1
                first = first or depth == polygon
            elif p[0] == ")":
                depth -= 1
                first = first or depth < polygon
                if depth == 0:
                    break
            elif p[0].strip(" ,\t\r\n"):
                corners = _corners(p[0])
                if m[2] == "POINT":
                    out += [(POINT, c[None]) for c in corners]
                elif m[2] == "LINESTRING":
                    out.append((LINE, corners))
                else:
                    out.append((OUTER if first else HOLE, corners))
                    first = False
        else:
            raise ValueError(f"open bracket: {wkt[:60]}")
    rings: list[Ring] = []
    solid = False
    for kind, ring in (r for kind, corners in out for r in _plain(kind, corners)):
        if kind != HOLE:
            solid = kind == OUTER
        if kind != HOLE or solid:
            rings.append((kind, ring))
    return rings


def _plain(kind: int, corners: np.ndarray) -> Iterator[Ring]:
    if kind in (OUTER, HOLE):
        ring = corners[:-1] if len(corners) > 1 and (corners[0] == corners[-1]).all() else corners
        if _area(ring):
            yield kind, ring
            return
        if kind == HOLE:
            return
        kind = LINE
    if kind == LINE and (corners == corners[0]).all():
        kind, corners = POINT, corners[:1]
    yield kind, corners


def project(lon_lat: np.ndarray) -> np.ndarray:
    """Degrees to the world's square: x from the west, y from the north, both from 0 to 1."""
    lat = np.radians(np.clip(lon_lat[:, 1], -90.0, 90.0))
    return np.stack([(lon_lat[:, 0] + 180) / 360, (1 - np.arcsinh(np.tan(lat)) / math.pi) / 2], axis=1)


def pack(rings: list[Ring]) -> bytes:
    head = np.array([len(rings), *(v for kind, ring in rings for v in (kind, len(ring)))], dtype="<i4")
    return head.tobytes() + b"".join(ring.astype("<f8").tobytes() for _, ring in rings)


def _ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers from each first one on, as many as its size says."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - (ends - size), size)


def _starts(size: np.ndarray) -> np.ndarray:
    return np.cumsum(size) - size


def pack_all(rings: np.ndarray, kind: np.ndarray, size: np.ndarray, xy: np.ndarray) -> pa.Array:
    """Values of so many rings each, as ``pack`` makes them; 0 rings stand for FULL."""
    corners = np.bincount(np.repeat(np.arange(len(rings)), rings), size, len(rings)).astype(np.int64)
    length = 1 + 2 * rings + 4 * corners
    at = _starts(length)
    words = np.empty(length.sum(), "<u4")
    words[at] = np.where(rings == 0, np.frombuffer(FULL, "<u4")[0], rings)
    words[_ranges(at + 1, 2 * rings)] = np.stack([kind, size], axis=1).ravel()
    words[_ranges(at + 1 + 2 * rings, 4 * corners)] = np.ascontiguousarray(xy, "<f8").view("<u4").ravel()
    if 4 * len(words) >= 1 << 31:
        raise ValueError("the parts of one batch exceed 2 GB; spark.sql.execution.arrow.maxRecordsPerBatch has to be lower")
    offsets = np.append(4 * at, 4 * len(words)).astype("<i4")
    return pa.Array.from_buffers(pa.binary(), len(rings), [None, pa.py_buffer(offsets), pa.py_buffer(words)])


def unpack_all(held: pa.Array) -> Rings:
    """The rings of all values; a null has none."""
    offsets = np.frombuffer(held.buffers()[1] or bytes(4), "<i4")[held.offset : held.offset + len(held) + 1].astype(np.int64) // 4
    data = held.buffers()[2]
    words = np.frombuffer(data, "<u4", data.size // 4) if data is not None else np.empty(0, "<u4")
    rows = np.flatnonzero((offsets[1:] > offsets[:-1]) & held.is_valid().to_numpy(zero_copy_only=False))
    at, length = offsets[rows], offsets[rows + 1] - offsets[rows]
    full = (length == 1) & (words[at] == np.frombuffer(FULL, "<u4")[0])
    whole, rows, at, length = rows[full], rows[~full], at[~full], length[~full]
    rings = words[at].astype(np.int64)
    head = words[_ranges(at + 1, 2 * rings)].astype(np.int64).reshape(-1, 2)
    values = words[_ranges(at + 1 + 2 * rings, length - 1 - 2 * rings)].view("<f8").reshape(-1, 2)
    return Rings(
        np.append(np.repeat(rows, rings), whole),
        np.append(head[:, 0], np.full(len(whole), OUTER)),
        np.append(head[:, 1], np.full(len(whole), len(_WORLD))),
        np.concatenate([values, np.tile(_WORLD, (len(whole), 1))]),
    )


def _area(ring: np.ndarray) -> float:
    if len(ring) < 3:
        return 0.0
    x, y = (ring - ring[0]).T
    return abs(float(np.dot(x[:-1], y[1:]) - np.dot(x[1:], y[:-1]))) / 2


def half_plane(ring: np.ndarray, axis: int, at: float, low: bool) -> np.ndarray:
    """The part of a ring on one side of a grid line (Sutherland and Hodgman): corners inside stay, crossings come in."""
    v = ring[:, axis]
    keep = v <= at if low else v >= at
    if keep.all():
        return ring
    if not keep.any():
        return ring[:0]
    then = np.roll(ring, -1, axis=0)
    cross = keep != np.roll(keep, -1)
    a, b = ring[cross], then[cross]
    cut = a + ((at - a[:, axis]) / (b[:, axis] - a[:, axis]))[:, None] * (b - a)
    cut[:, axis] = at
    place = np.concatenate([2 * np.flatnonzero(keep), 2 * np.flatnonzero(cross) + 1])
    return np.concatenate([ring[keep], cut])[np.argsort(place)]


def _areas(size: np.ndarray, xy: np.ndarray) -> np.ndarray:
    """The area of each ring; none is empty."""
    first = _starts(size)
    # beside a ring's first corner, so that the step from its last one to the next ring counts nothing
    x, y = (xy - np.repeat(xy[first], size, axis=0)).T
    twice = np.append(x[:-1] * y[1:] - x[1:] * y[:-1], np.zeros(min(len(x), 1)))
    return np.abs(np.add.reduceat(twice, first)) / 2 if len(first) else np.empty(0)


def _lengths(size: np.ndarray, xy: np.ndarray) -> np.ndarray:
    """The length of each path; none is empty."""
    step = np.diff(xy, axis=0, append=xy[-1:])
    step[np.cumsum(size) - 1] = 0.0
    return np.add.reduceat(np.hypot(*step.T), _starts(size)) if len(size) else np.empty(0)


def _take(p: Parts, parts: np.ndarray, rings: np.ndarray | None = None) -> Parts:
    """Some parts, and of them some rings."""
    rings = np.repeat(parts, p.rings) & (True if rings is None else rings)
    if rings.all():
        return p
    count = np.bincount(np.repeat(np.arange(len(parts)), p.rings)[rings], minlength=len(parts))[parts]
    return Parts(p.ring[parts], p.x[parts], p.y[parts], count, p.size[rings], p.area[rings], p.xy[np.repeat(rings, p.size)])


def _side(p: Parts, axis: int, at: np.ndarray, low: bool) -> Parts:
    """What lies on one side of a grid line of each part, by ``half_plane`` for all rings; nothing of those without area there."""
    far = (np.minimum if low else np.maximum).reduceat(p.xy[:, axis], _starts(p.size))[_starts(p.rings)]
    some = far < at if low else far > at
    p, at = _take(p, some), at[some]
    if not len(p.ring):
        return p
    first = _starts(p.size)
    line = np.repeat(at, np.add.reduceat(p.size, _starts(p.rings)))
    keep = p.xy[:, axis] <= line if low else p.xy[:, axis] >= line
    unchanged = np.logical_and.reduceat(keep, first)[_starts(p.rings)]
    then = np.arange(1, len(keep) + 1)
    then[first + p.size - 1] = first
    cross = np.flatnonzero(keep != keep[then])
    made = keep.astype(np.int64)
    made[cross] += 1
    place = _starts(made)
    xy = np.empty((made.sum(), 2))
    xy[place[keep]] = p.xy[keep]
    a, b = p.xy[cross], p.xy[then[cross]]
    cut = a + ((line[cross] - a[:, axis]) / (b[:, axis] - a[:, axis]))[:, None] * (b - a)
    cut[:, axis] = line[cross]
    xy[place[cross] + keep[cross]] = cut
    p = p._replace(size=np.add.reduceat(made, first), xy=xy)
    left = p.size[_starts(p.rings)] > 0
    p, unchanged = _take(p, left, p.size > 0), unchanged[left]
    if not len(p.ring):
        return p
    p = p._replace(area=_areas(p.size, p.xy))
    outer, first = _starts(p.rings), _starts(p.size)
    width, height = ((np.maximum.reduceat(v, first) - np.minimum.reduceat(v, first))[outer] for v in p.xy.T)
    holes = np.add.reduceat(p.area, outer) - p.area[outer] if len(outer) < len(first) else 0.0
    real = (unchanged | ((height if axis else width) > TINY)) & (p.area[outer] - holes > 1e-9 * width * height)
    return _take(p, real, p.area > 0)


def _polygon_tiles(p: Parts, n: int) -> tuple[Parts, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The parts with area in each of n * n tiles, by halving; of tiles that lie wholly inside only (ring, x, y)."""
    whole: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    width = height = n
    while len(p.ring):
        size = width * height
        inside = (p.rings == 1) & (np.abs(p.area[_starts(p.rings)] - size) <= 1e-12 * size)
        place = np.tile(np.arange(size), inside.sum())
        whole.append((np.repeat(p.ring[inside], size), np.repeat(p.x[inside], size) + place // height, np.repeat(p.y[inside], size) + place % height))
        p = _take(p, ~inside)
        if size == 1 or not len(p.ring):
            break
        if width >= height:
            width //= 2
            sides = [_side(p, 0, p.x + width, low) for low in (True, False)]
            sides[1] = sides[1]._replace(x=sides[1].x + width)
        else:
            height //= 2
            sides = [_side(p, 1, p.y + height, low) for low in (True, False)]
            sides[1] = sides[1]._replace(y=sides[1].y + height)
        p = Parts(*map(np.concatenate, zip(*sides)))
    none = np.empty(0, np.int64)
    return p, tuple(map(np.concatenate, zip(*whole, (none, none, none))))


def _line_tiles(size: np.ndarray, xy: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(path, x, y, size, corners) of each stretch of paths within one of n * n tiles, by all crossings of their segments with the grid.

    A stretch along a border belongs to the tile east or south of it.
    """
    path = np.repeat(np.arange(len(size)), size)
    begins = np.ones(len(xy), bool)
    begins[np.cumsum(size) - 1] = False
    begins = np.flatnonzero(begins)
    a, b = xy[begins], xy[begins + 1]
    segments, places, points, cuts = [np.arange(len(xy))], [np.zeros(len(xy))], [xy], [np.zeros(len(xy), bool)]
    for axis in (0, 1):
        low, high = np.minimum(a, b)[:, axis], np.maximum(a, b)[:, axis]
        first = np.floor(low) + 1
        count = np.maximum(np.ceil(high) - first, 0).astype(int)
        s = np.repeat(np.arange(len(a)), count)
        line = first[s] + np.arange(len(s)) - np.repeat(np.cumsum(count) - count, count)
        t = (line - a[s, axis]) / (b[s, axis] - a[s, axis])
        at = a[s] + t[:, None] * (b[s] - a[s])
        at[:, axis] = line
        segments, places, points, cuts = [*segments, begins[s]], [*places, t], [*points, at], [*cuts, np.ones(len(s), bool)]
    segment = np.concatenate(segments)
    order = np.lexsort((np.concatenate(places), segment))
    nodes, cut, path = np.concatenate(points)[order], np.concatenate(cuts)[order], path[segment[order]]
    length = np.hypot(*np.diff(nodes, axis=0).T)
    real = (path[1:] == path[:-1]) & ((length > TINY) | ((length > 0) & ~(cut[:-1] | cut[1:])))
    start, stop, path = nodes[:-1][real], nodes[1:][real], path[:-1][real]
    middle = (start + stop) / 2
    tile = np.floor(middle)
    tile[middle == n] = n - 1
    tile = tile.astype(np.int64)
    new = np.append(np.ones(min(len(start), 1), bool), (path[1:] != path[:-1]) | (tile[1:] != tile[:-1]).any(axis=1) | (np.abs(start[1:] - stop[:-1]) > TINY).any(axis=1))
    bounds = np.flatnonzero(new)
    pieces = np.diff(np.append(bounds, len(start))) + 1
    corners = np.empty((len(start) + len(bounds), 2))
    corners[_starts(pieces)] = start[bounds]
    corners[np.arange(len(stop)) + np.cumsum(new)] = stop
    x, y = tile[bounds].T
    inside = (x >= 0) & (x < n) & (y >= 0) & (y < n)
    return path[bounds][inside], x[inside], y[inside], pieces[inside], corners[np.repeat(inside, pieces)]


def cut_all(rings: Rings, n: int) -> Tiles:
    """What each of n * n tiles holds of the rings of each row in the unit square."""
    xy, first = rings.xy * n, _starts(rings.size)
    solid, path, point = (np.flatnonzero(of) for of in (rings.kind >= OUTER, rings.kind == LINE, rings.kind == POINT))
    of = lambda found: xy[_ranges(first[found], rings.size[found])]
    outer = np.flatnonzero(rings.kind[solid] == OUTER)
    zero = np.zeros(len(outer), np.int64)
    ring_size, corners = rings.size[solid], of(solid)
    p, (full, full_x, full_y) = _polygon_tiles(Parts(solid[outer], zero, zero, np.diff(np.append(outer, len(solid))), ring_size, _areas(ring_size, corners), corners), n)
    line, line_x, line_y, line_size, line_xy = _line_tiles(rings.size[path], of(path), n)
    point_xy = of(point)
    point_x, point_y = np.clip(np.floor(point_xy), 0, n - 1).astype(np.int64).T

    each = lambda v: np.repeat(v, p.rings)
    alone = np.zeros(len(p.size), bool)
    alone[_starts(p.rings)] = p.area[_starts(p.rings)] >= 1 - 1e-12
    kind = np.full(len(p.size), HOLE)
    kind[_starts(p.rings)] = OUTER
    ring = np.concatenate([each(p.ring), path[line], point, full])
    x, y = np.concatenate([each(p.x), line_x, point_x, full_x]), np.concatenate([each(p.y), line_y, point_y, full_y])
    kind = np.concatenate([kind, np.full(len(line), LINE), np.full(len(point), POINT), np.full(len(full), OUTER)])
    alone = np.concatenate([alone, np.zeros(len(line) + len(point), bool), np.ones(len(full), bool)])
    size = np.concatenate([p.size, line_size, np.ones(len(point), np.int64)])
    pool = np.concatenate([p.xy, line_xy, point_xy])
    pool = np.concatenate([pool - np.repeat(np.stack([x, y], axis=1)[: len(size)], size, axis=0), _WORLD])
    # tiles that lie inside share the corners of one
    start = np.append(_starts(size), np.full(len(full), len(pool) - len(_WORLD)))
    size = np.append(size, np.full(len(full), len(_WORLD)))

    tile = (rings.row[ring] * n + x) * n + y
    order = np.lexsort((ring, tile))
    tile, kind, size, start, alone = (v[order] for v in (tile, kind, size, start, alone))
    bounds = np.flatnonzero(np.append(np.ones(min(len(tile), 1), bool), tile[1:] != tile[:-1]))
    count = np.diff(np.append(bounds, len(tile)))
    whole = (count == 1) & alone[bounds]
    used = ~np.repeat(whole, count)
    kind, size, start, tile = kind[used], size[used], start[used], tile[bounds]
    return Tiles(tile // (n * n), tile // n % n, tile % n, np.where(whole, 0, count), kind, size, pool[_ranges(start, size)])


def _world(wkt: str) -> bytes:
    """The part of a geometry in the world's square; points outside are moved to its edge."""
    rings: list[Ring] = []
    for kind, ring in parse_wkt(wkt):
        ring = project(ring)
        if kind == POINT:
            rings.append((kind, np.clip(ring, 0.0, 1.0)))
        elif kind == LINE:
            _, _, _, size, corners = _line_tiles(np.array([len(ring)]), ring, 1)
            rings += [(LINE, path) for path in np.split(corners, np.cumsum(size)[:-1]) if len(path)]
        else:
            for axis, at, low in ((0, 0.0, False), (0, 1.0, True), (1, 0.0, False), (1, 1.0, True)):
                ring = half_plane(ring, axis, at, low) if len(ring) else ring
            # an outer ring that is cut away leaves a mark, so that its holes do not join another
            rings.append((kind, ring))
    out: list[Ring] = []
    inside = False
    for kind, ring in rings:
        inside = inside if kind == HOLE else kind == OUTER and _area(ring) > 0
        if kind in (POINT, LINE) or (inside and _area(ring) > 0):
            out.append((kind, ring))
    return pack(out)


def _form(kinds: tuple[int, ...], sizes: tuple[int, ...]) -> str:
    """WKT of such rings, with a place for each number; an outer ring's and a hole's first corner come once more at the end."""
    text = lambda size: ", ".join(["%.12g %.12g"] * size)
    bodies: list[tuple[str, str]] = []
    for kind, size in zip(kinds, sizes):
        if kind == POINT:
            bodies.append(("POINT", f"({text(size)})"))
        elif kind == LINE:
            bodies.append(("LINESTRING", f"({text(size)})"))
        else:
            closed = f"({text(size + 1)})"
            if kind == HOLE:
                closed = f"{bodies.pop()[1][1:-1]}, {closed}"
            bodies.append(("POLYGON", f"({closed})"))
    found = {k for k, _ in bodies}
    if len(bodies) == 1:
        return " ".join(bodies[0])
    if len(found) == 1:
        return f"MULTI{found.pop()} ({', '.join(b for _, b in bodies)})"
    return f"GEOMETRYCOLLECTION ({', '.join(f'{k} {b}' for k, b in bodies)})"


_simple_form = functools.lru_cache(maxsize=256)(_form)


def to_wkt(tiles: Tiles, extent: float) -> pa.Array:
    """WKT of what tiles hold, in units of which ``extent`` make a tile's side."""
    first, solid = _starts(tiles.size), tiles.kind >= OUTER
    # corners by number, and the first one again for a closed ring
    size = tiles.size + solid
    place = _ranges(first, size)
    place[(np.cumsum(size) - 1)[solid]] = first[solid]
    values = (tiles.xy[place] * extent + 0.0).ravel().tolist()
    kinds, sizes, forms, i = tiles.kind.tolist(), tiles.size.tolist(), [], 0
    for n in tiles.rings[tiles.rings > 0].tolist():
        small = n == 1 and sizes[i] < 64
        forms.append((_simple_form if small else _form)(tuple(kinds[i : i + n]), tuple(sizes[i : i + n])))
        i += n
    texts = ("\n".join(forms) % tuple(values)).split("\n") if forms else []
    at = np.where(tiles.rings > 0, np.cumsum(tiles.rings > 0) - 1, len(texts))
    texts.append(_form((OUTER,), (4,)) % tuple((_WORLD[[0, 1, 2, 3, 0]] * extent + 0.0).ravel()))
    return pa.array(texts, pa.string()).take(pa.array(at))


def _batches(values: pa.Array) -> Iterator[pa.Array]:
    """Slices of at most _TOGETHER rows and bytes, or of one row."""
    rows, most = _TOGETHER
    ends = np.cumsum(pc.fill_null(pc.binary_length(values), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(values):
        end = int(np.searchsorted(ends, most + (ends[at - 1] if at else 0), "right"))
        end = min(max(end, at + 1), at + rows, len(values))
        yield values[at:end]
        at = end


def parse_all(texts: pa.Array) -> tuple[Rings, np.ndarray]:
    """Rings of texts of one plain ring, and the rows of all others that are not null, which ``parse_wkt`` reads.

    A ring almost without area and a path almost without length are left to it, too.
    """
    simple = pc.fill_null(pc.match_substring_regex(texts, _ONE_RING), False)
    rows, other = np.flatnonzero(simple), np.flatnonzero(pc.and_not(texts.is_valid(), simple))
    texts = texts.filter(simple)
    offsets = np.frombuffer(texts.buffers()[1] or bytes(4), "<i4")[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]].copy()
    at = offsets[:-1] - offsets[0]
    letter = data[at + 2]  # of poInt, liNestring and poLygon
    kind = np.select([letter == ord("I"), letter == ord("N")], [POINT, LINE], OUTER)
    data[_ranges(at, np.array([6, 11, 8])[kind])] = ord(" ")
    size = pc.count_substring(texts, ",").to_numpy(zero_copy_only=False).astype(np.int64) + 1
    xy = np.fromstring(data.tobytes().translate(_BLANKS), sep=" ").reshape(-1, 2)
    if len(xy) != size.sum():
        raise AssertionError("numbers of plain texts were not read")
    first = _starts(size)
    closed = (kind == OUTER) & (size > 1) & (xy[first] == xy[first + size - 1]).all(axis=1)
    used = np.ones(len(xy), bool)
    used[(first + size - 1)[closed]] = False
    xy, size = xy[used], size - closed
    if not len(size):
        return Rings(rows, kind, size, xy), other
    first = _starts(size)
    width, height = (np.maximum.reduceat(v, first) - np.minimum.reduceat(v, first) for v in xy.T)
    odd = np.where(kind == OUTER, _areas(size, xy) <= 1e-9 * width * height, (kind == LINE) & (width <= 0) & (height <= 0))
    return Rings(rows[~odd], kind[~odd], size[~odd], xy[np.repeat(~odd, size)]), np.append(other, rows[odd])


def _worlds(texts: pa.Array) -> pa.Array:
    """``_world`` of each text; those of one plain ring inside the world together."""
    rings, other = parse_all(texts)
    xy = project(rings.xy)
    first = _starts(rings.size)
    inside = np.logical_and.reduceat(((xy >= 0) & (xy <= 1)).all(axis=1), first) if len(first) else np.empty(0, bool)
    size = rings.size[inside]
    held = pack_all(np.ones(len(size), np.int64), rings.kind[inside], size, xy[np.repeat(inside, rings.size)])
    other = np.append(other, rings.row[~inside])
    rest = pa.array([_world(t) for t in texts.take(pa.array(other)).to_pylist()], pa.binary())
    at = np.full(len(texts), len(held) + len(rest))
    at[rings.row[inside]] = np.arange(len(held))
    at[other] = len(held) + np.arange(len(rest))
    return pa.concat_arrays([held, rest, pa.nulls(1, pa.binary())]).take(pa.array(at))


def _start(geometry: Column) -> Column:
    @F.arrow_udf("binary")
    def run(wkt: pa.Array) -> pa.Array:
        return pa.concat_arrays([pa.array([], pa.binary()), *(_worlds(t) for t in _batches(wkt.cast(pa.string())))])

    return run(geometry)


def _held(tiles: Tiles) -> list[pa.Array]:
    return [pack_all(tiles.rings, tiles.kind, tiles.size, tiles.xy)]


def _step(levels: int, give: Callable[[Tiles], list[pa.Array]], fields: dict[str, str]):
    """Tiles as rows of x, y and what is given of them."""
    n = 2**levels

    def cut(data: pa.Array) -> pa.Array:
        tiles = cut_all(unpack_all(data), n)
        columns = [pa.array(tiles.x, pa.int32()), pa.array(tiles.y, pa.int32()), *give(tiles)]
        return pa.ListArray.from_arrays(pa.array(np.searchsorted(tiles.row, np.arange(len(data) + 1)), pa.int32()), pa.StructArray.from_arrays(columns, ["x", "y", *fields]))

    @F.arrow_udf(f"array<struct<x:int,y:int{''.join(f',{f}:{kind}' for f, kind in fields.items())}>>")
    def run(data: pa.Array) -> pa.Array:
        return pa.concat_arrays([cut(d) for d in _batches(data.cast(pa.binary()))] or [cut(pa.array([], pa.binary()))])

    return run


def _descend(df: DataFrame, geometry: str, zoom: int, give: Callable[[Tiles], list[pa.Array]], fields: dict[str, str]) -> DataFrame:
    """A row for each tile, with its place in tile_x and tile_y and fields of what it holds."""
    if zoom < 0:
        raise ValueError("zoom begins at 0")
    zero = F.lit(0).cast("long")
    df = df.withColumns({"_held": _start(F.col(geometry)), "tile_x": zero, "tile_y": zero})
    steps = [STEP] * (zoom // STEP) + [zoom % STEP] * (zoom % STEP > 0 or zoom == 0)
    for i, levels in enumerate(steps):
        if i:
            df = df.repartition("tile_x", "tile_y", F.xxhash64("_held"))
        step = _step(levels, give, fields) if i == len(steps) - 1 else _step(levels, _held, {"_held": "binary"})
        df = df.withColumn("_cut", F.explode(step("_held"))).drop("_held")
        place = {t: F.col(t) * 2**levels + F.col("_cut")[t[-1]] for t in ("tile_x", "tile_y")}
        given = fields if i == len(steps) - 1 else ("_held",)
        df = df.withColumns({**place, **{f: F.col("_cut")[f] for f in given}}).drop("_cut")
    return df


def cover_tiles(df: DataFrame, geometry: str, zoom: int) -> DataFrame:
    """A row for each web tile in which a geometry (WKT in degrees) lies, with its tile_x and tile_y, y from the north.

    A polygon lies where it has area, a line where it has length (along a
    border: in the tile east or south of it), a point in one tile.  A ring
    without area counts as a line, a line without length as a point.  What lies
    outside the world's square is cut off, points outside go to its edge.  Null
    and empty geometries give no row, text that is no geometry is an error.
    Columns of the names tile_x and tile_y are replaced.
    """
    return _descend(df, geometry, zoom, lambda tiles: [], {})


def clip_tiles(df: DataFrame, geometry: str, zoom: int, extent: float = 4096.0, into: str = "part") -> DataFrame:
    """``cover_tiles`` with the part in each tile as WKT, ``extent`` units to a tile's side, y downwards.

    Parts add up to the geometry, but for slivers under a billionth of a tile that rounding makes at borders.  Where a tile holds several pieces of a
    concave polygon, they are one ring with edges along the tile's border.
    """

    return _descend(df, geometry, zoom, lambda tiles: [to_wkt(tiles, extent)], {into: "string"})


def measure_tiles(df: DataFrame, geometry: str, zoom: int, extent: float = 4096.0) -> DataFrame:
    """``cover_tiles`` with the length of all lines and the area of all polygons of the part in each tile, as ``measures`` has them of ``clip_tiles``, without the texts."""

    def measured(tiles: Tiles) -> list[pa.Array]:
        full = tiles.rings == 0
        tile = np.repeat(np.arange(len(full)), tiles.rings)
        sign = np.select([tiles.kind == OUTER, tiles.kind == HOLE], [1.0, -1.0], 0.0)
        length = np.bincount(tile, np.where(tiles.kind == LINE, _lengths(tiles.size, tiles.xy), 0.0), len(full))
        area = np.bincount(tile, sign * _areas(tiles.size, tiles.xy), len(full)) + full
        return [pa.array(length * extent), pa.array(area * extent**2)]

    return _descend(df, geometry, zoom, measured, {"length": "double", "area": "double"})


def tile_features(df: DataFrame, geometry: str, zoom: int) -> DataFrame:
    """(tile_x, tile_y, features): how many geometries each tile has."""
    return cover_tiles(df.select(geometry), geometry, zoom).groupBy("tile_x", "tile_y").agg(F.count("*").alias("features"))


def measures_wkt(wkt: str | None) -> tuple[float | None, float | None]:
    if wkt is None:
        return None, None
    length = area = 0.0
    for kind, ring in parse_wkt(wkt):
        if kind == LINE:
            length += float(np.hypot(*np.diff(ring, axis=0).T).sum())
        elif kind in (OUTER, HOLE):
            area += _area(ring) if kind == OUTER else -_area(ring)
    return length, area


def measures(geometry: Column) -> Column:
    """The length of all lines and the area of all polygons of a WKT column, in its own units."""

    def measured(texts: pa.Array) -> pa.Array:
        rings, other = parse_all(texts)
        values = np.full((len(texts), 2), np.nan)
        values[rings.row] = 0.0
        line, solid = rings.kind == LINE, rings.kind == OUTER
        values[rings.row[line], 0] = _lengths(rings.size, rings.xy)[line]
        values[rings.row[solid], 1] = _areas(rings.size, rings.xy)[solid]
        for i, text in zip(other.tolist(), texts.take(pa.array(other)).to_pylist()):
            values[i] = measures_wkt(text)
        missing = texts.is_null().to_numpy(zero_copy_only=False)
        return pa.StructArray.from_arrays([pa.array(v, pa.float64(), mask=missing) for v in values.T], ["length", "area"])

    @F.arrow_udf("length double, area double")
    def run(texts: pa.Array) -> pa.Array:
        # many tiles lie wholly inside, and have one text
        texts = texts.cast(pa.string()).dictionary_encode()
        known = [measured(t) for t in _batches(texts.dictionary)]
        return pa.concat_arrays([*known, measured(pa.nulls(1, pa.string()))]).take(pc.fill_null(texts.indices, len(texts.dictionary)))

    return run(geometry)
