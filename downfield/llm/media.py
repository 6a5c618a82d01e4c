"""Media columns: copies of images by local descriptors.

Corners are found at several scales; around each, pairs of pixels are compared along its own direction, which gives 128
bits that brightness and turning hardly change. Tables keyed by 32 of the bits bring like corners of different images
together. Images with two such matches of one turn and scale are candidates; a candidate is confirmed by one geometry
(turn, scale and shift) that takes many corners of the one image to their matches in the other.

Pairs of rare keys become rows and are confirmed one by one. Images with hot keys are packed into blocks, each a row of one
table, and every two blocks meet in a task that reads both from it: no pair of a hot key ever is a row, and nothing is copied
for a comparison.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_IDS, cut, drop, fits, map_batches, mix64
from .components import Forest, components


#: Factors by which the levels are made smaller; larger pictures are reduced to SIDE pixels first.
SCALES, SIDE = (1.0, 1.26, 1.59, 2.0), 512
#: Bits of a descriptor, radius of its tests, distance of corners from the edge, and from a stronger corner.
BITS, RADIUS, BORDER, APART = 128, 15, 17, 3
#: A match differs in so many bits at most; one geometry has to join so many corners, and this part of the corners of
#: the region that the two images share, so that a common mark alone makes no copy.
HAMMING, MATCHES, PART = 24, 6, 0.3
#: Matches that share a word, in one cell of the geometry, that make a candidate; cells of a turn, pixels of a shift.
MET, TURNS, SHIFT = 3, 24, 32
#: Pixels that a match may be off, and matches that are tried as the lead of a geometry, nearest first.
OFF, LEADS = 2.0, 48
#: Pixels that are handled at a time, and pairs of corners.
STACK_PIXELS, PAIRS = 1 << 19, 1 << 17
#: A key of more corners than this is hot; images with hot keys are compared in blocks of about so many corners. Small tables
#: have smaller blocks, down to a SPREAD of that, for all cores; so many blocks are read by one task at most.
HOT, BLOCK_CORNERS, SPREAD, HELD = 16, 350_000, 16, 16
#: Matches are counted by image pair, turn and scale in so many slots first, which some may share.
SLOTS = 1 << 20
#: Hot images are looked for in one of so many parts of the keys first, and candidates are confirmed so many at a time.
KEY_PARTS, TRIED = 16, 64
#: A corner: place in 1/UNITS pixels, number of its scale, direction in 1/256 turns, bits as four words.
UNITS = 16
POINT = np.dtype([("x", "<u2"), ("y", "<u2"), ("level", "u1"), ("turn", "u1"), ("bits", "<u4", 4)])
_SCALE = np.array(SCALES)


def _tests() -> np.ndarray:
    """Pairs of points around a corner (tests by 2 points by y, x), a fixed draw within the radius."""
    points = np.random.RandomState(5).normal(0, RADIUS / 2, (BITS * 4, 2, 2))
    return points[(np.hypot(points[..., 0], points[..., 1]) <= RADIUS).all(axis=1)][:BITS]


_POINTS = _tests()
_DISC_Y, _DISC_X = (
    v[np.hypot(*np.mgrid[-RADIUS : RADIUS + 1, -RADIUS : RADIUS + 1]) <= RADIUS]
    for v in np.mgrid[-RADIUS : RADIUS + 1, -RADIUS : RADIUS + 1]
)


def smooth(x: np.ndarray) -> np.ndarray:
    """Binomial filter of width 5 over the last two axes of a stack."""
    for axis in (1, 2):
        pad = np.moveaxis(np.pad(x, [(2, 2) if a == axis else (0, 0) for a in range(3)], "edge"), axis, 0)
        n = len(pad) - 4
        y = pad[2 : n + 2] * x.dtype.type(6 / 16)
        y += (pad[1 : n + 1] + pad[3 : n + 3]) * x.dtype.type(4 / 16)
        y += (pad[:n] + pad[4:]) * x.dtype.type(1 / 16)
        x = np.moveaxis(y, 0, axis)
    return x


def resized(x: np.ndarray, factor: float) -> np.ndarray:
    """A stack made smaller by ``factor``: means of whole pixels, then bilinear weights for what is left of it."""
    whole = max(1, int(factor))
    if whole > 1:
        n, h, w = x.shape[0], x.shape[1] // whole, x.shape[2] // whole
        x = x[:, : h * whole, : w * whole].reshape(n, h, whole, w, whole).mean(axis=(2, 4), dtype=np.float32)
        factor /= whole
    x = x.astype(np.float32)
    for axis in (1, 2) if factor > 1 else ():
        n = x.shape[axis]
        at = np.clip((np.arange(max(1, int(n / factor))) + 0.5) * factor - 0.5, 0, n - 1)
        low = np.minimum(at.astype(int), max(n - 2, 0))
        weight = (at - low).astype(np.float32).reshape([-1 if a == axis else 1 for a in range(3)])
        x = x.take(low, axis=axis) * (1 - weight) + x.take(np.minimum(low + 1, n - 1), axis=axis) * weight
    return x


def _window_max(x: np.ndarray, reach: int) -> np.ndarray:
    """Maximum over the square of ``reach`` places around each place that has a whole square."""
    for axis in (1, 2):
        x = np.moveaxis(x, axis, 0)
        n = len(x) - 2 * reach
        x = np.moveaxis(np.maximum.reduce([x[k : k + n] for k in range(2 * reach + 1)]), 0, axis)
    return x


def corners(level: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Image, y and x of the corners of a stack: places where the structure tensor beats all others within APART. Their
    number grows with the area, and a crop keeps those of its part."""
    n, h, w = level.shape
    if min(h, w) <= 2 * BORDER:
        return (np.zeros(0, int),) * 3
    dy, dx = np.gradient(level, axis=(1, 2))
    yy, xx, xy = smooth(dy * dy), smooth(dx * dx), smooth(dy * dx)
    power = yy * xx - xy * xy - np.float32(0.05) * (yy + xx) ** 2
    edge = BORDER - APART
    top = _window_max(power[:, edge : h - edge, edge : w - edge], APART)
    inner = power[:, BORDER : h - BORDER, BORDER : w - BORDER]
    image, y, x = np.nonzero((inner == top) & (inner > 1))
    return image, y + BORDER, x + BORDER


def describe_stack(stack: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The image of each corner of all scales, and the corners as POINT, sorted by image."""
    shrink = max(1.0, max(stack.shape[1:]) / SIDE)
    base = resized(stack, shrink)
    images, points = [np.zeros(0, int)], [np.zeros(0, POINT)]
    for number, scale in enumerate(SCALES):
        level = smooth(resized(base, scale))
        image, y, x = corners(level)
        if not len(image):
            continue
        level = np.rint(smooth(level) * 8).astype(np.int32)  # whole numbers, so that even areas compare alike everywhere
        _, h, w = level.shape
        flat, centre = level.reshape(-1), (image * h + y) * w + x
        patch = flat[centre[:, None] + (_DISC_Y * w + _DISC_X)]
        angle = np.arctan2((patch @ _DISC_Y).astype(float), (patch @ _DISC_X).astype(float))
        point = np.zeros(len(image), POINT)
        point["turn"] = np.rint(angle / (2 * np.pi) * 256).astype(np.int64) & 255
        s, c = np.sin(angle)[:, None], np.cos(angle)[:, None]
        value = []
        for k in range(2):
            py, px = _POINTS[:, k, 0], _POINTS[:, k, 1]
            value.append(flat[centre[:, None] + np.rint(s * px + c * py).astype(int) * w + np.rint(c * px - s * py).astype(int)])
        point["bits"] = np.packbits(value[0] < value[1], axis=1).view("<u4")
        point["x"], point["y"] = (np.rint((v + 0.5) * scale * UNITS) for v in (x, y))
        point["level"] = number
        images.append(image)
        points.append(point)
    image, point = np.concatenate(images), np.concatenate(points)
    order = np.argsort(image, kind="stable")
    return image[order], point[order]


def describe(images: DataFrame) -> DataFrame:
    """(media_id, wide, tall, points) for each of (long media_id, width, height, pixels: 8-bit grey values, row by row)
    that has corners; ``points`` holds them as POINT, wide and tall are of the reduced picture. Images that are null,
    empty, not of the size they state or too small have no row."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_size: dict[tuple[int, int], list[int]] = {}
            for k, (m, w, h) in enumerate(zip(*(batch[c].to_pylist() for c in ("media_id", "width", "height")), strict=True)):
                p = batch["pixels"][k]
                if m is not None and w and h and min(w, h) > 2 * BORDER and p.is_valid and w * h == p.as_buffer().size:
                    by_size.setdefault((h, w), []).append(k)
            ids = batch["media_id"].fill_null(-1).to_numpy()
            for (h, w), rows in by_size.items():
                step, shrink = max(1, STACK_PIXELS // (h * w)), max(1.0, max(h, w) / SIDE)
                for at in range(0, len(rows), step):
                    some = rows[at : at + step]
                    image, point = describe_stack(
                        np.stack([np.frombuffer(batch["pixels"][k].as_buffer(), np.uint8).reshape(h, w) for k in some])
                    )
                    edge = np.searchsorted(image, np.arange(len(some) + 1))
                    have = np.flatnonzero(np.diff(edge))
                    size = [pa.array(np.full(len(have), int(v / shrink), np.int32)) for v in (w, h)]
                    packed = pa.array([point[edge[k] : edge[k + 1]].tobytes() for k in have], pa.binary())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[np.array(some)[have]]), *size, packed], ["media_id", "wide", "tall", "points"]
                    )

    return map_batches(images.select("media_id", "width", "height", "pixels"), make, "media_id long, wide int, tall int, points binary")


def _halves(points: np.ndarray) -> np.ndarray:
    """The bits of corners as two numbers each, in two rows."""
    return np.ascontiguousarray(np.ascontiguousarray(points["bits"]).view(np.uint64).T)


def _matches(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Corners of two images, given by :func:`_halves`, that match: a corner's best matches only, from both sides, nearest first."""
    off = np.bitwise_count(a[0][:, None] ^ b[0]) + np.bitwise_count(a[1][:, None] ^ b[1])
    most = np.minimum(np.minimum(off.min(axis=1, initial=BITS)[:, None], off.min(axis=0, initial=BITS)[None]) + 1, HAMMING)
    i, j = np.nonzero(off <= most)
    order = np.argsort(off[i, j], kind="stable")
    return i[order], j[order]


def same_picture(a: np.ndarray, b: np.ndarray, size_a: tuple[int, int], size_b: tuple[int, int]) -> bool:
    """Whether one geometry takes enough corners of image ``a`` (POINT) to their matches in ``b``; sizes: wide, tall."""
    i, j = _matches(_halves(a), _halves(b))
    if len(i) < MATCHES:
        return False
    at, to = ((p["x"] + 1j * p["y"]) / UNITS for p in (a, b))
    scale = _SCALE
    turn = (b["turn"][j].astype(float) - a["turn"][i]) / 256 * 2 * np.pi
    zoom = scale[b["level"][j]] / scale[a["level"][i]] * np.exp(1j * turn)  # as the match alone tells
    p, q = at[i], to[j]
    size = np.maximum(scale[b["level"][j]], scale[a["level"][i]] * np.abs(zoom))

    def fits(z: np.ndarray, from_p: np.ndarray, to_q: np.ndarray, loose: float) -> np.ndarray:
        far = p - from_p
        return (np.abs(z * far + to_q - q) <= OFF * size + loose * np.abs(z * far)) & (np.abs(zoom / z - 1) < 0.45)

    lead = np.arange(min(len(i), LEADS))[:, None]
    agree = fits(zoom[lead], p[lead], q[lead], 0.2)
    best = agree[agree.sum(axis=1).argmax()]
    for _ in range(4):
        if best.sum() < MATCHES:
            return False
        mp, mq = p[best].mean(), q[best].mean()
        spread = (np.abs(p[best] - mp) ** 2).sum()
        z = ((q[best] - mq) * np.conj(p[best] - mp)).sum() / max(spread, 1e-9)
        if abs(z) < 0.1:
            return False
        best = fits(z, mp, mq, 0.0)
    cells = lambda x: len(np.unique(np.rint(x / 4)))  # noqa: E731  a corner found at several scales counts once
    n = min(cells(p[best]), cells(q[best]))

    def seen(x: np.ndarray, level: np.ndarray, size: tuple[int, int]) -> np.ndarray:
        edge = BORDER * scale[level]
        return x[(x.real >= edge) & (x.real <= size[0] - edge) & (x.imag >= edge) & (x.imag <= size[1] - edge)]

    shared = min(cells(seen(z * (at - mp) + mq, a["level"], size_b)), cells(seen((to - mq) / z + mp, b["level"], size_a)))
    return n >= MATCHES and n >= PART * shared


def _votes(a: np.ndarray, b: np.ndarray) -> list[np.ndarray]:
    """The cell of the geometry of each match of ``a`` to ``b`` (POINT) as one number: turn, scale, shift in x and y.
    Two grids, apart by half a cell, so that few geometries fall on a border in both."""
    cell = _turn_cells(b["turn"].astype(np.int64) - a["turn"])
    ratio = _SCALE[b["level"]] / _SCALE[a["level"]]
    c, s = (f(np.arange(TURNS) * (2 * np.pi / TURNS))[cell] for f in (np.cos, np.sin))
    dx, dy = b["x"] - ratio * (a["x"] * c - a["y"] * s), b["y"] - ratio * (a["x"] * s + a["y"] * c)
    step = b["level"].astype(np.int64) - a["level"] + len(SCALES)
    out = []
    for grid in (0.0, 0.5):
        x, y = (np.floor(v / (SHIFT * UNITS) + grid).astype(np.int64) + 512 for v in (dx, dy))
        out.append(((cell * 2 * len(SCALES) + step) * 1024 + x) * 1024 + y)
    return out


def _turn_cells(by: np.ndarray) -> np.ndarray:
    """Numbers of the cells of turns in 1/256."""
    return (by % 256 * TURNS + 128) // 256 % TURNS


def _steps() -> np.ndarray:
    """The slot of the cell of turn and scale by the difference of two corners' 512 * level + turn, which begins at -2047; then
    that of the same two corners the other way round."""
    by = np.arange(4096) - 2047
    level = (by + 255) // 512
    turn = by - 512 * level
    cells = np.concatenate([_turn_cells(d * turn) * 2 * len(SCALES) + d * level + len(SCALES) for d in (1, -1)])
    return cells * 0x9E3779B1 & (SLOTS - 1)


_STEPS = _steps()


class _Block:
    """Images of a block by rising id: ids, sizes, corners, where each image's corners begin, and the corners in the order of each word."""

    def __init__(self, ids: np.ndarray, wide: np.ndarray, tall: np.ndarray, corners: np.ndarray, points: np.ndarray):
        self.ids, self.wide, self.tall, self.points = ids, wide, tall, points
        self.edge = np.concatenate([[0], np.cumsum(corners, dtype=np.int64)])
        self.image = np.repeat(np.arange(len(ids)), corners)
        self.half = _halves(points)
        self.words = np.ascontiguousarray(points["bits"].T).astype(np.uint64) << np.uint64(32)
        place = np.arange(len(points), dtype=np.uint64)
        #: For each word, words and places of corners as one number, sorted.
        self.sorted = [np.sort(w | place) for w in self.words]
        self.order = np.concatenate(self.sorted).astype(np.uint32).astype(np.int64)
        self.aspect = points["level"].astype(np.int64) << 9 | points["turn"]
        #: For each place in ``order`` the image, and in twelve lower bits the level and turn of the corner.
        self.seen = (self.image << 12 | self.aspect)[self.order]

    def spans(self, words: list[np.ndarray], first: int = 0, last: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """For each of four lists of words the places in ``order`` from which on, and the number of times, a word stands among the
        images ``first`` to before ``last``."""
        ends = [np.uint64(self.edge[len(self.ids) if x is None else x]) for x in (first, last)]
        low, high = (np.stack([np.searchsorted(s, w | end) for s, w in zip(self.sorted, words, strict=True)]) for end in ends)
        return low + np.arange(4)[:, None] * len(self.points), high - low


def _candidates(left: _Block, right: _Block) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of images of two blocks, or of one with itself, with MET matches in one cell. About PAIRS pairs of corners are handled
    at a time; an image that has more meets the others by halves."""
    low, count = (np.empty((4, len(left.points)), np.int64) for _ in range(2))
    mask = np.uint64(0xFFFFFFFF)
    found = right.spans([s & ~mask for s in left.sorted])  # sorted words are found faster
    for k, s in enumerate(left.sorted):
        low[k, s & mask], count[k, s & mask] = found[0][k], found[1][k]
    upto = np.concatenate([[0], np.cumsum(count.sum(axis=0))])[left.edge]
    at = 0
    while at < len(left.ids):
        to = max(at + 1, int(np.searchsorted(upto, upto[at] + PAIRS, "right")) - 1)
        to = min(to, at + max(1, 16 * PAIRS // len(right.ids)))  # which bounds the number of pairs of images as well
        mine = slice(left.edge[at], left.edge[to])
        if upto[to] - upto[at] <= PAIRS:
            yield _met(left, right, mine, low[:, mine], count[:, mine])
        else:
            parts = [(0, len(right.ids))]
            while parts:
                first, last = parts.pop()
                span = right.spans(list(left.words[:, mine]), first, last)
                if span[1].sum() <= PAIRS or last - first == 1:
                    yield _met(left, right, mine, *span)
                else:
                    half = (first + last) // 2
                    parts += [(half, last), (first, half)]
        at = to


def _met(left: _Block, right: _Block, mine: slice, low: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The candidates among the images of some corners of ``left`` and those whose words they share (see :meth:`_Block.spans`)."""
    low, count = low.ravel(), count.ravel()
    n, first, last = len(right.ids), int(left.image[mine.start]), int(left.image[mine.stop - 1]) + 1
    upto = np.cumsum(count)
    at = np.repeat(low - (upto - count), count)
    at += np.arange(len(at))
    seen = right.seen[at]
    turned = np.searchsorted(right.ids, left.ids[first:last])  # images of ``right`` before these have smaller ids
    if left is right or not turned.any():
        other = 0
    elif turned.min() == n:
        other = 4096
    else:
        other = np.where(seen >> 12 < np.repeat(np.tile(turned[left.image[mine] - first], 4), count), 4096, 0)
    seen += np.repeat(np.tile(((left.image[mine] - first) * n << 12) - left.aspect[mine] + 2047, 4), count)
    pair = seen >> 12
    seen &= 4095
    seen += other
    slot = (pair + _STEPS[seen]) & (SLOTS - 1)
    keep = np.flatnonzero((np.bincount(slot, minlength=SLOTS) >= MET)[slot])
    # of those in slots that are met often enough, the like corners, each once
    at, pair = at[keep], pair[keep]
    a = np.searchsorted(upto, keep, "right") % (mine.stop - mine.start) + mine.start
    b, table = right.order[at], at // len(right.points)
    off = [left.half[h][a] ^ right.half[h][b] for h in range(2)]
    keep = np.bitwise_count(off[0]) + np.bitwise_count(off[1]) <= HAMMING
    for k in range(3):
        word = off[k // 2] >> np.uint64(32) if k % 2 else off[k // 2].astype(np.uint32)
        keep &= (table <= k) | (word != 0)
    if left is right:
        keep &= left.image[a] < left.image[b]
    a, b, pair = a[keep], b[keep], pair[keep]
    # a geometry leads from the image of the smaller id to the other
    p, q = left.points[a], right.points[b]
    turned = left.ids[left.image[a]] > right.ids[right.image[b]]
    p, q = np.where(turned, q, p), np.where(turned, p, q)
    good = [np.zeros(0, np.int64)]
    for vote in _votes(p, q):
        key = pair << 28 | vote
        ordered = np.sort(key)
        many = np.unique(ordered[MET - 1 :][ordered[MET - 1 :] == ordered[: len(ordered) - MET + 1]])
        if not len(many):
            continue
        some = np.flatnonzero(many[np.minimum(np.searchsorted(many, key), len(many) - 1)] == key)
        some = some[np.argsort(key[some], kind="stable")]
        begin = np.searchsorted(key[some], many)
        ok = np.ones(len(many), bool)
        for x in (p[some], q[some]):
            place = x["x"].astype(np.int64) << 16 | x["y"]
            ok &= np.minimum.reduceat(place, begin) < np.maximum.reduceat(place, begin)
        good.append(many[ok] >> 28)
    found = np.unique(np.concatenate(good))
    return found // n + first, found % n


def _hopeful(points: np.ndarray, half: np.ndarray, pairs: list[tuple[slice, slice]]) -> np.ndarray:
    """Of pairs of images, given by the places of their corners, whether :func:`same_picture` can confirm them: a lead needs
    MATCHES that agree with it. All of them at once, and a hair wider than there."""
    got = []
    for u, v in pairs:
        i, j = _matches(half[:, u], half[:, v])
        got.append((i + u.start, j + v.start))
    n = np.array([len(a) for a, _ in got])
    a, b = (points[np.concatenate(x)] for x in zip(*got, strict=True))
    begin = np.cumsum(n) - n
    # each of a pair's first LEADS matches as the lead of all its matches
    leads = np.minimum(n, LEADS)
    lead = np.repeat(begin - (np.cumsum(leads) - leads), leads) + np.arange(int(leads.sum()))
    times = np.repeat(n, leads)
    one = np.repeat(lead, times)
    two = np.repeat(np.repeat(begin, leads) - (np.cumsum(times) - times), times) + np.arange(int(times.sum()))
    p, q = ((x["x"] + 1j * x["y"]) / UNITS for x in (a, b))
    turn = (b["turn"].astype(float) - a["turn"]) / 256 * 2 * np.pi
    zoom = _SCALE[b["level"]] / _SCALE[a["level"]] * np.exp(1j * turn)
    size = np.maximum(_SCALE[b["level"]], _SCALE[a["level"]] * np.abs(zoom))
    far = zoom[one] * (p[two] - p[one])
    agree = (np.abs(far + q[one] - q[two]) <= OFF * size[two] + 0.2 * np.abs(far) + 1e-6) & (np.abs(zoom[two] / zoom[one] - 1) < 0.45 + 1e-9)
    votes = np.bincount(np.repeat(np.arange(len(lead)), times), agree, len(lead))
    best = np.zeros(len(pairs))
    np.maximum.at(best, np.repeat(np.arange(len(pairs)), leads), votes)
    return best >= MATCHES


_LINKS = "u long, v long"


def _links(left: _Block, right: _Block) -> list[tuple[int, int]]:
    """A spanning forest of the links between the images of two blocks, or of one with itself."""
    blocks = [left] if left is right else [left, right]
    points, half = np.concatenate([x.points for x in blocks]), np.concatenate([x.half for x in blocks], axis=1)
    corners = np.concatenate([[0], *(np.diff(x.edge) for x in blocks)]).cumsum().tolist()
    ids, wide, tall = (np.concatenate([getattr(x, c) for x in blocks]).tolist() for c in ("ids", "wide", "tall"))
    joined, shift, out = Forest(len(ids)), 0 if left is right else len(left.ids), []
    place = lambda u: slice(corners[u], corners[u + 1])
    for us, vs in _candidates(left, right):
        for at in range(0, len(us), TRIED):
            some = zip(us[at : at + TRIED].tolist(), (vs[at : at + TRIED] + shift).tolist(), strict=True)
            some = [(u, v) if ids[u] < ids[v] else (v, u) for u, v in some if joined.root(u) != joined.root(v)]
            for k in np.flatnonzero(_hopeful(points, half, [(place(u), place(v)) for u, v in some])) if some else ():
                u, v = some[k]
                if joined.root(u) != joined.root(v) and same_picture(
                    points[place(u)], points[place(v)], (wide[u], tall[u]), (wide[v], tall[v])
                ):
                    joined.join(u, v)
                    out.append((ids[u], ids[v]))
    return out


_BLOCK = {"ids": "array<long>", "wide": "array<int>", "tall": "array<int>", "corners": "array<int>", "points": "binary"}


def _blocks(images: DataFrame, corners: int) -> DataFrame:
    """Images of (media_id, wide, tall, points) as they come, packed into rows of about so many corners: a scratch table of a file
    for each row."""
    kinds = [pa.list_(pa.int64()), *[pa.list_(pa.int32())] * 3, pa.binary()]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, wide, tall, bodies, held = [], [], [], [], 0

        def row() -> pa.RecordBatch:
            order = sorted(range(len(ids)), key=ids.__getitem__)
            values = [[x[k] for k in order] for x in (ids, wide, tall, bodies)]
            values[3:] = [len(x) // POINT.itemsize for x in values[3]], b"".join(values[3])
            return pa.RecordBatch.from_arrays([pa.array([x], kind) for x, kind in zip(values, kinds, strict=True)], list(_BLOCK))

        for batch in batches:
            for values in zip(*(batch[c] for c in ("media_id", "wide", "tall", "points")), strict=True):
                for to, x in zip((ids, wide, tall, bodies), values, strict=True):
                    to.append(x.as_py())
                held += len(bodies[-1]) // POINT.itemsize
                if held >= corners:
                    yield row()
                    ids, wide, tall, bodies, held = [], [], [], [], 0
        if ids:
            yield row()

    packed = map_batches(images.select("media_id", "wide", "tall", "points"), pack, ", ".join(f"{c} {kind}" for c, kind in _BLOCK.items()))
    return cut(packed.withColumn("block", F.monotonically_increasing_id()), "media-blocks", maxRecordsPerFile=1)


def _compared(blocks: DataFrame, cores: int) -> DataFrame:
    """(u, v): links between the images of a scratch table of blocks, of any two blocks a spanning forest."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, left = None, None
        for batch in batches:
            for k in range(batch.num_rows):
                sides = [batch[f"block{side}"][k].as_py() for side in "12"]

                def block(side: str, batch: pa.RecordBatch = batch, k: int = k) -> _Block:
                    numbers = (batch[f"{c}{side}"][k].values.to_numpy() for c in ("ids", "wide", "tall", "corners"))
                    return _Block(*numbers, np.frombuffer(batch[f"points{side}"][k].as_buffer(), POINT))

                if number != sides[0]:
                    number, left = sides[0], block("1")
                links = np.array(_links(left, left if sides[0] == sides[1] else block("2")), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in links.T.copy()], ["u", "v"])

    n = blocks.count()
    parts = max(1, -(-n // HELD), min(n, 2 * cores))
    one, two = (blocks.select(*(F.col(c).alias(f"{c}{side}") for c in ("block", *_BLOCK))).coalesce(parts) for side in "12")
    # each two blocks meet once, in either order
    first = F.pmod(F.xxhash64(F.least("block1", "block2"), F.greatest("block1", "block2")), F.lit(2)) == 0
    pairs = one.crossJoin(two).where((F.col("block1") == F.col("block2")) | (F.col("block1") != F.col("block2")) & ((F.col("block1") < F.col("block2")) == first))
    return map_batches(pairs, compare, _LINKS)


def _keyed(classes: DataFrame, points: bool = False, parts: int = 1) -> DataFrame:
    """(key, media_id) for each word of each corner, the number of the word in the key's upper bits, of all keys or of one of so many
    parts of them; with ``points`` also the corner: x, y, level, turn, b0, b1."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies = [np.frombuffer(x.as_buffer(), POINT) for x in batch["points"]]
            body = np.concatenate([np.zeros(0, POINT), *bodies])
            ids = np.repeat(batch["media_id"].to_numpy(), [len(x) for x in bodies])
            for k in range(4):
                key = body["bits"][:, k].astype(np.int64) | k << 32
                mine = np.flatnonzero(mix64(key.view(np.uint64)) % np.uint64(parts) == 0)
                p, columns = body[mine], {"key": pa.array(key[mine]), "media_id": pa.array(ids[mine])}
                if points:
                    columns |= {c: pa.array(p[c].astype(np.int32)) for c in ("x", "y", "level", "turn")}
                    columns |= {f"b{h}": pa.array(x.view(np.int64)) for h, x in enumerate(_halves(p))}
                yield pa.RecordBatch.from_pydict(columns)

    more = ", x int, y int, level int, turn int, b0 long, b1 long" if points else ""
    return map_batches(classes.select("media_id", "points"), make, f"key long, media_id long{more}")


def _fits(ids: DataFrame) -> DataFrame:
    """A scratch table of one long column, hinted as broadcast only up to BROADCAST_IDS rows."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def _rare_candidates(cold: DataFrame, classes: DataFrame, keys: DataFrame) -> DataFrame:
    """(u, v), u < v: candidates of which one image is in ``cold``, that is, has no hot key; so they share rare keys only."""
    wanted = _fits(cut(_keyed(cold).select("key").distinct().join(keys.where(F.col("n") <= HOT).select("key"), "key"), "media-wanted"))
    some = classes.join(cold.select("media_id", F.lit(True).alias("is_cold")), "media_id", "left")
    corner = _keyed(classes, True).join(wanted, "key", "left_semi")
    side = corner.join(some.select("media_id", F.coalesce("is_cold", F.lit(False)).alias("is_cold")), "media_id")
    side = side.select("key", F.struct("media_id", "is_cold", "x", "y", "level", "turn", "b0", "b1").alias("p"))
    met = side.withColumnRenamed("p", "a").join(side.withColumnRenamed("p", "b"), "key").where(
        "a.media_id < b.media_id and (a.is_cold or b.is_cold)"
    )
    off = [F.col(f"a.b{h}").bitwiseXOR(F.col(f"b.b{h}")) for h in range(2)]
    equal = [f(o) == 0 for o in off for f in (lambda o: o.bitwiseAND(F.lit(0xFFFFFFFF)), lambda o: F.shiftrightunsigned(o, 32))]
    first = F.when(equal[0], 0).when(equal[1], 1).when(equal[2], 2).otherwise(3)  # each pair of corners once
    met = met.where((F.bit_count(off[0]) + F.bit_count(off[1]) <= HAMMING) & (first == F.shiftright("key", 32)))
    scale = F.array(*map(F.lit, SCALES))
    cell = F.floor((F.pmod(F.col("b.turn") - F.col("a.turn"), F.lit(256)) * TURNS + 128) / 256) % TURNS
    met = met.withColumns(
        {"cell": cell, "step": F.col("b.level") - F.col("a.level"), "ratio": scale[F.col("b.level")] / scale[F.col("a.level")]}
    )
    met = met.withColumns(
        {
            "c": F.cos(F.col("cell") * (2 * np.pi / TURNS)), "s": F.sin(F.col("cell") * (2 * np.pi / TURNS)),
            "grid": F.explode(F.array(F.lit(0.0), F.lit(0.5)))
        }
    )
    shift = [
        F.col("b.x") - F.col("ratio") * (F.col("a.x") * F.col("c") - F.col("a.y") * F.col("s")),
        F.col("b.y") - F.col("ratio") * (F.col("a.x") * F.col("s") + F.col("a.y") * F.col("c"))
    ]
    places = [F.col(f"{p}.x") * 65536 + F.col(f"{p}.y") for p in "ab"]
    met = met.select(
        F.col("a.media_id").alias("u"), F.col("b.media_id").alias("v"), "cell", "step", "grid",
        *(F.floor(d / (SHIFT * UNITS) + F.col("grid")).alias(f"d{k}") for k, d in enumerate(shift)),
        *(p.alias(f"p{k}") for k, p in enumerate(places))
    )
    counted = met.groupBy("u", "v", "cell", "step", "grid", "d0", "d1").agg(
        F.count(F.lit(1)).alias("n"), *(f(f"p{k}").alias(f"{f.__name__}{k}") for k in range(2) for f in (F.min, F.max))
    )
    return counted.where(
        (F.col("n") >= MET) & (F.col("min0") < F.col("max0")) & (F.col("min1") < F.col("max1"))
    ).select("u", "v").distinct()


def _confirmed(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (u, v) of images that one geometry joins."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            good = [
                same_picture(
                    np.frombuffer(r["points"], POINT), np.frombuffer(r["points2"], POINT), (r["wide"], r["tall"]),
                    (r["wide2"], r["tall2"])
                )
                for r in rows
            ]
            yield batch.select(["u", "v"]).filter(pa.array(good, pa.bool_()))

    body = classes.select("media_id", "wide", "tall", "points")
    both = pairs.join(body.withColumnRenamed("media_id", "u"), "u").join(body.toDF("v", "wide2", "tall2", "points2"), "v")
    return map_batches(both.select("u", "v", "wide", "tall", "points", "wide2", "tall2", "points2"), check, _LINKS)


def _hot_images(keyed: DataFrame, counted: DataFrame) -> DataFrame:
    """A scratch table of media_id: the images that have a key which ``counted`` (key, n) says is hot. A count for each key stays in
    the scratch table that it reads."""
    hot = _fits(cut(counted.where(F.col("n") > HOT).select("key"), "media-hot-keys"))
    return cut(keyed.join(hot, "key", "left_semi").select("media_id").distinct(), "media-hot")


def copy_links(classes: DataFrame) -> DataFrame:
    """(u, v) for (media_id, wide, tall, points) that scratch tables hold: links that join every two images with MET matches that share
    a word and lie in one cell of the geometry, if :func:`same_picture` confirms them. Between images with hot keys only a spanning forest
    of two blocks' links comes out."""
    number = lambda keyed: keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    # one part of the keys shows most images that have a hot one, and spares the others the rest
    part = _keyed(classes, parts=KEY_PARTS)
    hot = _hot_images(part, number(part))
    rest = cut(classes.select("media_id").join(_fits(hot), "media_id", "left_anti"), "media-rest")
    if rest.isEmpty():
        cold = keys = None
        packed = classes
    else:
        wanted = cut(_keyed(classes.join(_fits(rest), "media_id")).select("key").distinct(), "media-wanted")
        keyed = _keyed(classes)
        keys = cut(number(keyed.join(F.broadcast(wanted), "key", "left_semi") if wanted.count() <= BROADCAST_IDS else keyed), "media-keys")
        cold = cut(rest.join(_fits(_hot_images(_keyed(classes.join(_fits(rest), "media_id")), keys)), "media_id", "left_anti"), "media-cold")
        packed = classes.join(_fits(cold), "media_id", "left_anti")
    cores = classes.sparkSession.sparkContext.defaultParallelism
    total = (packed.agg(F.sum(F.octet_length("points"))).first()[0] or 0) // POINT.itemsize
    blocks = _blocks(packed, min(BLOCK_CORNERS, max(BLOCK_CORNERS // SPREAD, -(-total // cores))))
    found = cut(_compared(blocks, cores), "media-found")
    drop(blocks)
    if cold is None or cold.isEmpty():
        return found
    bodies = classes.join(_fits(cold), "media_id")
    rare = cut(_rare_candidates(bodies, classes, keys), "media-candidates")
    return found.unionByName(_confirmed(rare, classes))


def image_copies(images: DataFrame) -> DataFrame:
    """(media_id, n_corners, component_id, kept) for each row of ``images``: component_id is the least id that links
    lead to. An image without corners is linked with nothing; images of equal corners are compared as one; of different
    pictures of one id only that of the least digest counts, and each row of the id gives a row; a null id has a null component_id
    and is kept; other columns are not read; an empty table gives no rows."""
    packs = describe(images)
    packs = cut(packs.withColumns({f"h{k}": F.xxhash64(F.lit(k), "wide", "tall", "points") for k in range(2)}), "media-packs")
    picture = ["media_id", "h0", "h1"]
    heads = packs.groupBy(*picture).agg(
        F.first((F.octet_length("points") / POINT.itemsize).cast("long")).alias("n_corners"), F.count(F.lit(1)).alias("times")
    )
    heads = cut(heads, "media-heads")
    named = heads.groupBy("media_id").agg(F.min(F.struct("h0", "h1", "n_corners")).alias("h")).select("media_id", "h.*")
    classes = cut(named.groupBy("h0", "h1").agg(F.min("media_id").alias("least")), "media-classes")
    # bodies stay where they are; what is taken from them is mostly little
    gone = cut(heads.join(classes.withColumnRenamed("least", "media_id"), picture, "left_anti").select(*picture), "media-gone")
    able = packs.join(fits(gone), picture, "left_anti").where(F.octet_length("points") >= MATCHES * POINT.itemsize)
    able = able.select("media_id", "wide", "tall", "points")
    if not heads.where("times > 1").isEmpty():
        able = cut(able.dropDuplicates(["media_id"]), "media-bodies")
    links = cut(copy_links(able), "media-links")
    drop(packs)
    roots = components(links, "media").select(F.col("u").alias("least"), "v")
    classes = classes.join(roots, "least", "left").select("h0", "h1", F.coalesce("v", "least").alias("root"))
    counts = named.join(classes, ["h0", "h1"]).select("media_id", "n_corners", "root")
    out = images.select("media_id").join(counts, "media_id", "left")
    component = F.coalesce("root", "media_id")
    return out.select(
        "media_id", F.coalesce("n_corners", F.lit(0)).cast("long").alias("n_corners"), component.alias("component_id"),
        F.coalesce(F.col("media_id") == component, F.lit(True)).alias("kept")
    )


def vector_images(vectors: DataFrame, block: int = 10) -> DataFrame:
    """A picture of each vector of (vec_id, embedding): its values as blocks of grey, row by row in a square. It stands
    for image files, which the tables have none of."""

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            side, pixels = [], []
            for v in batch["embedding"]:
                values = np.nan_to_num(np.array(v.as_py() or [], float))
                n = int(np.ceil(np.sqrt(len(values))))
                grid = np.zeros(n * n)
                grid[: len(values)] = np.clip(128 + 300 * values, 0, 255)
                side.append(n * block)
                pixels.append(np.kron(grid.reshape(n, n), np.ones((block, block))).astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch["vec_id"].cast(pa.int64()), pa.array(side, pa.int32()), pa.array(side, pa.int32()), pa.array(pixels, pa.binary())],
                ["media_id", "width", "height", "pixels"]
            )

    return map_batches(vectors.select("vec_id", "embedding"), draw, "media_id long, width int, height int, pixels binary")
