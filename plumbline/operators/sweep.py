"""Sums of points within circles, for one tile's points and the places whose circles may meet it: numpy inside a task.

Points stand in bands of latitude and, within a band, in narrow columns, in that order, with running totals of their values. In a band, a circle covers a
stretch of longitudes: columns within its least stretch add a difference of two totals, those beyond the greatest nothing, and only points of the columns between
are compared. So a place's work follows its circles' edges.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Elements of an array at a time; columns of a band as wide as it is high; bands of a tile at the most.
CHUNK, NARROW, BANDS_MOST = 16_000, 6, 4096
#: Radians, some micrometres, by which stretches are kept apart for rounding.
MARGIN = 1e-12


def _sphere(lat: np.ndarray, lng: np.ndarray) -> np.ndarray:
    return np.stack([np.cos(lat) * np.cos(lng), np.cos(lat) * np.sin(lng), np.sin(lat)])


def _added(out: np.ndarray, at: np.ndarray, values: np.ndarray) -> None:
    if out.dtype == np.float64:
        out += np.bincount(at, weights=values, minlength=len(out))
    else:
        np.add.at(out, at, values)


def _totals(values: np.ndarray) -> np.ndarray:
    """As doubles where all their sums are exact, else as longer ones."""
    exact = np.issubdtype(values.dtype, np.integer) or bool((values == np.floor(values)).all())
    wide = values.astype(np.longdouble)
    return values.astype(np.float64) if exact and np.abs(wide).sum() < 2**53 else wide


def circle_sums(lat: np.ndarray, lng: np.ndarray, r_lat: np.ndarray, r_lng: np.ndarray, values: list[np.ndarray], angles: list[float]) -> list[np.ndarray]:
    """For each place, in degrees, the sums of each of the values within its angle (radians); values are finite."""
    values = [_totals(v) for v in values]
    out = [np.zeros(len(lat), v.dtype) for v in values]
    if not len(lat) or not len(r_lat):
        return out
    chords = [(2 * np.sin(min(np.pi / 2, a / 2))) ** 2 for a in angles]
    phi, lam, y, x = (np.radians(v) for v in (lat, lng, r_lat, r_lng))
    p, q = _sphere(phi, lam), _sphere(y, x)
    # Longitudes count from a point of the tile.
    lam, x = (np.radians((v - r_lng[0] + 180.0) % 360.0 - 180.0) for v in (lng, r_lng))
    if np.abs(lam).max() + np.abs(x).max() > np.pi:  # around a pole
        step = max(1, CHUNK // len(x))
        for at in range(0, len(lam), step):
            part = slice(at, at + step)
            far = ((p[:, part, None] - q[:, None, :]) ** 2).sum(0)
            for o, v, chord in zip(out, values, chords):
                o[part] = np.where(far <= chord, v, 0).sum(1)
        return out
    y0, x0, tall = y.min(), x.min(), max(y.max() - y.min(), 1e-9)
    broad = max((x.max() - x0) * np.cos(np.abs(y).min()), 1e-9)
    high = max(np.sqrt(tall * broad / len(y)), tall / BANDS_MOST, min(angles) / 64)
    wide = max((x.max() - x0) / max(1.0, broad / high * NARROW), 1e-12)
    bands, columns = int(tall / high) + 1, int((x.max() - x0) / wide) + 1
    cell = np.minimum(((y - y0) / high).astype(np.int64), bands - 1) * columns + np.minimum(((x - x0) / wide).astype(np.int64), columns - 1)
    order = np.argsort(cell, kind="stable")
    start = np.zeros(bands * columns + 1, np.int64)
    np.cumsum(np.bincount(cell, minlength=bands * columns), out=start[1:])
    q, values = np.ascontiguousarray(q[:, order]), [v[order] for v in values]
    totals = [np.concatenate([np.zeros(1, v.dtype), np.cumsum(v)]) for v in values]
    edge = y0 + np.arange(bands + 1) * high
    low, up = edge[:-1] - MARGIN, edge[1:] + MARGIN
    widest = np.where((low < 0) & (up > 0), 1.0, np.maximum(np.cos(low), np.cos(up)))
    least = np.maximum(np.minimum(np.cos(low), np.cos(up)), 1e-15)
    slim, cos = np.sqrt(least / widest), np.maximum(np.cos(phi), 1e-15)
    places = np.lexsort((lam, np.floor((phi - y0) / high)))  # neighbours in turn
    for o, v, total, angle, chord in zip(out, values, totals, angles, chords):
        square, count = np.sin(min(np.pi / 2, angle / 2)) ** 2, int(2 * angle / high) + 3
        own_places = places[(phi[places] >= y0 - angle - MARGIN) & (phi[places] <= y.max() + angle + MARGIN)]
        for at in range(0, len(own_places), max(1, CHUNK // count)):
            own = own_places[at : at + max(1, CHUNK // count)]
            f, band = phi[own, None], np.floor((phi[own] - angle - y0) / high).astype(np.int64)[:, None] + np.arange(count)
            valid = (band >= 0) & (band < bands)
            band = np.clip(band, 0, bands - 1)
            # Of the band's latitudes the nearest and the farthest bound the stretch: sin(d / 2) ** 2 lies between d ** 2 / 4 * (1 - d ** 2 / 12) and d ** 2 / 4.
            below, above = f - low[band], up[band] - f
            near = np.square(np.maximum(-np.minimum(below, above), 0.0)) / 4
            outer = square * (1 + 1e-9) - near * (1 - near / 3)
            k, j = np.nonzero((outer > 0) & valid)
            band, here = band[k, j], own[k]
            inner = square * (1 - 1e-9) - np.square(np.maximum(below[k, j], above[k, j])) / 4
            scale = 1 / (cos[here] * least[band])
            # asin(u) lies between u and u + 0.571 * u ** 3.
            reach = np.minimum(np.sqrt(outer[k, j] * scale), 1.0)
            reach = 2 * (reach + 0.571 * reach * reach * reach) + MARGIN
            sure = np.maximum(2 * np.minimum(np.sqrt(np.maximum(inner, 0.0) * scale) * slim[band], 1.0) - MARGIN, 0.0)
            middle = lam[here] - x0
            column = lambda c: np.clip(c / wide, 0, columns).astype(np.int64)  # noqa: B023, E731
            first, last = column(middle - reach), column(middle + reach + wide)
            a, b = column(middle - sure + wide), column(middle + sure)
            b = np.maximum(a, b)
            row = band * columns
            s0, s1, s2, s3 = start[row + first], start[row + a], start[row + b], start[row + last]
            _added(o, here, total[s2] - total[s1])
            starts, sizes, owner = np.concatenate([s0, s2]), np.concatenate([s1 - s0, s3 - s2]), np.concatenate([here, here])
            held = sizes > 0
            starts, sizes, owner = starts[held], sizes[held], owner[held]
            upto = np.cumsum(sizes)
            # A crowd's columns are compared a part at a time.
            cuts = np.searchsorted(upto, np.arange(0, upto[-1] if len(upto) else 0, 4 * CHUNK), side="left")
            for i0, i1 in zip(cuts, [*cuts[1:], len(sizes)]):
                n = sizes[i0:i1]
                if not len(n):
                    continue
                index = np.arange(n.sum()) + np.repeat(starts[i0:i1] - (np.cumsum(n) - n), n)
                whose = np.repeat(owner[i0:i1], n)
                d = (p[0][whose] - q[0][index]) ** 2 + (p[1][whose] - q[1][index]) ** 2 + (p[2][whose] - q[2][index]) ** 2
                hit = d <= chord
                _added(o, whose[hit], v[index[hit]])
    return out


def tile_sums(names: list[str], owns: list[str], angles: list[float], schema: pa.Schema):
    """The function that takes a tile's places (lat, lng) and its points (r_lat, r_lng and the values), as tables; owns: the value that each of the sums adds up."""

    def sums(places: pa.Table, points: pa.Table) -> pa.Table:
        of = lambda t, c: t.column(c).to_numpy()
        got = {}
        for own in dict.fromkeys(owns):  # a value's points are those that have it
            some = points.filter(points.column(own).is_valid())
            its = [k for k, o in enumerate(owns) if o == own]
            values = [of(some, own)] * len(its)
            got.update(zip(its, circle_sums(of(places, "lat"), of(places, "lng"), of(some, "r_lat"), of(some, "r_lng"), values, [angles[k] for k in its])))
        return pa.table([places.column("lat"), places.column("lng"), *(pa.array(got[k].astype(schema.field(n).type.to_pandas_dtype())) for k, n in enumerate(names))], schema=schema)

    return sums
