"""Exact counts and nearest distances of places within one tile of cases, for `counting.ring_counts`."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

# Relative slack of the bounds; whatever lies within it is compared exactly.
SLACK = 1e-12
# Places and cases that are compared at once.
AT_ONCE = 2_000_000


class Tile:
    """The cases of a tile in rows of equal numbers from south to north, by longitude inside a row."""

    def __init__(self, x: np.ndarray, y: np.ndarray, code: np.ndarray, values: int):
        count = max(1, int(np.sqrt(len(x))))
        self.start = np.linspace(0, len(x), count + 1).astype(np.int64)
        row = np.repeat(np.arange(count), np.diff(self.start))
        north = np.argsort(y, kind="stable")
        self.south, self.north = y[north][self.start[:-1]], y[north][self.start[1:] - 1]
        order = north[np.lexsort((x[north], row))]
        self.x, self.y, self.code, self.values = x[order], y[order], code[order], values
        self.before = np.zeros((values, len(x) + 1), np.int64)
        for v in range(values):
            np.cumsum(self.code == v, out=self.before[v, 1:])

    def row(self, r: int) -> tuple[int, np.ndarray]:
        return self.start[r], self.x[self.start[r] : self.start[r + 1]]

    def low(self, r: int, y: np.ndarray) -> np.ndarray:
        """How far a row's nearest and farthest case can be to the north or south."""
        return np.maximum(np.maximum(self.south[r] - y, y - self.north[r]), 0.0)

    def high(self, r: int, y: np.ndarray) -> np.ndarray:
        return np.maximum(np.abs(y - self.south[r]), np.abs(y - self.north[r]))

    def met(self, x, y, who, first, stop):
        """(who, case, distance) for the cases from `first` to `stop` of each place, in portions."""
        some = stop > first
        who, first, size = who[some], first[some], (stop - first)[some]
        portion = (np.cumsum(size) - size) // AT_ONCE
        for at, end in zip(*_runs(portion)):
            n = size[at:end]
            each = np.repeat(who[at:end], n)
            case = np.arange(n.sum()) + np.repeat(first[at:end] - (np.cumsum(n) - n), n)
            dx, dy = x[each] - self.x[case], y[each] - self.y[case]
            yield each, case, np.sqrt(dx * dx + dy * dy)

    def within(self, x: np.ndarray, y: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """Cases of each value at most the radius away from each place."""
        total = np.zeros((len(x), self.values), np.int64)
        wide, narrow, pad = radius * (1 + SLACK), radius * (1 - SLACK), SLACK * (np.abs(x) + radius)
        for r in range(len(self.south)):
            low = self.low(r, y)
            who = np.flatnonzero(low <= wide)
            if not len(who):
                continue
            at, row = self.row(r)
            px, low, high, outer, inner = x[who], low[who], self.high(r, y[who]), wide[who], narrow[who]
            out = np.sqrt((outer - low) * (outer + low)) + pad[who]
            sure = np.sqrt(np.maximum((inner - high) * (inner + high), 0.0)) - pad[who]
            first, stop = np.searchsorted(row, px - out), np.searchsorted(row, px + out, "right")
            # cases from `left` to `right` are surely within
            left, right = np.searchsorted(row, px - sure), np.searchsorted(row, px + sure, "right")
            none = (sure <= 0) | (left >= right)
            left, right = np.where(none, stop, left), np.where(none, stop, right)
            for v in range(self.values):
                total[who, v] += self.before[v, at + right] - self.before[v, at + left]
            for a, b in ((first, left), (right, stop)):
                for each, case, away in self.met(x, y, who, at + a, at + b):
                    hit = away <= radius[each]
                    np.add.at(total, (each[hit], self.code[case[hit]]), 1)
        return total

    def nearest(self, x: np.ndarray, y: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """Distance of the nearest case of each place, infinite if none is within the limit."""
        best = np.full(len(x), np.inf)
        own = np.minimum(np.searchsorted(self.north, y), len(self.south) - 1)
        order = np.argsort(own, kind="stable")
        for a, b in zip(*_runs(own[order])):
            # a first guess: the case before and the case after it in the row at its height
            who = order[a:b]
            at, row = self.row(own[who[0]])
            after = np.searchsorted(row, x[who])
            for case in (at + np.maximum(after - 1, 0), at + np.minimum(after, len(row) - 1)):
                dx, dy = x[who] - self.x[case], y[who] - self.y[case]
                best[who] = np.minimum(best[who], np.sqrt(dx * dx + dy * dy))
        for r in range(len(self.south)):
            low, reach = self.low(r, y), np.minimum(best, limit) * (1 + SLACK)
            who = np.flatnonzero(low <= reach)
            if not len(who):
                continue
            at, row = self.row(r)
            reach, low = reach[who], low[who]
            out = np.sqrt((reach - low) * (reach + low)) + SLACK * (np.abs(x[who]) + reach)
            first, stop = np.searchsorted(row, x[who] - out), np.searchsorted(row, x[who] + out, "right")
            for each, _, away in self.met(x, y, who, at + first, at + stop):
                np.minimum.at(best, each, away)
        return np.where(best <= limit, best, np.inf)


def _runs(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of equal numbers begin and end."""
    first = np.flatnonzero(np.diff(numbers, prepend=-1)) if len(numbers) else np.empty(0, np.int64)
    return first, np.append(first[1:], len(numbers)) if len(first) else first


def _codes(cases: pa.Table, by: tuple[str, ...]) -> tuple[np.ndarray, np.ndarray]:
    """A number for each row's values of `by`, and a row that has the values of each number."""
    code = np.zeros(len(cases), np.int64)
    for name in by:
        column = cases[name].combine_chunks().dictionary_encode(null_encoding="encode")
        code = code * (len(column.dictionary) + 1) + column.indices.to_numpy(zero_copy_only=False)
        code = np.unique(code, return_inverse=True)[1]
    return code, np.unique(code, return_index=True)[1]


def tile_counter(degrees: list[float], by: tuple[str, ...]):
    """The function over the places and the cases of one tile: (lon, lat, _ring, *by, _n, _near).

    A place has `_rim` if its cases are to be counted, and a `_bound`, not below zero, if its nearest case within it is wanted.
    """

    def run(places: pa.Table, cases: pa.Table) -> pa.Table:
        names = ["lon", "lat", "_ring", *by, "_n", "_near"]
        code, example = _codes(cases, by)
        case_x, case_y = (cases[c].to_numpy() for c in ("case_lon", "case_lat"))
        tile = Tile(case_x, case_y, code, len(example)) if len(cases) else None
        x, y, bound = (places[c].to_numpy() for c in ("lon", "lat", "_bound"))
        rim = np.flatnonzero(places["_rim"].to_numpy()) if tile else np.empty(0, np.int64)
        total = np.zeros((len(rim), len(degrees), max(1, len(example))), np.int64)
        if len(rim):
            px, py = x[rim], y[rim]
            dx = np.maximum(np.maximum(case_x.min() - px, px - case_x.max()), 0.0)
            dy = np.maximum(np.maximum(case_y.min() - py, py - case_y.max()), 0.0)
            wide = np.maximum(np.abs(px - case_x.min()), np.abs(px - case_x.max()))
            high = np.maximum(np.abs(py - case_y.min()), np.abs(py - case_y.max()))
            nearest, farthest = np.sqrt(dx * dx + dy * dy), np.sqrt(wide * wide + high * high)
            for k, radius in enumerate(degrees):
                total[farthest <= radius, k] = tile.before[:, -1]
                cut = np.flatnonzero((nearest <= radius) & (farthest > radius))
                total[cut, k] = tile.within(px[cut], py[cut], np.full(len(cut), radius))
            total[:, 1:] -= total[:, :-1].copy()
        who, ring, value = np.nonzero(total)
        close = np.flatnonzero(bound >= 0) if tile else np.empty(0, np.int64)
        away = tile.nearest(x[close], y[close], np.minimum(bound[close], degrees[-1])) if len(close) else np.empty(0)
        close, away = close[away < np.inf], away[away < np.inf]
        rows, nothing = pa.array(np.concatenate([rim[who], close])), len(close)
        columns = [places[c].take(rows) for c in ("lon", "lat")]
        columns.append(pa.concat_arrays([pa.array(ring.astype(np.int32)), pa.nulls(nothing, pa.int32())]))
        for name in by:
            kept = cases[name].combine_chunks().take(pa.array(example[value]))
            columns.append(pa.concat_arrays([kept, pa.nulls(nothing, kept.type)]))
        columns.append(pa.array(np.concatenate([total[who, ring, value], np.zeros(nothing, np.int64)])))
        columns.append(pa.concat_arrays([pa.nulls(len(who), pa.float64()), pa.array(away, pa.float64())]))
        return pa.Table.from_arrays(columns, names=names)

    return run
