"""One-to-one assignment of the trips of one group by cost, where so many meet that tables of their pairs would be large.

A pair costs its shift over `within` plus the share of places that it doesn't have in common. So at a cost, the fewer places
two patterns can share, the closer their trips must run. Costs are gone through in steps: in each, free trips meet at a place
inside the span that their lengths leave them, and the pairs up to that cost are taken in order. Memory is bounded by slices.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from feedloom.functions.kernels import blocks

#: Pairs of visits that a step should meet, pairs of trips below which the next one is wider, and cells of an array at once.
STEP, WIDER, CELLS = 1 << 22, 1 << 18, 1 << 21
#: Slots of places in which the members of patterns are counted.
SLOTS = 16
#: Cells of a table of all new trips and places; beyond it, times are searched.
DENSE = 1 << 24
#: Pairs of patterns whose matched places a worker keeps.
KEPT = 1 << 20
UNIT, NONE = 10**6, np.iinfo(np.int32).max

_codes: dict[str | None, int] = {}
_matched: dict[tuple[bytes, bytes], int] = {}


def _coded(places: pa.Array) -> np.ndarray:
    """A number for each place, the same in all groups of a worker; nulls are -1."""
    words = places.dictionary_encode()
    if len(_codes) > KEPT:
        _codes.clear()
        _matched.clear()
    known = np.array([_codes.setdefault(x, len(_codes)) for x in words.dictionary.to_pylist()] + [-1], np.int32)
    return known[words.indices.fill_null(len(known) - 1).to_numpy(zero_copy_only=False)]


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The indexes start, start + 1, ... of each run, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def millionths(cost: np.ndarray) -> np.ndarray:
    """Costs in millionths, halves up as Spark's round does it: by the shortest decimals that a double is written with."""
    at = cost * UNIT
    out = np.floor(at + 0.5).astype(np.int64)
    for i in np.flatnonzero(np.abs(at - np.floor(at) - 0.5) < 1e-4):
        out[i] = int(Decimal(repr(float(cost[i]))).quantize(Decimal("0.000001"), ROUND_HALF_UP).scaleb(6))
    return out


def _flat(lists: pa.ChunkedArray) -> tuple[np.ndarray, pa.Array]:
    """(offsets, values) of a column of lists."""
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy().astype(np.int64)
    values = pc.list_flatten(lists)
    return np.append(0, np.cumsum(sizes)), values.combine_chunks() if isinstance(values, pa.ChunkedArray) else values


class Trips:
    """Classes of equal trips of one side: their places, timed visits and members, those with few visits first."""

    def __init__(self, rows: pa.Table, first: bool):
        self.n = len(rows)
        at, values = _flat(rows["places"])
        self.place, self.at = _coded(values), at
        till, times = _flat(rows["times"])
        self.members_at, self.members = _flat(rows["members"])
        self.size = np.diff(self.members_at)
        self.length = np.diff(at)
        trip = np.repeat(np.arange(self.n), self.length)
        nth = np.arange(len(trip)) - at[:-1][trip]
        padded = np.append(pc.fill_null(times, NONE).to_numpy(zero_copy_only=False).astype(np.int64), NONE)
        self.time = padded[np.where(nth < np.diff(till)[trip], np.minimum(till[:-1][trip] + nth, len(padded) - 1), len(padded) - 1)]
        self.untimed = np.diff(till) - self.length
        self.dep = rows["dep"].to_numpy().astype(np.int64)
        timed = np.flatnonzero((self.time != NONE) & (self.place >= 0))
        by = (self.place[timed], trip[timed]) if first else (self.time[timed], self.place[timed], trip[timed])
        timed = timed[np.lexsort(by)]  # stable, so a place's first call comes first
        same = (trip[timed][1:] == trip[timed][:-1]) & (self.place[timed][1:] == self.place[timed][:-1])
        same = same if first else same & (self.time[timed][1:] == self.time[timed][:-1])
        begin = np.flatnonzero(np.append(True, ~same)) if len(timed) else timed
        self.v_trip, self.v_place, self.v_time = trip[timed][begin], self.place[timed][begin].astype(np.int64), self.time[timed][begin]
        self.v_times = np.diff(np.append(begin, len(timed)))
        self.v_at = np.searchsorted(self.v_trip, np.arange(self.n + 1))

    def patterns(self, known: dict[bytes, int]) -> np.ndarray:
        raw, at = self.place.tobytes(), (self.at * self.place.itemsize).tolist()
        return np.array([known.setdefault(raw[a:b], len(known)) for a, b in zip(at[:-1], at[1:], strict=True)], np.int64)

    def end(self, last: bool) -> np.ndarray:
        out = np.full(self.n, -1)
        some = self.length > 0
        out[some] = self.place[(self.at[1:] - 1 if last else self.at[:-1])[some]]
        return out


class Group:
    """The trips of both sides of one group, and what of them is free."""

    def __init__(self, old: Trips, new: Trips, shorter: bool, least: float, within: int, most: float | None, ends: bool):
        self.old, self.new, self.shorter, self.least, self.within, self.ends = old, new, shorter, least, within, ends
        known: dict[bytes, int] = {}
        self.old_pattern, self.new_pattern = old.patterns(known), new.patterns(known)
        self.names = list(known)
        slots = max(1, min(SLOTS, int(max(x.place.max(initial=0) for x in (old, new))) + 1))
        self.counts = np.zeros((slots, len(known)), np.uint16)
        for side, pattern in ((old, self.old_pattern), (new, self.new_pattern)):
            _, one = np.unique(pattern, return_index=True)
            member = ranges(side.at[one], side.length[one])
            count = np.bincount(side.place[member] % slots * len(known) + np.repeat(pattern[one], side.length[one]), minlength=self.counts.size)
            self.counts = np.maximum(self.counts, np.minimum(count, 65535).reshape(slots, -1).astype(np.uint16))
        self.most = float(np.floor(UNIT * (2 - least if most is None else min(most, 2 - least)) + 1e-6))
        self.tips = [(old.end(last), new.end(last)) for last in (False, True)]
        self.lengths, self.rank = np.unique(new.length, return_inverse=True)
        self.low = min(int(x.v_time.min()) for x in (old, new)) - 1
        self.wide = max(int(x.v_time.max()) for x in (old, new)) - self.low + 2
        self.codes, place = np.unique(np.append(old.v_place, new.v_place), return_inverse=True)
        self.old_place, self.new_place = place[: len(old.v_place)], place[len(old.v_place) :]
        self.cell = new.v_trip * len(self.codes) + self.new_place
        self.dense = None
        if new.n * len(self.codes) <= DENSE:
            self.dense = np.full(new.n * len(self.codes), NONE, np.int32)
            self.dense[self.cell] = new.v_time
        self.used_old, self.used_new = np.zeros(old.n, np.int64), np.zeros(new.n, np.int64)

    def bound(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The largest share that different patterns of these lengths can have."""
        return np.where(a == b, a - 1, np.minimum(a, b)) / self.whole(a, b)

    def whole(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """What a share of patterns of these lengths is relative to."""
        return np.maximum(np.minimum(a, b) if self.shorter else np.maximum(a, b), 1)

    def best(self, o: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The largest share that trips can have by the lengths of their patterns and by how often these have each place."""
        p, q = self.old_pattern[o], self.new_pattern[n]
        a, b = self.old.length[o], self.new.length[n]
        common = sum((np.minimum(x[p], x[q]).astype(np.int64) for x in self.counts), np.zeros(len(p), np.int64))
        common[np.maximum(a, b) > 65535] = NONE  # counts end there
        return np.where(p == q, 1.0, np.minimum(self.bound(a, b), common / self.whole(a, b)))

    def spans(self, cost: float) -> tuple[list, int]:
        """(for each way to meet, the old visits, and from where to where new ones are close enough, with those; their number)."""
        old, new, found, total = self.old, self.new, [], 0
        a = np.flatnonzero((self.used_old < old.size)[old.v_trip])
        b = np.flatnonzero((self.used_new < new.size)[new.v_trip])
        time = old.v_time[a] - self.low
        for equal in (True, False):
            n = len(self.names) if equal else len(self.lengths)
            kind = (self.new_pattern if equal else self.rank)[new.v_trip[b]]
            key = (self.new_place[b] * n + kind) * self.wide + new.v_time[b] - self.low
            order = np.argsort(key)
            key, trips = key[order], new.v_trip[b][order]
            for j in (None,) if equal else range(n):
                if equal:
                    share = np.ones(len(a))
                else:
                    share = self.bound(old.length, self.lengths[j])[old.v_trip[a]]
                span = np.minimum(self.within * (cost / UNIT - 1 + share) + 1e-3, self.within)
                sel = np.flatnonzero((span >= 0) & (share >= self.least))
                base = (self.old_place[a[sel]] * n + (self.old_pattern[old.v_trip[a[sel]]] if equal else j)) * self.wide
                span = np.floor(span[sel]).astype(np.int64)
                lo = np.searchsorted(key, base + np.maximum(time[sel] - span, 0))
                hi = np.searchsorted(key, base + np.minimum(time[sel] + span, self.wide - 1), "right")
                some = np.flatnonzero(hi > lo)
                found.append((old.v_trip[a[sel[some]]], lo[some], hi[some], trips))
                total += int((hi - lo).sum())
        return found, total

    def met(self, found: list, total: int) -> Iterator[np.ndarray]:
        """Pairs of trips (old x number of new + new), each once, in slices of old trips."""
        weight = np.zeros(self.old.n, np.int64)
        for trip, lo, hi, _ in found:
            weight += np.bincount(trip, hi - lo, self.old.n).astype(np.int64)
        cuts = np.searchsorted(np.cumsum(weight), np.arange(CELLS, total + CELLS, CELLS), "right") if total > CELLS else [self.old.n]
        begin = 0
        for end in [*dict.fromkeys(int(x) for x in cuts), self.old.n]:
            end = max(end, begin + 1)
            if begin >= self.old.n:
                return
            some = []
            for trip, lo, hi, trips in found:
                i, j = np.searchsorted(trip, [begin, end])
                size = hi[i:j] - lo[i:j]
                some.append(np.repeat(trip[i:j], size) * self.new.n + trips[ranges(lo[i:j], size)])
            pairs = np.concatenate(some)
            if len(pairs):
                pairs.sort()
                yield pairs[np.append(True, pairs[1:] != pairs[:-1])]
            begin = end

    def shifts(self, o: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(median delay, whether a call that is kept has another time) of pairs."""
        old, wide = self.old, int((self.old.v_at[o + 1] - self.old.v_at[o]).max())
        nth = np.arange(wide)
        there = nth < (old.v_at[o + 1] - old.v_at[o])[:, None]
        at = np.where(there, old.v_at[o][:, None] + nth, 0)
        cell = n[:, None] * len(self.codes) + self.old_place[at]
        if self.dense is None:
            i = np.minimum(np.searchsorted(self.cell, cell), len(self.cell) - 1)
            time = np.where(self.cell[i] == cell, self.new.v_time[i], NONE)
        else:
            time = self.dense[cell]
        there &= time != NONE
        delay = np.where(there, np.abs(old.v_time[at] - time), NONE).astype(np.int32)
        times = np.where(there, old.v_times[at], 0)
        rows, count = np.arange(len(o)), times.sum(1)
        late = (there & (delay > 0)).any(1)
        if int(times.max(initial=0)) <= 1:
            delay.sort(axis=1)
            low, high = delay[rows, (count - 1) // 2], delay[rows, count // 2]
        else:
            order = np.argsort(delay, axis=1, kind="stable")
            delay, upto = np.take_along_axis(delay, order, 1), np.cumsum(np.take_along_axis(times, order, 1), 1)
            low, high = (delay[rows, (upto > x[:, None]).argmax(1)] for x in ((count - 1) // 2, count // 2))
        return (low.astype(np.float64) + high) / 2.0, late

    def shares(self, p: np.ndarray, q: np.ndarray) -> np.ndarray:
        """What the patterns p and q share; each pair of patterns is compared once."""
        _, where, inverse = np.unique(p * len(self.names) + q, return_index=True, return_inverse=True)
        out = np.empty(len(where))
        if len(_matched) > KEPT:
            _matched.clear()
        for i, (x, y) in enumerate(zip(p[where].tolist(), q[where].tolist(), strict=True)):
            a, b = self.names[x], self.names[y]
            known = _matched.get((a, b))
            if known is None:
                known = _matched[a, b] = blocks(np.frombuffer(a, np.int32).tolist(), np.frombuffer(b, np.int32).tolist())
            out[i] = known / (min if self.shorter else max)(len(a) // 4, len(b) // 4)
        return out[inverse]

    def edges(self, found: list, total: int, cost: float) -> tuple[np.ndarray, ...]:
        """(cost, departures, old, new, late) of the pairs up to a cost, in order."""
        parts = []
        for pairs in self.met(found, total):
            for i in range(0, len(pairs), size := max(1, CELLS // 16)):
                o, n = pairs[i : i + size] // self.new.n, pairs[i : i + size] % self.new.n
                best = self.best(o, n)
                keep = (best >= self.least) & (1 - best <= cost / UNIT + 2e-6)
                if self.ends:
                    keep &= np.logical_or(*((x[o] == y[n]) & (x[o] >= 0) for x, y in self.tips))
                o, n, best = o[keep], n[keep], best[keep]
                if not len(o):
                    continue
                shift, late = self.shifts(o, n)
                keep = (shift <= self.within) & (shift / self.within + 1 - best <= cost / UNIT + 2e-6)
                o, n, shift, late = (x[keep] for x in (o, n, shift, late))
                p, q = self.old_pattern[o], self.new_pattern[n]
                share = self.shares(p, q)
                whole = millionths(shift / self.within + (1 - share))
                keep = (share >= self.least) & (whole <= cost)
                parts.append([x[keep] for x in (whole, o, n, late)])
        whole, o, n, late = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (np.zeros(0, np.int64),) * 4
        order = np.lexsort((self.new.dep[n], self.old.dep[o], whole))
        whole, o, n, late = (x[order] for x in (whole, o, n, late))
        return whole, self.old.dep[o], self.new.dep[n], o, n, late

    def taken(self, whole: np.ndarray, a: np.ndarray, b: np.ndarray, o: np.ndarray, n: np.ndarray, late: np.ndarray) -> Iterator[tuple]:
        """(old, new, late, first member of either, how many) in order: cost, departures, old member, new member."""
        begin = np.append(True, (whole[1:] != whole[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])) if len(whole) else np.zeros(0, bool)
        starts = np.flatnonzero(begin).tolist()
        o, n, late = o.tolist(), n.tolist(), late.tolist()
        left, right, sizes, others = self.used_old.tolist(), self.used_new.tolist(), self.old.size.tolist(), self.new.size.tolist()
        for i, j in itertools.pairwise([*starts, len(o)]):
            open_ = [k for k in range(i, j) if left[o[k]] < sizes[o[k]] and right[n[k]] < others[n[k]]]
            if len(open_) == 1:
                x, y = o[open_[0]], n[open_[0]]
                m = min(sizes[x] - left[x], others[y] - right[y])
                yield x, y, late[open_[0]], left[x], right[y], m
                left[x] += m
                right[y] += m
            elif open_:
                name = lambda side, x, m: side.members[int(side.members_at[x]) + m].as_py()
                near: dict[int, list[int]] = {}
                for k in open_:
                    near.setdefault(o[k], []).append(k)
                for _, x, m in sorted((name(self.old, x, m), x, m) for x in near for m in range(left[x], sizes[x])):
                    free = [(name(self.new, n[k], right[n[k]]), k) for k in near[x] if right[n[k]] < others[n[k]]]
                    if free:
                        k = min(free)[1]
                        yield x, n[k], late[k], m, right[n[k]], 1
                        left[x] += 1
                        right[n[k]] += 1
        self.used_old, self.used_new = np.array(left, np.int64), np.array(right, np.int64)

    def won(self) -> np.ndarray:
        done, step, out = -1.0, 0.02 * UNIT, [np.zeros((0, 6), np.int64)]
        while done < self.most:
            cost = min(done + step, self.most)
            found, total = self.spans(cost)
            if total > STEP and step > UNIT / (2 * self.within):
                step /= 2
                continue
            edges = self.edges(found, total, cost)
            out.append(np.array(list(self.taken(*edges)), np.int64).reshape(-1, 6))
            done = cost
            step = step * 2 if len(edges[0]) < WIDER else step
            if not ((self.used_old < self.old.size).any() and (self.used_new < self.new.size).any()):
                break
        return np.concatenate(out)

    def retimed(self, o: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Whether trips of equal places have other times."""
        size = self.old.length[o]
        differ = self.old.time[ranges(self.old.at[o], size)] != self.new.time[ranges(self.new.at[n], size)]
        pair = np.repeat(np.arange(len(o)), size)
        return (np.bincount(pair, differ, len(o)) > 0) | (self.old.untimed[o] != self.new.untimed[n])


def assigned(keys: list[str], shorter: bool, least: float, within: int, most: float | None, ends: bool) -> Callable[[pa.Table], pa.Table]:
    """A task on the classes of one group (keys, side, members, places, times, dep): keys, old_trip, new_trip, kind of what is taken.

    shorter: the share is that of the shorter pattern, else of the longer one. ends: pairs share their first or last place.
    """

    def run(rows: pa.Table) -> pa.Table:
        old = Trips(rows.filter(pc.equal(rows["side"], "old")).sort_by("calls"), False)
        new = Trips(rows.filter(pc.equal(rows["side"], "new")), True)
        names = [*keys, "old_trip", "new_trip", "kind"]
        if not len(old.v_trip) or not len(new.v_trip):
            none = pa.nulls(0, pa.string())
            return pa.table([*(rows[k].slice(0, 0) for k in keys), none, none, none], names)
        group = Group(old, new, shorter, least, within, most, ends)
        o, n, late, uo, un, m = group.won().T
        rerouted = group.old_pattern[o] != group.new_pattern[n]
        retimed = late.astype(bool)
        retimed[~rerouted] = group.retimed(o[~rerouted], n[~rerouted])
        kind = pa.DictionaryArray.from_arrays(pa.array(np.repeat(retimed + 2 * rerouted, m).astype(np.int32)), ["exact", "retimed", "rerouted", "retimed_rerouted"]).cast(pa.string())
        trips = [side.members.take(pa.array(ranges(side.members_at[x] + u, m))) for side, x, u in ((old, o, uo), (new, n, un))]
        return pa.table([*(rows[k].combine_chunks().take(pa.array(np.zeros(len(kind), np.int64))) for k in keys), *trips, kind], names)

    return run
