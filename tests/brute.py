"""Reading-by-reading models of usage, to compare the set-based operators with."""

import datetime as dt
from decimal import Decimal


def _start(t, step):
    if step == "1n":
        d = dt.datetime.fromtimestamp(t, dt.timezone.utc).replace(day=1, hour=0, minute=0, second=0)
        return int(d.timestamp())
    return t - t % {"30m": 1800, "1h": 3600, "1d": 86400}[step]


def _next_start(start, step):
    if step == "1n":
        return _start(start + 32 * 86400, step)
    return start + {"30m": 1800, "1h": 3600, "1d": 86400}[step]


def windows(t, step):
    """Every closed window a moment lies in."""
    start = _start(t, step)
    found = [(start, _next_start(start, step))]
    if start == t:
        before = _start(t - 1, step)
        found.append((before, start))
    return found


def minus(a, b):
    return float(Decimal(repr(a)) - Decimal(repr(b)))


def changelog(rows, steps):
    """(feed, step, ws, we, arrival, value) after every reading, keeping both ends as state."""
    state, out = {}, []
    for feed, t, arrival, value in sorted(rows, key=lambda r: r[2]):
        for step in steps:
            for ws, we in windows(t, step):
                first, last = state.get((feed, step, ws), ((t, value), (t, value)))
                first = (t, value) if t <= first[0] else first
                last = (t, value) if t >= last[0] else last
                state[feed, step, ws] = (first, last)
                out.append((feed, step, ws, we, arrival, minus(last[1], first[1])))
    return out


def final(log):
    return {(feed, step, ws, we): value for feed, step, ws, we, _, value in log}


def in_order(rows):
    newest, kept = {}, []
    for row in sorted(rows, key=lambda r: r[2]):
        if row[1] >= newest.get(row[0], row[1]):
            newest[row[0]] = row[1]
            kept.append(row)
    return kept


def delta(rows, steps):
    """Running sum of differences to the previous reading of the feed."""
    previous, sums = {}, {}
    for feed, t, _, value in in_order(rows):
        for step in steps:
            for ws, we in windows(t, step):
                key = (feed, step, ws, we)
                if key not in sums:
                    sums[key] = 0.0
                elif feed in previous:
                    sums[key] += value - previous[feed]
        previous[feed] = value
    return sums


def from_start(rows, steps):
    """Current minus the stored start; a reading on the window's start replaces it."""
    starts, out = {}, {}
    for feed, t, _, value in in_order(rows):
        for step in steps:
            for ws, we in windows(t, step):
                key = (feed, step, ws, we)
                if key not in starts or t == ws:
                    starts[key] = value
                out[key] = value - starts[key]
    return out
