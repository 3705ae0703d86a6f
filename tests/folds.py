"""Plain row-by-row definitions the operators are compared with."""

from __future__ import annotations


def moving_anchor(rows, min_ms, max_ms):
    """rows: (ts, value) in order. Returns (ts, value, anchor_ts, anchor_value)."""
    out, anchor = [], None
    for ts, value in rows:
        if anchor is None or ts - anchor[0] > max_ms:
            anchor = (ts, value)
        elif min_ms <= ts - anchor[0]:
            out.append((ts, value, *anchor))
    return out


def running_rate(rows):
    """rows: (ts, level) in order. Returns (ts, rate, level)."""
    average, started = 0.0, False
    last = rows[0]
    for (ts0, level0), (ts1, level1) in zip(rows, rows[1:]):
        if ts1 == ts0:
            continue
        step = (level1 - level0) * 1000 / (ts1 - ts0)
        average, started = ((average + step) / 2, True) if started else (step, True)
        last = (ts1, level1)
    return last[0], average, last[1]
