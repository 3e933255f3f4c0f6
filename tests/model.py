"""The late-event policy one event at a time: the yardstick for the operators."""

from __future__ import annotations

import datetime as dt

DAY = dt.timedelta(days=1)


def replay(deliveries, out_of_orderness=300, lateness=3600):
    """``deliveries``: (arrival, tick, event_id, customer, rate, event_time) in any order.

    Returns per-arrival flags and per-window results.
    """
    slack, grace = dt.timedelta(seconds=out_of_orderness), dt.timedelta(seconds=lateness)
    highest = None
    stored, windows, flags = set(), {}, {}
    ordered = sorted(deliveries)
    for position, (arrival, tick, event_id, customer, rate, when) in enumerate(ordered):
        mark = None if highest is None else highest - slack
        late = mark is not None and when < mark
        highest = when if highest is None else max(highest, when)
        new = event_id not in stored
        stored.add(event_id)
        key = (customer, when.replace(hour=0, minute=0, second=0, microsecond=0))
        window = windows.get(key)
        taken = new and not (window and window["closed_at"] is not None)
        if taken:
            window = windows.setdefault(key, {"rates": [], "closed_at": None})
            window["rates"].append(rate)
        flags[arrival] = {
            "late": late, "behind": (mark - when).total_seconds() if late else None,
            "new": new, "aggregated": taken,
        }
        flushes = position + 1 == len(ordered) or ordered[position + 1][1] != tick
        if flushes:
            for (_, start), state in windows.items():
                if state["closed_at"] is None and highest - slack > start + DAY + grace:
                    state["closed_at"] = tick
    return flags, windows
