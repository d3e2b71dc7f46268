"""Row-by-row answers in plain Python for small inputs."""

from __future__ import annotations

from collections import defaultdict
from datetime import date, timedelta


def states(initial: list[tuple], changes: list[tuple]) -> dict[tuple, tuple]:
    """(license, date) -> (renewable, price, type, id)."""
    found: dict[tuple, tuple] = {}
    for cid, lic, day, price, kind, renewable in sorted(changes, key=lambda r: r[0]):
        found[lic, day] = (renewable, price, kind, cid)
    for lic, _customer, kind, day, price, renewable in initial:
        found.setdefault((lic, day), (renewable, price, kind, -1))
    return found


def calendar(history: dict[tuple, tuple]) -> list[date]:
    days = [day for _, day in history]
    return [min(days) + timedelta(days=i) for i in range((max(days) - min(days)).days + 1)]


def panel(initial: list[tuple], changes: list[tuple], fill: str) -> dict[tuple, tuple]:
    """(license, date) -> (renewable, price, type)."""
    history = states(initial, changes)
    created: dict[int, date] = {}
    for row in initial:
        created[row[0]] = min(row[3], created.get(row[0], row[3]))
    result = {}
    for lic, first in created.items():
        current: list = [None, None, None]
        for day in calendar(history):
            if day < first:
                continue
            state = history.get((lic, day))
            if state is not None:
                kept = current if fill == "column" else [None, None, None]
                current = [new if new is not None else old for new, old in zip(state[:3], kept)]
            if fill == "column" or current[0] is not None:
                result[lic, day] = tuple(current)
    return result


def mart(initial: list[tuple], changes: list[tuple], fill: str = "row") -> list[tuple]:
    rows = panel(initial, changes, fill)
    kinds = {r[2] for r in rows.values()}
    totals: dict[tuple, list[int]] = defaultdict(lambda: [0, 0, 0])
    for (_, day), (renewable, price, kind) in rows.items():
        if kind is None or renewable is None:
            continue
        cell = totals[day, kind]
        if renewable:
            cell[0] += 1
            cell[1] += price or 0
        else:
            cell[2] += 1
    result = []
    for kind in kinds:
        before = None
        for day in calendar(states(initial, changes)):
            now = totals.get((day, kind), [0, 0, 0])
            diff = [0, 0, 0] if before is None else [a - b for a, b in zip(now, before)]
            result.append((day, kind, *now, *diff))
            before = now
    return result
