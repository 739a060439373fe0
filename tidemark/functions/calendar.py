"""Calendar windows: phrases of time as predicates of the dialect."""

from __future__ import annotations

import re

_PERIODS = {"day": "P1D", "week": "P1W", "month": "P1M", "quarter": "P3M", "year": "P1Y"}
_ROLLING = re.compile(r"(?:past|last) (\d+) (minute|hour|day|week|month|year)s?")
_RANGE = re.compile(r"(\d{4}-\d\d-\d\d) to (\d{4}-\d\d-\d\d)")


def time_window(phrase: str, column: str = "__time") -> str:
    """The predicate for today, yesterday, this or last week, month, quarter and year,
    ``last N days`` (and other units) up to now, or ``2024-01-01 to 2024-01-31`` with both days.

    All but ranges hang on CURRENT_TIMESTAMP, the engine's clock, so that they
    fold to bounds which the scan can use.
    """
    words = " ".join(phrase.lower().split())
    words = {"today": "this day", "yesterday": "last day"}.get(words, words)
    if m := _RANGE.fullmatch(words):
        return f"{column} >= TIMESTAMP '{m[1]}' AND {column} < TIMESTAMP '{m[2]}' + INTERVAL '1' DAY"
    if m := _ROLLING.fullmatch(words):
        amount, unit = (int(m[1]) * 7, "DAY") if m[2] == "week" else (int(m[1]), m[2].upper())
        return f"{column} >= CURRENT_TIMESTAMP - INTERVAL '{amount}' {unit} AND {column} < CURRENT_TIMESTAMP"
    which, _, unit = words.partition(" ")
    if which not in ("this", "last") or unit not in _PERIODS:
        raise ValueError(f"no window for {phrase!r}")
    period = _PERIODS[unit]
    begin = f"TIME_FLOOR(CURRENT_TIMESTAMP, '{period}')"
    if which == "this":
        return f"{column} >= {begin} AND {column} < TIME_SHIFT({begin}, '{period}', 1)"
    return f"{column} >= TIME_SHIFT({begin}, '{period}', -1) AND {column} < {begin}"
