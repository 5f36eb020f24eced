"""A sequential model of the collector's session loop, written from reading it.

Used only by tests: the Spark plans must agree with it poll by poll.
"""

from __future__ import annotations

import math
from decimal import ROUND_HALF_UP, Decimal


def round_half_up(x: float, scale: int) -> float:
    d = Decimal(repr(x)).quantize(Decimal(1).scaleb(-(scale + 4)), rounding=ROUND_HALF_UP)
    return float(d.quantize(Decimal(1).scaleb(-scale), rounding=ROUND_HALF_UP))


def _f(v):
    return 0.0 if v is None or (isinstance(v, float) and math.isnan(v)) else float(v)


def pick(bars):
    """bars: list of (bar_key, seq, o, h, l, c, v). Dedup by key keeping the highest seq; second newest."""
    best = {}
    for b in bars:
        if b[0] not in best or b[1] > best[b[0]][1]:
            best[b[0]] = b
    keys = sorted(best)
    if not keys:
        return None
    return best[keys[-2]] if len(keys) >= 2 else best[keys[-1]]


def run_session(polls, max_bad=5, spike=0.05, all_polls=True, stale_good_only=False):
    """polls: list of (poll_id, ok, bars) in poll order. Returns {poll_id: dict}."""
    last_bar, prev_close, num, den, streak, ticks, aborted = None, None, 0.0, 0.0, 0, 0, False
    out = {}
    for pid, ok, bars in polls:
        if aborted:
            out[pid] = {"outcome": "AFTER_ABORT"}
            continue
        bar = pick(bars) if ok else None
        if bar is None:
            streak += 1
            out[pid] = {"outcome": "FETCH_FAILED", "fail_streak": streak}
            if streak >= max_bad:
                aborted = True
            continue
        o, h, l, c, v = (_f(x) for x in bar[2:7])
        if h == l == o == c and c > 0:
            if not stale_good_only:
                last_bar = bar[0]
            out[pid] = {"outcome": "COLLAPSED", "fail_streak": streak}
            continue
        if c <= 0:
            if not stale_good_only:
                last_bar = bar[0]
            out[pid] = {"outcome": "BAD_PRICE", "fail_streak": streak}
            continue
        stale = bar[0] == last_bar
        if all_polls or not stale:
            num += (h + l + c) / 3 * max(v, 1.0)
            den += max(v, 1.0)
        if stale:
            out[pid] = {"outcome": "STALE", "fail_streak": streak}
            continue
        last_bar = bar[0]
        streak = 0
        ticks += 1
        lr = round_half_up(math.log(c / prev_close), 6) if prev_close is not None and prev_close > 0 else 0.0
        if c <= 0:
            dq = "BAD_PRICE"
        elif prev_close is not None and prev_close > 0 and abs(c - prev_close) / prev_close > spike:
            dq = "SPIKE"
        elif v == 0:
            dq = "OK_NO_VOL"
        else:
            dq = "OK"
        out[pid] = {"outcome": "GOOD", "fail_streak": 0, "tick_no": ticks, "prev_close": prev_close,
                    "vwap": round_half_up(num / den, 2), "log_return": lr, "data_quality": dq,
                    "close": round_half_up(c, 2)}
        prev_close = round_half_up(c, 2)
    return out
