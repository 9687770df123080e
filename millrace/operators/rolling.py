"""Array helpers for the part-rolling rule, used inside Spark tasks.

A writer's state is ``(open, last, bytes, part)``: when its part was opened, when it was
last written, how much it holds, and its number. Rolling depends on all earlier records of
a group, so a group that spans several chunks of sorted rows is handled in two steps. A
``Span`` describes what a chunk does to *any* incoming state; spans compose, so the state
at the start of each chunk follows without reading the rows again.

A span lists the rows at which the incoming part may be rolled for the first time. From
such a row on nothing depends on the past, so the state after the chunk is known for each.
The size rule bounds the list: a part rolls once it holds more than ``max_bytes``.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

from millrace.operators.policy import OFF, RollPolicy

# The state before the first record: so long ago that the first record opens part 0.
LONG_AGO = -(1 << 62)


class State(NamedTuple):
    open: int = LONG_AGO
    last: int = LONG_AGO
    bytes: int = 0
    part: int = -1


class Span(NamedTuple):
    first_ts: int
    last_ts: int
    total: int  # bytes of all rows
    must_roll: bool  # every incoming part rolls at the last listed row at the latest
    at_ts: np.ndarray  # listed rows: instant
    before: np.ndarray  # bytes of the rows before it
    end_open: np.ndarray  # state at the end when the first roll is at or before this row
    end_bytes: np.ndarray
    rolls: np.ndarray  # rolls from there to the end


def roll(ts: np.ndarray, size: np.ndarray, state: State, policy: RollPolicy):
    """Part number of each row of one group, and the state after the last row."""
    n = len(ts)
    before = np.cumsum(size) - size
    idle = np.append(np.flatnonzero(np.diff(ts, prepend=state.last) >= policy.idle_us), n)
    opened, base, low = state.open, -state.bytes, 0
    starts = []
    while True:
        at = min(
            ts.searchsorted(opened + policy.age_us),
            before.searchsorted(base + policy.size, "right"),
            idle[idle.searchsorted(low)],
        )
        if at >= n:
            break
        starts.append(at)
        opened, base, low = int(ts[at]), int(before[at]), at + 1
    rolled = np.zeros(n, np.int64)
    rolled[starts] = 1
    held = int(before[-1] + size[-1]) - base
    after = State(opened, int(ts[-1]), held, state.part + len(starts))
    return state.part + np.cumsum(rolled), after


def describe(ts: np.ndarray, size: np.ndarray, policy: RollPolicy) -> Span:
    """The span of sorted rows of one group."""
    n = len(ts)
    before = np.cumsum(size) - size
    total = int(before[-1] + size[-1])
    idle = np.append(np.flatnonzero(np.diff(ts) >= policy.idle_us) + 1, n)
    rows = np.arange(n)
    follow = np.minimum(
        ts.searchsorted(ts + policy.age_us),
        before.searchsorted(before + policy.size, "right"),
    )
    follow = np.minimum(follow, idle[idle.searchsorted(rows, "right")])
    # Pointer doubling from every row to the last roll it leads to.
    ends = follow >= n
    jump = np.where(ends, rows, follow)
    hops = np.where(ends, 0, 1)
    while True:
        further = jump[jump]
        if np.array_equal(further, jump):
            break
        hops = hops + hops[jump]
        jump = further

    limit = min(
        int(idle[0]),
        int(ts.searchsorted(int(ts[0]) + policy.age_us)),
        int(before.searchsorted(policy.size, "right")),
    )
    if policy.age_us == OFF and policy.size == OFF:
        # Only a pause rolls: at the first row or at the first pause after it.
        listed = np.unique([0, min(limit, n - 1)]) if limit < n else np.array([0])
    else:
        listed = np.arange(min(limit + 1, n))
        if policy.size == OFF:
            # Rows of one instant roll together, so only the first of them can be first.
            listed = listed[np.diff(ts[listed], prepend=LONG_AGO) > 0]
    span = Span(
        int(ts[0]), int(ts[-1]), total, limit < n,
        ts[listed], before[listed],
        ts[jump[listed]], total - before[jump[listed]], hops[listed] + 1,
    )
    return merge_equal(span)


def merge_equal(span: Span) -> Span:
    """Keep the last of neighbouring rows that lead to the same end."""
    ends = np.stack([span.end_open, span.end_bytes, span.rolls])
    keep = np.append(np.any(ends[:, 1:] != ends[:, :-1], axis=0), True)
    return span._replace(**{f: getattr(span, f)[keep] for f in Span._fields[4:]})


def follow_span(span: Span, opened, last: int, held, part, policy: RollPolicy):
    """States after a span, for arrays of states before it that share ``last``."""
    at = np.minimum(
        span.at_ts.searchsorted(opened + policy.age_us),
        span.before.searchsorted(policy.size - held, "right"),
    )
    if span.must_roll:
        at = np.minimum(at, len(span.at_ts) - 1)
    if span.first_ts - last >= policy.idle_us:
        at = np.zeros_like(at)
    rolled = at < len(span.at_ts)
    row = np.minimum(at, len(span.at_ts) - 1)
    return (
        np.where(rolled, span.end_open[row], opened),
        np.where(rolled, span.end_bytes[row], held + span.total),
        part + np.where(rolled, span.rolls[row], 0),
    )


def advance(span: Span, state: State, policy: RollPolicy) -> State:
    """The state after a span."""
    opened, held, part = follow_span(
        span, np.array([state.open]), state.last,
        np.array([state.bytes]), np.array([state.part]), policy,
    )
    return State(int(opened[0]), span.last_ts, int(held[0]), int(part[0]))


def compose(a: Span, b: Span, policy: RollPolicy) -> Span:
    """The span of ``a`` followed by ``b``."""
    end_open, end_bytes, rolls = follow_span(
        b, a.end_open, a.last_ts, a.end_bytes, a.rolls, policy
    )
    both = a._replace(
        last_ts=b.last_ts, total=a.total + b.total,
        end_open=end_open, end_bytes=end_bytes, rolls=rolls,
    )
    if a.must_roll:
        return merge_equal(both)
    paused = b.first_ts - a.last_ts >= policy.idle_us
    before = b.before + a.total
    # Rows past the first one that rolls whatever came before are out of reach.
    due = (before > policy.size) | (b.at_ts >= a.first_ts + policy.age_us)
    due[0] |= paused
    due[-1] |= b.must_roll
    count = int(np.argmax(due)) + 1 if due.any() else len(due)
    # Where only a pause rolls, no row before the first that is due can.
    begin = 0 if policy.age_us < OFF or policy.size < OFF else count - int(due.any())
    added = (b.at_ts, before, b.end_open, b.end_bytes, b.rolls)
    mine = (both.at_ts, both.before, both.end_open, both.end_bytes, both.rolls)
    joined = [np.concatenate([x, y[begin:count]]) for x, y in zip(mine, added)]
    arrays = dict(zip(Span._fields[4:], joined))
    return merge_equal(both._replace(must_roll=bool(due.any()), **arrays))
