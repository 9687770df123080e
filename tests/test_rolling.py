"""The array helpers against a record-at-a-time loop."""

import numpy as np
from hypothesis import given, settings, strategies as st

from millrace.operators.policy import RollPolicy
from millrace.operators.rolling import State, advance, compose, describe, roll


def one_by_one(ts, size, policy):
    part, opened, last, held, out = -1, None, None, 0, []
    for t, s in zip(ts, size):
        if (
            part < 0
            or t - opened >= policy.age_us
            or t - last >= policy.idle_us
            or held > policy.size
        ):
            part, opened, held = part + 1, t, 0
        held, last = held + s, t
        out.append(part)
    return out


rows = st.lists(st.tuples(st.integers(0, 12), st.integers(1, 40)), min_size=1, max_size=120)
policies = st.builds(
    RollPolicy,
    st.one_of(st.none(), st.integers(1, 40).map(lambda s: s / 1e6)),
    st.one_of(st.none(), st.integers(1, 14).map(lambda s: s / 1e6)),
    st.one_of(st.none(), st.integers(1, 200)),
)


@settings(max_examples=400, deadline=None)
@given(rows, policies, st.data())
def test_every_way_of_cutting_gives_the_same_parts(gaps, policy, data):
    ts = np.cumsum([g for g, _ in gaps]).astype(np.int64) + 1_700_000_000_000_000
    size = np.array([s for _, s in gaps], np.int64)
    expected = one_by_one(ts.tolist(), size.tolist(), policy)
    assert roll(ts, size, State(), policy)[0].tolist() == expected

    cuts = sorted(data.draw(st.sets(st.integers(1, max(1, len(ts) - 1)), max_size=12)))
    edges = [0, *(c for c in cuts if c < len(ts)), len(ts)]
    pieces = list(zip(edges, edges[1:]))

    state, got = State(), []
    for a, b in pieces:
        parts, state = roll(ts[a:b], size[a:b], state, policy)
        got += parts.tolist()
    assert got == expected

    # Spans, one after the other, give the state before each piece ...
    spans = [describe(ts[a:b], size[a:b], policy) for a, b in pieces]
    before, state, exact = [], State(), State()
    for (a, b), span in zip(pieces, spans):
        assert state == exact
        before.append(state)
        state = advance(span, state, policy)
        exact = roll(ts[a:b], size[a:b], exact, policy)[1]
    assert state == exact

    # ... and so do composed spans, from any state on the way.
    for i in range(len(spans)):
        whole = spans[i]
        for span in spans[i + 1 :]:
            whole = compose(whole, span, policy)
        assert advance(whole, before[i], policy) == exact


def test_listed_rows_stay_within_the_size_limit():
    n = 100_000
    ts = np.arange(n, dtype=np.int64)
    size = np.full(n, 61, np.int64)
    span = describe(ts, size, RollPolicy(None, None, 6100))
    assert len(span.at_ts) <= 102
    both = compose(span, describe(ts + n, size, RollPolicy(None, None, 6100)), RollPolicy(None, None, 6100))
    assert len(both.at_ts) <= 102


def test_spans_where_only_a_pause_rolls_stay_small():
    policy, whole = RollPolicy(None, 30, None), None
    for i in range(100):
        ts = np.arange(50, dtype=np.int64) * 1_000_000 + i * 50_000_000
        span = describe(ts, np.full(50, 61), policy)
        whole = span if whole is None else compose(whole, span, policy)
        assert len(whole.at_ts) <= 2
