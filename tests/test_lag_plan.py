from __future__ import annotations

import pytest
from hypothesis import given
from hypothesis import strategies as st

from panelwright.operators.lags import LagSpec, lag_frames, lag_groups, lag_name, lag_plan

TSTEP = 10


@pytest.mark.parametrize(
    "istep, t_min, t_max, power, past, ahead",
    [
        (-1, -14, 4, 0.79375, [(-12, 7), (-7, 5), (-4, 3), (-2, 2), (-1, 1)], [(1, 1), (3, 2)]),
        (-2, -9, 4, 0.48928, [(-8, 2), (-6, 2), (-4, 2), (-3, 1), (-2, 1)], [(-1, 1), (1, 1), (2, 1), (3, 1)]),
        (-3, -10, 5, 0.17445, [(t, 1) for t in range(-9, -2)], [(t, 1) for t in (-2, -1, 1, 2, 3, 4, 5)]),
        (-10, -14, -9, 0.20068, [(-13, 1), (-12, 1), (-11, 1), (-10, 1)], [(-9, 1)]),
        (-1, -16, 0, 0.45970, [(-13, 3), (-10, 3), (-8, 2), (-6, 2), (-4, 2), (-3, 1), (-2, 1), (-1, 1)], []),
    ],
)
def test_published_settings(istep, t_min, t_max, power, past, ahead):
    assert lag_plan(t_min, istep, istep, TSTEP, power) == past
    assert lag_plan(t_min, t_max, istep, TSTEP, power) == past + ahead


def test_bad_ranges():
    with pytest.raises(ValueError):
        lag_plan(-5, 10, -1, TSTEP, 0.5)
    with pytest.raises(ValueError):
        lag_plan(3, 2, -1, TSTEP, 0.5)


@given(st.integers(-10, -1), st.integers(1, 15), st.integers(0, 10), st.floats(0, 0.8))
def test_windows_tile_without_overlap(istep, back, forward, power):
    plan = lag_plan(istep - back, min(istep + forward, TSTEP + istep), istep, TSTEP, power)
    steps = [s for s, _ in plan]
    assert steps == sorted(set(steps)) and 0 not in steps
    covered = [p for s, w in plan for p in range(s - w + 1, s + 1)]
    assert len(covered) == len(set(covered))


@given(st.integers(-10, -1), st.integers(1, 15), st.floats(0, 0.8))
def test_observed_lags_never_pass_the_last_observation(istep, back, power):
    spec = LagSpec(istep, istep - back, istep, power, ("y",))
    assert all(f.step <= istep for f in lag_frames(spec, TSTEP).values())


def test_names_and_groups():
    assert lag_name("price", -3, 2) == "price_3n2" and lag_name("price", 3, 2) == "price_3p2"
    spec = LagSpec(-2, -4, 2, 0.0, ("y",), ("a", "b"))
    assert lag_groups(spec, TSTEP)["a"] == ["a_3n1", "a_2n1", "a_1n1", "a_1p1", "a_2p1"]
    assert spec.gap == 1 and spec.horizon == 2
