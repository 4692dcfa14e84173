"""Property tests (no Spark): the algebra behind the parallel clamped walk."""

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.operators.curve import _apply, _compose, _segmented_scan

steps = st.lists(st.floats(min_value=-60, max_value=60, allow_nan=False), min_size=1, max_size=200)


def _walk(ds, v=0.0, lo=25.0, hi=75.0):
    out = []
    for d in ds:
        v = max(lo, min(hi, v + d))
        out.append(v)
    return out


@given(steps, st.floats(min_value=-100, max_value=200, allow_nan=False))
@settings(max_examples=200, deadline=None)
def test_scan_equals_sequential_walk(ds, v0):
    a = np.array(ds)
    n = len(a)
    A, L, H = _segmented_scan(np.zeros(n, dtype=int), a, np.full(n, 25.0), np.full(n, 75.0))
    got = _apply(v0, A, L, H)
    want = _walk(ds, v0)
    assert np.allclose(got, want, atol=1e-9)


@given(steps, st.lists(st.integers(min_value=0, max_value=3), min_size=1, max_size=200))
@settings(max_examples=100, deadline=None)
def test_segments_do_not_leak(ds, keys):
    n = min(len(ds), len(keys))
    seg = np.sort(np.array(keys[:n]))
    a = np.array(ds[:n])
    A, L, H = _segmented_scan(seg, a, np.full(n, 25.0), np.full(n, 75.0))
    got = _apply(0.0, A, L, H)
    for s in np.unique(seg):
        m = seg == s
        assert np.allclose(got[m], _walk(list(a[m])), atol=1e-9)


@given(st.lists(st.tuples(st.floats(-50, 50), st.floats(0, 40), st.floats(40, 100)), min_size=3, max_size=3),
       st.floats(-100, 200))
@settings(max_examples=200, deadline=None)
def test_composition_is_associative(fs, v):
    (a1, l1, h1), (a2, l2, h2), (a3, l3, h3) = fs
    left = _compose(*_compose(a1, l1, h1, a2, l2, h2), a3, l3, h3)
    right = _compose(a1, l1, h1, *_compose(a2, l2, h2, a3, l3, h3))
    assert np.isclose(_apply(v, *left), _apply(v, *right), atol=1e-9)
    # and equals applying the three steps one after the other
    seq = _apply(_apply(_apply(v, a1, l1, h1), a2, l2, h2), a3, l3, h3)
    assert np.isclose(_apply(v, *left), seq, atol=1e-9)
