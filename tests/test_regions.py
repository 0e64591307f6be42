import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from earshot.functions.nearest import near_together
from earshot.functions.regions import Regions, boxes


def laid_out(rows, sample, size):
    tree = Regions(sample, size)
    own = tree.of(rows)
    low, high = np.full((tree.n_regions, rows.shape[1]), np.inf), np.full((tree.n_regions, rows.shape[1]), -np.inf)
    found, _, low[found], high[found] = boxes(rows, own)
    tree.set_boxes(low, high)
    return tree, own


@settings(max_examples=100, deadline=None)
@given(
    values=st.lists(st.lists(st.sampled_from([0.0, 0.0, 0.0, 1.0, 2.5, -1.0, 1e200]), min_size=3, max_size=3), min_size=1, max_size=60),
    size=st.integers(1, 9), bound=st.sampled_from([0.0, 0.5, 1.0, 1.6, np.inf]), every=st.integers(1, 4),
)
def test_visits_hold_everyone_within_the_bound(values, size, bound, every):
    rows = np.array(values)
    tree, own = laid_out(rows, rows[::every], size)
    assert ((0 <= own) & (own < tree.n_regions)).all()
    at, region = tree.visits(rows, own, np.full(len(rows), bound))
    visits = {*zip(at.tolist(), region.tolist())}
    assert len(visits) == len(at) and all(own[i] != r for i, r in visits) and (np.diff(at) >= 0).all()
    with np.errstate(over="ignore"):
        gaps = np.sqrt(((rows[:, None] - rows[None]) ** 2).sum(axis=2))
    for i, j in np.argwhere(gaps <= bound):
        assert own[i] == own[j] or (i, own[j]) in visits
    # Equal vectors are never parted; with the whole sample only they are more than the size.
    for r in range(tree.n_regions):
        assert every > 1 or (own == r).sum() <= size or len(np.unique(rows[own == r], axis=0)) == 1


def test_regions_are_about_even_and_few_are_visited():
    rng = np.random.default_rng(2)
    rows = rng.random((20_000, 3)) * (rng.random((20_000, 3)) < 0.5)
    tree, own = laid_out(rows, rows[::20], 50)
    sizes = np.bincount(own)
    assert 20 <= tree.n_regions <= 80 and (own == tree.of(rows)).all()
    zeros = (rows == 0).all(axis=1)
    assert sizes.max() <= max(2000, 1.2 * zeros.sum())
    at, _ = tree.visits(rows, own, np.full(len(rows), 0.01))
    assert len(at) < 2 * len(rows)


@settings(max_examples=60, deadline=None)
@given(
    values=st.lists(st.lists(st.sampled_from([0.0, 0.0, 0.0, 1.0, -2.0]), min_size=2, max_size=2), max_size=60), rows=st.integers(1, 9),
)
def test_runs_hold_everyone_once(values, rows):
    order = near_together(np.array(values).reshape(-1, 2), rows)
    assert sorted(order.tolist()) == list(range(len(values)))


def test_runs_are_cut_where_zeros_end():
    rng = np.random.default_rng(3)
    rows = np.eye(5)[rng.integers(0, 5, 4000)] * (1 + 0.1 * rng.random((4000, 1)))
    order = near_together(rows, 50)
    kinds = [len({*rows[order[i : i + 50]].argmax(axis=1).tolist()}) for i in range(0, 4000, 50)]
    # Runs are mixed only where a kind ends, not most of the 80.
    assert sum(k > 1 for k in kinds) < 12
