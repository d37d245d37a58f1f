import math

import numpy as np
import pytest

from culvert.operators import outliers


def brute_force(values, ids, alpha=0.05, k=None):
    """The test from its definition: whole sample re-read at every step."""
    left = sorted(zip(ids, values))
    n = len(left)
    k = max(1, math.floor(n * 0.10)) if k is None else k
    removed, significant = [], 0
    for step in range(1, k + 1):
        xs = np.array([v for _, v in left])
        if len(xs) < 3 or xs.min() == xs.max():
            break
        away = np.abs(xs - xs.mean())
        at = int(np.argmax(away))
        r = away[at] / xs.std(ddof=1)
        critical = outliers.critical_values(n, np.array([float(step)]), alpha)[0]
        removed.append(left.pop(at)[0])
        if r > critical:
            significant = step
    return set(removed[:significant])


def marked(spark, groups, block=outliers.BLOCK, k=None):
    data = [(c, f"{i:05d}", float(v)) for c, vs in groups.items() for i, v in enumerate(vs)]
    df = spark.createDataFrame(data, "cls string, id string, x double").repartition(5)
    out = outliers.gesd(df, "cls", "x", ["id"], block=block, k=k).collect()
    assert len(out) == len(data)
    return {c: {r.id for r in out if r.cls == c and r.is_outlier} for c in groups}


def samples(seed):
    rng = np.random.default_rng(seed)
    groups = {}
    for i in range(25):
        n = int(rng.integers(1, 160))
        base = [
            lambda: rng.lognormal(sigma=1.5, size=n),
            lambda: rng.integers(0, 4, n).astype(float),
            lambda: rng.normal(size=n),
            lambda: np.concatenate([rng.normal(size=n), rng.normal(scale=30, size=n // 12)]),
            lambda: np.round(rng.exponential(size=n), 1),
        ][i % 5]()
        groups[f"c{i}"] = base
    return groups


@pytest.mark.parametrize("seed,block", [(1, outliers.BLOCK), (2, 3), (3, 1)])
def test_equals_brute_force(spark, seed, block):
    groups = samples(seed)
    expected = {c: brute_force(v, [f"{i:05d}" for i in range(len(v))]) for c, v in groups.items()}
    assert any(expected.values())
    assert marked(spark, groups, block=block) == expected


def long_groups():
    rng = np.random.default_rng(11)
    return {
        "even": rng.normal(size=5000),
        "skewed": rng.lognormal(sigma=1.2, size=6000),
        "ties": np.round(rng.normal(size=4000), 1),
        "lumps": np.concatenate([rng.normal(size=3000), np.full(200, 40.0), np.full(150, -55.0), rng.normal(60, 0.01, 100)]),
        "short": rng.normal(size=300),
    }


def walked(spark, monkeypatch, groups, block):
    rounds, inner = [], outliers._settled

    def counted(spark, begins, sizes, walk_round, *rest):
        def round_(state, blocks, number):
            rounds.append(state.count())
            walk_round(state, blocks, number)

        return inner(spark, begins, sizes, round_, *rest)

    monkeypatch.setattr(outliers, "_settled", counted)
    return marked(spark, groups, block=block), rounds


def test_segments_walked_at_once_equal_brute_force(spark, monkeypatch):
    groups = long_groups()
    expected = {c: brute_force(v, [f"{i:05d}" for i in range(len(v))]) for c, v in groups.items()}
    got, rounds = walked(spark, monkeypatch, groups, 130)
    assert got == expected and all(expected[c] for c in ("skewed", "lumps"))
    # 500, 600, 400 and 345 steps in segments of 130: walked once, again from their true beginnings, and settled.
    assert rounds[0] == 4 + 5 + 4 + 3 and len(rounds) <= 3


def test_bad_guesses_cost_rounds_only(spark, monkeypatch):
    groups = {"skewed": long_groups()["skewed"]}
    expected = {c: brute_force(v, [f"{i:05d}" for i in range(len(v))]) for c, v in groups.items()}
    monkeypatch.setattr(outliers, "_guesses", lambda *_: {("skewed", j): (j * 130, 0) for j in range(5)})
    got, rounds = walked(spark, monkeypatch, groups, 130)
    assert got == expected and len(rounds) <= 5


def test_given_number_of_steps(spark):
    groups = {c: v for c, v in samples(4).items() if len(v) > 30}
    expected = {c: brute_force(v, [f"{i:05d}" for i in range(len(v))], k=9) for c, v in groups.items()}
    assert marked(spark, groups, k=9) == expected


def test_small_and_flat_groups(spark):
    far = [1.0, 1.1, 0.9, 1.0, 1.05, 0.95, 1.0, 1.1, 0.9, 1.0, 1.02, 50.0]
    out = marked(spark, {"two": [1.0, 9.0], "flat": [3.0] * 40, "far": far, "huge": [1.0, 2.0, 1.5] * 9 + [1e12, 1e9]})
    assert out["two"] == set() and out["flat"] == set()
    assert out["far"] == {"00011"}
    assert out["huge"] == brute_force([1.0, 2.0, 1.5] * 9 + [1e12, 1e9], [f"{i:05d}" for i in range(29)])


def test_equal_deviations_remove_the_lower_id_first(spark):
    values = [0.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 2.0]
    df = spark.createDataFrame([("c", f"{i:02d}", v) for i, v in enumerate(values)], "cls string, id string, x double")
    steps = outliers.gesd_steps(df, "cls", "x", ["id"]).collect()
    assert [s.id for s in steps] == ["00"]
    flipped = spark.createDataFrame([("c", f"{i:02d}", 2 - v) for i, v in enumerate(values)], "cls string, id string, x double")
    assert [s.id for s in outliers.gesd_steps(flipped, "cls", "x", ["id"]).collect()] == ["00"]


def test_ranks_of_a_distributed_sort(spark):
    rng = np.random.default_rng(7)
    data = [("a" if rng.random() < 0.9 else "b", float(rng.integers(0, 9)), i) for i in range(3000)]
    df = spark.createDataFrame(data, "g string, x double, i int").repartition(7)
    out = {(r.g, r.i): r["rank"] for r in outliers.rank_in_group(df, ["g"], ["x", "i"]).collect()}
    for g in "ab":
        ordered = sorted((x, i) for h, x, i in data if h == g)
        assert all(out[(g, i)] == rank for rank, (_, i) in enumerate(ordered))


def test_t_quantiles():
    got = outliers.t_quantile(np.array([0.025, 0.025, 0.025]), np.array([10.0, 1.0, 2.0]))
    assert got == pytest.approx([2.2281388520, 12.7062047362, 4.3026527297], rel=1e-9)
    tail, df = np.array([1e-3, 1e-6]), np.array([2001.0, 2001.0])
    assert outliers._t_quantile_large(tail, df) == pytest.approx(outliers._t_quantile_small(tail, df), rel=1e-10)
