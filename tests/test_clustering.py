"""Clustering: FFT coreset, weighted greedy, objective -- brute force, traps, invariants."""

import itertools
import math

import brute
import numpy as np
import pytest
from conftest import SF01
from pyspark.sql import functions as F

from popcenter.functions.vectors import euclidean, nearest_udf, parse_vector
from popcenter.operators.coreset import fft_coreset
from popcenter.operators.kcenter import ball_weights, initial_radius, weighted_kcenter_outliers
from popcenter.operators.objective import kcenter_objective, nearest_center
from popcenter.operators.partitioning import assign_parts
from popcenter.plans.kcenter import (clustering_summary, coreset_kcenter_outliers, coreset_weighted,
                                     kcenter_outliers, unit_weighted)
from popcenter.sources import points2_view, points64_view, read_points


def _pts(spark, X, ids=None):
    ids = ids if ids is not None else list(range(len(X)))
    return spark.createDataFrame([(int(i), [float(v) for v in x]) for i, x in zip(ids, X)],
                                 "point_id long, x array<double>")


def _clustered(seed=7, per=40, clusters=5, outliers=4, dim=2):
    rng = np.random.default_rng(seed)
    cs = rng.uniform(-100, 100, size=(clusters, dim))
    X = np.concatenate([c + rng.normal(0, 1.0, size=(per, dim)) for c in cs]
                       + [rng.uniform(-1000, 1000, size=(outliers, dim))])
    return np.round(X, 4)


# ---------------------------------------------------------------- scalar functions

def test_parse_and_distance(spark, tmp_text):
    pts = read_points(spark, tmp_text(["1.5,2", "3,4,", "", " -1 , 0.25"]))
    xs = sorted(r.x for r in pts.collect())
    assert xs == [[-1.0, 0.25], [1.5, 2.0], [3.0, 4.0]]
    df = spark.createDataFrame([([0.1, 0.2, 0.3], [1.0, -2.0, 0.5])], "a array<double>, b array<double>")
    got = df.select(euclidean("a", "b")).first()[0]
    assert got == brute.dist([0.1, 0.2, 0.3], [1.0, -2.0, 0.5])
    assert df.select(parse_vector(F.lit("1,,2"))).first()[0] == [1.0, None, 2.0]


def test_udf_matches_builtin_distance(spark):
    pts = points64_view(spark, SF01)
    cents = [r.x for r in pts.orderBy("point_id").limit(3).collect()]
    lit = F.array(*[F.array(*[F.lit(v) for v in c]) for c in cents])
    a = pts.select("point_id", F.array_min(F.transform(lit, lambda c: euclidean(F.col("x"), c))).alias("d"))
    b = pts.select("point_id", nearest_udf([(0, np.array(cents[:2])), (2, np.array(cents[2:]))])("x")["d"].alias("d"))
    assert sorted(a.collect()) == sorted(b.collect())  # bit-identical


# ---------------------------------------------------------------- round 1

@pytest.mark.parametrize("view,m", [(points64_view, 9), (points2_view, 14)])
def test_fft_matches_brute_force(spark, view, m):
    pts = assign_parts(view(spark, SF01), 4, "mod")
    got = {}
    for r in fft_coreset(pts, m).collect():
        got.setdefault(r.part, []).append((r.pos, r.point_id, r.weight, r.rho))
    local = pts.collect()
    for part in range(4):
        P = sorted((r.point_id, r.x) for r in local if r.part == part)
        assert sorted(got[part]) == brute.fft(P, m)


def test_fft_invariants_and_traps(spark):
    # part 0: 3 distinct points among 6 (fewer than m): no padding, weights still sum up
    # part 1: a single point; parts 2..7 empty (more parts than points can fill)
    X = [[0, 0], [0, 0], [1, 0], [1, 0], [5, 5], [0, 0], [9, 9]]
    ids = [0, 8, 16, 24, 32, 40, 1]
    pts = assign_parts(_pts(spark, X, ids), 8, "mod")
    cs = fft_coreset(pts, 5).collect()
    by_part = {}
    for r in cs:
        by_part.setdefault(r.part, []).append(r)
    assert set(by_part) == {0, 1}
    assert sorted(r.point_id for r in by_part[0]) == [0, 16, 32]
    assert sum(r.weight for r in by_part[0]) == 6 and all(r.weight >= 1 for r in cs)
    assert [(r.point_id, r.weight, r.rho) for r in by_part[1]] == [(1, 1, 0.0)]


def test_fft_mixed_dimensions_rejected(spark):
    pts = assign_parts(_pts(spark, [[0.0, 1.0], [1.0, 2.0, 3.0]]), 1, "mod")
    with pytest.raises(ValueError, match="mixed dimensions"):
        fft_coreset(pts, 2)


# ---------------------------------------------------------------- round 2

@pytest.mark.parametrize("k,z,alpha", [(5, 4, 0.0), (5, 10, 0.0), (3, 2, 2.0), (7, 0, 0.5)])
def test_greedy_matches_brute_force(spark, k, z, alpha):
    X = _clustered()
    rng = np.random.default_rng(k * 31 + z)
    W = [int(w) for w in rng.integers(1, 4, size=len(X))]
    ws = spark.createDataFrame([(i, i, [float(v) for v in x], W[i]) for i, x in enumerate(X)],
                               "idx long, point_id long, x array<double>, w long")
    res = weighted_kcenter_outliers(ws, k, z, alpha)
    S, r, guesses = brute.weighted_greedy(X.tolist(), W, k, z, alpha)
    got = [row.idx for row in sorted(res.centers.collect(), key=lambda t: t.step)]
    assert got == S
    assert res.r_final == r and res.guesses == guesses
    assert res.uncovered_weight <= z and len(got) <= k


def test_greedy_on_coreset_matches_brute_force(spark):
    m = 14
    cs = fft_coreset(assign_parts(points2_view(spark, SF01), 4, "mod"), m)
    ws = coreset_weighted(cs, m)
    rows = sorted(ws.collect(), key=lambda r: r.idx)
    assert sum(r.w for r in rows) == 2000 and len(rows) <= 4 * m
    for k, z, alpha in ((10, 3, 0.0), (4, 3, 0.0), (10, 3, 2.0)):
        res = weighted_kcenter_outliers(ws, k, z, alpha)
        S, r, g = brute.weighted_greedy([t.x for t in rows], [t.w for t in rows], k, z, alpha)
        assert [t.idx for t in sorted(res.centers.collect(), key=lambda t: t.step)] == [rows[i].idx for i in S]
        assert (res.r_final, res.guesses) == (r, g)


def test_initial_radius_and_ball_weights(spark):
    X = _clustered(seed=3, per=10, clusters=3, outliers=2)
    ws = unit_weighted(_pts(spark, X))
    row = initial_radius(ws, 6).first()
    assert row["r0"] == brute.initial_radius(X.tolist(), 6) and row["head_size"] == 6
    D = brute.dist_matrix(X)
    bw = {r.idx: r.ball_weight for r in ball_weights(ws, 3.0).collect()}
    assert bw == {i: int((D[i] <= 3.0).sum()) for i in range(len(X))}


def test_duplicates_in_head_do_not_loop(spark):
    # the first k+z+1 points contain a duplicate, so r0 = 0 (trap 12)
    X = [[0, 0], [0, 0], [10, 0], [0, 10], [10, 10], [50, 50], [51, 50]]
    res = kcenter_outliers(_pts(spark, X), 2, 1, 0.0)
    assert res.r_initial == 0.0 and res.schedule[1] > 0
    S = [r.idx for r in res.centers.collect()]
    assert len(S) <= 2 and res.uncovered_weight <= 1
    # every smaller guess really fails
    for r in res.schedule[:res.guesses - 1]:
        assert brute.uncovered_after(X, [1] * len(X), 2, 1, 0.0, r) > 1
    assert brute.uncovered_after(X, [1] * len(X), 2, 1, 0.0, res.r_final) <= 1


def test_all_points_equal(spark):
    res = kcenter_outliers(_pts(spark, [[1.0, 1.0]] * 5), 2, 0, 0.0)
    assert res.r_final == 0.0 and res.guesses == 1 and res.centers.count() == 1


def test_parameter_errors(spark):
    pts = _pts(spark, [[0.0], [1.0], [2.0]])
    with pytest.raises(ValueError):
        kcenter_outliers(pts, 0, 0)
    with pytest.raises(ValueError):
        kcenter_outliers(pts, 1, -1)
    with pytest.raises(ValueError, match="max_points"):
        kcenter_outliers(pts, 1, 0, max_points=2)
    with pytest.raises(ValueError, match="smaller than the number of points"):
        clustering_summary(pts, 1, 3, 2)


# ---------------------------------------------------------------- objective

def test_objective_matches_brute_force_and_is_monotone(spark):
    X = _clustered(seed=11)
    pts = _pts(spark, X)
    centers = spark.createDataFrame([(0, [0.0, 0.0]), (1, [50.0, -20.0]), (2, [-70.0, 10.0])],
                                    "step int, x array<double>")
    C = [[0.0, 0.0], [50.0, -20.0], [-70.0, 10.0]]
    prev = math.inf
    for z in (0, 1, 5, 20):
        got = kcenter_objective(pts, centers, z).first()["objective"]
        assert got == brute.objective(X.tolist(), C, z)
        assert got <= prev
        prev = got
    near = {r.point_id: (r.nearest, r.distance) for r in nearest_center(pts, centers).collect()}
    for i, x in enumerate(X.tolist()):
        ds = [brute.dist(x, c) for c in C]
        assert near[i] == (ds.index(min(ds)), min(ds))


def test_scoring_plan_has_no_exchange_on_points(spark):
    pts = points64_view(spark, SF01)
    centers = pts.orderBy("point_id").limit(3).select(F.col("point_id").alias("step"), "x")
    plan = nearest_center(pts, centers)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "Exchange" not in plan


def test_centers_in_many_blocks(spark, monkeypatch):
    import popcenter.functions.vectors as V

    X = _clustered(seed=2, per=12)
    pts, C = _pts(spark, X), X[::3].tolist()
    centers = spark.createDataFrame([(10 * i, c) for i, c in enumerate(C)], "step int, x array<double>")
    one = sorted(nearest_center(pts, centers).collect())
    monkeypatch.setattr(V, "BLOCK_COORDS", 4)
    monkeypatch.setattr(V, "BLOCK_DISTANCES", 5)
    assert sorted(nearest_center(pts, centers).collect()) == one
    for i, nearest, d in one:
        ds = [brute.dist(X[i].tolist(), c) for c in C]
        assert (nearest, d) == (ds.index(min(ds)), min(ds))


def test_balls_settle_most_centers():
    """Many centers: far fewer distances than points x centers, and the same answers bit for bit, ties included."""
    from popcenter.functions.vectors import Balls, nearest_rows

    rng = np.random.default_rng(17)
    for dim, few in ((1, True), (2, True), (16, False)):
        C = np.round(rng.uniform(0, 1000, size=(2500, dim)), 1)
        C[2000:2100] = C[:100]  # equal centers: the first counts
        X = np.round(rng.uniform(-50, 1050, size=(4000, dim)), 1)
        X[:50] = C[1990:2040]
        X[50] = 1e200
        with np.errstate(over="ignore", invalid="ignore"):
            balls = Balls(C, 7)
            pos, d = balls.nearest(X)
            want, least = nearest_rows(X, C)
        assert (pos == want + 7).all() and (d == least).all()
        if few:
            assert balls.computed < 0.25 * len(X) * len(C)


# ---------------------------------------------------------------- guarantees on small inputs

def _opt(X, k, z):
    D = brute.dist_matrix(X)
    best = math.inf
    for S in itertools.combinations(range(len(X)), k):
        d = sorted((min(D[j, s] for s in S) for j in range(len(X))), reverse=True)
        best = min(best, d[z])
    return best


@pytest.mark.parametrize("seed", [1, 2])
def test_approximation_bounds_small(spark, seed):
    rng = np.random.default_rng(seed)
    X = np.round(rng.uniform(0, 10, size=(9, 2)), 3).tolist()
    k, z = 2, 1
    res = kcenter_outliers(_pts(spark, X), k, z, 0.0)
    obj = kcenter_objective(_pts(spark, X), res.centers, z).first()[0]
    opt = _opt(X, k, z)
    assert obj <= 3 * res.r_final + 1e-12
    assert obj < 6 * opt + 1e-12


def test_coreset_bound_and_summary(spark):
    pts = points2_view(spark, SF01)
    summary, timings = clustering_summary(pts, 10, 3, 4, 2.0, part_method="mod")
    row = summary.first()
    assert row["n"] == 2000 and row["coreset_weight"] == 2000 and row["coreset_size"] <= 56
    assert row["objective"] <= row["bound"] + 1e-9
    assert row["num_centers"] <= 10 and set(timings) >= {"round1", "round2"}
    res = coreset_kcenter_outliers(pts, 10, 3, 4, 2.0, part_method="hash")
    assert res.coreset.agg(F.sum("weight")).first()[0] == 2000


def test_selection_of_any_rank(spark, monkeypatch):
    import popcenter.operators.selection as S

    X = _clustered(seed=5, per=60).tolist() + [[0.0, 0.0]] * 30  # ties at one distance
    pts = _pts(spark, X)
    centers = spark.createDataFrame([(0, [0.0, 0.0]), (1, [50.0, -20.0])], "step int, x array<double>")
    C = [[0.0, 0.0], [50.0, -20.0]]
    monkeypatch.setattr(S, "END", 2)
    monkeypatch.setattr(S, "LIST", 3)
    for z in (0, 7, 250, len(X) - 1):
        assert kcenter_objective(pts, centers, z).first()["objective"] == brute.objective(X, C, z)
    assert kcenter_objective(pts, centers, len(X)).count() == 0
    ids = [2**62 + i * i for i in range(40)] + [-5, 2**62 + 3]
    df = spark.createDataFrame([(i,) for i in ids], "v long")
    for k in (0, 1, 20, 41):
        assert S.kth_value(df, "v", k) == sorted(ids)[k]
        assert S.kth_value(df, "v", k, largest=True) == sorted(ids)[-1 - k]
    assert S.kth_value(df, "v", 42) is None
    tiny = spark.createDataFrame([(0.0,), (5e-324,), (1.5e308,), (-1.5e308,)], "v double")
    assert [S.kth_value(tiny, "v", k) for k in range(4)] == [-1.5e308, 0.0, 5e-324, 1.5e308]


def test_selection_takes_few_scans(spark, monkeypatch):
    """Heavy tails, one value in most rows, even values: three jobs at most for any rank."""
    import popcenter.operators.selection as S

    n = 200_000
    rng = np.random.default_rng(6)
    tables = {"heavy": np.exp(rng.normal(size=n) * 12), "equal": np.where(rng.uniform(size=n) < 0.7, 5.0, rng.uniform(0, 10, n)),
              "even": np.arange(n) * 1.5, "two": rng.integers(0, 2, n).astype(float)}
    monkeypatch.setattr(S, "LIST", 300)
    tracker = spark.sparkContext.statusTracker()
    for name, values in tables.items():
        df = spark.createDataFrame([(float(v),) for v in values], "v double").repartition(4).cache()
        df.count()
        want = np.sort(values)
        for k in (0, 1500, n // 3, n - 700, n - 1):
            spark.sparkContext.setJobGroup(f"{name}{k}", "")
            assert S.kth_value(df, "v", k) == want[k] and S.kth_value(df, "v", k, largest=True) == want[n - 1 - k]
            scans = len(tracker.getJobIdsForGroup(f"{name}{k}"))
            assert scans <= 2 * 2 * 3, scans  # two calls, an aggregate being a map and a result job under AQE
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        df.unpersist()


def test_initial_radius_over_many_tiles(spark):
    X = _clustered(seed=9, per=15, clusters=4, outliers=3).tolist() + [[1.0, 1.0]] * 2
    ws = unit_weighted(_pts(spark, X))
    for m in (5, 40, len(X) + 10):
        one, many = initial_radius(ws, m).first(), initial_radius(ws, m, tile=4).first()
        assert one == many and one["r0"] == brute.initial_radius(X, m)
        assert one["head_size"] == min(m, len(X))


@pytest.mark.parametrize("strips", [1, 4])
def test_greedy_over_many_tiles(spark, strips):
    """Tiny tiles, ids in strides: the same centers, and many pairs of tiles settled by their bounds."""
    X = _clustered(seed=13, per=20, clusters=4, outliers=3)
    ids = [8 * i for i in range(len(X))]
    res = weighted_kcenter_outliers(unit_weighted(_pts(spark, X, ids)), 4, 3, 0.0, tile=9, strips=strips)
    S, r, guesses = brute.weighted_greedy(X.tolist(), [1] * len(X), 4, 3, 0.0)
    assert res.center_idx == [8 * i for i in S] and (res.r_final, res.guesses) == (r, guesses)
    assert [tuple(t.x) for t in sorted(res.centers.collect(), key=lambda t: t.step)] == [tuple(X[i]) for i in S]
    assert res.tile_pairs / 4 < res.pruned_pairs < res.tile_pairs


def test_layout_is_linear_in_the_points(spark):
    """Rows laid out: the tiles hold each point once, the units ``strips`` times, whatever the number of tiles."""
    import popcenter.operators.kcenter as K

    X = np.random.default_rng(1).uniform(0, 1000, size=(20_000, 2))
    ws = unit_weighted(_pts(spark, X)).select("idx", "x", "w")
    for tile in (256, 1024):
        layout = K.lay_out(ws, len(X), 2, tile, strips=5)
        n_tiles, rows = layout.tiles.agg(F.count("*"), F.sum("n")).first()
        copies, in_units = layout.units.agg(F.count("*"), F.sum("n")).first()
        assert rows == len(X) and n_tiles >= len(X) // tile
        assert copies == 5 * n_tiles and in_units == 5 * len(X)
        radii = sorted(r["radius"] for r in layout.tiles.collect())
        assert radii[len(radii) // 2] < 250  # neighbours, not a sample of the square
        layout.close()


def test_cover_state_is_carried(spark):
    """A bitmap per tile and guess, lowered by the newest centers alone; tiles outside or inside as a whole cost nothing."""
    import popcenter.operators.kcenter as K

    X = _clustered(seed=21, per=30, clusters=3, outliers=0)
    ws = unit_weighted(_pts(spark, X)).select("idx", "x", "w")
    layout = K.lay_out(ws, len(X), 2, 10, strips=2)
    D = brute.dist_matrix(X)

    def covered(bits):
        out = [set(), set()]
        rows = {r["tile"]: r for r in layout.tiles.collect()}
        for r in bits.collect():
            ids = np.frombuffer(rows[r["tile"]]["ids"], np.int64)
            for g, some in enumerate(K._unpack(r["bits"], 2, len(ids))):
                out[g] |= set(ids[some].tolist())
        return out

    one = K.cover(layout.tiles, None, 2, {0: (X[0], 5.0), 1: (X[0], 2.0)}).persist()
    assert covered(one) == [set(np.flatnonzero(D[0] <= 5.0)), set(np.flatnonzero(D[0] <= 2.0))]
    two = K.cover(layout.tiles, one, 2, {1: (X[40], 3.0)})
    assert covered(two) == [covered(one)[0], covered(one)[1] | set(np.flatnonzero(D[40] <= 3.0))]
    assert two.agg(F.sum("computed")).first()[0] < len(X)
    layout.close()


def _tiles(x, w, first, size):
    from popcenter.functions.vectors import block_distances
    from popcenter.operators.tiles import Tile, _by_neighbours

    out = []
    for k in range(0, len(x), size):
        rows = k + _by_neighbours(x[k:k + size])
        center = x[rows].mean(axis=0)
        out.append(Tile(first + k, rows.tobytes(), x[rows].tobytes(), w[rows].astype(float).tobytes(), center.tobytes(),
                        float(block_distances(x[rows], center[None, :]).max())))
    return out


@pytest.mark.parametrize("dim", [1, 2, 3])
def test_balls_by_leaves_are_exact(dim):
    """pairs of tiles looked at by leaves give the sums of block_distances, distances equal to the radius included."""
    import popcenter.operators.kcenter as K
    from popcenter.functions.vectors import block_distances

    rng = np.random.default_rng(dim)
    balls = {0: 0.0, 1: 0.5, 2: 5.0, 3: 30.0, 4: math.inf}
    for scale in (1, 1e6):
        x, w = np.round(rng.uniform(0, 30, (1500, dim)), 1) * scale, rng.integers(1, 5, 1500)
        own, other = _tiles(x[:700], w[:700], 0, 100), _tiles(x[700:], w[700:], 10**6, 150)
        radii = {g: r * scale for g, r in balls.items()}
        weight = lambda t, g: t.w * (np.arange(len(t.ids)) % (g + 1) != 1)
        for behind in ([], other):
            got = {(tile, g): sums for tile, g, sums, *_ in K._by_leaves(own, behind, weight, radii)}
            for t in own + behind:
                meets = own if not behind or t in behind else behind
                for g, r in radii.items():
                    assert (got[t.tile, g] == sum((block_distances(t.x, u.x) <= r) @ weight(u, g) for u in meets)).all()


@pytest.mark.parametrize("dim", [1, 2, 3])
def test_balls_by_lines_are_exact(dim):
    """strips of few lines give the sums of block_distances too, also where rounding swallows differences."""
    import popcenter.operators.kcenter as K
    from popcenter.functions.vectors import block_distances
    from popcenter.operators.tiles import lines_of

    rng = np.random.default_rng(40 + dim)
    balls = {0: 0.0, 1: 0.1, 2: 0.5, 3: 3.7, 4: 5.0, 5: 13.0, 6: 1e3, 7: math.inf}
    for scale, shift in ((1, 0), (1e6, 0), (0.1, 0), (1, 1e16), (1e-170, 0)):
        x = rng.integers(0, 7 if dim == 2 else 3, (1500, dim)).astype(float)
        x[:, dim // 2] = np.round(rng.uniform(-20, 20, 1500), 1)
        x[::9, dim // 2] += shift
        x, w = x * scale, rng.integers(1, 5, 1500)
        own, other = _tiles(x[:700], w[:700], 0, 100), _tiles(x[700:], w[700:], 10**6, 150)
        radii = {g: r * scale for g, r in balls.items()} | {8: shift}
        weight = lambda t, g: t.w * (np.arange(len(t.ids)) % (g + 1) != 1)
        for behind in ([], other):
            got = {(tile, g): sums for tile, g, sums, *_ in K._by_lines(*lines_of(own, behind), weight, radii)}
            for t in own + behind:
                meets = own if not behind or t in behind else behind
                for g, r in radii.items():
                    assert (got[t.tile, g] == sum((block_distances(t.x, u.x) <= r) @ weight(u, g) for u in meets)).all()
    spread = _tiles(rng.uniform(0, 1, (1000, 2)), np.ones(1000), 0, 100)
    assert lines_of(spread, []) is None  # a line a point
    assert lines_of(_tiles(np.array([[1e200], [2.0]]), np.ones(2), 0, 2), []) is None  # its square overflows


@pytest.mark.parametrize("dim", [1, 2])
def test_a_unit_of_few_lines_computes_no_distances(dim, monkeypatch):
    """a unit takes time near its number of points, not its pairs."""
    import time

    import popcenter.operators.kcenter as K
    import pyarrow as pa

    n = 60_000
    rng = np.random.default_rng(6)
    x = np.sort(np.round(rng.uniform(0, 10_000, n), 3))[:, None]
    if dim == 2:
        x = np.concatenate([rng.integers(0, 40, (n, 1)).astype(float), x], axis=1)
    rows = _tiles(x, np.ones(n, int), 0, 500)
    tiles = pa.table({"tile": [t.tile for t in rows], "held": [True] * len(rows), "ids": [t.ids.tobytes() for t in rows],
                      "x": [t.x.tobytes() for t in rows], "w": [t.w.tobytes() for t in rows],
                      "center": [t.center.tobytes() for t in rows], "radius": [t.radius for t in rows]})
    monkeypatch.setattr(K, "_by_leaves", None)
    monkeypatch.setattr(K, "_by_tiles", None)
    began = time.process_time()
    K._partial_sums(4, {g: 300.0 * 2 ** g for g in range(4)}, False)(None, tiles, pa.table({}))
    assert time.process_time() - began < 30


def test_later_steps_take_off_what_became_covered(spark):
    """after the first step only newly covered points are looked at; the totals are those of a new count."""
    import popcenter.operators.kcenter as K

    X = np.round(np.random.default_rng(8).uniform(0, 60, size=(900, 2)), 1)
    layout = K.lay_out(unit_weighted(_pts(spark, X)).select("idx", "x", "w"), len(X), 2, 40, strips=3)
    balls, newest = {0: 3.0, 1: 9.0}, {0: (X[5], 4.0), 1: (X[700], 20.0)}
    first = K.scored(layout, None, 2, balls).persist()
    one = K.cover(layout.tiles, None, 2, newest).persist()
    later, anew = K.scored(layout, one, 2, balls, totals=first), K.scored(layout, one, 2, balls)
    found = lambda df: sorted((r["g"], r["tile"], r["idx"], r["val"], r["base"], r["sums"]) for r in df.collect())
    assert found(later) == found(anew)
    again = K.cover(layout.tiles, one, 2, newest)
    assert again.where("fresh is not null").count() == 0
    assert K.scored(layout, again, 2, balls, totals=later).agg(F.sum("pairs")).first()[0] == 0
    layout.close()


def test_memory_of_a_unit():
    """a task holds the weights and sums of one guess; what it sends takes a few bytes a point and guess."""
    import tracemalloc

    import popcenter.operators.kcenter as K
    import pyarrow as pa

    n, guesses = 40_000, 16
    x = np.sort(np.random.default_rng(3).uniform(0, 10_000, n))[:, None]
    rows = _tiles(x, np.ones(n, int), 0, 500)
    columns = {"tile": [t.tile for t in rows], "held": [True] * len(rows), "ids": [t.ids.tobytes() for t in rows],
               "x": [t.x.tobytes() for t in rows], "w": [t.w.tobytes() for t in rows],
               "center": [t.center.tobytes() for t in rows], "radius": [t.radius for t in rows]}
    tiles, none = pa.table(columns), pa.table({})
    run = K._partial_sums(guesses, {g: 2.0 ** (g - 3) for g in range(guesses)}, False)
    tracemalloc.start()
    out = run(None, tiles, none)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(len(s) for s in out.column("sums").to_pylist()) <= 2 * n * guesses
    assert peak < 240 * n, peak / n


def test_nearness_is_exact():
    from popcenter.functions.vectors import Nearness, block_distances

    rng = np.random.default_rng(4)
    for dim, scale in ((1, 1.0), (2, 1e6), (64, 1.0), (3, 1e200), (2, 1e-170)):
        a, b = rng.normal(size=(60, dim)) * scale, rng.normal(size=(50, dim)) * scale
        b[:20] = a[:20]
        with np.errstate(over="ignore"):
            d = block_distances(a, b)
            for radius in (0.0, np.quantile(d, 0.01), np.quantile(d, 0.5), d.max(), np.nextafter(d[0, 1], 0)):
                assert (Nearness(a, b).within(radius) == (d <= radius)).all()
            least, positive = Nearness(a, b).least(np.inf, np.inf)
        assert least == d.min() and positive == np.where(d > 0, d, np.inf).min()
        with np.errstate(over="ignore"):
            own = block_distances(a, a)[np.triu_indices(60, 1)]
            assert Nearness(a, a).least(np.inf, np.inf, apart=True)[0] == own.min()


def test_closest_pair_of_a_long_head(spark):
    """100,000 points: few blocks of distances, the result of a sorted sweep."""
    from popcenter.operators.kcenter import closest_pair

    rng = np.random.default_rng(8)
    X = np.round(rng.uniform(0, 1e6, size=(100_000, 2)), 3)
    X[70_000] = X[5]  # one pair coincides: least 0, least positive by the sweep
    order = np.argsort(X[:, 0], kind="stable")
    S, best = X[order], np.inf
    for lag in range(1, 60):
        d = np.sqrt(((S[lag:] - S[:-lag]) ** 2).sum(axis=1))
        best = min(best, d[d > 0].min())
    assert (S[60:, 0] - S[:-60, 0]).min() > best  # no pair further apart in the order can be nearer
    ws = spark.createDataFrame([(i, x.tolist(), 1) for i, x in enumerate(X)], "idx long, x array<double>, w long")
    d, dpos, blocks = closest_pair(ws, len(X), 2)
    assert d == 0 and abs(dpos - best) <= 1e-9 * best
    assert blocks < 3000  # of about 19,000 pairs of tiles


def test_greedy_alpha2_takes_several_centers_and_guesses(spark):
    X = [[float(v)] for v in np.round(np.random.default_rng(5).uniform(-999, 9999, 300), 2)]
    res = kcenter_outliers(_pts(spark, X), 3, 60, 2.0)
    S, r, g = brute.weighted_greedy(X, [1] * len(X), 3, 60, 2.0)
    assert res.center_idx == S and (res.r_final, res.guesses) == (r, g)
    assert len(S) >= 2 and g >= 2


def test_fft_takes_few_passes(spark):
    from popcenter.operators.coreset import fft_traversal

    rng = np.random.default_rng(3)
    X = np.round(rng.normal(size=(4000, 2)) * 100, 3)
    pts = assign_parts(_pts(spark, X), 2, "mod").repartition(6)
    m = 64
    out = fft_traversal(pts, m)
    assert out.passes <= m // 3
    tight = fft_traversal(pts, 9, candidates=1)  # one center a pass at most
    got, few = {}, {}
    for r in out.coreset.collect():
        got.setdefault(r.part, []).append((r.pos, r.point_id, r.weight, r.rho))
    for r in tight.coreset.collect():
        few.setdefault(r.part, []).append((r.pos, r.point_id, r.weight, r.rho))
    for part in range(2):
        P = [(i, X[i].tolist()) for i in range(len(X)) if i % 2 == part]
        assert sorted(got[part]) == brute.fft(P, m)
        assert sorted(few[part]) == brute.fft(P, 9)


def test_malformed_points_raise(spark):
    """What a positional parser rejects never changes a result silently."""
    bad = spark.createDataFrame([(0, [0.0, 0.0]), (1, [1.0, 0.0]), (2, [5.0, 5.0]), (3, [9.0, 9.0]), (4, [3.0, None])],
                                "point_id long, x array<double>")
    mixed = _pts(spark, [[0.0, 0.0], [1.0, 0.0, 2.0], [4.0, 4.0]])
    good = _pts(spark, [[0.0, 0.0], [1.0, 0.0], [4.0, 4.0], [9.0, 9.0]])
    centers = spark.createDataFrame([(0, [0.0, 0.0])], "step int, x array<double>")
    wide = spark.createDataFrame([(0, [0.0, 0.0, 100.0])], "step int, x array<double>")
    for call in (lambda p, c: nearest_center(p, c), lambda p, c: kcenter_objective(p, c, 1)):
        with pytest.raises(ValueError, match="malformed"):
            call(bad, centers)
        with pytest.raises(ValueError, match="mixed"):
            call(mixed, centers)
        with pytest.raises(ValueError, match="dimension"):
            call(good, wide)
        with pytest.raises(ValueError, match="no centers"):
            call(good, centers.limit(0))
    for z in (0, 1):
        with pytest.raises(ValueError, match="malformed"):
            kcenter_outliers(bad, 1, z)
    with pytest.raises(ValueError, match="malformed"):
        fft_coreset(assign_parts(bad, 2), 2)
    with pytest.raises(ValueError, match="mixed"):
        kcenter_outliers(mixed, 1, 0)
    for z in (4, 7):
        with pytest.raises(ValueError, match="smaller"):
            kcenter_outliers(good, 1, z)
        with pytest.raises(ValueError, match="smaller"):
            coreset_kcenter_outliers(good, 1, z, 2)
    with pytest.raises(ValueError, match="duplicate"):
        kcenter_outliers(_pts(spark, [[0.0], [1.0], [5.0]], [1, 2, 2]), 2, 0)


def test_greedy_step_moves_no_vectors(spark):
    import popcenter.operators.kcenter as K

    layout = K.lay_out(unit_weighted(points64_view(spark, SF01)).select("idx", "x", "w"), 1000, 64, 100, strips=3)
    layout.units.count(), layout.tiles.count()
    bits = K.cover(layout.tiles, None, 1, {0: (np.zeros(64), 0.5)}).persist()
    bits.count()
    def exchanges(node):  # a cached table is a leaf
        below = [x for i in range(node.children().size()) for x in exchanges(node.children().apply(i))]
        return below + ([node.simpleString(200)] if "Exchange" in node.nodeName() else [])

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        moved = exchanges(K.scored(layout, bits, 1, {0: 1.0})._jdf.queryExecution().executedPlan())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # the bitmaps go to their units and the partial sums to their tiles; tiles and units are read where they lie
    assert len(moved) == 2 and "hashpartitioning(unit" in moved[0] and "hashpartitioning(tile" in moved[1], moved
    layout.close()


def _folder_bytes(path):
    import os

    path = path.removeprefix("file:")
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(path) for f in files if f.endswith(".parquet"))


def test_fft_state_is_narrow_and_superseded_states_go(spark, monkeypatch):
    """Bytes written per pass do not depend on the dimension, two states exist at most, nothing is left behind,
    and neither points nor state are exchanged."""
    import os

    import popcenter.operators.coreset as C
    from popcenter.session import ensure_checkpoint_dir

    root = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(root))
    written, alive, plans = {}, [], []

    class Watched(C.BucketedTable):
        def __init__(self, df, key, buckets):
            if "d" in df.columns:
                plans.append(df._jdf.queryExecution().executedPlan().toString())
            super().__init__(df, key, buckets)
            if "d" in df.columns:
                alive.append(sum(1 for f in os.listdir(root) if f.startswith("table-")))
                written.setdefault(dim, []).append(_folder_bytes(self.path))

    monkeypatch.setattr(C, "BucketedTable", Watched)
    monkeypatch.setattr(C, "PENDING", 1)
    rng = np.random.default_rng(3)
    for dim in (2, 32):
        X = rng.normal(size=(6000, dim))
        passes = C.fft_traversal(assign_parts(_pts(spark, X), 2, "mod").repartition(4), 16, tile=500, tile_top=2, candidates=4).passes
        assert passes > len(written[dim]) > 1
    assert max(alive) <= 3  # the points, the last state and the new one
    assert max(written[32]) < 1.2 * max(written[2]) and max(written[32]) < 6000 * 40
    for plan in plans[1:2]:  # the second pass: points and state, bucketed alike
        assert "Exchange" not in plan and plan.count("Bucketed: true") == 2
    left = {f for f in set(os.listdir(root)) - before if f.startswith(("table-", "centers-"))}
    assert not left


@pytest.mark.parametrize("block", [1 << 20, 7])
def test_fft_centers_travel_in_blocks(spark, monkeypatch, block):
    import popcenter.operators.coreset as C

    monkeypatch.setattr(C, "BLOCK_COORDS", block)
    X = _clustered(seed=31, per=60, clusters=4, outliers=5)
    got = {}
    for r in C.fft_traversal(assign_parts(_pts(spark, X), 3, "mod"), 20, candidates=9, tile=16, tile_top=4).coreset.collect():
        got.setdefault(r.part, []).append((r.pos, r.point_id, r.weight, r.rho))
    for part in range(3):
        assert sorted(got[part]) == brute.fft([(i, x) for i, x in enumerate(X.tolist()) if i % 3 == part], 20)


def test_fft_candidates_are_cut_before_the_shuffle(spark):
    """Of each part a task hands on ``top`` candidates, merged in two levels where there are many buckets."""
    import popcenter.operators.coreset as C
    from popcenter.session import BucketedTable

    rng = np.random.default_rng(12)
    X = np.round(rng.normal(size=(3000, 3)), 6)
    pts = assign_parts(_pts(spark, X), 2, "mod")
    packed = pts.select("part", "point_id", "x").repartition(5).sortWithinPartitions("part", "point_id").mapInArrow(C._packer(64), "part int, tile long, ids binary, x binary")
    tiles = BucketedTable(packed.repartition(90, "tile"), "tile", 90)
    far = {}
    state = tiles.df.groupBy("tile").applyInArrow(
        lambda key, t: C._applier([])(key, t, t.slice(0, 0)), C._STATE)
    D = np.linalg.norm(X, axis=1)

    def at_origin(key, t, s):
        import pyarrow as pa
        part, tile, ids, x = C._points_in(t)
        d = np.linalg.norm(x, axis=1)
        return pa.table({"part": pa.array([part], pa.int32()), "tile": pa.array([tile]), "d": pa.array([d.tobytes()], pa.binary()),
                         "pos": pa.array([np.zeros(len(ids), np.int32).tobytes()], pa.binary()), "chosen": pa.array([1], pa.int32())})

    state = tiles.df.groupBy("tile").cogroup(state.groupBy("tile")).applyInArrow(at_origin, C._STATE)
    for r in C._candidates(tiles.df, state, 9, 7, 7, 90, []).collect():
        far.setdefault(r["part"], []).append((r["d"], r["point_id"], r["bound"]))
    for part, rows in far.items():
        want = sorted(((D[i], i) for i in range(part, len(X), 2)), reverse=True)
        best = sorted(rows, reverse=True)[:7]
        assert [i for _, i, _ in best] == [i for _, i in want[:7]]
        assert len(rows) <= 9 * 7 and all(b >= 0 for _, _, b in rows)
    tiles.drop()
