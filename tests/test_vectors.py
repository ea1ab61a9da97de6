import numpy as np
import pytest

from weftline.operators import centroids, kmeans, linkage, pairs

START = [[0.0, 0.0], [10.0, 10.0], [33.0, 33.0]]


def points_of(spark, table):
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(table)]
    return spark.createDataFrame(rows, "id bigint, v array<double>")


def test_kmeans_on_six_points(spark, six_points):
    found = {r["id"]: r["cluster"] for r in kmeans.assign(six_points, START).collect()}
    assert [found[i] for i in range(6)] == [0, 1, 1, 2, 1, 1]
    sizes = {r["cluster"]: r["n"] for r in kmeans.sizes(six_points, START).collect()}
    assert sizes == {0: 1, 1: 4, 2: 1}
    assert kmeans.within_variation(six_points, START).first()[0] == 896
    fitted = kmeans.fit(six_points, 3, 10, START)
    assert fitted.centres == [[0, 0], [16, 16], [33, 33]]
    assert fitted.converged and fitted.iterations == 2
    assert kmeans.within_variation(six_points, fitted.centres).first()[0] == 608
    new = kmeans.centre_table(spark, fitted.centres)
    old = kmeans.centre_table(spark, START)
    assert kmeans.between_variation(new).first()[0] == 3268
    assert kmeans.shift(old, new).first()[0] == 72
    assert kmeans.changed(old, new).first()[0] is True
    assert kmeans.changed(new, new).first()[0] is False


def test_kmeans_edges(spark, six_points):
    one = kmeans.centre_table(spark, [[1.0, 2.0]])
    assert kmeans.between_variation(one).first()[0] == 0
    far = [[0.0, 0.0], [1e6, 1e6]]
    assert kmeans.one_round(six_points, far)[1] == [1e6, 1e6]
    same = points_of(spark, [[1, 1]] * 5)
    assert {r["cluster"] for r in kmeans.assign(same, [[2, 1], [0, 1]]).collect()} == {0}
    with pytest.raises(ValueError):
        kmeans.within_variation(six_points, [])


def test_kmeans_variation_never_rises(spark):
    rng = np.random.default_rng(3)
    points = points_of(spark, rng.normal(size=(120, 3)))
    centres, last = kmeans.fit(points, 4, 1, seed=5).centres, np.inf
    for _ in range(4):
        now = kmeans.within_variation(points, centres).first()[0]
        assert now <= last + 1e-9
        centres, last = kmeans.one_round(points, centres), now
    assert kmeans.fit(points, 4, 50, seed=5, tolerance=0.5).converged


def test_distances_of_centres(spark, six_points):
    condensed = {(r.i, r.j): r.d for r in pairs.centre_distances(six_points).collect()}
    assert len(condensed) == 15 and condensed[0, 1] == pytest.approx(200**0.5)
    square = {(r.i, r.j): r.d for r in pairs.centre_square(six_points).collect()}
    assert len(square) == 36 and square[1, 0] == square[0, 1] and square[3, 3] == 0


@pytest.mark.parametrize("block_rows", [None, 7])
def test_nearest_pair(spark, block_rows):
    table = np.random.default_rng(1).normal(size=(60, 3))
    d = np.sqrt(((table[:, None] - table) ** 2).sum(-1))
    d[np.tril_indices(60)] = np.inf
    i, j = np.unravel_index(d.argmin(), d.shape)
    found = pairs.nearest_pair(points_of(spark, table), block_rows).first()
    assert (found.i, found.j) == (i, j) and found.d == pytest.approx(d.min())


def test_distant_blocks_are_left_out(spark):
    spans = spark.createDataFrame(
        [(0, 0.0, 1.0, 2.5), (1, 1.0, 2.0, 0.1), (2, 3.0, 4.0, 9.0), (3, 4.0, 6.0, 0.5), (4, 8.0, 9.0, 2.0)],
        "block int, lo double, hi double, reach double",
    )
    found = sorted((r.a, r.b) for r in pairs.within_reach(spans).collect())
    assert found == [(0, 2), (2, 0), (2, 4)]
    rng = np.random.default_rng(8)
    table = np.column_stack([rng.random(90) * 50, rng.random(90)])
    table[[3, 70]] = [[0.0, 0.5], [50.0, 0.5]]
    d = np.sqrt(((table[:, None] - table) ** 2).sum(-1))
    d[np.tril_indices(90)] = np.inf
    i, j = np.unravel_index(d.argmin(), d.shape)
    found = pairs.nearest_pair(points_of(spark, table), 4).first()
    assert (found.i, found.j) == (i, j) and found.d == pytest.approx(d.min())
    spread = np.random.default_rng(9).normal(size=(60, 6))
    d = np.sqrt(((spread[:, None] - spread) ** 2).sum(-1))
    d[np.tril_indices(60)] = np.inf
    i, j = np.unravel_index(d.argmin(), d.shape)
    found = pairs.nearest_pair(points_of(spark, spread), 4).first()
    assert (found.i, found.j) == (i, j)


def test_nearest_pair_with_copies_and_ties(spark):
    copies = points_of(spark, [[5, 5], [1, 1], [2, 2], [1, 1], [5, 5], [1, 1]])
    assert tuple(pairs.nearest_pair(copies, 2).first()) == (0, 4, 0.0)
    ties = points_of(spark, [[9], [7], [3], [1], [5]])
    assert tuple(pairs.nearest_pair(ties, 2).first()) == (0, 1, 2.0)
    assert pairs.nearest_pair(points_of(spark, [[1]])).first().d is None


SIX = {
    "single": "0 1 14.142136 2, 2 6 15.556349 3, 5 7 16.552945 4, 3 8 16.970563 5, 4 9 17.088007 6",
    "complete": "0 1 14.142136 2, 2 5 16.552945 2, 3 7 27.459060 3, 4 6 27.459060 3, 8 9 46.669048 6",
    "average": "0 1 14.142136 2, 2 5 16.552945 2, 3 7 22.214812 3, 4 6 22.589553 3, 8 9 27.599333 6",
    "centroid": "0 1 14.142136 2, 2 5 16.552945 2, 3 7 21.272047 3, 4 6 22.000000 3, 8 9 23.612614 6",
}
LINKAGES = {
    "single": linkage.single_linkage,
    "complete": linkage.complete_linkage,
    "average": linkage.average_linkage,
    "centroid": linkage.centroid_linkage,
}


def merges(df):
    rows = sorted(df.collect())
    assert [r.step for r in rows] == list(range(len(rows)))
    return [(r.left_id, r.right_id, r.height, r.size) for r in rows]


@pytest.mark.parametrize("name", SIX)
def test_linkage_of_six_points(six_points, name):
    expected = [tuple(map(float, m.split())) for m in SIX[name].split(", ")]
    got = merges(LINKAGES[name](six_points))
    assert [(a, b, round(h, 6), n) for a, b, h, n in got] == expected


def greedy(table, name):
    """One merge at a time by (distance, low id, high id), from the full matrix."""
    members = {i: [i] for i in range(len(table))}
    table = np.asarray(table, dtype=float)
    d = np.sqrt(((table[:, None] - table) ** 2).sum(-1))
    of = {
        "single": lambda x, y: d[np.ix_(x, y)].min(),
        "complete": lambda x, y: d[np.ix_(x, y)].max(),
        "average": lambda x, y: d[np.ix_(x, y)].mean(),
        "centroid": lambda x, y: np.linalg.norm(table[x].mean(0) - table[y].mean(0)),
    }[name]
    out = []
    while len(members) > 1:
        ids = sorted(members)
        h, a, b = min((of(members[a], members[b]), a, b) for a in ids for b in ids if a < b)
        new = len(table) + len(out)
        members[new] = members.pop(a) + members.pop(b)
        out.append((a, b, h, len(members[new])))
    return out


def same_merges(got, expected):
    assert [(a, b, n) for a, b, _, n in got] == [(a, b, n) for a, b, _, n in expected]
    assert [g[2] for g in got] == pytest.approx([e[2] for e in expected])


@pytest.mark.parametrize("name", ["complete", "average"])
def test_linkage_across_blocks(spark, name):
    """Blocks far smaller than the last clusters, which then are spread over several."""
    table = np.random.default_rng(4).normal(size=(26, 2))
    same_merges(merges(LINKAGES[name](points_of(spark, table), 8)), greedy(table, name))


@pytest.mark.parametrize("name", ["complete", "average"])
@pytest.mark.parametrize("whole", [1, 9, 100])
def test_last_merges_in_one_round(spark, monkeypatch, name, whole):
    """A round of jobs only while more clusters are left than one task's matrix holds."""
    table = np.random.default_rng(14).normal(size=(30, 3)).tolist()
    rounds, real = [], linkage._neighbours
    monkeypatch.setattr(linkage, "_neighbours", lambda *args: (rounds.append(1), real(*args))[1])
    got = merges(LINKAGES[name](points_of(spark, table), 8, whole))
    same_merges(got, greedy(table, name))
    assert len(rounds) == 0 if whole == 100 else len(rounds) >= 2


@pytest.mark.parametrize("name", ["complete", "average"])
def test_linkage_of_copies(spark, name):
    table = [[0, 0], [4, 1], [0, 0], [9, 9], [4, 1], [0, 0], [20, 3], [0, 0]]
    got = merges(LINKAGES[name](points_of(spark, table)))
    expected = greedy(table, name)
    assert [h for _, _, h, _ in got] == pytest.approx([h for _, _, h, _ in expected])
    assert [n for *_, n in got][-3:] == [n for *_, n in expected][-3:]


def test_single_linkage_with_copies(spark):
    table = np.random.default_rng(5).normal(size=(50, 2)).tolist()
    table += [table[7], table[7], table[20]]
    got = merges(linkage.single_linkage(points_of(spark, table), 8))
    expected = greedy(table, "single")
    # The three merges of copies tie at 0; what follows is unique but for their numbers.
    assert sorted(n for *_, n in got[:3]) == sorted(n for *_, n in expected[:3])
    assert [(h, n) for _, _, h, n in got[3:]] == [(pytest.approx(h), n) for _, _, h, n in expected[3:]]
    same_merges(merges(linkage.single_linkage(points_of(spark, table[:50]), 8)), greedy(table[:50], "single"))


def test_single_linkage_past_distant_blocks(spark):
    rng = np.random.default_rng(11)
    table = np.concatenate([rng.normal(c, 1, size=(15, 3)) for c in (0, 6, 40)])
    same_merges(merges(linkage.single_linkage(points_of(spark, table), 5)), greedy(table, "single"))


def test_linkage_of_few_points(spark):
    assert merges(linkage.single_linkage(points_of(spark, [[1]]))) == []
    assert merges(linkage.average_linkage(points_of(spark, [[1]]))) == []
    assert merges(linkage.complete_linkage(points_of(spark, [[1], [4]]))) == [(0, 1, 3.0, 2)]


def test_centroid_linkage_with_sizes_and_falling_heights(spark):
    sized = spark.createDataFrame([(0, [0.0], 3), (1, [4.0], 1), (2, [9.0], 2)], "id bigint, v array<double>, size bigint")
    assert merges(linkage.centroid_linkage(sized)) == [(0, 1, 4.0, 4), (2, 3, 8.0, 6)]
    assert merges(linkage.centroid_linkage(sized, n_clusters=2)) == [(0, 1, 4.0, 4)]
    triangle = [[0, 0], [2, 0], [1, 1.8]]
    same_merges(merges(linkage.centroid_linkage(points_of(spark, triangle))), greedy(triangle, "centroid"))


@pytest.mark.parametrize("bad", [float("nan"), float("inf"), None])
def test_points_that_are_not_finite_are_refused(spark, bad):
    rows = [(i, [float(i), 0.0]) for i in range(11)] + [(11, [bad, 1.0])]
    df = spark.createDataFrame(rows, "id bigint, v array<double>")
    for run in (pairs.nearest_pair, *LINKAGES.values(), lambda x: pairs.pairs_within(x, 1.0)):
        with pytest.raises(ValueError, match="point 11"):
            run(df).collect()


def test_pairs_within_measures_only_what_may_be_near(spark):
    """Far from the origin, with distances at the radius; what is clearly too far is not measured."""
    rng = np.random.default_rng(4)
    for origin in (0.0, 1e6):
        x = origin + np.round(rng.normal(0, 1, (600, 16)) * 64) / 64
        x[300:400] = x[:100] + np.r_[0.25, np.zeros(15)]
        order = np.argsort(x[:, 0], kind="stable")
        x = x[order]
        d = pairs.distances(x, x)
        radius = 0.25
        got = list(pairs.pairs_of_blocks(x, x, x[:, 0], x[:, 0], radius))
        found = sorted((int(i), int(j), float(z)) for i, j, z in zip(*map(np.concatenate, zip(*got))))
        expected = sorted((int(i), int(j), float(d[i, j])) for i, j in zip(*np.nonzero(d <= radius)))
        assert found == expected and len(found) >= 800
    measured = []
    real = np.sqrt
    pairs_measured = lambda a: (measured.append(a.size), real(a))[1]
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(pairs.np, "sqrt", pairs_measured)
        list(pairs.pairs_of_blocks(x, x, x[:, 0], x[:, 0], 0.25))
    assert sum(measured) < 600 * 600 / 50


@pytest.mark.parametrize("origin", [0.0, 1e6])
def test_quick_distances(origin):
    """Near copies, copies, points on a grid and very large ones, far from the origin too."""
    rng = np.random.default_rng(2)
    x = origin + rng.normal(size=(60, 16))
    x[20:30], x[30:40] = x[:10], x[:10] + 1e-5
    assert pairs.quick_distances(x, x) == pytest.approx(pairs.distances(x, x), rel=1e-9, abs=0)
    grid = origin + rng.integers(-64, 64, (60, 16)) / 16
    assert (pairs.quick_distances(grid[:20], grid) == pairs.distances(grid[:20], grid)).all()
    with np.errstate(over="ignore", invalid="ignore"):
        x[5] = 1e200
        assert (np.isinf(pairs.quick_distances(x, x)) == np.isinf(pairs.distances(x, x))).all()


def test_single_linkage_in_strips(spark, monkeypatch):
    """Ties within a point's row, and more points than a strip."""
    monkeypatch.setattr(linkage, "_STRIP", 4)
    table = [[x * 1.5, y * 1.0] for x in range(5) for y in range(4)]
    got = merges(linkage.single_linkage(points_of(spark, table), 40))
    expected = greedy(table, "single")
    assert [(h, n) for _, _, h, n in got][-1] == (pytest.approx(expected[-1][2]), 20)
    assert [h for _, _, h, _ in got] == pytest.approx([h for _, _, h, _ in expected])


@pytest.mark.parametrize("radius", [0.0, 0.4, float("inf")])
def test_pairs_within(spark, radius):
    table = np.random.default_rng(6).normal(size=(50, 2)).tolist()
    table += [table[3], table[3]]
    t = np.asarray(table)
    d = np.sqrt(((t[:, None] - t) ** 2).sum(-1))
    expected = [(i, j) for i in range(52) for j in range(i + 1, 52) if d[i, j] <= radius]
    found = sorted(tuple(r) for r in pairs.pairs_within(points_of(spark, table), radius, 7).collect())
    assert [(i, j) for i, j, _ in found] == expected
    assert [x for *_, x in found] == pytest.approx([d[i, j] for i, j in expected])


@pytest.mark.parametrize("stop", [{}, {"n_clusters": 3}, {"max_height": 17.0}, {"n_clusters": 4, "max_height": 99.0}, {"n_clusters": 6}])
def test_cluster_labels(spark, six_points, stop):
    merged = linkage.single_linkage(six_points)
    got = {r["id"]: r["cluster"] for r in linkage.cluster_labels(merged, six_points, **stop).collect()}
    groups = {i: {i} for i in range(6)}
    for a, b, height, _ in merges(merged):
        if len({frozenset(g) for g in groups.values()}) <= stop.get("n_clusters", 1) or height > stop.get("max_height", 1e9):
            break
        new = groups[a] | groups[b]
        for node in [*new, 6 + merges(merged).index((a, b, height, _))]:
            groups[node] = new
        for node in (a, b):
            groups[node] = new
        for k, g in list(groups.items()):
            if g & new:
                groups[k] = new
    assert got == {i: min(groups[i]) for i in range(6)}


def test_edges_named_range_by_range(spark):
    """Ranges of a few edges, whose clusters come from components of all shorter ones."""
    rng = np.random.default_rng(6)
    n = 60
    rows = [(int(rng.integers(0, i)), i, float(rng.integers(0, 30))) for i in range(1, n)]
    tree = spark.createDataFrame([(min(a, b), max(a, b), d) for a, b, d in rows], "lo bigint, hi bigint, d double")
    whole = merges(linkage.merges_of_tree(tree, n))
    assert merges(linkage.merges_of_tree(tree, n, range_rows=9)) == whole
    up, size, expected = list(range(n)), {i: 1 for i in range(n)}, []
    for k, (d, lo, hi) in enumerate(sorted((d, min(a, b), max(a, b)) for a, b, d in rows)):
        a, b = sorted((up[lo], up[hi]))
        size[n + k] = size[a] + size[b]
        up = [n + k if x in (a, b) else x for x in up]
        expected.append((a, b, d, size[n + k]))
    assert whole == expected


def test_centroid_rounds_with_few_clusters_in_sight(spark):
    rng = np.random.default_rng(8)
    table = np.concatenate([rng.normal(c, 0.3, size=(14, 2)) for c in (0, 4, 9)])
    got = merges(linkage.centroid_linkage(points_of(spark, table), whole=12, seeds=8, listed=6))
    same_merges(got, greedy(table, "centroid"))


def test_centroid_rounds_where_distances_hardly_differ(spark, monkeypatch):
    """One cluster takes in most points one by one, most of them out of sight; many merges a round."""
    table = np.random.default_rng(3).normal(size=(110, 24))
    table /= np.linalg.norm(table, axis=1)[:, None]
    seen, real = [], centroids.Workspace.merges

    def merging(self, *args):
        seen.append(len(self.ids))
        return real(self, *args)

    monkeypatch.setattr(centroids.Workspace, "merges", merging)
    got = merges(linkage.centroid_linkage(points_of(spark, table), whole=30, seeds=30, listed=5))
    same_merges(got, greedy(table, "centroid"))
    assert max(seen) <= 30 and len(seen) <= 12


def test_centroid_workspace_with_ties():
    """All at once, and equal distances by lowest ids, against the plain loop."""
    table = [[x, y] for x in range(5) for y in range(4)] + [[0, 0], [0, 0], [3, 3]]
    members = [{"id": i, "v": [float(c) for c in v], "size": 1} for i, v in enumerate(table)]
    work = centroids.Workspace(members, {i: float("inf") for i in range(len(table))}, float("inf"))
    got = work.merges(0, len(table), len(table) - 1)
    alive, expected = {i: (np.array(v, float), 1) for i, v in enumerate(table)}, []
    while len(alive) > 1:
        d, a, b = min((float(np.sqrt(((alive[a][0] - alive[b][0]) ** 2).sum())), a, b) for a in alive for b in alive if a < b)
        (v, p), (w, q) = alive.pop(a), alive.pop(b)
        new = len(table) + len(expected)
        alive[new] = ((v * p + w * q) / (p + q), p + q)
        expected.append((len(expected), a, b, new, d, p + q))
    assert [m[:4] for m in got] == [m[:4] for m in expected]
    assert [m[4] for m in got] == pytest.approx([m[4] for m in expected])


def test_centroid_workspace_holds_no_matrix():
    """What the driver holds grows with the clusters in sight, not with their square."""
    table = np.random.default_rng(5).normal(size=(700, 12))
    table /= np.linalg.norm(table, axis=1)[:, None]
    members = [{"id": i, "v": v.tolist(), "size": 1} for i, v in enumerate(table)]
    work = centroids.Workspace(members, dict.fromkeys(range(700), np.inf), np.inf)
    assert sum(x.nbytes for x in vars(work).values() if isinstance(x, np.ndarray)) < 700 * 12 * 8 * 5
    assert work.merges(0, 700, 699)[-1][5] == 700


@pytest.mark.parametrize("dims, k", [(3, 1), (12, 6)])
def test_nearest_of(dims, k):
    """Against all distances, in strips and tiles, with rows that are themselves on the other side."""
    rng = np.random.default_rng(dims)
    left, right = rng.normal(size=(530, dims)) + 50, rng.normal(size=(8_300, dims)) + 50
    right[:400], right[400:410] = left[:400], left[0]
    own = np.where(np.arange(530) < 400, np.arange(530), -1)
    r, c, d = pairs.nearest_of(left, right, k, own)
    all_of = pairs.distances(left, right)
    assert (d == all_of[r, c]).all() and (c != own[r]).all()
    all_of[np.arange(400), np.arange(400)] = np.inf
    assert (d.reshape(530, k) == np.sort(all_of, axis=1)[:, :k]).all()


def test_single_linkage_meets_all_points_once(spark, monkeypatch):
    """Lists tell the tree; only a family larger than a list searches again, once or twice."""
    rng = np.random.default_rng(11)
    table = np.concatenate([rng.normal(0, 0.001, size=(20, 3)), rng.normal(0, 5, size=(50, 3))])
    asked, real = [], linkage._nearest_foreign

    def searching(members, clusters, points, *args):
        asked.append(points)
        return real(members, clusters, points, *args)

    monkeypatch.setattr(linkage, "_nearest_foreign", searching)
    got = merges(linkage.single_linkage(points_of(spark, table), 30))
    same_merges(got, greedy(table, "single"))
    assert len(asked) <= 2 and sum(asked) < 70
