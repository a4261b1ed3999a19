"""Trees, ensembles, attributions and ridge against plain versions."""

import datetime as dt
import itertools
import math
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelkit.errors import ContractError
from panelkit.operators import attribution, boosting, models, ridge, split, trees
from panelkit.operators.trees import TreeSettings

COLUMNS = ["a", "b", "c", "void"]
MONTHS = [split.shift_month(dt.date(2018, 1, 1), i) for i in range(50)]


@pytest.fixture(scope="module")
def table(spark):
    """Steps, gaps that tell something, ties, a column without values, rows without target."""
    rng = np.random.default_rng(5)
    rows = []
    for z in range(12):
        for i, m in enumerate(MONTHS):
            a, b = rng.normal(size=2)
            c = float(rng.integers(0, 4))
            gap = rng.random() < 0.2
            y = 0.3 * (a > 0.2) + 0.2 * (c >= 2) * b - 0.4 * gap + rng.normal(scale=0.05)
            rows.append((f"{z:05d}", m, float(a), None if gap else float(b), c, None, None if rng.random() < 0.05 else float(y), "train"))
    return spark.createDataFrame(
        rows, "zip string, month date, a double, b double, c double, void double, target double, split string").repartition(3)


@pytest.fixture(scope="module")
def samples(table):
    folds = [split.Fold(i + 1, MONTHS[40 + i], MONTHS[2 + i], MONTHS[37 + i]) for i in range(3)]
    return models.fold_samples(split.assign_folds(table, folds)), folds


def arrays(table):
    pdf = table.where("target IS NOT NULL").toPandas().sort_values(["zip", "month"])
    return pdf, pdf[COLUMNS].to_numpy(dtype=float, na_value=np.nan), pdf["target"].to_numpy()


def plain_tree(bins, g, rows, depth, s):
    """Best split by trying every feature, cut and side of the missing rows."""
    n, total = len(rows), g[rows].sum()
    node = {"n": n, "g": total}
    if depth == s.depth:
        return node
    best = None
    for side, f, cut in itertools.product((True, False), range(bins.shape[1]), range(1, trees.BINS - 1)):
        own = bins[rows, f]
        left = np.where(own == 0, side, own <= cut)
        nl, nr, gl = left.sum(), n - left.sum(), g[rows][left].sum()
        if nl < s.least or nr < s.least:
            continue
        worth = gl**2 / (nl + s.l2) + (total - gl) ** 2 / (nr + s.l2)
        if worth > total**2 / (n + s.l2) * (1 + 1e-9) + 1e-9 and (best is None or worth > best[0]):
            best = worth, f, cut, side, left
    if best:
        _, node["f"], node["cut"], node["side"], left = best
        node["kids"] = [plain_tree(bins, g, rows[left], depth + 1, s), plain_tree(bins, g, rows[~left], depth + 1, s)]
    return node


def same(tree, at, node):
    assert (tree.cover[at], tree.total[at]) == (node["n"], node["g"])
    assert (tree.feature[at] >= 0) == ("kids" in node)
    if "kids" in node:
        assert (tree.feature[at], tree.bin[at], tree.missing_left[at]) == (node["f"], node["cut"], node["side"])
        same(tree, tree.left[at], node["kids"][0])
        same(tree, tree.right[at], node["kids"][1])


@pytest.mark.parametrize("least,l2", [(1, 1.0), (25, 0.0)])
def test_a_tree_is_the_best_by_trying_all(table, least, l2):
    _, x, y = arrays(table)
    cuts = [np.unique(np.nanquantile(x[:, j], np.linspace(0.1, 0.9, 9), method="lower")) if j < 3 else np.zeros(0) for j in range(4)]
    bins = trees.bin_values(x, cuts)
    s = TreeSettings(depth=3, least=least, l2=l2)
    g = np.round(y * 1000)
    tree, leaf = trees.grow_tree(bins, g, None, np.arange(len(y)), s)
    same(tree, 0, plain_tree(bins, g, np.arange(len(y)), 0, s))
    assert (leaf == trees.leaves_of(bins, tree, 3)).all()
    assert np.bincount(leaf, minlength=len(tree.cover))[np.array(tree.feature) < 0].tolist() == [
        c for c, f in zip(tree.cover, tree.feature) if f < 0]


def test_limited_leaves_take_the_best_splits(table):
    _, x, y = arrays(table)
    bins = trees.bin_values(x, [np.unique(np.round(x[:, j], 1)[~np.isnan(x[:, j])])[:60] for j in range(4)])
    rows, g = np.arange(len(y)), np.round(y * 1000)
    for leaves in (1, 2, 5, 9):
        tree, _ = trees.grow_tree(bins, g, None, rows, TreeSettings(depth=6, leaves=leaves))
        assert sum(f < 0 for f in tree.feature) <= leaves
    full, _ = trees.grow_tree(bins, g, None, rows, TreeSettings(depth=1))
    two, _ = trees.grow_tree(bins, g, None, rows, TreeSettings(depth=6, leaves=2))
    assert (full.feature[0], full.bin[0]) == (two.feature[0], two.bin[0])


SETTINGS = [
    TreeSettings(rounds=4, depth=3, step=0.3),
    TreeSettings(rounds=3, depth=4, step=0.5, least=20, leaves=5, l2=0.0),
    TreeSettings(rounds=4, depth=2, step=0.3, quantile=0.9),
    TreeSettings(rounds=4, depth=2, step=0.3, quantile=0.5, least=10),
]
FOREST = [TreeSettings(rounds=5, depth=4, least=10, l2=0.0, averaged=True, share=0.4, impute=True)]


def values(df, *names):
    return sorted(tuple(r[n] for n in names) for r in df.collect())


@pytest.mark.parametrize("settings", [SETTINGS, FOREST], ids=["boosted", "forest"])
def test_both_ways_and_any_partitioning_give_the_same(samples, settings, monkeypatch):
    monkeypatch.setattr(boosting, "WRITTEN", 2)
    monkeypatch.setattr(boosting, "PARTIAL", 2)
    rows, _ = samples
    names = ("setting", "sample", "rounds", "zip", "month", "prediction")
    marks = [(2, s.rounds) for s in settings]
    grouped = values(boosting.held_out_predictions(rows, COLUMNS, settings, marks, seed=7), *names)
    levelled = values(boosting.held_out_predictions(rows.repartition(5), COLUMNS, settings, marks, seed=7, max_group=10), *names)
    assert grouped == levelled
    assert len(grouped) == len(settings) * 2 * 3 * 12
    nodes = ("setting", "tree", "node", "feature", "cut", "missing_left", "left", "right", "value", "cover")
    whole = rows.where("sample = 1 and train").drop("sample", "train")
    fits = [boosting.fit_trees(whole.repartition(n), COLUMNS, settings, 7, limit) for n, limit in ((2, None), (5, 10))]
    a, b = ([tuple(map(repr, r)) for i, m in enumerate(f) for r in values(m.nodes(rows.sparkSession, i), *nodes)] for f in fits)
    assert a == b


def test_marks_are_prefixes_of_longer_fits(samples):
    rows, _ = samples
    long, short = TreeSettings(rounds=6, depth=3, step=0.2), TreeSettings(rounds=3, depth=3, step=0.2)
    both = boosting.held_out_predictions(rows, COLUMNS, [long], [(3, 6)])
    names = ("sample", "zip", "month", "prediction")
    assert values(both.where("rounds = 3"), *names) == values(boosting.held_out_predictions(rows, COLUMNS, [short]), *names)


def test_models_predict_what_the_fit_predicted(spark, table, tmp_path):
    """Also after saving; a missing value goes where it lost less, a forest's to the median."""
    known = table.where("target IS NOT NULL")
    pdf, x, y = arrays(table)
    cuts, medians = boosting.cut_points(boosting.whole_sample(known), COLUMNS)[0]
    hashes = known.select("zip", "month", F.xxhash64("zip", "month").alias("h")).toPandas().sort_values(["zip", "month"])["h"].to_numpy()
    for s in (SETTINGS[0], FOREST[0]):
        model = boosting.fit_trees(known, COLUMNS, [s], 3)[0]
        model.save(str(tmp_path / "m"))
        scale = boosting.scale_of(boosting.whole_sample(known))
        bins = trees.bin_values(x, cuts, medians if s.impute else None)
        *_, (_, want) = trees.boost(bins, y, np.ones(len(y), dtype=bool), hashes, s, 3, scale)
        for own in (model, boosting.TreeModel.load(spark, str(tmp_path / "m"))):
            got = own.transform(known).toPandas().sort_values(["zip", "month"])["prediction"].to_numpy()
            assert np.abs(got - want).max() < 1e-12


def test_pinball_leaves_hold_their_share(table):
    """With one full step the share of rows at or below the forecast is the level."""
    known = table.where("target IS NOT NULL")
    for q in (0.1, 0.5, 0.9):
        model = boosting.fit_trees(known, COLUMNS, [TreeSettings(rounds=1, depth=2, step=1.0, least=30, quantile=q)])[0]
        below = model.transform(known).select(F.avg((F.col("target") <= F.col("prediction")).cast("double"))).first()[0]
        assert abs(below - q) < 0.03


def test_nothing_to_fit(table):
    with pytest.raises(ContractError):
        boosting.fit_trees(table.withColumn("target", F.lit(None).cast("double")), COLUMNS, [TreeSettings(rounds=1)])
    with pytest.raises(ContractError):
        ridge.fit_ridge(table.limit(0), COLUMNS, 1.0)


# --- attributions ---------------------------------------------------------------


def expectation(tree, row, known, node=0):
    """Value of a tree when only the known features are seen."""
    f = tree["feature"][node]
    if f < 0:
        return tree["value"][node]
    left, right = tree["left"][node], tree["right"][node]
    if f in known:
        to_left = tree["missing_left"][node] if np.isnan(row[f]) else row[f] <= tree["cut"][node]
        return expectation(tree, row, known, left if to_left else right)
    share = tree["cover"][left] / tree["cover"][node]
    return share * expectation(tree, row, known, left) + (1 - share) * expectation(tree, row, known, right)


def brute_shapley(model, row):
    m = len(row)
    value = {k: sum(expectation(t, row, set(k)) for t in model.trees) for r in range(m + 1) for k in itertools.combinations(range(m), r)}
    out = []
    for i in range(m):
        rest = [j for j in range(m) if j != i]
        total = 0.0
        for r in range(m):
            for k in itertools.combinations(rest, r):
                weight = math.factorial(r) * math.factorial(m - 1 - r) / math.factorial(m)
                total += weight * (value[tuple(sorted((*k, i)))] - value[k])
        out.append(total)
    return model.base + value[()], out


@pytest.mark.parametrize("s", [TreeSettings(rounds=6, depth=4, step=0.3), FOREST[0]], ids=["boosted", "forest"])
def test_contributions_are_shapley_values(table, s):
    model = boosting.fit_trees(table, COLUMNS, [s], 3)[0]
    rows = table.where(F.col("month") < F.lit(MONTHS[25])).where("zip = '00003'")
    got = {}
    for r in attribution.tree_contributions(model, rows).collect():
        got.setdefault(r.month, {"base": r.base, "prediction": r.prediction})[r.feature] = r.contribution
    for r in rows.collect():
        row = np.array([np.nan if r[c] is None else r[c] for c in COLUMNS])
        base, parts = brute_shapley(model, row)
        own = got[r.month]
        assert own["base"] == pytest.approx(base, abs=1e-12)
        assert [own[c] for c in COLUMNS] == pytest.approx(parts, abs=1e-12)
        assert own["prediction"] == pytest.approx(base + sum(parts), abs=1e-12)


# --- ridge ----------------------------------------------------------------------


def closed_form(x, y, alpha):
    filled = np.column_stack([np.where(np.isnan(c), np.sort(c[~np.isnan(c)])[(np.sum(~np.isnan(c)) - 1) // 2], c) if not np.isnan(c).all() else 0 * y for c in x.T])
    mean, sd = filled.mean(axis=0), filled.std(axis=0)
    z = (filled - mean) / np.where(sd > 0, sd, 1.0)
    beta = np.linalg.solve(z.T @ z + alpha * np.eye(x.shape[1]), z.T @ (y - y.mean())) / np.where(sd > 0, sd, 1.0)
    return beta, y.mean() - beta @ mean


def test_folds_from_monthly_matrices_equal_the_closed_form(spark, table, samples, tmp_path):
    _, folds = samples
    shifted = table.withColumn("a", F.col("a") * 1e3 + 2e5)  # large values need the centres
    fitted = ridge.fit_folds(shifted, split.assign_folds(shifted, folds), COLUMNS, folds, 2.5)
    for fold in folds:
        own = shifted.where(F.col("month").between(F.lit(fold.train_start), F.lit(fold.train_end)))
        _, x, y = arrays(own)
        beta, intercept = closed_form(x, y, 2.5)
        model = fitted[fold.fold]
        assert model.coefficients == pytest.approx(beta, rel=1e-6, abs=1e-12)
        assert model.intercept == pytest.approx(intercept, rel=1e-6)
    model.save(str(tmp_path / "r"))
    assert ridge.RidgeModel.load(spark, str(tmp_path / "r")) == model


def test_ridge_parts_add_up(table):
    model = ridge.fit_ridge(table, COLUMNS, 1.0)
    error = attribution.additivity_error(attribution.ridge_contributions(model, table)).first()
    assert error.rows == table.count() and error.max_error < 1e-12


def test_histograms_need_no_memory_that_follows_rows_and_features():
    import tracemalloc

    rng = np.random.default_rng(3)
    bins, slot = rng.integers(0, trees.BINS, (200_000, 24)).astype(np.uint8), rng.integers(-1, 3, 200_000)
    g, w = rng.integers(-1000, 1000, 200_000).astype(float), rng.integers(0, 3, 200_000).astype(float)
    tracemalloc.start()
    hist = trees.histograms(bins, slot, 3, g, w)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 12e6
    for k in range(3):
        own = slot == k
        for j in (0, 23):
            assert np.array_equal(hist[0, k, j], np.bincount(bins[own, j], g[own], trees.BINS))
            assert np.array_equal(hist[1, k, j], np.bincount(bins[own, j], w[own], trees.BINS))


def moving_together(rows=20_000):
    """Bins of a month, three features of the month, and two features of their own."""
    rng = np.random.default_rng(11)
    month = rng.integers(0, 40, rows)
    own = rng.integers(0, trees.BINS, (rows, 2))
    macro = [rng.integers(0, trees.BINS, 40)[month] for _ in range(3)]
    return np.stack([own[:, 0], *macro, own[:, 1], month], axis=1).astype(np.uint8)


@pytest.mark.parametrize("most", [1000, 2**30], ids=["packed", "apart"])
@pytest.mark.parametrize("slots", [3, 200])
def test_features_that_move_together_are_counted_once(slots, most):
    bins = np.asfortranarray(moving_together())
    bundles = trees.Bundles.of(bins)
    assert bundles.codes.shape[1] == 3 and sorted(j for m in bundles.members for j, _ in m) == list(range(6))
    rng = np.random.default_rng(2)
    slot, g = rng.integers(-1, slots, len(bins)), rng.integers(-most, most, len(bins)).astype(float)
    for w in (None, rng.integers(0, 4, len(bins)).astype(np.uint8)):
        made = trees.histograms(bins, slot, slots, g, w, None, bundles)
        assert np.array_equal(made, trees.histograms(np.ascontiguousarray(bins), slot, slots, g, w))
        for k, j in itertools.product((0, slots - 1), range(6)):
            own = slot == k
            assert np.array_equal(made[0, k, j], np.bincount(bins[own, j], g[own], trees.BINS))
            assert np.array_equal(made[1, k, j], np.bincount(bins[own, j], None if w is None else w[own], trees.BINS))


@pytest.mark.parametrize("steep", [1, 2**24, 2**26], ids=["flat", "full", "steep"])
@pytest.mark.parametrize("drawn", [False, True], ids=["once", "drawn"])
def test_two_columns_are_counted_as_one(steep, drawn):
    rng = np.random.default_rng(5)
    bins = rng.integers(0, trees.BINS, (60_000, 5)).astype(np.uint8)
    bins[:50_000, :2] = 7  # cells that are emptied before their sums get too long for a double
    bins = np.asfortranarray(bins)
    bundles = trees.Bundles.of(bins).pairs()
    assert bundles.joint.shape[1] < len(bundles.widths) == bins.shape[1]
    g = rng.choice([-steep, steep], len(bins)).astype(float)
    w = rng.integers(0, 9, len(bins)).astype(np.uint8) if drawn else None
    for rows in (np.arange(len(bins)), np.flatnonzero(rng.random(len(bins)) < 0.7), np.arange(0)):
        made = trees.joint_histogram(rows, g, w, bundles, float(steep))
        slot = np.zeros(len(rows), dtype=np.int32)
        assert np.array_equal(made, trees.histograms(bins, slot, 1, g, w, rows))


@pytest.mark.parametrize("s", [TreeSettings(rounds=3, depth=6), TreeSettings(rounds=3, depth=5, quantile=0.9), TreeSettings(rounds=3, depth=7, l2=0.0, averaged=True, share=0.4)])
def test_counting_columns_together_changes_no_tree(s, monkeypatch):
    rng = np.random.default_rng(8)
    bins = np.asfortranarray(np.column_stack([moving_together(30_000), rng.integers(0, trees.BINS, (30_000, 2))]).astype(np.uint8))
    y = bins[:, 0] / 66 + rng.normal(size=len(bins)) / 9
    train, hashes = rng.random(len(bins)) < 0.9, rng.integers(-(2**62), 2**62, len(bins))
    made = []
    for least in (500, 10**9):
        monkeypatch.setattr(trees, "JOINT_ROWS", least)
        _, *rounds = trees.boost(bins, y, train, hashes, s, 3, 4.0)
        made.append([(t.feature, t.bin, t.missing_left, t.total, t.cover, t.value.tolist(), p.tolist()) for t, p in rounds])
        for t, _ in rounds:
            assert len(t.feature) > 3
    assert made[0] == made[1]
    held = [p for _, p in trees.boost(bins, y, train, hashes, s, 3, 4.0, whole=False)][-1]
    assert np.array_equal(held[~train], np.array(made[0][-1][-1])[~train])


def test_a_gradient_that_is_no_number_gives_no_split_of_a_large_node():
    bins, g = np.asfortranarray(moving_together()), np.full(20_000, np.nan)
    tree, _ = trees.grow_tree(bins, g, None, np.arange(20_000), TreeSettings(depth=3), trees.Bundles.of(bins).pairs())
    assert tree.feature == [-1]


def test_a_gradient_that_is_no_number_gives_no_split():
    bins, g = moving_together(500), np.full(500, np.nan)
    tree, _ = trees.grow_tree(bins, g, None, np.arange(500), TreeSettings(depth=3))
    assert tree.feature == [-1]


def test_trees_of_a_forest_are_spread_over_tasks(samples, monkeypatch):
    rows, _ = samples
    names = ("setting", "sample", "rounds", "zip", "month", "target", "prediction")
    nodes = ("sample", "tree", "node", "feature", "left", "right", "value", "cover")
    made = {}
    for number in (2, 100):
        monkeypatch.setattr(boosting, "TREES", number)
        held = boosting.held_out_predictions(rows.union(rows), COLUMNS, FOREST, [(1, 3, 5)], seed=7)
        fit = boosting.fit_nodes(rows, COLUMNS, FOREST, 7)
        made[number] = values(held.where("target IS NOT NULL"), *names), values(fit, *nodes)
    assert made[2] == made[100]  # copies of rows stay rows of their own
    assert held.count() == 2 * 3 * 3 * 12
    job = boosting.Job((), tuple([SETTINGS[0], FOREST[0]]), (), {1: None, 2: None}, 1.0, 0)
    monkeypatch.setattr(boosting, "TREES", 2)
    tasks = boosting._group_tasks(job)
    assert len(tasks) == 2 + 2 * 3
    assert sorted(n for s, k, numbers in tasks if (s, k) == (1, 1) for n in numbers) == list(range(5))


def test_splits_of_a_wide_tree_need_no_memory_that_follows_its_nodes():
    import tracemalloc

    rng = np.random.default_rng(4)
    hist = rng.integers(0, 50, (2, 512, 8, trees.BINS)).astype(float)
    tracemalloc.start()
    made = trees.best_splits(hist, 1.0, 1.0)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < hist.nbytes
    one = trees.best_splits(hist[:, 300:301], 1.0, 1.0)
    assert all(one[k][0] == made[k][300] for k in made)


def test_a_fit_in_one_task_stays_within_its_memory():
    """Bytes a row of the largest sample that is fitted in one task, well below 3 GB in all."""
    import tracemalloc

    rng = np.random.default_rng(8)
    bins = np.asfortranarray(rng.integers(0, trees.BINS, (1_000_000, 25)).astype(np.uint8))
    train, hashes, y = np.ones(len(bins), dtype=bool), rng.integers(0, 2**62, len(bins)), rng.normal(size=len(bins))
    for s, bytes_a_row in ((TreeSettings(rounds=2, depth=6), 140), (replace(FOREST[0], rounds=1), 180)):
        tracemalloc.start()
        for _ in trees.boost(bins, y, train, hashes, s, 3, 4.0, whole=False):
            pass
        most = (tracemalloc.get_traced_memory()[1] + bins.nbytes + y.nbytes + hashes.nbytes + train.nbytes) / len(bins)
        tracemalloc.stop()
        assert most < bytes_a_row and most * boosting.GROUP_ROWS < 3e9


def test_samples_of_the_whole_table_are_fitted_without_a_job_per_level(samples, monkeypatch):
    """Twelve million rows, as a refit on all months of a large table has, are counted as one task's."""
    rows, _ = samples
    monkeypatch.setattr(boosting, "_by_group", lambda *a: "by group")
    monkeypatch.setattr(boosting, "_Levels", lambda *a: type("L", (), {"run": lambda self, nodes: "by level"})())
    for limit, way in ((boosting.GROUP_ROWS // 12_000_000, "by group"), (0, "by level")):
        # a row of the sample stands for 12 million
        assert boosting._fit(rows.where("sample = 1").limit(1).withColumn("train", F.lit(True)), COLUMNS, [SETTINGS[0]], [()], 7, True, limit) == way
