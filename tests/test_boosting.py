"""The boosted grid against a plain fit of one configuration, row by row and node by node."""

import math

import numpy as np
from pyspark.ml.linalg import Vectors
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from riskloom.operators import boosting, folds, selection
from riskloom.session import pin


def plain_fit(x, y, ids, depth, subsample, columns, least, gamma, rounds, seed=2):
    """One configuration by recursion over exact row lists; margins of all rows."""
    n, p = x.shape
    margin = np.zeros(n)
    for turn in range(rounds):
        chance = 1 / (1 + np.exp(-margin))
        g, h = chance - y, chance * (1 - chance)
        rows = [i for i in range(n) if boosting.mixed(ids[i : i + 1], seed * 1009 + turn)[0] < subsample]
        lots = boosting.mixed(np.arange(p), seed * 9176 + turn)
        allowed = sorted(np.argsort(lots, kind="stable")[: max(1, int(columns * p))])

        def node(at, level):
            total_g, total_h = sum(g[i] for i in at), sum(h[i] for i in at)
            leaf = {"value": -0.3 * total_g / (total_h + 1)}
            best = None
            for j in allowed if level < depth else []:
                for cut in range(int(x[:, j].max())):
                    left = [i for i in at if x[i, j] <= cut]
                    lg, lh = sum(g[i] for i in left), sum(h[i] for i in left)
                    rg, rh = total_g - lg, total_h - lh
                    if lh < least or rh < least:
                        continue
                    gain = round(lg * lg / (lh + 1) + rg * rg / (rh + 1) - total_g**2 / (total_h + 1), 9)
                    if gain > 1e-6 and (best is None or gain > best[0]):
                        best = (gain, j, cut)
            if best is None:
                return leaf
            gain, j, cut = best
            left = node([i for i in at if x[i, j] <= cut], level + 1)
            right = node([i for i in at if x[i, j] > cut], level + 1)
            if gain < gamma and "feature" not in left and "feature" not in right:
                return leaf
            return {"feature": j, "cut": cut, "left": left, "right": right}

        tree = node(rows, 0)
        for i in range(n):
            at = tree
            while "feature" in at:
                at = at["left"] if x[i, at["feature"]] <= at["cut"] else at["right"]
            margin[i] += at["value"]
    return margin


@pytest.fixture(scope="module")
def toy():
    rng = np.random.default_rng(5)
    x = np.c_[rng.integers(0, 9, 150), rng.integers(0, 4, 150), rng.integers(0, 2, (150, 3))].astype(np.uint8)
    y = ((x[:, 0] + 2 * x[:, 2] + rng.normal(0, 1.5, 150)) > 5).astype(float)
    return x, y, rng.permutation(1000)[:150]


@pytest.mark.parametrize("depth, least, gamma", [(3, 1.0, 0.0), (6, 0.5, 0.4), (2, 3.0, 0.2)])
def test_a_configuration_is_the_plain_fit(toy, depth, least, gamma):
    x, y, ids = toy
    trees = boosting.grow(x, y, ids, x.max(axis=0).astype(int) + 1, depth, 0.8, 0.75, np.array([least]), np.array([gamma]), 8)
    want = plain_fit(x, y, ids, depth, 0.8, 0.75, least, gamma, 8)
    assert np.allclose(trees.margins(x, 1)[0], want, atol=1e-8)


def test_a_configuration_does_not_depend_on_its_group(toy):
    x, y, ids = toy
    least, gamma = np.repeat([1.0, 3.0], 3), np.tile([0.0, 0.2, 0.4], 2)
    widths = x.max(axis=0).astype(int) + 1
    together = boosting.grow(x, y, ids, widths, 5, 0.75, 0.8, least, gamma, 20).margins(x, 6)
    for i in range(6):
        alone = boosting.grow(x, y, ids, widths, 5, 0.75, 0.8, least[i : i + 1], gamma[i : i + 1], 20)
        assert np.array_equal(alone.margins(x, 1)[0], together[i])


def test_groups_hold_every_point_once():
    from riskloom.constants import BOOSTED_GRID

    groups = boosting.grid_groups(selection.grid_points(BOOSTED_GRID))
    assert len(groups) == 36 and sorted(i for _, members in groups for i in members) == list(range(540))


@pytest.fixture(scope="module")
def rows(spark):
    ids = spark.range(600).select(F.col("id").alias("application_id"))
    value = lambda s: F.pmod(F.xxhash64("application_id", F.lit(s)), F.lit(20)).cast("double")
    made = ids.withColumn("x", F.array(value(1), value(2), value(3)))
    made = made.withColumn("label", (F.col("x")[0] + F.col("x")[1] / 2 > 14).cast("double"))
    return pin(folds.with_stratified_kfold(made.select("application_id", "label", array_to_vector("x").alias("features")), k=3), "rows")


def test_grid_scores_are_those_of_separate_fits(spark, rows, monkeypatch):
    monkeypatch.setattr(boosting, "BLOCK", 70)
    grid = {"max_depth": [2, 4], "min_child_weight": [1, 3], "gamma": [0.0, 0.3], "subsample": [0.8], "colsample_bytree": [0.7]}
    sample = selection.sampled(rows, 400)
    table = {r["grid_index"]: r for r in boosting.boosted_grid(rows, sample, 3, grid, 3, 10).collect()}
    assert sorted(table) == list(range(8))
    point = selection.grid_points(grid)[5]
    everything = rows.toPandas()
    learned = {r[0] for r in sample.select("application_id").collect()}
    x = np.stack([v.toArray() for v in everything["features"]])
    inside = everything["application_id"].isin(learned).to_numpy()
    most = [np.quantile(x[inside, j], [i / boosting.BINS for i in range(1, boosting.BINS)]) for j in range(3)]
    cuts = boosting.Bins([np.array(sorted({q for q in m if q < x[inside, j].max()})) for j, m in enumerate(most)])
    bins, recalls = cuts.place(x), []
    for fold in range(3):
        train = np.flatnonzero(inside & (everything["fold"] != fold).to_numpy())
        ids = everything["application_id"].to_numpy()
        train = train[np.argsort(ids[train])]
        trees = boosting.grow(
            bins[train], everything["label"].to_numpy()[train], ids[train], cuts.widths, 4, 0.8, 0.7,
            np.array([float(point["min_child_weight"])]), np.array([point["gamma"]]), 10,
        )
        held = ((everything["fold"] == fold) & (everything["label"] == 1)).to_numpy()
        recalls.append((trees.margins(bins[held], 1)[0] > 0).mean())
    assert math.isclose(table[5]["mean_score"], np.mean(recalls)) and math.isclose(table[5]["std_score"], np.std(recalls))


def test_the_best_point_is_fitted_and_kept(spark, rows):
    grid = {"max_depth": [2, 3], "min_child_weight": [1], "gamma": [0.0], "subsample": [0.8], "colsample_bytree": [1.0]}
    table, model = selection.boosted_grid_search(rows, 3, grid, 20, 3, 500)
    assert table.count() == 2
    again = boosting.BoostedModel.from_table(model.to_table(spark))
    scored = again.transform(rows)
    right = scored.agg(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0]
    assert scored.columns == ["application_id", "label", "fold", "probability", "prediction"] and right > 0.9


def test_a_sample_keeps_several_partitions(spark):
    df = spark.range(50_000).select(F.col("id").alias("application_id")).repartition(8)
    got = selection.sampled(df, 20_000)
    assert got.count() == 20_000 and got.rdd.getNumPartitions() > 1
    assert selection.sampled(df.limit(0), 10).count() == 0 and selection.sampled(df, 60_000).count() == 50_000


def test_folds_without_positives_count_as_zero(spark):
    rng = np.random.default_rng(8)
    x = rng.integers(0, 4, (300, 2)).astype(float)
    rows = [(i, i % 3, float(i % 3 != 2 and x[i, 0] > 1), Vectors.dense(x[i])) for i in range(300)]
    df = spark.createDataFrame(rows, ["application_id", "fold", "label", "features"])
    grid = {"max_depth": [2], "min_child_weight": [1], "gamma": [0.0], "subsample": [1.0], "colsample_bytree": [1.0]}
    found = boosting.boosted_grid(df, df, 2, grid, 3, 5).collect()
    assert len(found) == 1 and 0 < found[0]["mean_score"] <= 2 / 3


def test_positives_travel_packed(spark):
    rows = spark.createDataFrame([(i, i % 2, bytes([i, 7])) for i in range(40)], "application_id bigint, fold int, bins binary")
    blocks = boosting.packed(rows, 3).collect()
    assert len({(r["fold"], r["block"]) for r in blocks}) == len(blocks) <= 6
    assert sorted(b for r in blocks for b in r["bins"][::2]) == list(range(40))
    assert all(set(r["bins"][1::2]) == {7} for r in blocks)


class Learned(Exception):
    pass


def counted(rows, *_):
    raise Learned(rows.count())


def complete(spark, sf_dir):
    from riskloom.operators import columns
    from riskloom.plans import catalog

    data = catalog.model_data(spark, sf_dir)
    return columns.design(data.train, data.features, target="label").count()


def test_the_grid_query_learns_from_all_rows(spark, sf_dir, monkeypatch):
    from riskloom.plans import catalog

    monkeypatch.setattr(boosting, "fit_groups", counted)
    with pytest.raises(Learned) as learned:
        catalog.gbt_grid(spark, sf_dir)
    assert learned.value.args[0] == complete(spark, sf_dir) > 1_000


def test_the_search_and_its_best_point_learn_from_all_rows(spark, sf_dir, monkeypatch):
    from riskloom.plans import catalog

    asked = []

    def grid(df, sample, *_):
        asked.append(sample.count())
        return spark.createDataFrame([(0, "", 0.5)], "grid_index int, params string, mean_score double")

    monkeypatch.setattr(boosting, "boosted_grid", grid)
    monkeypatch.setattr(boosting, "fit_boosted", counted)
    with pytest.raises(Learned) as learned:
        catalog.gbt_best_confusion(spark, sf_dir)
    assert [*asked, *learned.value.args] == [complete(spark, sf_dir)] * 2 and asked[0] > 1_000


def test_quantiles_are_exact_however_many_values(spark, monkeypatch):
    rng = np.random.default_rng(3)
    x = np.c_[rng.normal(0, 1, 900), rng.integers(0, 3, 900), np.full(900, 7.0), rng.integers(0, 200, 900)]
    rows = spark.createDataFrame([(v.tolist(),) for v in x], "x array<double>")
    monkeypatch.setattr(boosting, "FEW_VALUES", 100)
    cuts = boosting.Bins.of(rows, 4)
    for j, edges in enumerate(cuts.edges):
        want = np.quantile(x[:, j], [i / boosting.BINS for i in range(1, boosting.BINS)])
        assert np.allclose(edges, sorted({q for q in want if q < x[:, j].max()}))
    assert boosting.Bins.of(rows.limit(0), 4).widths.tolist() == [1, 1, 1, 1]


def test_rows_beyond_memory_grow_the_same_trees(toy, monkeypatch):
    x, y, ids = toy
    widths, least, gamma = x.max(axis=0).astype(int) + 1, np.repeat([1.0, 3.0], 3), np.tile([0.0, 0.2, 0.4], 2)
    want = boosting.grow(x, y, ids, widths, 5, 0.75, 0.8, least, gamma, 20).margins(x, 6)
    monkeypatch.setattr(boosting, "HELD_ROWS", 10)
    monkeypatch.setattr(boosting, "SPAN", 40)
    monkeypatch.setattr(boosting, "MASKED", 4)
    assert isinstance(boosting.held(11, float).base, np.memmap)
    trees = boosting.grow(x, y, ids, widths, 5, 0.75, 0.8, least, gamma, 20)
    assert np.allclose(boosting.Trees.load(trees.dump()).margins(x, 6), want, atol=1e-9)


def test_features_are_counted_together(toy):
    x, y, _ = toy
    widths = np.array([9, 4, 2, 2, 2])
    assert sorted(j for members in boosting.bundles(widths) for j in members) == list(range(5))
    assert all(np.prod(widths[members]) <= boosting.CELLS for members in boosting.bundles(widths))
    (found,) = boosting.Histograms(x, widths).of(np.array([0, -1, 1]), 2, np.arange(150) % 3, y)
    want = [[y[(np.arange(150) % 3 == node) & (x[:, j] == v)].sum() for j in range(5) for v in range(widths[j])] for node in (0, 2)]
    assert np.allclose(found, want)


def test_trees_kept_before_they_were_shared_still_score(toy):
    x, y, ids = toy
    trees = boosting.grow(x, y, ids, x.max(axis=0).astype(int) + 1, 3, 0.8, 0.75, np.array([1.0]), np.array([0.0]), 4)
    old = boosting.Trees.load(boosting.Trees(trees.feature, trees.cut, trees.left, trees.value, trees.starts).dump())
    assert old.roots is None and np.array_equal(old.margins(x, 1), trees.margins(x, 1))


def test_folds_are_read_without_their_rows(spark, tmp_path):
    path = str(tmp_path / "rows")
    rows = [(i, None if i == 7 else i % 3, float(i % 2), bytes([i, i + 1])) for i in range(30)]
    spark.createDataFrame(rows, "application_id bigint, fold int, label double, bins binary").repartition(3).write.parquet(path)
    files = sorted(spark.read.parquet(path).inputFiles())
    bins, labels, ids = boosting._outside(files, 1, 2)
    assert sorted(ids) == [i for i in range(30) if i % 3 != 1 or i == 7]
    assert (bins == np.stack([ids, ids + 1], axis=1)).all() and (labels == ids % 2).all()
    assert len(boosting._outside(files, None, 2)[0]) == 30
