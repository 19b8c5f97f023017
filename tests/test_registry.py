"""Stored models: registry, promotion in one step, ensembles as node tables."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import ml as ML
from tidemark.operators.registry import Registry, load
from tidemark.operators.scoring import raw_score
from tidemark.operators.trees import score_nodes, tree_nodes
from tidemark.sources.fixtures import training_frame
from tidemark.spec import CLOUD_GAMING
from tests.conftest import SF_SMALL

U = CLOUD_GAMING


@pytest.fixture(scope="module")
def split(spark):
    return ML.train_test_split(training_frame(spark, SF_SMALL, U))


@pytest.fixture(scope="module")
def lines(split):
    return ML.fit_all(split[0], U, ML.DEFAULT_MODELS[:2], strict=True)[0]


def test_promotion_from_stored_artifacts(spark, split, lines, tmp_dir):
    reg = Registry(spark, f"{tmp_dir}/r")
    assert reg.candidates(U.name).count() == 0 and reg.final(U.name).first() is None
    with pytest.raises(LookupError):
        reg.load_final(U.name)
    for version, run in enumerate(("a", "b"), 1):
        paths = [reg.register(U.name, run, n, m) for n, m in lines.items()]
        board = reg.evaluate(split[1], U, run)
        assert [(r.model, r["rank"]) for r in board.orderBy("rank").collect()] == [("linreg", 1), ("elasticnet", 2)]
        assert reg.promote(board, U.name, run) == version
        assert not any(reg.stored(p) for p in paths) and reg.candidates(U.name).count() == 0
    finals = reg._table("finals", "dataset string, version long, path string").collect()
    assert len(finals) == 2 and all(reg.stored(r.path) for r in finals)  # the version before stays
    got = raw_score(split[1], U, reg.load_final(U.name), out="p").join(raw_score(split[1], U, lines["linreg"], out="q").select("id", "q"), "id")
    assert got.agg(F.max(F.abs(F.col("p") - F.col("q")))).first()[0] < 1e-9


def test_a_failed_write_changes_nothing(spark, split, lines, tmp_dir):
    reg = Registry(spark, f"{tmp_dir}/r")
    reg.register(U.name, "a", "linreg", lines["linreg"])
    board = reg.evaluate(split[1], U, "a")
    reg.promote(board, U.name, "a")
    before = reg.final(U.name).first()
    reg.register(U.name, "b", "elasticnet", lines["elasticnet"])
    board = reg.evaluate(split[1], U, "b")

    def half(model, path):
        model.write().save(path)  # written, but its row never comes
        raise OSError("lost")

    with pytest.raises(OSError):
        reg.promote(board, U.name, "b", writer=half)
    assert reg.final(U.name).first() == before and reg.candidates(U.name).count() == 1
    assert reg.promote(board, U.name, "b") == 2 and reg.final(U.name).first()["model"] == "elasticnet"


def test_a_candidate_that_does_not_load_is_reported(spark, split, lines, tmp_dir):
    reg = Registry(spark, f"{tmp_dir}/r")
    reg.register(U.name, "a", "linreg", lines["linreg"])
    gone = reg.register(U.name, "a", "elasticnet", lines["elasticnet"])
    reg._fs(gone).delete(reg._path(gone), True)
    board = {r["model"]: r for r in reg.evaluate(split[1], U, "a").collect()}
    assert board["linreg"]["rank"] == 1 and board["linreg"]["error"] is None
    assert board["elasticnet"]["rmse"] is None and board["elasticnet"]["error"]
    with pytest.raises(ValueError):
        load("os.path", "x")


@pytest.mark.parametrize("name,params,combine", [("RandomForestRegressor", {"n_estimators": 5, "max_depth": 6, "min_samples_leaf": 3, "random_state": 1}, "mean"), ("GradientBoostingRegressor", {"n_estimators": 6, "learning_rate": 0.1, "max_depth": 3, "random_state": 1}, "sum")])
def test_node_table_scores_like_the_model(spark, split, tmp_dir, name, params, combine):
    fitted, _ = ML.fit_all(split[0], U, [("m", name, params)], strict=True)
    reg = Registry(spark, f"{tmp_dir}/r")
    path = reg.register(U.name, "a", "m", fitted["m"])
    nodes = tree_nodes(spark, path)
    assert nodes.select("tree").distinct().count() == (params["n_estimators"])
    assert nodes.where("(feature is null) != (left_child is null)").count() == 0
    a = score_nodes(split[1], nodes, U.features, "id", combine)
    both = a.join(raw_score(split[1], U, fitted["m"], out="p").select("id", "p"), "id")
    assert both.count() == split[1].count() and both.agg(F.max(F.abs(F.col("p") - F.col("score")))).first()[0] < 1e-9


def test_strict_fits_raise(split):
    with pytest.raises(RuntimeError, match="bad"):
        ML.fit_all(split[0], U, [ML.DEFAULT_MODELS[0], ("bad", "RandomForestRegressor", {"max_depth": 99})], strict=True)
    cached = split[0].cache()
    ML.fit_all(cached, U, [ML.DEFAULT_MODELS[0]])
    assert cached.is_cached
    cached.unpersist()


def test_a_grown_forest_is_the_configured_one(spark, split, tmp_dir):
    """Branches from several levels on; bounds of depth and leaves, bagged rows, scores by joins, registry and promotion."""
    from tidemark.operators import forest

    train, test = split
    data = ML.training_rows(train, U).cache()
    est = ML.make_model("RandomForestRegressor", {"n_estimators": 20, "max_depth": 7, "min_samples_leaf": 5, "random_state": 3})
    n = data.count()
    boards = {}
    for small in (n, 100):
        grown = forest.fit(data, est, f"{tmp_dir}/f{small}", small=small)
        nodes = grown.nodes().cache()
        assert nodes.select("tree").distinct().count() == 20
        both = score_nodes(test, nodes, U.features, "id").join(raw_score(test, U, grown, out="p").select("id", "p"), "id")
        assert both.count() == test.count() and both.agg(F.max(F.abs(F.col("p") - F.col("score")))).first()[0] < 1e-9
        boards[small] = {(r.tree, r.node): r for r in nodes.collect()}
        for tree in range(20):
            of = {k: r for (t, k), r in boards[small].items() if t == tree}
            level, reached = {0: 0}, set()
            for k in sorted(of):
                reached.add(k)
                if of[k].left_child is not None:
                    level[of[k].left_child] = level[of[k].right_child] = level[k] + 1
            assert set(level) == reached == set(of) and 1 <= max(level.values()) <= 7
    # the same bags and splits, whether a node was split by histograms or in its branch
    a, b = (sorted((r.tree, round(r.value, 9)) for r in boards[x].values() if r.feature is None) for x in boards)
    assert a == b
    own = est.fit(data)
    rmse = [ML.metrics(raw_score(test, U, m, out="p"), U.target, "p", U).first()["rmse"] for m in (own, grown)]
    assert abs(rmse[0] - rmse[1]) < 0.05 * rmse[0]
    reg = Registry(spark, f"{tmp_dir}/r")
    reg.register(U.name, "a", "forest", grown)
    assert reg.promote(reg.evaluate(test, U, "a"), U.name, "a") == 1
    final = raw_score(test, U, reg.load_final(U.name), out="q").select("id", "q").join(raw_score(test, U, grown, out="p"), "id")
    assert final.agg(F.max(F.abs(F.col("p") - F.col("q")))).first()[0] < 1e-9
    data.unpersist()


def test_a_branch_has_no_split_below_its_least_rows_or_without_gain():
    import numpy as np

    from tidemark.operators.forest import grow

    bins = np.array([[0], [0], [1], [1], [2], [2]], np.uint8)
    y, w, c = np.array([1.0, 1, 1, 1, 5, 5]), np.ones(6), np.ones(6, np.uint8)
    feature, cut, left, value = grow(bins, y, w, c, 5, 2)
    assert feature.tolist() == [0, -1, -1] and cut[0] == 1 and left[0] == 1 and value[1:].tolist() == [1, 5]
    assert grow(bins, y, w, c, 5, 3)[1][0] == 0 or len(grow(bins, y, w, c, 5, 4)[0]) == 1
    assert grow(bins, np.ones(6), w, c, 5, 1)[0].tolist() == [-1]


def test_a_branch_is_the_same_by_histograms_and_by_sorting(monkeypatch):
    import numpy as np

    from tidemark.operators import forest

    rng = np.random.default_rng(7)
    bins = rng.integers(0, 40, (6000, 4)).astype(np.uint8)
    y, w, c = rng.normal(size=6000) + bins[:, 0] / 9 + (bins[:, 1] > 20), rng.random(6000) + 0.5, rng.integers(1, 4, 6000).astype(np.uint8)
    grown = []
    for dense in (1e9, 0.5, 4.0):
        monkeypatch.setattr(forest, "DENSE", dense)
        grown.append(forest.grow(bins, y, w, c, 8, 20))
    for other in grown[1:]:
        for a, b in zip(grown[0], other, strict=True):
            assert a.shape == b.shape and np.allclose(a, b)
    assert len(grown[0][0]) > 200


def test_a_forests_bags_are_poisson_numbers():
    import math

    import numpy as np

    from tidemark.operators.forest import _bag

    c = np.concatenate([_bag(5, t, 0, 0, 50_000) for t in range(40)])
    assert c.max() < 20 and (_bag(5, 1, 0, 0, 50_000) == c[50_000:100_000]).all()
    for k in range(6):
        p = math.exp(-1) / math.factorial(k)
        assert abs((c == k).mean() - p) < 5 * math.sqrt(p / len(c))


def test_a_forests_rows_wait_in_waves(spark, split, tmp_dir, monkeypatch):
    """The rows of few trees are in the shuffle at once, and the trees are those of one wave."""
    from tidemark.operators import forest

    data = ML.training_rows(split[0], U).cache()
    n = data.count()
    est = ML.make_model("RandomForestRegressor", {"n_estimators": 12, "max_depth": 6, "min_samples_leaf": 5, "random_state": 3})
    waves, dealt = [], forest._branches
    monkeypatch.setattr(forest, "_branches", lambda blocks, tops, wave, *rest: waves.append(list(wave)) or dealt(blocks, tops, wave, *rest))
    found = {}
    for name, size in (("one", 1e12), ("few", 5 * n * 15)):
        monkeypatch.setattr(forest, "WAVE", size)
        for small in (n, 300):
            grown = forest.fit(data, est, f"{tmp_dir}/{name}{small}", small=small)
            found[name, small] = sorted((r.tree, r.feature, r.threshold, r.left, [round(v, 9) for v in r.value]) for r in grown.trees().collect())
            assert [f[0] for f in found[name, small]] == list(range(12))
    assert found["one", n] == found["few", n] and found["one", 300] == found["few", 300]
    assert waves[:2] == [list(range(12))] * 2 and len(waves) > 4 and max(map(len, waves[2:])) <= 6
    data.unpersist()


def test_deep_forests_on_many_rows_are_grown_in_branches():
    from tidemark.operators.forest import many_leaves

    deep, shallow = (ML.make_model("RandomForestRegressor", {"n_estimators": 300, "max_depth": d, "min_samples_leaf": 5}) for d in (15, 4))
    assert many_leaves(deep, 80_000) and not many_leaves(deep, 8_000) and not many_leaves(shallow, 10**9)


def test_a_grown_forest_scores_the_rows_of_one_task_in_many(spark, tmp_dir):
    from tidemark.operators import forest

    spark.createDataFrame([(t, [0, -1, -1], [5.0, 0.0, 0.0], [1, -1, -1], [0.0, float(t), 3.0]) for t in (0, 1)], forest.TREE).write.parquet(f"{tmp_dir}/f")
    rows = spark.range(0, 1_000, 1, 1).selectExpr("id", "cast(id as double) as x")
    scored = forest.GrownForest(spark, f"{tmp_dir}/f").score(rows, ["x"], "p")
    assert {r.id: r.p for r in scored.collect()} == {i: 0.5 if i <= 5 else 3.0 for i in range(1_000)}
    used = scored.select(F.spark_partition_id().alias("i")).distinct().count()
    assert used == 2 * spark.sparkContext.defaultParallelism
