import numpy as np
import pytest
from helpers import at, rows
from pyspark.sql import functions as F

from gridops.ml import boosting
from gridops.ml import labels as lab
from gridops.ml import models as m
from gridops.schema import FEATURES


@pytest.fixture(scope="module")
def labelled(spark):
    """Risk depends on two of the features, so each learner can find it."""
    x = F.rand(7) * 10
    base = spark.range(1200).select(
        (F.col("id") % 20 + 1).cast("int").alias("grid_id"),
        (F.lit(at(0)).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.col("id").cast("int"))).alias("feature_timestamp"),
        x.alias("avg_activity"),
        F.randn(8).alias("activity_growth"),
        (F.col("id") % 25).alias("active_hours"),
        (F.rand(9) * 3).alias("peak_ratio"),
        F.rand(10).alias("variability"),
        F.rand(11).alias("internet_share"),
    )
    return base.withColumn("target", (F.col("avg_activity") + F.col("activity_growth") > 6).cast("int")).cache()


@pytest.fixture(scope="module")
def tree(labelled):
    return m.train_tree(lab.split_chronological(labelled)[0])


def accuracy(model, df):
    return m.binary_metrics(m.predict(model, df)).first().accuracy


def test_learners_find_the_signal(labelled, tree):
    train, test = lab.split_chronological(labelled)
    assert accuracy(tree, test) > 0.85
    assert accuracy(m.train_logistic(train), test) > 0.93
    boosted = m.train_boosted(lab.with_class_weight(train), rounds=20)
    assert accuracy(boosted, test) > 0.85


def test_rankings(spark, labelled, tree):
    linear = m.train_logistic(labelled)
    ranked = m.coefficient_ranking(spark, linear).collect()
    assert {ranked[0].feature, ranked[1].feature} == {"avg_activity", "activity_growth"}
    assert m.feature_importance(spark, tree).first().feature == "avg_activity"
    assert m.contributing_features(tree)[0] == "avg_activity" and len(m.contributing_features(tree)) <= 3


def test_save_and_load(spark, labelled, tree, fresh):
    path = str(fresh / "model")
    m.save_model(tree, path)
    again = m.load_model(spark, path)
    a, b = (rows(m.score_probability(x, labelled), "feature_timestamp", "risk_score") for x in (tree, again))
    assert a == b
    with pytest.raises(FileNotFoundError):
        m.load_model(spark, str(fresh / "absent"))


def test_class_never_seen_scores_zero(labelled):
    quiet = m.train_tree(labelled.withColumn("target", F.lit(0)))
    assert m.score_probability(quiet, labelled).agg(F.max("risk_score")).first()[0] == 0.0


def test_risk_scores(labelled, tree):
    scored = m.risk_scores(tree, labelled, None)
    assert scored.columns == [
        "grid_id", "timestamp", "risk_score", "risk_level", "model_version", "anomaly_score", "anomaly_flag", "direction", "reason",
    ]
    assert scored.count() == 1200 and scored.where("risk_level = 'high' AND risk_score < 0.7").isEmpty()
    with pytest.raises(ValueError, match="variability"):
        m.risk_scores(tree, labelled.drop("variability"), None)


def test_predict_risk_keeps_refused_rows(labelled, tree):
    broken = labelled.limit(5).withColumn("internet_share", F.when(F.col("grid_id") == 1, 1.5).otherwise(0.5))
    got = m.predict_risk(tree, broken)
    assert got.count() == 5
    bad = got.where("grid_id = 1").first()
    assert (bad.risk_score, bad.risk_level, bad.violations) == (None, None, ["internet_share"])
    assert got.where("grid_id = 2").first().contributing_features == m.contributing_features(tree)


def test_metrics_with_nothing_predicted(spark):
    df = spark.createDataFrame([(1, 0), (0, 0)], "target int, prediction int")
    assert tuple(m.binary_metrics(df).first()) == (0.5, 0.0, 0.0, 0.0, 0.5)
    assert rows(m.confusion_matrix(df), "target", "predicted_0", "predicted_1") == [(0, 1, 0), (1, 1, 0)]
    assert tuple(m.binary_metrics(df.limit(0)).first()) == (0.0, 0.0, 0.0, 0.0, 0.0)


def test_model_comparison(spark):
    df = spark.createDataFrame([(1, 1), (0, 0)], "target int, prediction int")
    got = m.model_comparison({"a": m.binary_metrics(df), "b": m.binary_metrics(df.withColumn("prediction", F.lit(0)))})
    assert rows(got.where("metric = 'recall'"), "a", "b") == [(1.0, 0.0)]
    assert got.count() == 5


def test_scores_equal_the_saved_model_evaluated_in_sql(spark, labelled, tree, fresh):
    """The second route: DuckDB walks the saved tree, and computes the logistic formula from the saved coefficients."""
    import duckdb

    con = duckdb.connect()
    data = str(fresh / "rows")
    labelled.select("feature_timestamp", *FEATURES).withColumn("feature_timestamp", F.col("feature_timestamp").cast("string")).write.parquet(data)
    con.execute(f"CREATE VIEW rows AS SELECT *, [{', '.join(f'{c}::DOUBLE' for c in FEATURES)}] AS x FROM read_parquet('{data}/*.parquet')")
    told = lambda model: {str(r.feature_timestamp): r.risk_score for r in m.score_probability(model, labelled).collect()}

    path = str(fresh / "tree")
    m.save_model(tree, path)
    con.execute(f"CREATE VIEW nodes AS SELECT * FROM read_parquet('{path}/stages/1_*/data/**/*.parquet')")
    walked = con.execute(
        """WITH RECURSIVE w AS (
             SELECT feature_timestamp, x, 0 AS id FROM rows
             UNION ALL
             SELECT feature_timestamp, x, CASE WHEN x[n.split.featureIndex + 1] <= n.split.leftCategoriesOrThreshold[1] THEN n.leftChild ELSE n.rightChild END
             FROM w JOIN nodes n ON w.id = n.id WHERE n.leftChild >= 0)
           SELECT feature_timestamp, n.impurityStats[2] / (n.impurityStats[1] + n.impurityStats[2]) FROM w JOIN nodes n ON w.id = n.id WHERE n.leftChild < 0"""
    ).fetchall()
    want = told(tree)
    assert len(walked) == len(want) == 1200 and all(abs(want[str(k)] - v) < 1e-12 for k, v in walked)

    linear = m.train_logistic(labelled)
    saved = m.coefficient_ranking(spark, linear).toPandas()
    weight = dict(zip(saved["feature"], saved["coefficient"], strict=True))
    formula = " + ".join(f"({weight[c]!r}) * {c}" for c in FEATURES)
    rows_ = con.execute(f"SELECT feature_timestamp, 1 / (1 + exp(-({linear.stages[-1].intercept!r} + {formula}))) FROM rows").fetchall()
    want = told(linear)
    assert len(rows_) == 1200 and all(abs(want[str(k)] - v) < 1e-9 for k, v in rows_)


def test_boosted_trees_keep_their_limits(spark, labelled, fresh):
    rows_ = lab.with_class_weight(labelled)
    settings = boosting.Settings(rounds=12, leaves=5, depth=4, leaf_rows=30, rate=0.2)
    model = boosting.boost(rows_, FEATURES, settings=settings, block=5)
    nodes = model.nodes(spark)
    per_tree = nodes.groupBy("tree").agg(F.count_if(F.col("feature").isNull()).alias("leaves"), F.max("level").alias("level"), F.min("rows").alias("rows")).collect()
    assert len(per_tree) == 12 and all(r.leaves <= 5 and r.level <= 4 and r.rows >= 30 for r in per_tree)
    # However the rows are dealt out and however often they are written, the model is the same.
    again = boosting.boost(rows_.repartition(7), FEATURES, settings=settings, block=3)
    assert [t.feature for t in again.trees] == [t.feature for t in model.trees] and [t.rows for t in again.trees] == [t.rows for t in model.trees]
    path = str(fresh / "boosted")
    m.save_model(model, path, spark)
    loaded = m.load_model(spark, path)
    assert loaded == model and rows(m.score_probability(loaded, labelled), "risk_score") == rows(m.score_probability(model, labelled), "risk_score")
    assert m.feature_importance(spark, model).first().feature in ("avg_activity", "activity_growth")
    assert abs(sum(model.importances()) - 1) < 1e-9 and accuracy(model, labelled) > 0.9


def test_boosted_trees_of_one_job_equal_those_of_a_job_a_level(spark, labelled, monkeypatch):
    rows_ = lab.with_class_weight(labelled)
    settings = boosting.Settings(rounds=8, leaves=9, depth=5, leaf_rows=10, rate=0.3, bins=24)
    spark.sparkContext.setJobGroup("boosting", "one job for all trees")
    try:
        at_once = boosting.boost(rows_, FEATURES, settings=settings)
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("boosting"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs < 12  # a job a level makes 30 at least
    monkeypatch.setattr(boosting, "ROWS_PER_TASK", 500)  # three tasks
    assert boosting.boost(rows_, FEATURES, settings=settings, block=3) == at_once
    assert len(at_once.trees) == 8 and max(len(t.feature) for t in at_once.trees) > 5


def plain_boost(rows_, s, borders, start):
    """Leaf-wise trees one leaf at a time, all sums over the rows themselves."""
    x = np.array([[np.searchsorted(b, v) for b, v in zip(borders, r[:-3], strict=True)] for r in rows_])
    y, w, key = (np.array([r[k] for r in rows_], float) for k in (-3, -2, -1))
    raw, out = np.full(len(y), start), []
    worth = lambda g, h: max(abs(g) - s.l1, 0) ** 2 / (h + s.l2)
    for t in range(s.rounds):
        factor = boosting.DRAW * (2 * t + 1) % boosting.DRAWS
        mine = key.astype(np.int64) % boosting.DRAWS * factor % boosting.DRAWS // 65_536 % 100 < round(s.row_share * 100)
        p = 1 / (1 + np.exp(-raw))
        g, h = (np.rint(v * boosting.UNIT) / boosting.UNIT for v in (w * (p - y), w * p * (1 - p)))
        leaves, columns = {"": np.ones(len(y), bool)}, boosting.sampled_columns(FEATURES, t, s)
        splits = []

        def best(rows__, columns=columns, g=g, h=h, mine=mine):
            found, use = (1e-9, None), rows__ & mine
            for f in columns:
                for cut in range(s.bins):
                    left, right = use & (x[:, f] <= cut), use & (x[:, f] > cut)
                    if min(left.sum(), right.sum()) >= s.leaf_rows:
                        gain = worth(g[left].sum(), h[left].sum()) + worth(g[right].sum(), h[right].sum()) - worth(g[use].sum(), h[use].sum())
                        if gain > found[0] + 1e-12:
                            found = (gain, (f, cut))
            return found

        while len(leaves) < s.leaves:
            gain, split, path = max(((*best(r), k) for k, r in leaves.items() if len(k) < s.depth), key=lambda c: c[0], default=(0, None, ""))
            if split is None:
                break
            f, cut = split
            r = leaves.pop(path)
            leaves |= {path + "L": r & (x[:, f] <= cut), path + "R": r & (x[:, f] > cut)}
            splits.append((path, f, cut))
        for r in leaves.values():
            use = r & mine
            raw[r] += -np.sign(g[use].sum()) * max(abs(g[use].sum()) - s.l1, 0) / (h[use].sum() + s.l2) * s.rate
        out.append(sorted(splits))
    return out, 1 / (1 + np.exp(-raw))


def test_boosted_trees_equal_a_plain_leaf_by_leaf_search(labelled):
    settings = boosting.Settings(rounds=3, leaves=6, depth=4, leaf_rows=20, rate=0.3, bins=12)
    small = lab.with_class_weight(labelled.where("minute(feature_timestamp) < 8").withColumn("key", F.xxhash64("feature_timestamp")))
    model = boosting.boost(small, FEATURES, key=F.col("key"), settings=settings)
    data = [tuple(float(v) if i < 8 else int(v) for i, v in enumerate(r)) for r in small.select(*FEATURES, "target", "weight", "key").collect()]
    data = [(*r[:-1], r[-1] % boosting.DRAWS) for r in data]
    want, scores = plain_boost(data, settings, model.borders, model.start)

    def paths(tree):
        names, found = {0: ""}, []
        for node, f in enumerate(tree.feature):
            if f >= 0:
                found.append((names[node], f, tree.cut[node]))
                names |= {tree.left[node]: names[node] + "L", tree.left[node] + 1: names[node] + "R"}
        return sorted(found)

    assert [paths(t) for t in model.trees] == want and all(want)
    got = [r.risk_score for r in m.score_probability(model, small).select("risk_score").collect()]
    assert np.allclose(sorted(got), sorted(scores.tolist()))


def test_boosting_without_a_second_class(spark, labelled):
    for target in (0, 1):
        one = labelled.withColumns({"target": F.lit(target), "weight": F.lit(1.0)})
        assert m.score_probability(m.train_boosted(one, rounds=3), labelled).agg(F.max("risk_score"), F.min("risk_score")).first() == (target, target)
    assert m.score_probability(m.train_boosted(one.limit(0), rounds=3), labelled).count() == 1200


def test_boosting_beyond_half_a_million_rows_is_not_a_job_a_level(spark):
    rows_ = spark.range(600_000).select(*((F.xxhash64("id", F.lit(i)) % 1000 / 10).alias(c) for i, c in enumerate(FEATURES)), F.lit(1.0).alias("weight"), "id")
    rows_ = rows_.withColumn("target", (F.col(FEATURES[0]) + F.col(FEATURES[1]) > 0).cast("int"))
    settings = boosting.Settings(rounds=6, leaves=6, depth=4, rate=0.3, bins=8)
    spark.sparkContext.setJobGroup("many", "one job for all trees")
    try:
        model = boosting.boost(rows_, FEATURES, key=F.col("id"), settings=settings)
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("many"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs < 12  # a job a level makes 24 at least
    assert len(model.trees) == 6 and abs(model.trees[0].rows[0] - 0.85 * 600_000) < 5000


def test_boosting_is_the_same_in_many_blocks_with_gaps_and_huge_weights(spark, labelled, monkeypatch):
    rows_ = labelled.withColumns({"weight": F.lit(3.7e9) + F.col("active_hours"), "peak_ratio": F.when(F.col("active_hours") > 3, F.col("peak_ratio"))})
    rows_ = rows_.withColumn("variability", F.when(F.col("active_hours") > 20, F.lit(float("nan"))).otherwise(F.col("variability")))
    settings = boosting.Settings(rounds=4, leaves=7, depth=4, leaf_rows=10, rate=0.3, bins=24)
    at_once = boosting.boost(rows_, FEATURES, settings=settings)
    assert len(at_once.trees) == 4 and all(len(t.feature) > 1 for t in at_once.trees)
    for name, value in (("ROWS_PER_TASK", 200), ("ROWS_PER_BLOCK", 64), ("PARTS_TOLD", 2)):
        monkeypatch.setattr(boosting, name, value)
    asked, own = [], boosting._counted
    monkeypatch.setattr(boosting, "_counted", lambda kept, growing, nodes, *rest: asked.append(nodes) or own(kept, growing, nodes, *rest))
    assert boosting.boost(rows_, FEATURES, settings=settings, block=2) == at_once
    # Of two sides only one is gone through.
    assert all(len({(x + 1) // 2 for x in nodes}) == len(nodes) for nodes in asked) and max(map(len, asked)) > 1


def test_sums_are_exact():
    rng = np.random.default_rng(3)
    for size in (1e3, 1e14):  # sums of the second are beyond floating point
        bins, parts = {2: rng.integers(0, 4, 500).astype(np.uint8)}, [np.rint(rng.normal(size=500) * size) for _ in range(2)]
        own = {5: np.arange(0, 500, 3), 6: np.arange(1, 500, 3)}
        got = boosting._sums(own, [6, 5, 9], bins, parts, boosting.Settings(bins=4))
        for k, node in enumerate((6, 5)):
            for cell in range(4):
                here = [i for i in own[node] if bins[2][i] == cell]
                assert got[k, 0, cell].tolist() == [*(sum(int(p[i]) for i in here) for p in parts), len(here)]
        assert not got[2].any()
