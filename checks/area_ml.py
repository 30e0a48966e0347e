"""Labels, splits, models and metrics."""

from pyspark.sql import functions as F

from checks.adapter import Tables, rounded
from checks.registry import query
from gridops.functions.scoring import apply_threshold as threshold
from gridops.functions.time import time_key
from gridops.ml import labels as lab
from gridops.ml import models as m
from gridops.ml.boosting import DRAW, DRAWS, UNIT, Settings, sampled_columns
from gridops.operators import aggregate as a
from gridops.operators.joins import join_labels
from gridops.schema import FEATURES
from gridops.session import scratch_path
from gridops.sinks.writers import write_parquet


def _labelled(t: Tables):
    return join_labels(t.features, lab.label_threshold(t.hourly), ["future_activity", "target"])


def _judged(t: Tables):
    """Anomaly flags taken as predictions of the next-hour label."""
    flags = t.anomalies.select("grid_id", "timestamp", F.col("anomaly_flag").alias("prediction"))
    targets = lab.label_threshold(t.hourly).select("grid_id", "timestamp", "target")
    return flags.join(targets, ["grid_id", "timestamp"])


_NEXT = (
    "(SELECT grid_id, timestamp, total_activity, lead(total_activity) OVER (PARTITION BY grid_id ORDER BY timestamp) "
    "AS future_activity FROM hourly)"
)


@query(
    "label_threshold",
    "SELECT grid_id, timestamp, round(future_activity, 4) AS future_activity, CAST(future_activity > 100 AS INTEGER) AS target "
    f"FROM {_NEXT} WHERE future_activity IS NOT NULL",
)
def label_threshold(t: Tables):
    rows = rounded(lab.label_threshold(t.hourly), ["future_activity"])
    return rows.select("grid_id", "timestamp", "future_activity", "target")


@query(
    "label_percentile",
    "SELECT grid_id, timestamp, CAST(future_activity > (SELECT quantile_disc(total_activity, 0.9) FROM hourly "
    f"WHERE timestamp <= TIMESTAMP '2024-01-20 00:00:00') AS INTEGER) AS target FROM {_NEXT} WHERE future_activity IS NOT NULL",
)
def label_percentile(t: Tables):
    return lab.label_percentile(t.hourly, "2024-01-20 00:00:00").select("grid_id", "timestamp", "target")


@query(
    "label_relative",
    "SELECT grid_id, timestamp, round(baseline_24h, 4) AS baseline_24h, round(future_activity, 4) AS future_activity, target FROM relative",
)
def label_relative(t: Tables):
    rows = rounded(lab.label_relative(t.hourly), ["baseline_24h", "future_activity"])
    return rows.select("grid_id", "timestamp", "baseline_24h", "future_activity", "target")


@query("split_chronological", "SELECT grid_id, feature_timestamp, target, part FROM split")
def split_chronological(t: Tables):
    train, test = t.split
    both = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return both.select("grid_id", "feature_timestamp", "target", "part")


@query(
    "split_by_date",
    "SELECT grid_id, feature_timestamp, target, CASE WHEN d <= 4 THEN 'train' ELSE 'test' END AS part FROM "
    "(SELECT *, dense_rank() OVER (ORDER BY CAST(feature_timestamp AS DATE)) AS d FROM labelled)",
)
def split_by_date(t: Tables):
    train, test = lab.split_by_date(_labelled(t), 4)
    both = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return both.select("grid_id", "feature_timestamp", "target", "part")


@query(
    "class_balance",
    "SELECT target, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM labelled GROUP BY target",
)
def class_balance(t: Tables):
    return rounded(a.class_balance(_labelled(t)), ["share"], 6)


@query(
    "class_weight",
    "SELECT count(*) FILTER (WHERE target = 1) AS positives, count(*) FILTER (WHERE target = 0) AS negatives, "
    "round(count(*) FILTER (WHERE target = 0) / nullif(count(*) FILTER (WHERE target = 1), 0), 6) AS weight FROM labelled",
)
def class_weight(t: Tables):
    return rounded(lab.class_weight(_labelled(t)), ["weight"], 6)


@query(
    "apply_threshold",
    "SELECT grid_id, feature_timestamp, CASE WHEN internet_share >= 0.5 THEN 1 ELSE 0 END AS prediction FROM features",
)
def apply_threshold(t: Tables):
    return t.features.select("grid_id", "feature_timestamp", threshold("internet_share").alias("prediction"))


@query(
    "confusion_matrix",
    "SELECT target, count(*) FILTER (WHERE prediction = 0) AS predicted_0, count(*) FILTER (WHERE prediction = 1) AS predicted_1 "
    "FROM judged GROUP BY target",
)
def confusion_matrix(t: Tables):
    return m.confusion_matrix(_judged(t))


_COUNTS = (
    "(SELECT count(*) AS n, count(*) FILTER (WHERE target = 1 AND prediction = 1) AS tp, count(*) FILTER (WHERE prediction = 1) AS p, "
    "count(*) FILTER (WHERE target = 1) AS t, count(*) FILTER (WHERE target = prediction) AS ok FROM judged)"
)


@query(
    "binary_metrics",
    "SELECT round(ok / n, 6) AS accuracy, round(coalesce(tp / nullif(p, 0), 0), 6) AS precision, "
    "round(coalesce(tp / nullif(t, 0), 0), 6) AS recall, round(coalesce(2 * tp / nullif(p + t, 0), 0), 6) AS f1, "
    f"round(t / n, 6) AS base_rate FROM {_COUNTS}",
)
def binary_metrics(t: Tables):
    return rounded(m.binary_metrics(_judged(t)), ["accuracy", "precision", "recall", "f1", "base_rate"], 6)


@query(
    "class_report",
    "SELECT 1 AS class, round(coalesce(tp / nullif(p, 0), 0), 6) AS precision, round(coalesce(tp / nullif(t, 0), 0), 6) AS recall, "
    f"round(coalesce(2 * tp / nullif(p + t, 0), 0), 6) AS f1, t AS support FROM {_COUNTS} UNION ALL "
    "SELECT 0, round(coalesce((ok - tp) / nullif(n - p, 0), 0), 6), round(coalesce((ok - tp) / nullif(n - t, 0), 0), 6), "
    f"round(coalesce(2 * (ok - tp) / nullif(2 * n - p - t, 0), 0), 6), n - t FROM {_COUNTS}",
)
def class_report(t: Tables):
    return rounded(m.class_report(_judged(t)), ["precision", "recall", "f1"], 6)


def _held_out(model, test, fits):
    """What SQL can say of a model: the counts of its test rows, whether its metrics there follow from
    the confusion matrix, and whether it fits the rows it learned from (``fits``, one boolean).

    Quality on the test rows is left out: the given tables hold no signal to be learned.
    """
    scored = m.predict(model, test)
    told = m.binary_metrics(scored).select(F.struct("*")).scalar()
    cell = lambda target, p: F.coalesce(F.sum(F.when(F.col("target") == target, F.col(f"predicted_{p}"))), F.lit(0))
    cells = m.confusion_matrix(scored).agg(*[cell(t, p).alias(f"n{t}{p}") for t in (0, 1) for p in (0, 1)])
    positives, rows = F.col("n11") + F.col("n10"), F.col("n00") + F.col("n01") + F.col("n10") + F.col("n11")
    ratio = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    again = {
        "accuracy": ratio(F.col("n00") + F.col("n11"), rows),
        "precision": ratio(F.col("n11"), F.col("n11") + F.col("n01")),
        "recall": ratio(F.col("n11"), positives),
        "f1": ratio(2 * F.col("n11"), 2 * F.col("n11") + F.col("n01") + F.col("n10")),
        "base_rate": ratio(positives, rows),
    }
    agree = F.lit(True)
    for name, value in again.items():
        agree = agree & (F.abs(F.col("told")[name] - value) < 1e-9)
    return cells.withColumn("told", told).select(
        rows.alias("test_rows"),
        positives.alias("test_positives"),
        agree.alias("metrics_agree"),
        fits.scalar().alias("fits_training"),
    )


_TESTED = (
    "SELECT count(*) AS test_rows, count(*) FILTER (WHERE target = 1) AS test_positives, true AS metrics_agree, "
    "true AS fits_training FROM {rows}"
)


@query("train_logistic", _TESTED.format(rows="split WHERE part = 'test'"))
def train_logistic(t: Tables):
    """A fitted intercept makes the scores of the training rows add up to their positives."""
    train, test = t.split
    model = m.train_logistic(train)
    off = F.abs(F.sum("risk_score") - F.sum("target"))
    return _held_out(model, test, m.score_probability(model, train).agg(off <= 0.01 * F.count("*")))


@query("train_tree", _TESTED.format(rows="split WHERE part = 'test'"))
def train_tree(t: Tables):
    """Every leaf predicts its larger class, so the training rows are told at least as well as by the larger class."""
    train, test = t.split
    model = m.train_tree(train)
    right = F.count_if(F.col("prediction") == F.col("target"))
    return _held_out(model, test, m.predict(model, train).agg(right >= F.greatest(F.sum("target"), F.count("*") - F.sum("target"))))


def _first_tree_sql(levels: int = 3) -> str:
    """The first ``levels`` splits of the first boosted tree, grown level by level on the same bins and rows."""
    s = Settings()
    names = [FEATURES[i] for i in sampled_columns(FEATURES, 0, s)]
    shares = ", ".join(str(i / s.bins) for i in range(1, s.bins))
    soft = lambda g: f"(sign({g}) * greatest(abs({g}) - {s.l1}, 0))"
    worth = lambda g, h: f"({soft(g)} * {soft(g)} / ({h} + {s.l2}))"
    fixed = lambda x: f"round({x} * {UNIT}) / {UNIT}"
    bins = ", ".join(f"len(list_filter((SELECT e_{c} FROM edges), lambda b: b < {c})) AS b_{c}" for c in names)
    edges = ", ".join(f"list_distinct(quantile_disc({c}::DOUBLE, [{shares}])) AS e_{c}" for c in names)
    each = " UNION ALL ".join(f"SELECT path, {i} AS f, '{c}' AS feature, b_{c} AS cut, list_sort((SELECT e_{c} FROM edges)) AS borders, g, h FROM {{rows}}" for i, c in enumerate(names))
    parts = [
        "train AS (SELECT * FROM related WHERE NOT late)",
        "ratio AS (SELECT count(*) FILTER (WHERE target = 0) / count(*) FILTER (WHERE target = 1) AS w, "
        "count(*) FILTER (WHERE target = 1) * w AS one, count(*) FILTER (WHERE target = 0) AS zero FROM train)",
        f"edges AS (SELECT {edges} FROM train)",
        "weighed AS (SELECT *, CASE WHEN target = 1 THEN w ELSE 1.0 END AS wt, 1 / (1 + exp(-ln(one / zero))) AS p FROM train, ratio)",
        f"rows0 AS (SELECT '' AS path, {bins}, {fixed('wt * (p - target)')} AS g, {fixed('wt * p * (1 - p)')} AS h FROM weighed "
        f"WHERE (grid_id * 1000003 + epoch(feature_timestamp)::BIGINT) % {DRAWS} * {DRAW % DRAWS} % {DRAWS} // 65536 % 100 < {round(s.row_share * 100)})",
    ]
    for level in range(levels):
        parts += [
            f"cells{level} AS (SELECT path, f, feature, cut, any_value(borders) AS borders, sum(g) AS g, sum(h) AS h, count(*) AS n "
            f"FROM ({each.format(rows=f'rows{level}')}) GROUP BY path, f, feature, cut)",
            f"sums{level} AS (SELECT *, sum(g) OVER u AS gl, sum(h) OVER u AS hl, sum(n) OVER u AS nl, sum(g) OVER w - sum(g) OVER u AS gr, "
            f"sum(h) OVER w - sum(h) OVER u AS hr, sum(n) OVER w - sum(n) OVER u AS nr, sum(g) OVER w AS ga, sum(h) OVER w AS ha FROM cells{level} "
            "WINDOW w AS (PARTITION BY path, f), u AS (PARTITION BY path, f ORDER BY cut))",
            f"gains{level} AS (SELECT *, {worth('gl', 'hl')} + {worth('gr', 'hr')} - {worth('ga', 'ha')} AS gain FROM sums{level} "
            f"WHERE nl >= {s.leaf_rows} AND nr >= {s.leaf_rows})",
            f"best{level} AS (SELECT * FROM gains{level} WHERE gain > 1e-9 QUALIFY row_number() OVER (PARTITION BY path ORDER BY gain DESC, f, cut) = 1)",
            f"rows{level + 1} AS (SELECT r.* REPLACE (r.path || CASE b.feature "
            + " ".join(f"WHEN '{c}' THEN CASE WHEN b_{c} <= b.cut THEN 'L' ELSE 'R' END" for c in names)
            + f" END AS path) FROM rows{level} r JOIN best{level} b ON r.path = b.path)",
        ]
    split = lambda level: f"LEFT JOIN best{level} b ON r.path = b.path" if level < levels else ""
    told = lambda level: "any_value(b.feature), any_value(b.borders[b.cut + 1]), round(any_value(b.gain), 6)" if level < levels else "NULL, NULL, NULL"
    nodes = " UNION ALL ".join(
        f"SELECT r.path AS path, {told(level)}, round(-{soft('sum(r.g)')} / (sum(r.h) + {s.l2}) * {s.rate}, 9), count(*) FROM rows{level} r {split(level)} GROUP BY r.path"
        for level in range(levels + 1)
    )
    return (
        f"SELECT path, feature, border, gain, weight, rows, 300 AS trees, true AS within_limits FROM (WITH {', '.join(parts)} "
        f"SELECT * FROM ({nodes}) x(path, feature, border, gain, weight, rows)) WHERE EXISTS (SELECT 1 FROM related)"
    )


@query("train_boosted", _first_tree_sql())
def train_boosted(t: Tables):
    """The first three levels of the first of 300 trees: splits, gains, leaf weights; and whether all trees keep the limits."""
    rows = join_labels(t.features, lab.label_relative(t.hourly), ["future_activity", "target"])
    path = scratch_path(t.spark, "relative")
    write_parquet(rows, path)
    train, _ = lab.split_chronological(t.spark.read.parquet(path))
    key = F.col("grid_id").cast("bigint") * 1_000_003 + time_key("feature_timestamp")
    model = m.train_boosted(lab.with_class_weight(train), key=key)
    nodes = model.nodes(t.spark)
    leaf = F.col("feature").isNull()
    per_tree = nodes.groupBy("tree").agg(F.count_if(leaf).alias("leaves"), F.max("level").alias("depth"), F.min(F.when(leaf & (F.col("level") > 0), F.col("rows"))).alias("least"))
    limits = per_tree.agg(F.count("*").cast("int").alias("trees"), F.every((F.col("leaves") <= 31) & (F.col("depth") <= 6) & (F.coalesce("least", F.lit(50)) >= 50)).alias("within_limits"))
    first = nodes.where("tree = 0")
    up = first.where("feature IS NOT NULL")
    sides = up.select("node", F.explode(F.array(F.struct(F.col("left").alias("child"), F.lit("L").alias("side")), F.struct((F.col("left") + 1).alias("child"), F.lit("R").alias("side")))).alias("s"))
    sides = sides.select(F.col("node").alias("parent"), "s.*")
    paths = first.where("node = 0").select("node", F.lit("").alias("path"))
    shown, level = paths, paths
    for _ in range(3):
        level = level.join(sides, level["node"] == sides["parent"]).select(F.col("child").alias("node"), F.concat("path", "side").alias("path"))
        shown = shown.union(level)
    inner = lambda c: F.when(F.col("level") < 3, F.col(c))
    return first.join(shown, "node").join(limits).select(
        "path", inner("feature").alias("feature"), inner("border").alias("border"), F.round(inner("gain"), 6).alias("gain"), F.round("weight", 9).alias("weight"), "rows", "trees", "within_limits"
    )


_BASE = "(SELECT round(avg(target), 6) FROM split WHERE part = 'test')"


@query(
    "model_comparison",
    f"SELECT metric, CASE WHEN metric = 'base_rate' THEN {_BASE} END AS logistic_base, "
    f"CASE WHEN metric = 'base_rate' THEN {_BASE} END AS tree_base, true AS in_range FROM "
    "(SELECT unnest(['accuracy', 'precision', 'recall', 'f1', 'base_rate']) AS metric)",
)
def model_comparison(t: Tables):
    train, test = t.split
    made = {"logistic": m.train_logistic(train), "tree": m.train_tree(train)}
    table = m.model_comparison({name: m.binary_metrics(m.predict(model, test)) for name, model in made.items()})
    base = lambda name: F.when(F.col("metric") == "base_rate", F.round(name, 6)).alias(f"{name}_base")
    return table.select("metric", base("logistic"), base("tree"), (F.col("logistic").between(0, 1) & F.col("tree").between(0, 1)).alias("in_range"))


_NAMES = "(SELECT unnest(['avg_activity', 'activity_growth', 'active_hours', 'peak_ratio', 'variability', 'internet_share']) AS feature)"


@query("coefficient_ranking", f"SELECT feature, true AS is_absolute FROM {_NAMES}")
def coefficient_ranking(t: Tables):
    ranked = m.coefficient_ranking(t.spark, m.train_logistic(t.split[0]))
    return ranked.select("feature", (F.col("absolute_coefficient") == F.abs("coefficient")).alias("is_absolute"))


@query("feature_importance", f"SELECT feature, true AS in_range, 1.0::DOUBLE AS total FROM {_NAMES}")
def feature_importance(t: Tables):
    shares = m.feature_importance(t.spark, m.train_tree(t.split[0]))
    total = shares.agg(F.round(F.sum("importance"), 6)).scalar()
    return shares.select("feature", F.col("importance").between(0, 1).alias("in_range"), total.alias("total"))


@query(
    "score_probability",
    "SELECT count(*) AS rows, count(*) FILTER (WHERE target = 1)::DOUBLE AS expected_positives, 0::BIGINT AS out_of_range "
    "FROM split WHERE part = 'train'",
)
def score_probability(t: Tables):
    """Leaves hold class shares, so the scores of the training rows add up to their positives."""
    train = t.split[0]
    scored = m.score_probability(m.train_tree(train), train)
    return scored.agg(
        F.count("*").alias("rows"),
        F.round(F.sum("risk_score"), 4).alias("expected_positives"),
        F.count_if(~F.col("risk_score").between(0, 1)).alias("out_of_range"),
    )


@query(
    "save_load_model",
    "SELECT grid_id, feature_timestamp, true AS same_score, true AS same_label FROM features",
)
def save_load_model(t: Tables):
    """Every row scored by the model and by its reloaded copy."""
    path = scratch_path(t.spark, "model")
    model = m.train_tree(t.split[0])
    m.save_model(model, path)
    first = m.predict(model, t.features).withColumnsRenamed({"risk_score": "s", "prediction_label": "l"}).drop("prediction")
    both = m.predict(m.load_model(t.spark, path), first)
    return both.select(
        "grid_id", "feature_timestamp", (F.col("s") == F.col("risk_score")).alias("same_score"), (F.col("l") == F.col("prediction_label")).alias("same_label")
    )


def _level():
    return F.when(F.col("risk_score") >= 0.7, "high").when(F.col("risk_score") >= 0.4, "medium").otherwise("low")


@query(
    "network_risk_scores",
    "SELECT f.grid_id, f.feature_timestamp AS timestamp, true AS scored, true AS level_fits, round(n.anomaly_score, 6) AS anomaly_score, "
    "n.anomaly_flag, n.direction, n.reason FROM features f "
    "LEFT JOIN anomalies n ON f.grid_id = n.grid_id AND f.feature_timestamp = n.timestamp",
)
def network_risk_scores(t: Tables):
    rows = m.risk_scores(m.train_tree(t.split[0]), t.features, t.anomalies)
    return rows.select(
        "grid_id",
        "timestamp",
        F.col("risk_score").between(0, 1).alias("scored"),
        (F.col("risk_level") == _level()).alias("level_fits"),
        F.round("anomaly_score", 6).alias("anomaly_score"),
        "anomaly_flag",
        "direction",
        "reason",
    )


@query(
    "predict_risk",
    "SELECT grid_id, feature_timestamp, CASE WHEN grid_id NOT BETWEEN 1 AND 10000 THEN 'grid_id' ELSE '' END || "
    "CASE WHEN internet_share * 4 > 1 THEN CASE WHEN grid_id NOT BETWEEN 1 AND 10000 THEN '|' ELSE '' END || 'internet_share' ELSE '' END AS violations, "
    "grid_id BETWEEN 1 AND 10000 AND internet_share * 4 <= 1 AS has_score, true AS consistent FROM features",
)
def predict_risk(t: Tables):
    """The share is quadrupled so that some rows are refused."""
    rows = t.features.withColumn("internet_share", F.col("internet_share") * 4)
    told = m.predict_risk(m.train_tree(t.split[0]), rows)
    known = F.col("risk_score").isNotNull()
    fits = F.col("risk_level").eqNullSafe(F.when(known, _level())) & F.col("explanation_note").isNotNull().eqNullSafe(known)
    return told.select(
        "grid_id", "feature_timestamp", F.array_join("violations", "|").alias("violations"), known.alias("has_score"), fits.alias("consistent")
    )


@query("score_probability_figures")
def score_probability_figures(t: Tables):
    """Every row of the features with its score by the tree."""
    scored = m.score_probability(m.train_tree(t.split[0]), t.features)
    return scored.select("grid_id", "feature_timestamp", *FEATURES, "risk_score")


@query("network_risk_scores_figures")
def network_risk_scores_figures(t: Tables):
    return m.risk_scores(m.train_tree(t.split[0]), t.features, t.anomalies)


@query("predict_risk_figures")
def predict_risk_figures(t: Tables):
    return m.predict_risk(m.train_tree(t.split[0]), t.features.withColumn("internet_share", F.col("internet_share") * 4))


@query("coefficient_ranking_figures")
def coefficient_ranking_figures(t: Tables):
    return m.coefficient_ranking(t.spark, m.train_logistic(t.split[0]))


@query("feature_importance_figures")
def feature_importance_figures(t: Tables):
    return m.feature_importance(t.spark, m.train_tree(t.split[0]))


@query("model_comparison_figures")
def model_comparison_figures(t: Tables):
    train, test = t.split
    made = {"logistic": m.train_logistic(train), "tree": m.train_tree(train)}
    return m.model_comparison({name: m.binary_metrics(m.predict(model, test)) for name, model in made.items()})
