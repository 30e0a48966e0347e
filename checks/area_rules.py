"""Alerts, anomalies, detector comparison, scores and evidence."""

from pyspark.sql import functions as F

from checks.adapter import Tables, rounded
from checks.registry import query
from gridops.functions import scoring as sc
from gridops.ml import models
from gridops.ml.labels import label_relative
from gridops.operators import aggregate as a
from gridops.operators import asof, joins, nearby, ranking, rules
from gridops.plans import serve
from gridops.session import scratch_path
from gridops.sinks.tables import build_dim_time, build_fact
from gridops.sinks.writers import output_status, write_parquet


@query(
    "rule_alerts",
    "SELECT grid_id, timestamp, alert_type, round(current_activity, 4) AS current_activity, "
    "round(baseline_activity, 4) AS baseline_activity, reason FROM alerts",
)
def rule_alerts(t: Tables):
    return rounded(t.alerts, ["current_activity", "baseline_activity"])


@query("alert_reason", "SELECT grid_id, timestamp, alert_type, reason FROM alerts WHERE current_activity >= 100")
def alert_reason(t: Tables):
    return rules.rule_alerts(t.hourly).select("grid_id", "timestamp", "alert_type", "reason")


_SCORES = {"total_activity": 4, "baseline_activity": 4, "deviation": 4, "anomaly_score": 6}
_SCORE_SQL = ", ".join(f"round({c}, {d}) AS {c}" for c, d in _SCORES.items())


def _shown(df):
    return df.withColumns({c: F.round(c, d) for c, d in _SCORES.items()})


@query("detect_anomalies", f"SELECT grid_id, timestamp, {_SCORE_SQL}, anomaly_flag, direction, reason, "
       "CAST(NULL AS DOUBLE) AS prediction, flag AS alert_flag, CAST(NULL AS INTEGER) AS ml3_anomaly_disagreement, "
       "CASE WHEN anomaly_flag <> flag THEN 1 ELSE 0 END AS np3_anomaly_disagreement FROM (SELECT n.*, x.flag FROM anomalies n "
       "LEFT JOIN (SELECT DISTINCT grid_id, timestamp, 1 AS flag FROM alerts) x "
       "ON n.grid_id = x.grid_id AND n.timestamp = x.timestamp)")
def detect_anomalies(t: Tables):
    return _shown(rules.detect_anomalies(t.hourly, None, t.alerts))


@query("join_baseline", "SELECT grid_id, timestamp, round(baseline_activity, 4) AS baseline_activity, "
       "round(deviation, 4) AS deviation, round(anomaly_score, 6) AS anomaly_score FROM scored")
def join_baseline(t: Tables):
    baseline = a.baseline_median(t.grid_hour, ["grid_id", "hour"]).withColumnRenamed("hour", "hour_of_day")
    joined = joins.join_baseline(t.hourly.select("grid_id", "timestamp", "total_activity"), baseline)
    names = ["baseline_activity", "deviation", "anomaly_score"]
    return joined.withColumns({c: F.round(c, _SCORES[c]) for c in names}).select("grid_id", "timestamp", *names)


@query("deviation", "SELECT l_orderkey, l_linenumber, round(l_extendedprice - l_quantity * 1000, 4) AS deviation FROM lineitem")
def deviation(t: Tables):
    value = sc.deviation(F.col("l_extendedprice"), F.col("l_quantity") * 1000)
    return t.table("lineitem").select("l_orderkey", "l_linenumber", F.round(value, 4).alias("deviation"))


_PERCENT = "CASE WHEN l_quantity - 5 > 0 THEN (l_extendedprice / 1000 - (l_quantity - 5)) / (l_quantity - 5) * 100 ELSE 0.0 END"


def _lines(t: Tables):
    base = F.col("l_quantity") - 5
    return t.table("lineitem").select(
        "l_orderkey", "l_linenumber", sc.anomaly_score(F.col("l_extendedprice") / 1000, base).alias("score")
    )


@query("anomaly_score", f"SELECT l_orderkey, l_linenumber, round({_PERCENT}, 9) AS score FROM lineitem")
def anomaly_score(t: Tables):
    # Nine decimals: with six, quotients of two-decimal prices often fall on a rounding tie.
    return rounded(_lines(t), ["score"], 9)


@query(
    "anomaly_direction",
    "SELECT l_orderkey, l_linenumber, CASE WHEN s >= 50 OR s <= -50 THEN 1 ELSE 0 END AS anomaly_flag, "
    "CASE WHEN s >= 50 THEN 'HIGH' WHEN s <= -50 THEN 'LOW' ELSE 'NORMAL' END AS direction FROM "
    f"(SELECT l_orderkey, l_linenumber, {_PERCENT} AS s FROM lineitem)",
)
def anomaly_direction(t: Tables):
    return _lines(t).select(
        "l_orderkey",
        "l_linenumber",
        sc.anomaly_flag("score").alias("anomaly_flag"),
        sc.anomaly_direction("score").alias("direction"),
    )


@query("anomaly_reason", "SELECT grid_id, timestamp, direction, reason FROM anomalies")
def anomaly_reason(t: Tables):
    return t.anomalies.select("grid_id", "timestamp", "direction", "reason")


@query(
    "risk_level",
    "SELECT l_orderkey, l_linenumber, CASE WHEN l_discount * 10 >= 0.70 THEN 'high' WHEN l_discount * 10 >= 0.40 THEN 'medium' "
    "ELSE 'low' END AS risk_level FROM lineitem",
)
def risk_level(t: Tables):
    level = sc.risk_level(F.col("l_discount") * 10)
    return t.table("lineitem").select("l_orderkey", "l_linenumber", level.alias("risk_level"))


@query(
    "prediction_label",
    "SELECT grid_id, timestamp, CASE WHEN anomaly_flag = 1 THEN 'RISK' ELSE 'NO RISK' END AS prediction_label FROM anomalies",
)
def prediction_label(t: Tables):
    return t.anomalies.select("grid_id", "timestamp", sc.prediction_label("anomaly_flag").alias("prediction_label"))


@query(
    "join_daily_total",
    "SELECT grid_id, timestamp, round(sum(total_activity) OVER (PARTITION BY date, grid_id), 4) AS daily_total_activity FROM grid_hour",
)
def join_daily_total(t: Tables):
    rows = joins.join_daily_total(t.grid_hour)
    return rounded(rows, ["daily_total_activity"]).select("grid_id", "timestamp", "daily_total_activity")


@query("join_labels", "SELECT f.*, round(h.total_activity, 4) AS total_activity FROM features f JOIN hourly h "
       "ON f.grid_id = h.grid_id AND f.feature_timestamp = h.timestamp")
def join_labels(t: Tables):
    return rounded(joins.join_labels(t.features, t.hourly, ["total_activity"]), ["total_activity"])


def _plain_scores(t: Tables):
    """A risk score made from two features, so the SQL can make the same."""
    f = t.features
    score = F.least(F.round(F.col("internet_share") * 2, 6), F.lit(1.0))
    return f.select(
        "grid_id",
        "feature_timestamp",
        score.alias("risk_score"),
        sc.risk_level(score).alias("risk_level"),
        F.lit("fixed-v1").alias("model_version"),
    )


_RISK = (
    "SELECT f.grid_id, f.feature_timestamp AS timestamp, least(round(f.internet_share * 2, 6), 1.0) AS risk_score, "
    "CASE WHEN least(round(f.internet_share * 2, 6), 1.0) >= 0.7 THEN 'high' "
    "WHEN least(round(f.internet_share * 2, 6), 1.0) >= 0.4 THEN 'medium' ELSE 'low' END AS risk_level, "
    "'fixed-v1' AS model_version, round(n.anomaly_score, 6) AS anomaly_score, n.anomaly_flag, n.direction, n.reason "
    "FROM features f LEFT JOIN anomalies n ON f.grid_id = n.grid_id AND f.feature_timestamp = n.timestamp"
)


@query("join_risk_anomaly", _RISK)
def join_risk_anomaly(t: Tables):
    return rounded(joins.join_risk_anomaly(_plain_scores(t), t.anomalies), ["anomaly_score"], 6)


@query(
    "top_attention",
    f"SELECT *, abs(anomaly_score) AS anomaly_magnitude FROM ({_RISK}) "
    "ORDER BY risk_score DESC, abs(anomaly_score) DESC, grid_id, timestamp LIMIT 20",
)
def top_attention(t: Tables):
    return ranking.top_attention(rounded(joins.join_risk_anomaly(_plain_scores(t), t.anomalies), ["anomaly_score"], 6))


@query(
    "compare_detectors",
    "SELECT n.grid_id, n.timestamp, n.anomaly_flag, p.prediction, x.flag AS alert_flag, "
    "CASE WHEN n.anomaly_flag <> p.prediction THEN 1 ELSE 0 END AS ml3_anomaly_disagreement, "
    "CASE WHEN n.anomaly_flag <> x.flag THEN 1 ELSE 0 END AS np3_anomaly_disagreement FROM anomalies n "
    "LEFT JOIN (SELECT grid_id, timestamp, CAST(target AS DOUBLE) AS prediction FROM relative) p "
    "ON n.grid_id = p.grid_id AND n.timestamp = p.timestamp "
    "LEFT JOIN (SELECT DISTINCT grid_id, timestamp, 1 AS flag FROM alerts) x ON n.grid_id = x.grid_id AND n.timestamp = x.timestamp",
)
def compare_detectors(t: Tables):
    guesses = label_relative(t.hourly).select("grid_id", "timestamp", F.col("target").cast("double").alias("prediction"))
    flags = t.anomalies.select("grid_id", "timestamp", "anomaly_flag")
    return joins.compare_detectors(flags, guesses, t.alerts)


@query(
    "check_foreign_keys",
    "SELECT 'grid_id' AS key_name, count(*) FILTER (WHERE grid_id NOT IN (SELECT grid_id FROM geo WHERE geometry IS NOT NULL)) "
    "AS orphan_rows FROM fact UNION ALL SELECT 'time_key', count(*) FILTER (WHERE time_key NOT IN (SELECT time_key FROM dim_time)) FROM fact",
)
def check_foreign_keys(t: Tables):
    dims = {"grid_id": t.geo.where(F.col("geometry").isNotNull()), "time_key": build_dim_time(t.hourly)}
    return joins.check_foreign_keys(build_fact(t.hourly), dims)


@query(
    "star_join",
    "SELECT f.grid_id, d.timestamp, d.hour, d.day, round(f.total_activity, 4) AS total_activity FROM fact f JOIN dim_time d "
    "ON f.time_key = d.time_key",
)
def star_join(t: Tables):
    rows = joins.star_join(build_fact(t.hourly), build_dim_time(t.hourly))
    return rounded(rows, ["total_activity"]).select("grid_id", "timestamp", "hour", "day", "total_activity")


#: Where each part of the evidence is read, and what the model score cannot be made without.
_SOURCES = {
    "current_grid_activity": "hourly",
    "grid_features": "features",
    "model_score": "predict_risk",
    "anomaly_score": "alerts",
    "grid_location": "geometry",
    "nearby_hotspots": "nearby_grids",
    "activity_history_summary": "hourly",
}
_NEEDS = {"model_score": "grid_features", "nearby_hotspots": "grid_location"}
_HISTORY = ["activity_history_summary", "alert_history_summary", "prior_alerts"]


def _evidence(t: Tables):
    t = t.stored()
    newest = t.hourly.groupBy("grid_id").agg(F.max_by(F.struct("timestamp", "total_activity"), "timestamp").alias("r"))
    current, hot = asof.features_as_of(t.features), ranking.hotspots(t.hourly)
    model = models.train_tree(t.split[0])
    written = scratch_path(t.spark, "hourly")
    write_parquet(t.hourly, written)
    outputs = {"hourly_grid_summary": written, "network_risk_scores": scratch_path(t.spark, "missing")}
    return serve.evidence_parts(
        t.cells,
        {
            "current_grid_activity": newest.select("grid_id", "r.*"),
            "grid_features": current,
            "model_score": models.predict_risk(model, current),
            "anomaly_score": asof.anomaly_as_of(t.alerts),
            "grid_location": nearby.grid_location(t.geo).where(F.col("geometry").isNotNull()),
            "nearby_hotspots": serve.nearby_hotspots(nearby.nearby_grids(t.cells), hot),
            "activity_history_summary": a.history_summary(t.hourly),
            "alert_history_summary": serve.alert_history_summary(t.alerts, t.cells),
        },
        {
            "network_summary": serve.network_summary(t.hourly),
            "hotspots": hot,
            "prior_alerts": ranking.rank_alerts(t.alerts, 25),
            "pipeline_status": output_status(t.spark, outputs),
        },
    )


_KNOWN = (
    "geo g LEFT JOIN (SELECT grid_id, max(timestamp) AS timestamp, arg_max(total_activity, timestamp) AS total_activity FROM hourly GROUP BY 1) h "
    "ON g.grid_id = h.grid_id LEFT JOIN (SELECT grid_id, max(feature_timestamp) AS feature_timestamp FROM features GROUP BY 1) f "
    "ON g.grid_id = f.grid_id LEFT JOIN (SELECT DISTINCT grid_id FROM alerts) x ON g.grid_id = x.grid_id "
    "LEFT JOIN (SELECT DISTINCT grid_id FROM hourly WHERE timestamp >= (SELECT max(timestamp) FROM hourly) - INTERVAL 23 HOUR) w "
    "ON g.grid_id = w.grid_id"
)
_GAPS = (
    "concat_ws('|', CASE WHEN h.grid_id IS NULL THEN 'current_grid_activity<hourly: no rows' END, "
    "CASE WHEN f.grid_id IS NULL THEN 'grid_features<features: no rows|model_score<predict_risk: skipped, grid_features is missing' END, "
    "CASE WHEN x.grid_id IS NULL THEN 'anomaly_score<alerts: no rows' END, "
    "CASE WHEN g.geometry IS NULL THEN "
    "'grid_location<geometry: no rows|nearby_hotspots<nearby_grids: skipped, grid_location is missing' END, "
    "CASE WHEN w.grid_id IS NULL THEN 'activity_history_summary<hourly: no rows' END)"
)
_NEAREST = (
    "(SELECT grid_id, arg_min(other, (d, other)) AS nearest FROM (SELECT a.grid_id, b.grid_id AS other, "
    "round(sqrt((a.lon - b.lon) * (a.lon - b.lon) + (a.lat - b.lat) * (a.lat - b.lat)), 5) AS d "
    "FROM centroids a JOIN centroids b ON a.grid_id <> b.grid_id WHERE a.lon IS NOT NULL AND b.lon IS NOT NULL) GROUP BY grid_id)"
)


def _told(gaps):
    """Gap records as one text."""
    return F.array_join(F.transform(gaps, lambda g: F.concat(g["evidence"], F.lit("<"), g["source"], F.lit(": "), g["gap"])), "|")


@query("evidence_gaps", f"SELECT g.grid_id, {_GAPS} AS gaps FROM {_KNOWN}")
def evidence_gaps(t: Tables):
    return serve.evidence_gaps(_evidence(t), _SOURCES, _NEEDS).select("grid_id", _told(F.col("gaps")).alias("gaps"))


def _fields(root: str, history: str) -> dict[str, tuple[str, str]]:
    """Figures that are read back from a package: path in the JSON text and type."""
    return {
        "activity": (f"{root}.current_grid_activity.total_activity", "double"),
        "features_at": (f"{root}.grid_features.feature_timestamp", "timestamp_ntz"),
        "scored_at": (f"{root}.model_score.feature_timestamp", "timestamp_ntz"),
        "nearest": (f"{root}.nearby_hotspots.nearby_cells[0].nearby_grid_id", "int"),
        "top_grid": (f"{root}.network_summary[0].top_grid", "int"),
        "hottest": (f"{root}.hotspots[0].grid_id", "int"),
        "missing_output": (f"{root}.pipeline_status[1].output", "string"),
        "alerts_checked": (f"{history}.alert_history_summary.alerts_checked", "bigint"),
        "alerts_here": (f"{history}.alert_history_summary.matching_grid_alerts", "bigint"),
        "newest_alert_grid": (f"{history}.prior_alerts[0].grid_id", "int"),
    }


_READ_BACK = (
    "SELECT g.grid_id, h.total_activity AS activity, f.feature_timestamp AS features_at, f.feature_timestamp AS scored_at, m.nearest, "
    "(SELECT grid_id FROM hourly GROUP BY grid_id ORDER BY round(sum(total_activity), 4) DESC, grid_id LIMIT 1) AS top_grid, "
    "(SELECT grid_id FROM hourly WHERE timestamp = (SELECT max(timestamp) FROM hourly) ORDER BY total_activity DESC, grid_id LIMIT 1) AS hottest, "
    "'network_risk_scores' AS missing_output, (SELECT least(count(*), 25) FROM latest_alerts) AS alerts_checked, coalesce(l.n, 0) AS alerts_here, "
    "(SELECT grid_id FROM latest_alerts ORDER BY current_activity DESC, grid_id, alert_type LIMIT 1) AS newest_alert_grid{more} "
    f"FROM {_KNOWN} LEFT JOIN {_NEAREST} m ON g.grid_id = m.grid_id LEFT JOIN (SELECT grid_id, count(*) AS n FROM "
    "(SELECT * FROM latest_alerts ORDER BY current_activity DESC, grid_id, alert_type LIMIT 25) GROUP BY grid_id) l ON g.grid_id = l.grid_id"
)


def _read_back(packages, root: str, history: str, *more):
    fields = [F.get_json_object("package", path).cast(kind).alias(name) for name, (path, kind) in _fields(root, history).items()]
    return packages.select("grid_id", *fields, *more)


@query("evidence_package", _READ_BACK.format(more=f", {_GAPS} AS gaps"))
def evidence_package(t: Tables):
    """Figures read back from every grid's package, and its gaps."""
    made = serve.evidence_package(_evidence(t), _HISTORY, _SOURCES, _NEEDS)
    gap = "array<struct<evidence:string,source:string,gap:string>>"
    gaps = F.from_json(F.get_json_object("package", "$.uncertainty"), gap)
    return _read_back(made, "$.current_evidence", "$.historical_evidence", _told(gaps).alias("gaps"))


@query("evidence_dump", _READ_BACK.format(more=""))
def evidence_dump(t: Tables):
    return _read_back(serve.evidence_dump(_evidence(t)), "$", "$")


@query(
    "evidence_sufficient",
    "SELECT n.grid_id, n.timestamp, CASE WHEN f.grid_id IS NULL THEN 'missing value' "
    "WHEN n.baseline_activity IS NULL OR n.baseline_activity <= 0 THEN 'no baseline' "
    "WHEN n.timestamp < (SELECT max(timestamp) FROM hourly) - INTERVAL 48 HOUR THEN 'stale' "
    "WHEN sign(n.anomaly_score) <> sign(n.total_activity - n.baseline_activity) THEN 'inconsistent' END AS insufficiency_reason "
    "FROM anomalies n LEFT JOIN features f ON n.grid_id = f.grid_id AND n.timestamp = f.feature_timestamp",
)
def evidence_sufficient(t: Tables):
    features = t.features.withColumnRenamed("feature_timestamp", "timestamp")
    rows = t.anomalies.join(features, ["grid_id", "timestamp"], "left").withColumnsRenamed(
        {"total_activity": "current_activity", "timestamp": "evidence_timestamp"}
    )
    newest = t.hourly.agg(F.max("timestamp").alias("m")).scalar()
    judged = serve.evidence_sufficient(rows, newest, stale_hours=48)
    return judged.select("grid_id", F.col("evidence_timestamp").alias("timestamp"), "insufficiency_reason")
