"""Sources, sinks, derived columns, baselines and quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from kpiloom import fixed_values as fv
from kpiloom.functions import expr as E
from kpiloom.operators import cases, features, incremental, quality
from kpiloom.registry.base import check_sql, query, r, rounded, rs
from kpiloom.registry.inputs import baselines, incidents, kpi_r
from kpiloom.session import stage, stage_path
from kpiloom.sources import kpi as kpi_source
from kpiloom.sources import layout, sinks, views
from pyspark.sql import types as T

KPI_COLS = ["event_id", "cell_name", "ts", "is_anomaly", *fv.RAW_KPIS]
ALL_KPI = ", ".join(["event_id", "cell_name", "ts", "is_anomaly", rs(fv.RAW_KPIS)])


# ---- sources and sinks ---------------------------------------------------------------------

@query("csv_scan", check_sql(f"SELECT {ALL_KPI} FROM kpi", "kpi"))
def csv_scan(spark, d):
    path = stage_path(spark, "kpi-csv")
    dotted = {v: k for k, v in fv.SOURCE_COLUMNS.items() if v != "ts"}
    rows = views.kpi_view(spark, d).withColumn("ts", F.col("ts").cast("string"))
    ordered = rows.select("event_id", "cell_name", "ts", "is_anomaly", *fv.RAW_KPIS)
    ordered.withColumnsRenamed({**dotted, "ts": "timestamp"}).write.option("header", True).csv(path)
    schema = kpi_source.kpi_schema(extra=[T.StructField("event_id", T.LongType())])
    return rounded(kpi_source.read_kpi_csv(spark, path, schema).select(*KPI_COLS))


@query("parse_ts", check_sql("SELECT event_id, ts FROM kpi", "kpi"))
def parse_ts(spark, d):
    as_text = views.kpi_view(spark, d).select("event_id", F.col("ts").cast("string").alias("ts"))
    return kpi_source.parse_ts(as_text)


@query("kpi_view", check_sql(f"SELECT {ALL_KPI} FROM kpi", "kpi"))
def kpi_view(spark, d):
    return rounded(views.kpi_view(spark, d).select(*KPI_COLS))


@query("sorted_kpi", check_sql(f"SELECT {ALL_KPI} FROM kpi ORDER BY cell_name, ts, event_id", "kpi"))
def sorted_kpi(spark, d):
    return kpi_source.sort_kpi(rounded(views.kpi_view(spark, d).select(*KPI_COLS)))


@query("baseline_round_trip", check_sql(f"SELECT cell_name, {rs(fv.KPIS)} FROM base", "base"))
def baseline_round_trip(spark, d):
    path = stage_path(spark, "baselines-csv")
    sinks.write_baselines(features.entity_baselines(kpi_r(spark, d), fv.KPIS), path)
    return rounded(sinks.read_baselines(spark, path, fv.KPIS))


@query("case_append", check_sql(
    "SELECT event_id, cell_name, row_number() OVER (ORDER BY late, cell_name, ts, event_id) AS record_id "
    "FROM (SELECT *, ts >= (SELECT max(ts) - INTERVAL 10 DAY FROM kpi) AS late FROM incidents) x", "incidents"))
def case_append(spark, d):
    path = stage_path(spark, "history")
    found = incidents(spark, d).select("event_id", "cell_name", "ts")
    border = kpi_r(spark, d).agg((F.max("ts") - F.expr("INTERVAL 10 DAYS")).alias("border")).first()["border"]
    order = ["cell_name", "ts", "event_id"]
    early, late = F.col("ts") < F.lit(border).cast("timestamp_ntz"), F.col("ts") >= F.lit(border).cast("timestamp_ntz")
    for run, part in (("early", early), ("late", late), ("early", early)):  # a run that is tried again adds nothing
        sinks.record_cases(found.filter(part), path, order, run=run)
    return spark.read.parquet(path).select("event_id", "cell_name", "record_id")


# ---- derived columns and filters -----------------------------------------------------------

@query("success_rate", check_sql(f"SELECT event_id, {r('rrc_rate')} FROM kpi_r", "kpi_r"))
def success_rate(spark, d):
    return rounded(kpi_r(spark, d).select("event_id", "rrc_rate"))


@query("anomaly_rows", check_sql("SELECT event_id, cell_name, ts FROM kpi WHERE is_anomaly", "kpi"))
def anomaly_rows(spark, d):
    return features.anomalies(views.kpi_view(spark, d)).select("event_id", "cell_name", "ts")


@query("normal_rows", check_sql("SELECT event_id, cell_name, ts FROM kpi WHERE NOT is_anomaly", "kpi"))
def normal_rows(spark, d):
    return features.normals(views.kpi_view(spark, d)).select("event_id", "cell_name", "ts")


_DELTAS = [f"{k}{fv.DELTA_SUFFIX}" for k in fv.DELTA_KPIS]


@query("deviation_features", check_sql(
    "SELECT s.event_id, " + ", ".join(
        r(f"(s.{k} - b.{k}) / (b.{k} + 1e-9) * 1e2", f"{k}{fv.DELTA_SUFFIX}") for k in fv.DELTA_KPIS)
    + " FROM kpi_r s LEFT JOIN base b ON s.cell_name = b.cell_name", "base"))
def deviation_features(spark, d):
    return rounded(features.add_deviation_pct(kpi_r(spark, d), baselines(spark, d)).select("event_id", *_DELTAS))


@query("filled_features", check_sql(
    "SELECT event_id, " + ", ".join(r(f"coalesce({c}, 0)", c) for c in fv.KPIS) + " FROM kpi_r", "kpi_r"))
def filled_features(spark, d):
    return rounded(features.fill_features(kpi_r(spark, d), fv.KPIS).select("event_id", *fv.KPIS))


@query("time_slots", check_sql(
    "SELECT event_id, make_timestamp((epoch_us(ts) // 900000000) * 900000000) AS slot FROM kpi", "kpi"))
def time_slots(spark, d):
    return features.add_slot(views.kpi_view(spark, d)).select("event_id", "slot")


@query("entity_time_range", check_sql(
    "SELECT event_id, cell_name, ts FROM kpi WHERE cell_name = 'CELL_3' "
    "AND ts BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-20 12:00:00'", "kpi"))
def entity_time_range(spark, d):
    start, end = F.expr("timestamp_ntz'2024-01-05 00:00:00'"), F.expr("timestamp_ntz'2024-01-20 12:00:00'")
    return features.entity_between(views.kpi_view(spark, d), "CELL_3", start, end).select("event_id", "cell_name", "ts")


@query("picked_columns", check_sql(f"SELECT event_id, {rs(fv.SAMPLE_METRICS)} FROM kpi_r", "kpi_r"))
def picked_columns(spark, d):
    wanted = [*fv.SAMPLE_METRICS, "not_in_table"]
    return rounded(features.pick_existing(kpi_r(spark, d), wanted, ["event_id"]))


_MODELS = (
    "CASE conv_id % 5 WHEN 0 THEN 'us.amazon.NOVA-lite-v1:0' WHEN 1 THEN 'Anthropic.model-v2' "
    "WHEN 2 THEN 'titan-text' WHEN 3 THEN 'claude-nova' ELSE 'other' END"
)


@query("model_family", f"""
SELECT conv_id, turn, CASE WHEN contains(m, 'anthropic') OR contains(m, 'claude') THEN 'claude'
  WHEN contains(m, 'nova') THEN 'nova' WHEN contains(m, 'titan') THEN 'titan' ELSE 'unknown' END AS family
FROM (SELECT conv_id, turn, lower({_MODELS}) AS m FROM conversations) x""")
def model_family(spark, d):
    log = views.table(spark, d, "conversations").withColumn("model_id", F.expr(_MODELS))
    return log.select("conv_id", "turn", E.model_family("model_id").alias("family"))


# ---- baselines and profile -----------------------------------------------------------------

@query("entity_baselines", check_sql(f"SELECT cell_name, {rs(fv.KPIS)} FROM base", "base"))
def entity_baselines(spark, d):
    return rounded(features.entity_baselines(kpi_r(spark, d), fv.KPIS))


@query("entity_baselines_hot", check_sql(f"SELECT cell_name, {rs(fv.KPIS)} FROM base", "base"))
def entity_baselines_hot(spark, d):
    """The same medians by rank selection, the way of groups too large for one buffer."""
    return rounded(features.entity_baselines(kpi_r(spark, d), fv.KPIS, large=3))


_LINE = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("supplier_baselines",
       f"SELECT l_suppkey, {', '.join(r(f'median({c})', c) for c in _LINE)} FROM lineitem GROUP BY l_suppkey")
def supplier_baselines(spark, d):
    lines = views.table(spark, d, "lineitem")
    return rounded(features.entity_baselines(lines, _LINE, entity="l_suppkey", label=None))


@query("baseline_lookup", check_sql(
    "SELECT s.event_id, " + ", ".join(r(f"b.{c}", f"base_{c}") for c in fv.KPIS)
    + " FROM kpi_r s LEFT JOIN base b ON s.cell_name = b.cell_name", "base"))
def baseline_lookup(spark, d):
    joined = features.with_baseline(kpi_r(spark, d), baselines(spark, d), fv.KPIS)
    return rounded(joined.select("event_id", *[f"base_{c}" for c in fv.KPIS]))


@query("dataset_profile", check_sql(
    "SELECT count(*) AS n_rows, count(DISTINCT cell_name) AS n_entities, 24 AS n_features FROM kpi", "kpi"))
def dataset_profile(spark, d):
    rows = kpi_r(spark, d)
    return features.profile(rows, features.model_features(rows) + _DELTAS)


# ---- kept up to date and stored ------------------------------------------------------------

def _batches_by_time(spark, d):
    """All samples in three batches by time, the middle one last, as late data comes."""
    rows = kpi_r(spark, d)
    first, last = rows.agg(F.min(F.unix_micros(F.col("ts").cast("timestamp"))), F.max(F.unix_micros(F.col("ts").cast("timestamp")))).first()
    at, third = F.unix_micros(F.col("ts").cast("timestamp")), (last - first) // 3
    early, late = at < first + third, at >= first + 2 * third
    return {"early": rows.filter(early), "late": rows.filter(late), "middle": rows.filter(~early & ~late)}


def _incremental_state(spark, d):
    path = stage_path(spark, "state")
    for run, rows in _batches_by_time(spark, d).items():
        incremental.add_batch(rows, path, run, fv.KPIS)
    return path


@query("baselines_incremental", check_sql(
    " UNION ALL ".join(f"SELECT cell_name, '{c}' AS metric, count({c}) AS n_values, true AS within FROM kpi_r "
                       "WHERE NOT is_anomaly GROUP BY cell_name" for c in fv.KPIS), "kpi_r"))
def baselines_incremental(spark, d):
    """Medians from daily sketches, each held against the ranks it has among all values."""
    kept = stage(incremental.baselines(spark, _incremental_state(spark, d), fv.KPIS), "sketched")
    rows = features.with_baseline(features.normals(kpi_r(spark, d)), kept, fv.KPIS)
    counted = rows.groupBy("cell_name").agg(*[
        F.struct(
            F.lit(c).alias("metric"), F.count(c).alias("n_values"),
            F.count_if(F.col(c) < F.col(f"base_{c}")).alias("below"), F.count_if(F.col(c) <= F.col(f"base_{c}")).alias("upto"),
        ).alias(c) for c in fv.KPIS
    ])
    error = incremental.RANK_ERROR
    within = (F.col("below") <= (0.5 + error) * F.col("n_values")) & (F.col("upto") >= (0.5 - error) * F.col("n_values"))
    return counted.select("cell_name", F.inline(F.array(*fv.KPIS))).select("cell_name", "metric", "n_values", within.alias("within"))


@query("profile_incremental", check_sql(
    f"SELECT count(*) AS n_rows, count(DISTINCT cell_name) AS n_entities, {len(fv.KPIS)} AS n_features FROM kpi", "kpi"))
def profile_incremental(spark, d):
    return incremental.profile(spark, _incremental_state(spark, d), fv.KPIS)


@query("missing_incremental", check_sql(
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing_count, "
        f"{r(f'(count(*) - count({c})) * 1e2 / count(*)', 'missing_pct')} FROM kpi_r HAVING count(*) > count({c})" for c in fv.KPIS),
    "kpi_r"))
def missing_incremental(spark, d):
    return rounded(incremental.missing_by_column(spark, _incremental_state(spark, d)))


def _stored(spark, d):
    """Samples and baselines in the stored layout."""
    path = stage_path(spark, "stored")
    name = "kpiloom_" + path.rsplit("-", 1)[-1]
    layout.write_samples(kpi_r(spark, d), f"{name}_samples", f"{path}/samples", buckets=8)
    layout.write_entities(baselines(spark, d), f"{name}_baselines", f"{path}/baselines", buckets=8)
    return f"{name}_samples", f"{name}_baselines"


@query("stored_baseline_lookup", check_sql(
    "SELECT s.event_id, " + ", ".join(r(f"b.{c}", f"base_{c}") for c in fv.KPIS)
    + " FROM kpi_r s LEFT JOIN base b ON s.cell_name = b.cell_name", "base"))
def stored_baseline_lookup(spark, d):
    joined = layout.with_stored_baseline(spark, *_stored(spark, d), fv.KPIS)
    return rounded(joined.select("event_id", *[f"base_{c}" for c in fv.KPIS]))


@query("stored_time_range", check_sql(
    "SELECT event_id, cell_name, ts FROM kpi WHERE cell_name = 'CELL_3' "
    "AND ts BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-20 12:00:00'", "kpi"))
def stored_time_range(spark, d):
    samples, _ = _stored(spark, d)
    found = layout.stored_between(spark, samples, "CELL_3", "2024-01-05 00:00:00", "2024-01-20 12:00:00")
    return found.select("event_id", "cell_name", "ts")


# ---- quality -------------------------------------------------------------------------------

def _dirty(spark, d):
    return views.view(spark, d, "kpi_dirty")


_DIRTY_COLS = ["event_id", "cell_name", "ts", "is_anomaly", *fv.RAW_KPIS]
_DIRTY_ALL = ", ".join(["event_id", "cell_name", "ts", "is_anomaly", rs(fv.RAW_KPIS)])
_NULLS = " + ".join(f"CAST({c} IS NULL AS int)" for c in _DIRTY_COLS)
_N = len(_DIRTY_COLS)
_KEPT = f"SELECT DISTINCT * FROM kpi_dirty WHERE {_N} - ({_NULLS}) >= {_N} * 5e-1"


@query("duplicate_count", check_sql(
    "SELECT (SELECT count(*) FROM kpi_dirty) - (SELECT count(*) FROM (SELECT DISTINCT * FROM kpi_dirty) x) "
    "AS n_duplicates", "kpi_dirty"))
def duplicate_count(spark, d):
    return quality.duplicate_count(_dirty(spark, d))


_TYPES = {"event_id": "bigint", "cell_name": "string", "ts": "timestamp_ntz", "is_anomaly": "boolean"}


@query("missing_by_column", check_sql(
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing_count, "
        f"{r(f'(count(*) - count({c})) * 1e2 / count(*)', 'missing_pct')}, "
        f"'{_TYPES.get(c, 'double')}' AS data_type FROM kpi_dirty HAVING count(*) > count({c})"
        for c in _DIRTY_COLS), "kpi_dirty"))
def missing_by_column(spark, d):
    return rounded(quality.missing_by_column(_dirty(spark, d)))


@query("missing_overview", check_sql(
    f"SELECT sum(n)::bigint AS total_missing, {r(f'sum(n) * 1e2 / (count(*) * {_N})', 'missing_pct')}, "
    "count_if(n > 0)::bigint AS rows_with_missing, count_if(n = 0)::bigint AS complete_rows "
    f"FROM (SELECT {_NULLS} AS n FROM kpi_dirty) x", "kpi_dirty"))
def missing_overview(spark, d):
    return rounded(quality.missing_overview(_dirty(spark, d)))


@query("missing_by_column_clean", """
SELECT 'none' AS "column", 0::bigint AS missing_count, 0::double AS missing_pct, 'none' AS data_type
FROM events WHERE event_id IS NULL OR ts IS NULL OR user_id IS NULL OR event_type IS NULL OR value IS NULL
  OR props IS NULL""")
def missing_by_column_clean(spark, d):
    return quality.missing_by_column(views.table(spark, d, "events"))


@query("dtype_report", check_sql(
    " UNION ALL ".join(
        f"SELECT count(*) AS total_rows, {_N} AS total_columns, '{c}' AS \"column\", "
        f"'{_TYPES.get(c, 'double')}' AS data_type FROM kpi_dirty" for c in _DIRTY_COLS), "kpi_dirty"))
def dtype_report(spark, d):
    return quality.dtype_report(_dirty(spark, d))


_SCORE = (
    f"round(greatest(0e0, 1e2 - sum(n * c) * 1e2 / (sum(c) * {_N}) - sum(c - 1) * 1e2 / sum(c)), 2) AS quality_score"
)
_COPIES = (
    f"SELECT {_NULLS} AS n, c FROM (SELECT *, count(*) AS c FROM kpi_dirty "
    f"GROUP BY {', '.join(_DIRTY_COLS)}) y"
)


@query("quality_score", check_sql(
    f"SELECT sum(c)::bigint AS total_rows, {_N} AS total_columns, sum(c - 1)::bigint AS n_duplicates, {_SCORE} "
    f"FROM ({_COPIES}) x", "kpi_dirty"))
def quality_score(spark, d):
    return quality.quality_score(_dirty(spark, d))


def _outliers_sql(source: str, columns: list[str], needs: list[str], pick: str, having: str = "") -> str:
    parts = []
    for c in columns:
        parts.append(
            f"SELECT '{c}' AS \"column\", count_if({c} < lo OR {c} > hi)::bigint AS iqr_outliers, "
            f"count_if(coalesce(abs(({c} - m) / nullif(s, 0)) > 3, false))::bigint AS z_score_outliers, "
            f"count_if({c} < lo OR {c} > hi) * 1e2 / count(*) AS pct, any_value(lo) AS lower_bound, "
            f"any_value(hi) AS upper_bound, any_value(m) AS mean, any_value(s) AS std FROM {source}, "
            f"(SELECT q1 - 1.5e0 * (q3 - q1) AS lo, q3 + 1.5e0 * (q3 - q1) AS hi, m, s FROM "
            f"(SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3, avg({c}) AS m, "
            f"stddev_samp({c}) AS s FROM {source}) q) b"
        )
    union = " UNION ALL ".join(parts)
    return check_sql(f"SELECT {pick} FROM (SELECT *, sum(iqr_outliers) OVER ()::bigint AS total_outliers "
                     f"FROM ({union}) u) v {having}", *needs)


_BOUNDS = f"{r('pct')}, {r('lower_bound')}, {r('upper_bound')}"
_HITS = "WHERE iqr_outliers > 0 OR z_score_outliers > 0"
_REPORT = f'"column", iqr_outliers, z_score_outliers, {_BOUNDS}, {r("mean", digits=4)}, {r("std", digits=4)}, total_outliers'


def _rounded_report(df):
    four = {"mean", "std"} & set(df.columns)
    return rounded(df).withColumns({c: F.round(c, 4) for c in four})


@query("iqr_outliers", _outliers_sql(
    "kpi_dirty", fv.RAW_KPIS, ["kpi_dirty"], f'"column", iqr_outliers, {_BOUNDS}'))
def iqr_outliers(spark, d):
    return _rounded_report(quality.iqr_outliers(_dirty(spark, d), fv.RAW_KPIS))


@query("zscore_outliers", _outliers_sql(
    "kpi_dirty", fv.RAW_KPIS, ["kpi_dirty"],
    f'"column", z_score_outliers, {r("mean", digits=4)}, {r("std", digits=4)}'))
def zscore_outliers(spark, d):
    return _rounded_report(quality.zscore_outliers(_dirty(spark, d), fv.RAW_KPIS))


@query("outlier_report", _outliers_sql("kpi_dirty", fv.RAW_KPIS, ["kpi_dirty"], _REPORT, _HITS))
def outlier_report(spark, d):
    return _rounded_report(quality.outlier_report(_dirty(spark, d), fv.RAW_KPIS))


@query("outlier_report_lineitem", _outliers_sql("lineitem", _LINE, [], _REPORT))
def outlier_report_lineitem(spark, d):
    """A second schema, with the quartiles taken by rank selection."""
    lines = views.table(spark, d, "lineitem")
    return _rounded_report(quality.outlier_report(lines, _LINE, only_hits=False, large=1_000))


@query("drop_duplicates", check_sql(f"SELECT {_DIRTY_ALL} FROM (SELECT DISTINCT * FROM kpi_dirty) x", "kpi_dirty"))
def drop_duplicates(spark, d):
    return rounded(quality.drop_exact_duplicates(_dirty(spark, d)).select(*_DIRTY_COLS))


@query("drop_sparse_rows", check_sql(
    f"SELECT {_DIRTY_ALL} FROM kpi_dirty WHERE {_N} - ({_NULLS}) >= {_N} * 5e-1", "kpi_dirty"))
def drop_sparse_rows(spark, d):
    return rounded(quality.drop_sparse_rows(_dirty(spark, d)).select(*_DIRTY_COLS))


@query("append_rows", check_sql(
    f"SELECT {ALL_KPI} FROM (SELECT * FROM kpi UNION ALL SELECT * FROM kpi WHERE is_anomaly) x", "kpi"))
def append_rows(spark, d):
    rows = views.kpi_view(spark, d)
    return rounded(quality.append_rows(rows, features.anomalies(rows)).select(*KPI_COLS))


@query("clean", check_sql(f"SELECT {_DIRTY_ALL} FROM ({_KEPT}) x", "kpi_dirty"))
def clean(spark, d):
    return rounded(quality.clean(_dirty(spark, d)).select(*_DIRTY_COLS))


@query("clean_summary", check_sql(
    f"SELECT sum(c)::bigint AS total_rows, (SELECT count(*) FROM ({_KEPT}) k) AS clean_rows, "
    f"sum(c)::bigint - (SELECT count(*) FROM ({_KEPT}) k) AS rows_removed, {_SCORE} FROM ({_COPIES}) x",
    "kpi_dirty"))
def clean_summary(spark, d):
    return quality.clean_summary(_dirty(spark, d))


@query("timestamp_issues", check_sql(
    "SELECT cell_name, (SELECT 0::bigint) + sum(n - 1)::bigint AS duplicate_timestamps, "
    f"count_if(gap > 3600)::bigint AS gaps, {r('max(gap)', 'max_gap_seconds')} FROM (SELECT *, "
    "(epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY cell_name ORDER BY ts))) / 1e6 AS gap "
    "FROM (SELECT cell_name, ts, count(*) AS n FROM kpi_rep GROUP BY ALL) x) y GROUP BY cell_name",
    "kpi", kpi_rep="SELECT cell_name, ts FROM kpi UNION ALL SELECT cell_name, ts FROM kpi WHERE event_id % 50 = 0"))
def timestamp_issues(spark, d):
    return rounded(quality.timestamp_issues(_dirty(spark, d), 3600))


_RANGES = {"prb_dl": (0.0, 50.0), "bler_dl": (0.013, 0.02), "cqi_dl": (10.0, None), "thp_dl": (None, 31.0)}


@query("range_violations", check_sql(
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count_if({f'{c} < {lo!r}::double' if lo is not None else 'false'})::bigint "
        f"AS below_min, count_if({f'{c} > {hi!r}::double' if hi is not None else 'false'})::bigint AS above_max FROM kpi"
        for c, (lo, hi) in _RANGES.items()), "kpi"))
def range_violations(spark, d):
    return quality.range_violations(views.kpi_view(spark, d), _RANGES)


@query("first_cases", check_sql(
    "SELECT event_id, cell_name, ts FROM incidents ORDER BY cell_name, ts, event_id LIMIT 5", "incidents"))
def first_cases(spark, d):
    return cases.take_cases(incidents(spark, d), 5).select("event_id", "cell_name", "ts")
