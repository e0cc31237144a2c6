"""Queries: the 25 candidate features with their catalogue, selection rules on both paths, provenance
checks with injected faults, leave-one-out levels, and the metadata document."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isotherm.operators import features as fe
from isotherm.operators import moments as mo
from isotherm.operators import quality as dq
from isotherm.operators import stats as stt
from isotherm.plans import driver_sources as ds
from isotherm.plans.materialize import stage
from isotherm.plans.oracle_sources import with_sources
from isotherm.plans.q_clean import clean_frame, with_clean
from isotherm.plans.q_features import (FEATURE_COLUMNS, FEATURE_DOUBLES, GLOBAL_CTES, LOC, LOC_SQL, TARGET, TRAIN_END,
                                       VALIDATION_END, feature_frame, global_lag, with_features)
from isotherm.plans.q_stats import _ZONE_SQL, ETA_CTES, _r_sql
from isotherm.plans.registry import register
from isotherm.session import scratch_path
from isotherm.sources import files as io

KEY = [*LOC, "observation_date"]


@dataclass(frozen=True)
class Feature:
    group: str
    availability: str       # static, fit_stat (needs fitted statistics) or history (needs past months)
    description: str
    force_keep: bool = False


# The candidate features.
CANDIDATES: dict[str, Feature] = {
    "month_sin": Feature("calendar", "static", "calendar month on the circle, sine", True),
    "month_cos": Feature("calendar", "static", "calendar month on the circle, cosine", True),
    "climatic_month_sin": Feature("calendar", "static", "month shifted by half a year in the south, sine", True),
    "climatic_month_cos": Feature("calendar", "static", "month shifted by half a year in the south, cosine", True),
    "years_since_start": Feature("trend", "static", "years since the first observed year", True),
    "latitude": Feature("geography", "static", "signed latitude"),
    "abs_latitude": Feature("geography", "static", "distance from the equator in degrees"),
    "hemisphere_north": Feature("geography", "static", "on or north of the equator"),
    "longitude": Feature("geography", "static", "signed longitude"),
    "is_major_city": Feature("geography", "static", "listed among the major cities"),
    "abslat_x_month_sin": Feature("interaction", "static", "season by latitude, sine"),
    "abslat_x_month_cos": Feature("interaction", "static", "season by latitude, cosine"),
    "abslat_x_years": Feature("interaction", "static", "trend by latitude"),
    "loc_month_climatology": Feature("climatology", "fit_stat", "usual value of the place in the month, past only in train"),
    "loc_climatology_imputed": Feature("climatology", "fit_stat", "the usual value comes from a wider level"),
    "loc_mean_temperature": Feature("climatology", "fit_stat", "mean of the place, past only in train"),
    "loc_temperature_std": Feature("climatology", "fit_stat", "deviation of the place, past only in train"),
    "temp_lag_1": Feature("history", "history", "value one calendar month earlier"),
    "temp_lag_12": Feature("history", "history", "value twelve calendar months earlier"),
    "temp_roll_mean_12": Feature("history", "history", "mean of the twelve months before"),
    "temp_roll_std_12": Feature("history", "history", "deviation of the twelve months before"),
    "temp_anomaly_lag_12": Feature("history", "history", "value twelve months earlier against the usual one"),
    "land_temperature_lag_1": Feature("global", "history", "global land value one month earlier"),
    "land_anomaly_lag_1": Feature("global", "history", "global land anomaly one month earlier"),
    "city_uncertainty_lag_1": Feature("history", "history", "measurement uncertainty one month earlier"),
}
#: Columns of the same month, or made from the target: never features.
FORBIDDEN = ["major_city_average_temperature", "country_average_temperature", "land_average_temperature",
             "city_average_temperature_uncertainty", "temp_anomaly_vs_climatology", TARGET]
MIN_ETA2, MIN_R, MAX_PAIR_R = 0.005, 0.05, 0.95
DEPLOYABLE = ("static", "fit_stat")
#: Values are snapped to this grid before they are binned: averages that differ in the last bit only
#: would fall on either side of a bin's edge.
BIN_GRID = float(2 ** 30)
_EXTRA = ["is_major_city", "abslat_x_years", "land_temperature_lag_1", "land_anomaly_lag_1", "city_uncertainty_lag_1"]
CANDIDATE_DOUBLES = [*FEATURE_DOUBLES, "abslat_x_years", "land_temperature_lag_1", "land_anomaly_lag_1", "city_uncertainty_lag_1"]


def candidate_frame(spark, sf) -> DataFrame:
    """The feature table with the major-city flag, the latitude trend and the three lags that come from
    other series; the global series is broadcast (one row per calendar month)."""
    def build():
        c = fe.with_month_index(clean_frame(spark, sf))
        extra = c.select(*KEY, "is_major_city",
                         fe.calendar_lag("city_average_temperature_uncertainty", 1, LOC).alias("city_uncertainty_lag_1"))
        land = global_lag(spark, sf).select("observation_date", "land_temperature_lag_1", "land_anomaly_lag_1")
        f = feature_frame(spark, sf).withColumn("abslat_x_years", F.col("abs_latitude") * F.col("years_since_start"))
        return f.join(extra, KEY).join(F.broadcast(land), "observation_date", "left").select(
            *KEY, "year", "month", TARGET, *[c for c in CANDIDATES if c not in LOC], "data_split", "is_train_period")
    return stage(spark, "candidates", sf, build)


CANDIDATE_CTES = GLOBAL_CTES + f""", extra AS (SELECT {LOC_SQL}, observation_date, is_major_city,
  max(city_average_temperature_uncertainty) OVER (PARTITION BY {LOC_SQL}
    ORDER BY year(observation_date) * 12 + month(observation_date) RANGE BETWEEN 1 PRECEDING AND 1 PRECEDING) AS city_uncertainty_lag_1
  FROM clean),
candidates AS (SELECT {LOC_SQL}, observation_date, year, month, {TARGET}, {', '.join(c for c in CANDIDATES if c not in [*LOC, *_EXTRA])},
  abs_latitude * years_since_start AS abslat_x_years, is_major_city, city_uncertainty_lag_1, land_temperature_lag_1,
  land_anomaly_lag_1, data_split, is_train_period
  FROM features JOIN extra USING ({LOC_SQL}, observation_date)
  LEFT JOIN (SELECT observation_date, land_temperature_lag_1, land_anomaly_lag_1 FROM global_lags) gl USING (observation_date))
"""


def with_candidates(body: str) -> str:
    return with_features(CANDIDATE_CTES + body)


@register("candidate_table", with_candidates("SELECT * FROM candidates"), round_cols=CANDIDATE_DOUBLES,
          ids="FEA-07 FEA-14 FEA-15 FEA-18")
def candidate_table(spark, sf):
    return candidate_frame(spark, sf)


_TYPES = {"boolean": "flag", "double": "number"}


def _catalogue_sql() -> str:
    parts = [f"""SELECT {i} AS position, '{n}' AS feature, '{x.group}' AS feature_group, '{x.availability}' AS availability,
  {str(x.force_keep).upper()} AS force_keep, '{x.description}' AS description,
  CASE typeof(any_value({n})) WHEN 'BOOLEAN' THEN 'flag' WHEN 'DOUBLE' THEN 'number' ELSE 'integer' END AS kind,
  count({n}) AS present FROM candidates""" for i, (n, x) in enumerate(CANDIDATES.items(), 1)]
    return with_candidates(" UNION ALL ".join(parts))


@register("feature_catalogue", _catalogue_sql(), ids="FEA-18 AGG-48")
def feature_catalogue(spark, sf):
    """Position, group, availability, description and kind of every candidate, and its present values."""
    f = candidate_frame(spark, sf)
    kinds = dict(f.dtypes)
    rows = [(i, n, x.group, x.availability, x.force_keep, x.description, _TYPES.get(kinds[n], "integer"))
            for i, (n, x) in enumerate(CANDIDATES.items(), 1)]
    meta = spark.createDataFrame(rows, "position long, feature string, feature_group string, availability string, "
                                       "force_keep boolean, description string, kind string")
    counts = dq.unpivot_one_row(f.agg(*[F.count(c).alias(c) for c in CANDIDATES]), "feature", "present")
    return meta.join(F.broadcast(counts), "feature")      # 25 rows


# ---------------------------------------------------------------- selection rules

def decide(r: dict[str, float | None], eta2: dict[str, float | None], varied: set[str], pairs: list[tuple[str, str, float]],
           allowed: tuple[str, ...] | None) -> dict[str, tuple[str, str]]:
    """Feature -> (keep or drop, reason), from metrics alone (25 values each).

    Order: availability (only with ``allowed``), forced, constant, weak in both measures, then pairs
    above the threshold from the strongest on, of which the one with less eta squared goes unless it
    is forced or one of the two is gone already."""
    out: dict[str, tuple[str, str]] = {}
    for name, x in CANDIDATES.items():
        weak = (eta2.get(name) is None or eta2[name] < MIN_ETA2) and (r.get(name) is None or abs(r[name]) < MIN_R)
        out[name] = (("drop", "availability") if allowed and x.availability not in allowed else ("keep", "forced") if x.force_keep
                     else ("drop", "constant") if name not in varied else ("drop", "weak") if weak else ("keep", "signal"))
    def measure(name):
        return None if eta2.get(name) is None else round(eta2[name], 9)
    for a, b, _ in sorted(pairs, key=lambda p: (-round(abs(p[2]), 9), p[0], p[1])):
        if "drop" in (out[a][0], out[b][0]):
            continue
        ea, eb = measure(a), measure(b)
        weaker = a if ea is None or (eb is not None and eb > ea) else b
        if not CANDIDATES[weaker].force_keep:
            out[weaker] = ("drop", "redundant")
    return out


def _rules_sql() -> str:
    names = list(CANDIDATES)
    long = " UNION ALL ".join(f"SELECT '{c}' AS feature, round(CAST({c} AS DOUBLE) * {BIN_GRID}) / {BIN_GRID} AS x, {TARGET} AS y FROM tr "
                              f"WHERE {c} IS NOT NULL AND {TARGET} IS NOT NULL" for c in names)
    rs = " UNION ALL ".join(f"SELECT '{c}' AS feature, {_r_sql(f'CAST({c} AS DOUBLE)', TARGET)} AS r, count(DISTINCT {c}) AS nd FROM tr" for c in names)
    pairs = " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, {_r_sql(f'CAST({a} AS DOUBLE)', f'CAST({b} AS DOUBLE)')} AS pr FROM tr" for a, b in combinations(names, 2))
    meta = " UNION ALL ".join(f"SELECT '{n}' AS feature, '{x.availability}' AS availability, {str(x.force_keep).upper()} AS force_keep" for n, x in CANDIDATES.items())
    allowed = ", ".join(f"'{a}'" for a in DEPLOYABLE)
    return with_candidates(f""", tr AS MATERIALIZED (SELECT * FROM candidates WHERE data_split = 'train'),
lg AS ({long}), {ETA_CTES}, rs AS ({rs}), fmeta AS ({meta}),
metric AS MATERIALIZED (SELECT feature, r, nd, eta2, availability, force_keep FROM fmeta JOIN rs USING (feature) LEFT JOIN eta USING (feature)),
paths AS (SELECT unnest(['deployable', 'all']) AS path),
first AS MATERIALIZED (SELECT path, feature, r, eta2, force_keep, CASE WHEN path = 'deployable' AND availability NOT IN ({allowed}) THEN 'availability'
    WHEN force_keep THEN 'forced' WHEN nd < 2 THEN 'constant'
    WHEN (eta2 IS NULL OR eta2 < {MIN_ETA2}) AND (r IS NULL OR abs(r) < {MIN_R}) THEN 'weak' ELSE 'signal' END AS why FROM metric, paths),
strong AS MATERIALIZED (SELECT row_number() OVER (ORDER BY round(abs(pr), 9) DESC, a, b) AS i, a, b FROM ({pairs}) WHERE abs(pr) > {MAX_PAIR_R}),
judged AS MATERIALIZED (SELECT i, a, b, CASE WHEN ma.eta2 IS NULL OR (mb.eta2 IS NOT NULL AND round(mb.eta2, 9) > round(ma.eta2, 9)) THEN a ELSE b END AS weaker
  FROM strong JOIN metric ma ON ma.feature = a JOIN metric mb ON mb.feature = b),
walk AS (SELECT path, CAST(0 AS BIGINT) AS i, list(feature) FILTER (WHERE why IN ('availability', 'constant', 'weak')) AS gone,
    CAST([] AS VARCHAR[]) AS redundant FROM first GROUP BY path
  UNION ALL SELECT walk.path, judged.i,
    CASE WHEN skip THEN gone ELSE list_append(gone, weaker) END, CASE WHEN skip THEN redundant ELSE list_append(redundant, weaker) END
  FROM walk JOIN judged ON judged.i = walk.i + 1 JOIN metric m ON m.feature = judged.weaker,
    LATERAL (SELECT coalesce(list_contains(gone, a) OR list_contains(gone, b), FALSE) OR m.force_keep AS skip) s),
ended AS (SELECT path, redundant FROM walk QUALIFY row_number() OVER (PARTITION BY path ORDER BY i DESC) = 1)
SELECT path, feature, r, eta2, CASE WHEN list_contains(redundant, feature) OR why IN ('availability', 'constant', 'weak') THEN 'drop' ELSE 'keep' END AS decision,
  CASE WHEN list_contains(redundant, feature) THEN 'redundant' ELSE why END AS reason FROM first JOIN ended USING (path)""").replace("WITH ", "WITH RECURSIVE ", 1)


@register("selection_rules", _rules_sql(), round_cols=["r", "eta2"], ids="FSEL-06 FSEL-07 FEA-18 DQ-26")
def selection_rules(spark, sf):
    """Both selection paths over the 25 candidates: among the features a deployed model can have, and
    among all.  Metrics come from the train rows in Spark; the rules walk 25 of them."""
    f = candidate_frame(spark, sf).where("data_split = 'train'").select(TARGET, *[F.col(c).cast("double").alias(c) for c in CANDIDATES])
    names = list(CANDIDATES)
    m = mo.pair_moments(f, [*names, TARGET])
    r = {c: m.correlation(c, TARGET) for c in names}
    pairs = [(a, b, x) for a, b, x in mo.correlation_rows(m, list(combinations(names, 2))) if x is not None and abs(x) > MAX_PAIR_R]
    snapped = f.select(TARGET, *[(F.round(F.col(c) * F.lit(BIN_GRID)) / F.lit(BIN_GRID)).alias(c) for c in names])
    eta = {row["feature"]: row["eta2"] for row in stt.eta_squared(snapped, names, TARGET).collect()}
    spread = f.agg(*[F.min(c).alias(f"l_{c}") for c in names], *[F.max(c).alias(f"h_{c}") for c in names]).first()
    varied = {c for c in names if spread[f"l_{c}"] is not None and spread[f"l_{c}"] != spread[f"h_{c}"]}
    rows = [(path, n, r[n], eta.get(n), *d) for path, allowed in (("deployable", DEPLOYABLE), ("all", None))
            for n, d in decide(r, eta, varied, pairs, allowed).items()]
    return spark.createDataFrame(rows, "path string, feature string, r double, eta2 double, decision string, reason string")


# ---------------------------------------------------------------- provenance of the selection

def provenance_checks(features: list[str], window: DataFrame, candidates: DataFrame, first_year: int, last_year: int) -> DataFrame:
    """DQ-27: (check_name, passed): no forbidden column among the features, the selection window inside
    its years and in train only, no climatology of its own level on a place's first row of a month."""
    first = candidates.where("data_split = 'train'").groupBy(*LOC, "month").agg(F.min(F.struct("observation_date", "loc_climatology_imputed")).alias("f"))
    own = first.agg(F.bool_and(F.col("f.loc_climatology_imputed")).alias("passed"))
    w = window.agg(F.coalesce(F.bool_and(F.col("year").between(first_year, last_year)), F.lit(True)).alias("years"),
                   F.coalesce(F.bool_and(F.col("data_split") == "train"), F.lit(True)).alias("split"))
    clean = not set(features) & set(FORBIDDEN)
    return w.crossJoin(own).select(F.inline(F.array(*[F.struct(F.lit(n).alias("check_name"), c.alias("passed")) for n, c in (
        ("no_forbidden_feature", F.lit(clean)), ("window_inside_its_years", F.col("years")), ("window_in_train_only", F.col("split")),
        ("first_month_row_has_no_own_climatology", F.coalesce(F.col("passed"), F.lit(True))))])))


SELECTION_YEARS = (1997, TRAIN_END)


def _provenance_sql(scope: str, forbidden: bool, window: str) -> str:
    lo, hi = SELECTION_YEARS
    return f"""SELECT '{scope}' AS scope, 'no_forbidden_feature' AS check_name, {str(not forbidden).upper()} AS passed
UNION ALL SELECT '{scope}', 'window_inside_its_years', (SELECT count(*) FROM candidates WHERE {window} AND NOT year BETWEEN {lo} AND {hi}) = 0
UNION ALL SELECT '{scope}', 'window_in_train_only', (SELECT count(*) FROM candidates WHERE {window} AND data_split <> 'train') = 0
UNION ALL SELECT '{scope}', 'first_month_row_has_no_own_climatology', (SELECT count(*) FROM (SELECT loc_climatology_imputed FROM candidates
  WHERE data_split = 'train' QUALIFY row_number() OVER (PARTITION BY {LOC_SQL}, month ORDER BY observation_date) = 1) z
  WHERE NOT loc_climatology_imputed) = 0"""


_GOOD_WINDOW = f"year BETWEEN {SELECTION_YEARS[0]} AND {SELECTION_YEARS[1]}"
_BAD_WINDOW = f"year BETWEEN {SELECTION_YEARS[0]} AND {VALIDATION_END}"
PROVENANCE_SQL = with_candidates(f"""SELECT *, CASE WHEN passed THEN 'PASS' ELSE 'FAIL' END AS status FROM (
{_provenance_sql('as_built', False, _GOOD_WINDOW)} UNION ALL {_provenance_sql('with_faults', True, _BAD_WINDOW)}) z""")


@register("selection_provenance", PROVENANCE_SQL, ids="DQ-27 DQ-25 PRJ-17")
def selection_provenance(spark, sf):
    """The provenance tests on the selection as it is, which must pass, and on one that takes a forbidden
    column and a window reaching into validation, which must not."""
    f = candidate_frame(spark, sf)
    out = []
    for scope, features, window in (("as_built", list(CANDIDATES), _GOOD_WINDOW), ("with_faults", [*CANDIDATES, FORBIDDEN[0]], _BAD_WINDOW)):
        checks = provenance_checks(features, f.where(window), f, *SELECTION_YEARS)
        if scope == "as_built":
            dq.raise_on_fail(checks.withColumn("status", dq.status(F.col("passed"))), what="selection provenance")
        out.append(checks.select(F.lit(scope).alias("scope"), "check_name", "passed"))
    return reduce(DataFrame.unionByName, out).withColumn("status", dq.status(F.col("passed")))


# ---------------------------------------------------------------- leave-one-out levels

_LOO_N = f"CASE WHEN c.year <= {TRAIN_END} AND c.t IS NOT NULL THEN 1 ELSE 0 END"


def _loo(name: str, what: str) -> str:
    own = {"n": "1", "s": "c.t", "q": "c.t * c.t"}[what]
    return f"(coalesce({name}.{what}, 0) - CASE WHEN {_LOO_N} = 1 THEN {own} ELSE 0 END)"


def _loo_mean(name: str) -> str:
    return f"CASE WHEN {_loo(name, 'n')} > 0 THEN {_loo(name, 's')} / {_loo(name, 'n')} END"


def _loo_sums(name: str, keys: str) -> str:
    group = f" GROUP BY {keys}"
    return f"{name} AS (SELECT {keys}, count(t) AS n, sum(t) AS s, sum(t * t) AS q FROM c WHERE year <= {TRAIN_END}{group})"


LOO_LEVELS_SQL = with_clean(f""", c AS (SELECT {LOC_SQL}, observation_date, year, month, {TARGET} AS t, {_ZONE_SQL} AS zone FROM clean),
{_loo_sums('lm', LOC_SQL + ', month')}, {_loo_sums('l', LOC_SQL)}, {_loo_sums('zm', 'zone, month')}, {_loo_sums('m', 'month')}
SELECT {', '.join('c.' + k for k in LOC)}, c.observation_date, c.month,
  coalesce({_loo_mean('lm')}, {_loo_mean('zm')}, {_loo_mean('m')}) AS loo_climatology,
  CASE WHEN {_loo_mean('lm')} IS NOT NULL THEN 'location' WHEN {_loo_mean('zm')} IS NOT NULL THEN 'zone'
       WHEN {_loo_mean('m')} IS NOT NULL THEN 'month' END AS loo_level,
  {_loo_mean('l')} AS loo_mean,
  CASE WHEN {_loo('l', 'n')} > 1 THEN sqrt(greatest(({_loo('l', 'q')} - {_loo('l', 's')} * {_loo('l', 's')} / {_loo('l', 'n')})
    / ({_loo('l', 'n')} - 1), 0.0)) END AS loo_std
FROM c LEFT JOIN lm ON {' AND '.join(f'lm.{k} = c.{k}' for k in LOC)} AND lm.month = c.month
  LEFT JOIN l ON {' AND '.join(f'l.{k} = c.{k}' for k in LOC)}
  LEFT JOIN zm ON zm.zone IS NOT DISTINCT FROM c.zone AND zm.month = c.month LEFT JOIN m ON m.month = c.month""")


@register("leave_one_out_levels", LOO_LEVELS_SQL, round_cols=["loo_climatology", "loo_mean", "loo_std"], ids="WIN-05 WIN-06 FEA-10")
def leave_one_out_levels(spark, sf):
    return fe.leave_one_out_levels(clean_frame(spark, sf), TARGET, TRAIN_END)


# ---------------------------------------------------------------- metadata document, refused second load

def metadata_document(spark, sf) -> dict:
    """SNK-05: features with details, rules, split sizes and the fallback maps of the climatology (48 and
    12 values): all bounded by the contract, not by rows."""
    f = candidate_frame(spark, sf)
    bad = sorted(set(CANDIDATES) & set(FORBIDDEN))
    if bad:
        raise ValueError(f"forbidden columns among the features: {bad}")
    from isotherm.functions.labels import latitude_zone
    train = f.where("is_train_period").withColumn("zone", latitude_zone(F.abs("latitude")))
    zones = train.groupBy("zone", "month").agg(F.avg(TARGET).alias("v")).collect()
    months = train.groupBy("month").agg(F.avg(TARGET).alias("v")).collect()
    splits = f.groupBy("data_split").agg(F.count(F.lit(1)).alias("n")).collect()
    return {"target": TARGET, "features": list(CANDIDATES), "train_end": TRAIN_END, "validation_end": VALIDATION_END,
            "details": {n: {"group": x.group, "availability": x.availability, "description": x.description, "position": i}
                        for i, (n, x) in enumerate(CANDIDATES.items(), 1)},
            "rules": {"min_eta2": MIN_ETA2, "min_abs_r": MIN_R, "max_pair_r": MAX_PAIR_R},
            "split_rows": {r["data_split"]: r["n"] for r in splits},
            "fallback": {"zone_month": {f"{r['zone']}|{r['month']}": r["v"] for r in zones},
                         "month": {str(r["month"]): r["v"] for r in months}}}


METADATA_SQL = with_candidates(f"""SELECT 'feature' AS kind, feature AS name, CAST(position AS DOUBLE) AS value FROM (
  {' UNION ALL '.join(f"SELECT '{n}' AS feature, {i} AS position" for i, n in enumerate(CANDIDATES, 1))}) q
UNION ALL SELECT 'rule', * FROM (VALUES ('max_pair_r', {MAX_PAIR_R}), ('min_abs_r', {MIN_R}), ('min_eta2', {MIN_ETA2})) r
UNION ALL SELECT 'split_rows', data_split, CAST(count(*) AS DOUBLE) FROM candidates GROUP BY data_split
UNION ALL SELECT 'zone_month', {_ZONE_SQL} || '|' || CAST(month AS VARCHAR), avg({TARGET}) FROM candidates WHERE is_train_period GROUP BY ALL
UNION ALL SELECT 'month', CAST(month AS VARCHAR), avg({TARGET}) FROM candidates WHERE is_train_period GROUP BY ALL""")


@register("metadata_document", METADATA_SQL, round_cols=["value"], ids="SNK-05 SRC-12 PRJ-17")
def metadata_document_q(spark, sf):
    """The metadata document, written, read back with its required keys, and laid out as rows."""
    path = scratch_path(spark, f"metadata_{uuid.uuid4().hex}")
    io.write_json_document(spark, metadata_document(spark, sf), path)
    doc = io.read_json_contract(spark, path, ["target", "features", "details", "rules", "split_rows", "fallback"])
    rows = [("feature", n, float(doc["details"][n]["position"])) for n in doc["features"]]
    rows += [("rule", n, float(v)) for n, v in doc["rules"].items()] + [("split_rows", n, float(v)) for n, v in doc["split_rows"].items()]
    rows += [(kind, n, v) for kind, values in doc["fallback"].items() for n, v in values.items()]
    return spark.createDataFrame(rows, "kind string, name string, value double")


@register("load_once", with_sources("""SELECT CAST(1 AS BIGINT) AS attempt, TRUE AS loaded, count(*) AS table_rows FROM city_src
UNION ALL SELECT 2, FALSE, count(*) FROM city_src"""), ids="SRC-04")
def load_once(spark, sf):
    """Load a staging table, then load it again: the second load meets a table that is not empty and is
    refused before a row is written."""
    path = scratch_path(spark, f"staging_city_{uuid.uuid4().hex}")
    src = ds.city_source(spark, sf)
    out = []
    for attempt in (1, 2):
        loaded = io.load_into_empty(src, path)
        out.append((attempt, loaded, spark.read.parquet(path).count()))
    return spark.createDataFrame(out, "attempt long, loaded boolean, table_rows long")
