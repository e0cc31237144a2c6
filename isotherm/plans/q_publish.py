"""Queries: write-audit-publish of the clean table, its constraints and before / after audit, contracts
that stop a load, and the inventory of the stages that were written."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isotherm.operators import clean as cl
from isotherm.operators import publish as pb
from isotherm.operators import quality as dq
from isotherm.operators.star import ENRICHED_COLUMNS
from isotherm.plans import materialize as mat
from isotherm.plans.driver_star import build_star
from isotherm.plans.oracle_sources import with_star
from isotherm.plans.q_audit import TOP_N, _agg_ctes, _aggregates, _city_rows
from isotherm.plans.q_clean import _CELLS, _CRIT_ANY, _DOMAIN_SQL, _KEY, _NEGSUM, clean_frame, with_clean
from isotherm.plans.registry import register
from isotherm.session import scratch_path

TEMP = "city_average_temperature"
FLAGS = ["city_uncertainty_available", "country_temperature_available", "global_temperature_available",
         "major_city_temperature_available", "city_temperature_iqr_outlier"]
CLEAN_COLUMNS = [*ENRICHED_COLUMNS, *FLAGS]
NOT_NULL = [*cl.BUSINESS_KEY, "year", "month", "quarter", "decade", "is_major_city", TEMP, *cl.MATCH_COLUMNS, *FLAGS]


def _checks() -> dict:
    """The CHECK constraints of the clean table."""
    return {"month": F.col("month").between(1, 12), "quarter": F.col("quarter").between(1, 4),
            "latitude": F.col("latitude").between(-90, 90), "longitude": F.col("longitude").between(-180, 180),
            TEMP: F.col(TEMP).between(-90, 60), "major_city_matched": ~F.col("is_major_city") | F.col("major_city_matched"),
            "only_major_matched": F.col("is_major_city") | ~F.col("major_city_matched")}


def clean_spec() -> pb.AuditSpec:
    outside = lambda c, lo, hi: ~F.coalesce(F.col(c).between(lo, hi), F.lit(False))
    logic = (~F.coalesce(dq.calendar_consistency(), F.lit(False))
             | F.coalesce(F.col("is_major_city") != F.col("major_city_matched"), F.lit(False))
             | F.coalesce(~dq.order_consistency("land_min_temperature", "land_average_temperature", "land_max_temperature"),
                          F.lit(False)))
    return pb.AuditSpec(
        key=cl.BUSINESS_KEY, critical=cl.CRITICAL, non_negative=cl.UNCERTAINTY,
        invalid={"invalid_coordinates": outside("latitude", -90, 90) | outside("longitude", -180, 180),
                 "invalid_city_temperature": outside(TEMP, -90, 60), "logic_invalid_rows": logic},
        reported={"iqr_outliers_retained": F.col("city_temperature_iqr_outlier")})


# Faults for the audit: the months of one year, one fault each.
FAULT_YEAR = 1995


def with_faults(clean: DataFrame) -> DataFrame:
    """The clean table with a hot reading, a lost latitude, a negative uncertainty, repeated rows and a wrong
    quarter, each in one month of ``FAULT_YEAR``."""
    at = lambda m: (F.col("year") == FAULT_YEAR) & (F.col("month") == m)
    bad = {TEMP: F.when(at(1), F.lit(99.0)).otherwise(F.col(TEMP)),
           "latitude": F.when(at(2), F.lit(None).cast("double")).otherwise(F.col("latitude")),
           f"{TEMP}_uncertainty": F.when(at(3), F.lit(-1.0)).otherwise(F.col(f"{TEMP}_uncertainty")),
           "quarter": F.when(at(5), F.lit(4).cast(clean.schema["quarter"].dataType)).otherwise(F.col("quarter"))}
    return clean.select(*[bad[c].alias(c) if c in bad else F.col(c) for c in clean.columns]).unionByName(clean.where(at(4)))


_FAULTY = f""", faulty AS (SELECT * REPLACE (
  CASE WHEN year = {FAULT_YEAR} AND month = 1 THEN 99.0 ELSE {TEMP} END AS {TEMP},
  CASE WHEN year = {FAULT_YEAR} AND month = 2 THEN NULL ELSE latitude END AS latitude,
  CASE WHEN year = {FAULT_YEAR} AND month = 3 THEN -1.0 ELSE {TEMP}_uncertainty END AS {TEMP}_uncertainty,
  CASE WHEN year = {FAULT_YEAR} AND month = 5 THEN 4 ELSE quarter END AS quarter) FROM clean
  UNION ALL SELECT * FROM clean WHERE year = {FAULT_YEAR} AND month = 4)"""
_LOGIC = ("NOT coalesce(year = year(observation_date) AND month = month(observation_date) AND quarter = quarter(observation_date) "
          "AND decade = (year(observation_date) // 10) * 10, FALSE) OR coalesce(is_major_city <> major_city_matched, FALSE) "
          "OR coalesce(land_min_temperature > land_average_temperature AND land_max_temperature IS NOT NULL, FALSE) "
          "OR coalesce(land_average_temperature > land_max_temperature AND land_min_temperature IS NOT NULL, FALSE)")


def _audit_sql(table: str) -> list[tuple[str, str, bool]]:
    out = lambda c, lo, hi: f"NOT coalesce({c} BETWEEN {lo} AND {hi}, FALSE)"
    return [("rows", f"(SELECT count(*) FROM {table})", False),
            ("columns", f"CAST({len(CLEAN_COLUMNS)} AS BIGINT)", False),
            ("critical_missing_rows", f"(SELECT count(*) FILTER (WHERE {_CRIT_ANY}) FROM {table})", True),
            ("business_duplicate_rows", f"(SELECT count(*) - count(DISTINCT row({_KEY})) FROM {table})", True),
            ("exact_full_row_duplicates",
             f"((SELECT count(*) FROM {table}) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {table}) q))", True),
            ("invalid_coordinates", f"(SELECT count(*) FILTER (WHERE {out('latitude', -90, 90)} OR "
                                    f"{out('longitude', -180, 180)}) FROM {table})", True),
            ("invalid_city_temperature", f"(SELECT count(*) FILTER (WHERE {out(TEMP, -90, 60)}) FROM {table})", True),
            ("negative_uncertainty_cells", f"(SELECT CAST(coalesce(sum({_NEGSUM}), 0) AS BIGINT) FROM {table})", True),
            ("logic_invalid_rows", f"(SELECT count(*) FILTER (WHERE {_LOGIC}) FROM {table})", True),
            ("iqr_outliers_retained", f"(SELECT count(*) FILTER (WHERE city_temperature_iqr_outlier) FROM {table})", False)]


def _audit_rows(table: str, attempt: int) -> str:
    return " UNION ALL ".join(f"SELECT CAST({attempt} AS BIGINT) AS attempt, '{n}' AS check_name, {sql} AS result, "
                              f"{str(z).upper()} AS required_zero" for n, sql, z in _audit_sql(table))


PUBLISH_SQL = with_clean(f"""{_FAULTY}, consistent AS (SELECT * FROM clean WHERE NOT ({_LOGIC})),
a AS ({_audit_rows('consistent', 1)} UNION ALL {_audit_rows('clean', 2)} UNION ALL {_audit_rows('faulty', 3)}),
p AS (SELECT attempt, bool_and(NOT required_zero OR result = 0) AS published, max(result) FILTER (WHERE check_name = 'rows') AS n
  FROM a GROUP BY attempt),
seen AS (SELECT x.attempt, x.published, coalesce(arg_max(y.n, y.attempt) FILTER (WHERE y.published), 0) AS readable_rows
  FROM p x JOIN p y ON y.attempt <= x.attempt GROUP BY ALL)
SELECT attempt, check_name, result, required_zero,
  CASE WHEN required_zero AND result <> 0 THEN 'FAIL' ELSE 'PASS' END AS status, published, readable_rows FROM a JOIN seen USING (attempt)""")


@register("publish_clean", PUBLISH_SQL, ids="SNK-04 DQ-20 DQ-04")
def publish_clean(spark, sf):
    """Three loads of the published table: the clean rows whose flags agree, all clean rows, and rows with
    injected faults.  An audit that fails raises and leaves the version before it readable."""
    path = scratch_path(spark, f"published_clean_{uuid.uuid4().hex}")
    clean, spec = clean_frame(spark, sf).select(*CLEAN_COLUMNS), clean_spec()
    out = []
    for attempt, frame in enumerate((clean.where(~spec.invalid["logic_invalid_rows"]), clean, with_faults(clean)), 1):
        try:
            report, published = pb.write_audit_publish(frame, path, spec, NOT_NULL, _checks(), CLEAN_COLUMNS), True
        except pb.AuditFailed as e:
            report, published = e.report, False
        readable = pb.read_published(spark, path).count() if pb.published_version(spark, path) else 0
        out.append(report.select(
            F.lit(attempt).cast("long").alias("attempt"), "check_name", "result", "required_zero",
            dq.status(~F.col("required_zero") | (F.col("result") == 0)).alias("status"),
            F.lit(published).alias("published"), F.lit(readable).cast("long").alias("readable_rows")))
    pb.drop_unpublished(spark, path)
    return reduce(DataFrame.unionByName, out)


def _constraints_sql(table: str) -> str:
    checks = {"month": "month BETWEEN 1 AND 12", "quarter": "quarter BETWEEN 1 AND 4", "latitude": "latitude BETWEEN -90 AND 90",
              "longitude": "longitude BETWEEN -180 AND 180", TEMP: f"{TEMP} BETWEEN -90 AND 60",
              "major_city_matched": "NOT is_major_city OR major_city_matched", "only_major_matched": "is_major_city OR NOT major_city_matched"}
    parts = [f"SELECT 'not_null:{c}' AS constraint_name, count(*) FILTER (WHERE {c} IS NULL) AS violations FROM {table}" for c in NOT_NULL]
    parts += [f"SELECT 'check:{n}', count(*) FILTER (WHERE NOT ({sql})) FROM {table}" for n, sql in checks.items()]
    return " UNION ALL ".join(parts)


@register("clean_constraints", with_clean(_FAULTY + " SELECT z.constraint_name, z.violations AS clean_violations, "
                                          f"y.violations AS faulty_violations FROM ({_constraints_sql('clean')}) z "
                                          f"JOIN ({_constraints_sql('faulty')}) y USING (constraint_name)"), ids="SNK-04")
def clean_constraints(spark, sf):
    """Violations of the clean table's NOT NULL and CHECK constraints, and of the same with faults."""
    clean = clean_frame(spark, sf)
    counts = [pb.constraint_violations(f, NOT_NULL, _checks()).withColumnRenamed("violations", f"{n}_violations")
              for n, f in (("clean", clean), ("faulty", with_faults(clean)))]
    return counts[0].join(counts[1], "constraint_name")


_METRICS = [("rows", "count(*)"), ("all_missing_cells", None), ("critical_missing_rows", f"count(*) FILTER (WHERE {_CRIT_ANY})"),
            ("business_duplicate_rows", f"count(*) - count(DISTINCT row({_KEY}))"),
            ("invalid_core_or_logic_rows", f"count(*) FILTER (WHERE NOT ({_DOMAIN_SQL}) OR {_LOGIC})"),
            ("negative_uncertainty_cells", f"CAST(coalesce(sum({_NEGSUM}), 0) AS BIGINT)")]
_FLAG_CELLS = " + ".join(f"CAST({c} IS NULL AS BIGINT)" for c in FLAGS)


def _before_after_sql() -> str:
    parts = []
    for name, sql in _METRICS:
        before = sql or f"CAST(sum({_CELLS}) AS BIGINT)"
        after = sql or f"CAST(sum({_CELLS} + {_FLAG_CELLS}) AS BIGINT)"
        zero = name in ("critical_missing_rows", "business_duplicate_rows", "invalid_core_or_logic_rows", "negative_uncertainty_cells")
        want = "(SELECT b FROM want)" if name == "rows" else "0" if zero else "NULL"
        parts.append(f"SELECT '{name}' AS metric, (SELECT {before} FROM enriched) AS before_value, (SELECT {after} FROM clean) AS after_value, "
                     f"CAST({want} AS BIGINT) AS expected_after")
    parts.append(f"SELECT 'columns', CAST({len(ENRICHED_COLUMNS)} AS BIGINT), CAST({len(CLEAN_COLUMNS)} AS BIGINT), CAST({len(CLEAN_COLUMNS)} AS BIGINT)")
    parts.append("SELECT 'iqr_outliers', NULL, (SELECT count(*) FILTER (WHERE city_temperature_iqr_outlier) FROM clean), NULL")
    return with_clean(f""", want AS (SELECT count(DISTINCT row({_KEY})) AS b FROM enriched WHERE NOT ({_CRIT_ANY}) AND {_DOMAIN_SQL}),
ba AS ({' UNION ALL '.join(parts)})
SELECT *, CASE WHEN expected_after IS NULL THEN 'REPORTED' WHEN after_value = expected_after THEN 'PASS' ELSE 'FAIL' END AS status FROM ba""")


@register("before_after", _before_after_sql(), ids="DQ-21 DQ-23 DQ-20")
def before_after(spark, sf):
    """Every metric before and after cleaning, what it has to be after, and whether it is: the rows that
    are left must be the distinct keys of the complete, in-domain rows of the view."""
    spec = clean_spec()
    enriched, clean = build_star(spark, sf).enriched(), clean_frame(spark, sf)
    invalid = spec.invalid["logic_invalid_rows"] | ~cl.domain_ok(cl.DOMAIN)
    any_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cl.CRITICAL])
    negative = reduce(lambda a, b: a + b, [F.when(F.col(c) < 0, 1).otherwise(0) for c in cl.UNCERTAINTY])

    def side(df, name):
        cells = reduce(lambda a, b: a + b, [F.col(c).isNull().cast("long") for c in df.columns])
        one = df.agg(F.count(F.lit(1)).alias("rows"), F.lit(len(df.columns)).cast("long").alias("columns"),
                     F.sum(cells).cast("long").alias("all_missing_cells"), F.count_if(any_null).alias("critical_missing_rows"),
                     (F.count(F.lit(1)) - F.count_distinct(F.struct(*cl.BUSINESS_KEY))).alias("business_duplicate_rows"),
                     F.count_if(F.coalesce(invalid, F.lit(False))).alias("invalid_core_or_logic_rows"),
                     F.coalesce(F.sum(negative), F.lit(0)).cast("long").alias("negative_uncertainty_cells"),
                     (F.count_if("city_temperature_iqr_outlier") if name == "after_value" else F.lit(None).cast("long")).alias("iqr_outliers"))
        return dq.unpivot_one_row(one, "metric", name)

    good = enriched.where(~any_null & cl.domain_ok(cl.DOMAIN)).agg(F.count_distinct(F.struct(*cl.BUSINESS_KEY)).alias("__rows"))
    zero = ["critical_missing_rows", "business_duplicate_rows", "invalid_core_or_logic_rows", "negative_uncertainty_cells"]
    expected = (F.when(F.col("metric") == "rows", F.col("__rows")).when(F.col("metric") == "columns", F.lit(len(CLEAN_COLUMNS)))
                .when(F.col("metric").isin(zero), F.lit(0)).cast("long"))
    both = side(enriched, "before_value").join(side(clean, "after_value"), "metric").crossJoin(F.broadcast(good))
    return both.select("metric", "before_value", "after_value", expected.alias("expected_after")).withColumn(
        "status", F.when(F.col("expected_after").isNull(), F.lit("REPORTED")).otherwise(dq.status(F.col("after_value") == F.col("expected_after"))))


# ---------------------------------------------------------------- contracts that stop a load

CONTRACT_SQL = with_star(f"""
, ranked AS (SELECT NULLIF(trim(country), '') AS country, count(*) AS n FROM city_src GROUP BY 1),
manifest AS (SELECT country, n, row_number() OVER (ORDER BY n DESC, country) AS row_rank FROM ranked
  WHERE country IS NOT NULL ORDER BY n DESC, country LIMIT {TOP_N}),
m AS (SELECT 'manifest_rows' AS metric, CAST({TOP_N} AS DOUBLE) AS expected, CAST((SELECT count(*) FROM manifest) AS DOUBLE) AS actual
  UNION ALL SELECT 'manifest_ranks', {TOP_N}, (SELECT count(DISTINCT row_rank) FROM manifest)
  UNION ALL SELECT 'rows_after_filter', (SELECT sum(n) FROM manifest),
    (SELECT count(*) FROM city_src WHERE NULLIF(trim(country), '') IN (SELECT country FROM manifest))
  UNION ALL SELECT 'countries_after_filter', {TOP_N},
    (SELECT count(DISTINCT NULLIF(trim(country), '')) FROM city_src WHERE NULLIF(trim(country), '') IN (SELECT country FROM manifest)))
SELECT metric, expected, actual, CASE WHEN expected = actual THEN 'PASS' ELSE 'FAIL' END AS status FROM m""")


def load_contract(rows: DataFrame, key: str, top_n: int) -> DataFrame:
    """DQ-04 / DQ-06: the manifest has exactly N rows and ranks, the filtered stage the manifest's rows
    and its N entities.  Returns metric, expected, actual, status."""
    from isotherm.operators import aggregate as agg
    manifest = agg.ranked_counts(rows.where(F.col(key).isNotNull()), key, top_n).where("in_top")
    kept = rows.join(F.broadcast(manifest.select(key)), key, "left_semi")      # N rows
    m = manifest.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("row_rank").alias("r"), F.sum("row_count").alias("s"))
    k = kept.agg(F.count(F.lit(1)).alias("k"), F.count_distinct(key).alias("c"))
    entry = lambda name, want, got: F.struct(F.lit(name).alias("metric"), want.cast("double").alias("expected"), got.cast("double").alias("actual"))
    n = F.lit(top_n)
    long = m.crossJoin(k).select(F.inline(F.array(
        entry("manifest_rows", n, F.col("n")), entry("manifest_ranks", n, F.col("r")),
        entry("rows_after_filter", F.col("s"), F.col("k")), entry("countries_after_filter", n, F.col("c")))))
    return long.withColumn("status", dq.status(F.col("expected") == F.col("actual")))


@register("load_contract", CONTRACT_SQL, ids="DQ-04 DQ-06")
def load_contract_q(spark, sf):
    """The contract of the filtered load; a failed row stops the query."""
    return dq.raise_on_fail(load_contract(_city_rows(spark, sf), "country", TOP_N), what="load contract")


# ---------------------------------------------------------------- inventory of written stages

#: Expected stages by group.  ``state_src`` is a source of the data set that nothing loads: the
#: inventory has to report it.
EXPECTED = {
    "staging_tables": ["city_src", "major_src", "country_src", "global_src", "state_src"],
    "dimension_tables": ["dim_date", "dim_country", "dim_city"],
    "fact_tables": ["fact_city", "fact_major", "fact_country", "fact_global"],
    "unified_view": ["enriched"],
    "aggregates": ["agg_global_yearly", "agg_global_decadal", "agg_country_yearly", "agg_city_yearly", "agg_major_city_yearly"],
}
_AGG_CTE = {"agg_global_yearly": "a_gy", "agg_global_decadal": "a_gd", "agg_country_yearly": "a_cy",
            "agg_city_yearly": "a_ci", "agg_major_city_yearly": "a_mc"}


def build_stages(spark, sf) -> None:
    s = build_star(spark, sf)
    s.enriched()
    for name, (df, _) in _aggregates(s).items():
        mat.stage(spark, f"agg_{name}", sf, lambda df=df: df)


def inventory(spark, sf) -> DataFrame:
    """JON-10: every expected stage LEFT JOIN the manifest of what was written."""
    expected = spark.createDataFrame([(g, n) for g, names in EXPECTED.items() for n in names], "object_group string, stage string")
    found = mat.manifest(spark, sf).select("stage", "rows", "columns", "files")
    return expected.join(found, "stage", "left")


def _inventory_sql() -> str:
    parts = []
    for group, names in EXPECTED.items():
        for n in names:
            rows = "CAST(NULL AS BIGINT)" if n == "state_src" else f"(SELECT count(*) FROM {_AGG_CTE.get(n, n)})"
            parts.append(f"SELECT '{group}' AS object_group, '{n}' AS object_name, {rows} AS rows")
    return with_star(_agg_ctes() + f", inv AS ({' UNION ALL '.join(parts)})\n")


@register("stage_inventory", _inventory_sql() + "SELECT *, CASE WHEN rows IS NOT NULL THEN 'PASS' ELSE 'FAIL' END AS status FROM inv",
          ids="JON-10 DQ-12")
def stage_inventory(spark, sf):
    """Each expected stage with the rows its manifest entry reports; one that was not written FAILs."""
    build_stages(spark, sf)
    return inventory(spark, sf).select("object_group", F.col("stage").alias("object_name"), "rows",
                                       dq.status(F.col("rows").isNotNull()).alias("status"))


@register("object_check", _inventory_sql() + """SELECT object_group, count(*) AS expected, count(rows) AS found,
  CASE WHEN count(*) = count(rows) THEN 'PASS' ELSE 'FAIL' END AS status FROM inv GROUP BY object_group""", ids="JON-10 DQ-12")
def object_check(spark, sf):
    """Expected and found stages per group, from the manifest of what was written."""
    build_stages(spark, sf)
    return inventory(spark, sf).groupBy("object_group").agg(
        F.count(F.lit(1)).alias("expected"), F.count("rows").alias("found")).withColumn(
        "status", dq.status(F.col("expected") == F.col("found")))
