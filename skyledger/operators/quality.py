"""Data-quality checks over canonical flights.

A check offers `measures` (aggregates, all checks share one scan), `outcome` (status,
summary and details from the measures) and `rule` (which rows violate it) or
`violations` (the violating rows, when one row alone cannot tell).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import strip, to_number
from ..functions.times import zulu_text
from ..plans.staging import staged
from ..schema import CANONICAL, KEY, RAW_NUMERIC, REQUIRED
from .quantiles import iqr_fence

OK, WARN, FAIL = "OK", "WARN", "FAIL"
# Status of a dataset version per overall result.
QUALITY_STATUS = {OK: "validated", WARN: "quality_warn", FAIL: "quality_fail"}

_ORDINAL = {OK: 0, WARN: 1, FAIL: 2}
_OUTCOME = ("check_name", "status", "summary", "violation_count", "details")


def _outcome(name: str, status: Column, summary: Column, count: Column, details: Column) -> Column:
    return F.struct(
        F.lit(name).alias("check_name"),
        status.alias("status"),
        summary.alias("summary"),
        count.cast("long").alias("violation_count"),
        details.cast("string").alias("details"),
    )


def _fixed(name: str, status: str, summary: str) -> Column:
    return _outcome(name, F.lit(status), F.lit(summary), F.lit(0), F.lit(None))


class Check:
    """Base of all checks; subclass it to add one to a suite."""

    name: str
    severity = FAIL

    def measures(self, df: DataFrame) -> dict[str, Column]:
        return {}

    def outcome(self, df: DataFrame) -> Column:
        raise NotImplementedError

    def rule(self, df: DataFrame) -> Column | None:
        return None

    def violations(self, df: DataFrame) -> DataFrame | None:
        """All violating rows with `check_name`, None if the check names no rows."""
        rule = self.rule(df)
        return None if rule is None else df.where(rule).withColumn("check_name", F.lit(self.name))

    def result(self, df: DataFrame) -> DataFrame:
        return check_results(df, [self])

    def _m(self, key: str) -> Column:
        return F.col(f"{self.name}__{key}")


class SchemaCheck(Check):
    """All canonical columns, no others, no nulls in the required ones."""

    name = "schema"

    def __init__(self, expected: Sequence[str] = CANONICAL, required: Sequence[str] = REQUIRED):
        self.expected, self.required = expected, required

    def measures(self, df):
        return {f"null_{c}": F.count_if(F.col(c).isNull()) for c in self.required if c in df.columns}

    def outcome(self, df):
        columns = [c for c in df.columns if not c.startswith("_")]
        missing = sorted(set(self.expected) - set(columns))
        extra = sorted(set(columns) - set(self.expected))
        present = [c for c in sorted(self.required) if c in df.columns]
        counts = {c: self._m(f"null_{c}") for c in present}
        nulls = F.lit(0)
        for n in counts.values():
            nulls = nulls + n
        status = F.when(F.lit(bool(missing)) | (nulls > 0), F.lit(FAIL)).otherwise(WARN if extra else OK)
        messages = F.array_compact(
            F.array(
                F.lit("required columns are absent" if missing else None),
                F.lit("there are columns beyond the record" if extra else None),
                F.when(nulls > 0, F.lit("required columns hold nulls")),
            )
        )
        summary = F.when(F.size(messages) == 0, F.lit("the columns are those of the record")).otherwise(
            F.array_join(messages, "; ")
        )
        parts = []
        if missing:
            parts.append(F.array(*[F.lit(c) for c in missing]).alias("missing_columns"))
        if extra:
            parts.append(F.array(*[F.lit(c) for c in extra]).alias("unexpected_columns"))
        if counts:
            shown = F.struct(*[F.when(n > 0, n).alias(c) for c, n in counts.items()])
            parts.append(F.when(nulls > 0, shown).alias("null_counts"))
        details = F.nullif(F.to_json(F.struct(*parts)), F.lit("{}")) if parts else F.lit(None)
        return _outcome(self.name, status, summary, nulls, details)


class DurationRangeCheck(Check):
    """Durations within [minimum, maximum]; nulls pass (the schema check fails on them)."""

    name = "duration_range"

    def __init__(self, minimum: float = 1.0, maximum: float = 24 * 60):
        self.minimum, self.maximum = minimum, maximum

    def rule(self, df):
        if "duration_minutes" not in df.columns:
            return None
        d = F.col("duration_minutes")
        return (d < self.minimum) | (d > self.maximum)

    def measures(self, df):
        rule = self.rule(df)
        return {} if rule is None else {"bad": F.count_if(rule)}

    def outcome(self, df):
        if self.rule(df) is None:
            return _fixed(self.name, FAIL, "there is no column duration_minutes")
        bad = self._m("bad")
        details = F.to_json(
            F.struct(
                F.lit(float(self.minimum)).alias("minimum"),
                F.lit(float(self.maximum)).alias("maximum"),
                bad.alias("invalid_count"),
            )
        )
        return _outcome(
            self.name,
            F.when(bad > 0, FAIL).otherwise(OK),
            F.when(bad > 0, F.format_string("%d durations are out of range", bad)).otherwise(
                "every duration is in range"
            ),
            bad,
            details,
        )


class CoordinateRangeCheck(Check):
    """Latitude and longitude within the globe; nulls pass."""

    name = "coordinate_range"

    def rule(self, df):
        if not {"latitude", "longitude"} <= set(df.columns):
            return None
        bad = ~F.col("latitude").between(-90, 90)
        return F.coalesce(bad, F.lit(False)) | F.coalesce(~F.col("longitude").between(-180, 180), F.lit(False))

    def measures(self, df):
        rule = self.rule(df)
        return {} if rule is None else {"bad": F.count_if(rule)}

    def outcome(self, df):
        if self.rule(df) is None:
            return _fixed(self.name, WARN, "there are no coordinates")
        bad = self._m("bad")
        return _outcome(
            self.name,
            F.when(bad > 0, FAIL).otherwise(OK),
            F.when(bad > 0, F.format_string("%d coordinates are off the globe", bad)).otherwise(
                "every coordinate is on the globe"
            ),
            bad,
            F.when(bad > 0, F.to_json(F.struct(bad.alias("invalid_count")))),
        )


class UniquenessCheck(Check):
    """No two flights share (flight, start, region); null keys equal each other."""

    name = "uniqueness"

    def __init__(self, key: Sequence[str] = KEY):
        self.key = tuple(key)
        self._memo: tuple[DataFrame, DataFrame] | None = None

    def _missing(self, df) -> list[str]:
        return [c for c in self.key if c not in df.columns]

    def _repeated(self, df) -> DataFrame:
        # Written once per DataFrame: the outcome and the violations read it, the latter by its known size.
        # Hashes are counted first; only rows whose hash occurs more than once are grouped by the key.
        if self._memo is None or self._memo[0] is not df:
            hashed = df.select(*self.key, F.xxhash64(*self.key).alias("_hash"))
            hashes = hashed.groupBy("_hash").agg(F.count("*").alias("_n")).where("_n > 1").select("_hash")
            some = hashed.join(staged(hashes, "hashes"), "_hash", "left_semi")
            groups = some.groupBy(*self.key).agg(F.count("*").alias("_copies")).where("_copies > 1")
            self._memo = (df, staged(groups, "repeated_keys"))
        return self._memo[1]

    def violations(self, df):
        if self._missing(df):
            return None
        # Counting first keeps a hot key to one row; its members are then joined back.
        repeated = self._repeated(df).select(*[F.col(c).alias(f"_k_{c}") for c in self.key])
        same = F.lit(True)
        for c in self.key:
            same = same & F.col(c).eqNullSafe(F.col(f"_k_{c}"))
        rows = df.join(repeated, same, "left_semi")
        return rows.withColumn("check_name", F.lit(self.name))

    def outcome(self, df):
        missing = self._missing(df)
        if missing:
            return _fixed(self.name, FAIL, f"key columns are absent: {', '.join(missing)}")
        bad = self._repeated(df).agg(F.coalesce(F.sum("_copies"), F.lit(0))).scalar()
        return _outcome(
            self.name,
            F.when(bad > 0, FAIL).otherwise(OK),
            F.when(bad > 0, F.format_string("%d rows share their key", bad)).otherwise(
                "no two rows share a key"
            ),
            bad,
            F.when(bad > 0, F.to_json(F.struct(bad.alias("duplicate_count")))),
        )


class MonthlyCompletenessCheck(Check):
    """Every start time is known, and no month is missing between the first and last of a year."""

    name = "monthly_completeness"

    def rule(self, df):
        return F.col("start_time_utc").isNull() if "start_time_utc" in df.columns else None

    def measures(self, df):
        if self.rule(df) is None:
            return {}
        start = F.col("start_time_utc")
        # At most 12 entries per calendar year, whatever the number of flights.
        months = F.collect_set(F.year(start) * 12 + F.month(start) - 1)
        return {"bad": F.count_if(start.isNull()), "months": F.array_sort(months)}

    def outcome(self, df):
        if self.rule(df) is None:
            return _fixed(self.name, FAIL, "there is no column start_time_utc")
        bad, months = self._m("bad"), self._m("months")
        years = F.array_distinct(F.transform(months, lambda m: F.floor(m / 12)))

        def seen(y):
            return F.transform(
                F.filter(months, lambda m: F.floor(m / 12) == y), lambda m: (m % 12 + 1).cast("int")
            )

        def gaps(y):
            return F.array_except(F.sequence(F.array_min(seen(y)), F.array_max(seen(y))), seen(y))

        observed = F.map_from_entries(F.transform(years, lambda y: F.struct(y.cast("string"), seen(y))))
        missing = F.map_filter(
            F.map_from_entries(F.transform(years, lambda y: F.struct(y.cast("string"), gaps(y)))),
            lambda _, m: F.size(m) > 0,
        )
        gap_count = F.aggregate(F.map_values(missing), F.lit(0), lambda acc, m: acc + F.size(m))
        some_gap = F.size(missing) > 0
        details = (
            F.when(bad > 0, F.to_json(F.struct(bad.alias("invalid_count"))))
            .when(some_gap, F.to_json(F.struct(missing.alias("missing_months"), observed.alias("observed"))))
            .when(F.size(months) > 0, F.to_json(F.struct(observed.alias("observed"))))
        )
        return _outcome(
            self.name,
            F.when(bad > 0, FAIL).when(some_gap, WARN).otherwise(OK),
            F.when(bad > 0, "start times are unknown")
            .when(some_gap, "months without flights lie between others")
            .otherwise("no year has a gap between its months"),
            F.when(bad > 0, bad).otherwise(gap_count),
            details,
        )


class DurationOutlierCheck(Check):
    """Durations strictly outside the interquartile fence."""

    name = "duration_outliers"
    severity = WARN

    def __init__(self, width: float = 1.5):
        self.width = width
        self._memo: tuple[DataFrame, Column] | None = None

    def _bound(self, df, side: str) -> Column:
        # One row per DataFrame, written: results and violations both use it, in queries of their own.
        if self._memo is None or self._memo[0] is not df:
            fence = staged(iqr_fence(df, "duration_minutes", self.width), "fence")
            self._memo = (df, fence.select(F.struct("lower", "upper")).scalar())
        return self._memo[1].getField(side)

    def rule(self, df):
        if "duration_minutes" not in df.columns:
            return None
        d = F.col("duration_minutes")
        return (d < self._bound(df, "lower")) | (d > self._bound(df, "upper"))

    def measures(self, df):
        rule = self.rule(df)
        if rule is None:
            return {}
        return {"bad": F.count_if(rule), "values": F.count("duration_minutes")}

    def outcome(self, df):
        if "duration_minutes" not in df.columns:
            return _fixed(self.name, FAIL, "there is no column duration_minutes")
        bad, empty = self._m("bad"), self._m("values") == 0
        thresholds = F.struct(self._bound(df, "lower").alias("lower"), self._bound(df, "upper").alias("upper"))
        details = F.to_json(F.struct(thresholds.alias("thresholds"), bad.alias("outlier_count")))
        return _outcome(
            self.name,
            F.when(empty, WARN).when(bad > 0, WARN).otherwise(OK),
            F.when(empty, "there is no duration to compare")
            .when(bad > 0, F.format_string("%d durations are outside the fence", bad))
            .otherwise("every duration is inside the fence"),
            bad,
            F.when(~empty, details),
        )


def default_checks() -> list[Check]:
    return [
        SchemaCheck(),
        DurationRangeCheck(),
        CoordinateRangeCheck(),
        UniquenessCheck(),
        MonthlyCompletenessCheck(),
        DurationOutlierCheck(),
    ]


def counted_flights(flights: DataFrame, include_superseded: bool = False) -> DataFrame:
    """The rows a validation looks at; re-issued records are left out unless asked for."""
    return flights if include_superseded else flights.where(~F.col("superseded"))


def check_results(df: DataFrame, checks: Sequence[Check] | None = None) -> DataFrame:
    """One row per check: check_name, status, summary, violation_count, details (JSON).

    The measures of all checks are one aggregate over one scan.
    """
    checks = default_checks() if checks is None else list(checks)
    measures = [m.alias(f"{c.name}__{key}") for c in checks for key, m in c.measures(df).items()]
    row = df.agg(F.count("*").alias("_rows"), *measures)
    return row.select(F.inline(F.array(*[c.outcome(df) for c in checks])))


def violations(df: DataFrame, checks: Sequence[Check] | None = None) -> DataFrame:
    """Every violating flight row, once per check it violates, with `check_name`.

    Checks that decide row by row share one scan.
    """
    checks = default_checks() if checks is None else list(checks)
    rules = [(c, c.rule(df)) for c in checks]
    ruled = [F.when(rule, F.lit(c.name)) for c, rule in rules if rule is not None]
    parts = []
    if ruled:
        parts.append(df.withColumn("check_name", F.explode(F.array_compact(F.array(*ruled)))))
    parts += [v for v in (c.violations(df) for c, rule in rules if rule is None) if v is not None]
    if not parts:
        return df.where(F.lit(False)).withColumn("check_name", F.lit(None).cast("string"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _input_order(df: DataFrame) -> list[str]:
    first = ["_row_ord"] if "_row_ord" in df.columns else ["start_time_utc", "flight_id"]
    # All other columns make the order total.
    return first + [c for c in CANONICAL if c in df.columns and c not in first]


def sample_rows(found: DataFrame, limit: int = 5) -> DataFrame:
    """Per check the first `limit` violating rows in input order, as JSON."""
    w = Window.partitionBy("check_name").orderBy(*_input_order(found))
    first = found.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= limit)
    shown = [
        zulu_text(F.col(c)).alias(c) if c.endswith("_utc") else F.col(c)
        for c in CANONICAL
        if c in found.columns
    ]
    # At most `limit` rows per check are collected below.
    rows = F.transform(
        F.array_sort(F.collect_list(F.struct("_rank", F.struct(*shown).alias("row")))), lambda r: r.row
    )

    return first.groupBy("check_name").agg(F.to_json(rows).alias("sample_rows"))


def impacted(found: DataFrame) -> DataFrame:
    """Per check the regions of all its violating rows and how many flights they are.

    Regions are few, as the directory is; the flights themselves are in `flight_issues`.
    """
    per_region = found.groupBy("check_name", "region_code").agg(F.lit(1).alias("_one"))
    regions = per_region.groupBy("check_name").agg(
        F.array_sort(F.collect_set(F.when(F.col("region_code") != "", F.col("region_code")))).alias("impacted_regions")
    )
    flights = F.count_distinct(F.when(F.col("flight_id") != "", F.col("flight_id")))
    return regions.join(found.groupBy("check_name").agg(flights.alias("impacted_records")), "check_name")


def quality_report(df: DataFrame, checks: Sequence[Check] | None = None, limit: int = 5) -> DataFrame:
    """check_results with sample rows, and the regions and number of flights that violate each."""
    checks = default_checks() if checks is None else list(checks)
    return report_of(check_results(df, checks), violations(df, checks), limit)


def report_of(results: DataFrame, found: DataFrame, limit: int = 5) -> DataFrame:
    """The report from stored results and violations."""
    none = F.array().cast("array<string>")
    # One row per check on all sides.
    return results.join(sample_rows(found, limit), "check_name", "left").join(impacted(found), "check_name", "left").select(
        *_OUTCOME,
        "sample_rows",
        F.coalesce("impacted_regions", none).alias("impacted_regions"),
        F.coalesce("impacted_records", F.lit(0)).alias("impacted_records"),
    )


def flight_issues(df: DataFrame, checks: Sequence[Check] | None = None) -> DataFrame:
    """One row per flight and check it violates, from all violating rows."""
    checks = default_checks() if checks is None else list(checks)
    return issues_of(check_results(df, checks), violations(df, checks))


def issues_of(results: DataFrame, found: DataFrame) -> DataFrame:
    """The issues from stored results and violations."""
    found = (
        found.where(F.coalesce(F.col("flight_id"), F.lit("")) != "")
        .groupBy(F.col("flight_id").alias("flight_uid"), "check_name")
        .agg(F.count("*").alias("rows"))
    )
    results = results.select(
        "check_name",
        F.col("status").alias("severity"),
        F.to_json(F.struct("summary", "details")).alias("details"),
    )
    # One row per check: small whatever the number of flights.
    return found.join(F.broadcast(results), "check_name").select(
        "flight_uid", "check_name", "severity", "details"
    )


def ordered_issues(issues: DataFrame) -> DataFrame:
    return issues.orderBy("flight_uid", "check_name")


def overall(results: DataFrame) -> DataFrame:
    """One row: status (the worst), quality_status, warn_count, fail_count, total."""
    ordinal = F.create_map(*[F.lit(x) for pair in _ORDINAL.items() for x in pair])
    worst = F.coalesce(F.max(F.element_at(ordinal, F.col("status"))), F.lit(0))
    label = F.element_at(F.array(*[F.lit(s) for s in _ORDINAL]), worst + 1)
    stored = F.create_map(*[F.lit(x) for pair in QUALITY_STATUS.items() for x in pair])
    row = results.agg(
        label.alias("status"),
        F.count_if(F.col("status") == WARN).alias("warn_count"),
        F.count_if(F.col("status") == FAIL).alias("fail_count"),
    )
    return row.select(
        "status",
        F.element_at(stored, F.col("status")).alias("quality_status"),
        "warn_count",
        "fail_count",
        (F.col("warn_count") + F.col("fail_count")).alias("total"),
    )


def mixed_type_columns(raw: DataFrame, columns: Sequence[str] = RAW_NUMERIC) -> DataFrame:
    """Per numeric raw column: filled cells, cells that are no number, WARN if only some are."""
    cols = [c for c in columns if c in raw.columns]

    def filled(c: str) -> Column:
        return strip(F.col(c)) != ""

    counts = raw.agg(
        *[F.count_if(filled(c)).alias(f"{c}__filled") for c in cols],
        *[F.count_if(filled(c) & to_number(F.col(c)).isNull()).alias(f"{c}__text") for c in cols],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.col(f"{c}__filled").alias("filled"),
                F.col(f"{c}__text").alias("not_numeric"),
            )
            for c in cols
        ]
    )
    mixed = (F.col("not_numeric") > 0) & (F.col("not_numeric") < F.col("filled"))
    return counts.select(F.inline(rows)).withColumn("status", F.when(mixed, WARN).otherwise(OK))


def source_review(cells: DataFrame, files: DataFrame | None = None, width: int = 12) -> DataFrame:
    """Per source: rows, header width, FAIL if degraded or empty, WARN if the width is off.

    `files` (column `path`) adds the sources that gave no row at all.
    """
    found = cells.groupBy(F.col("_src_path").alias("path")).agg(
        F.count("*").alias("rows"),
        F.max(F.size("header")).alias("width"),
        F.bool_or(F.coalesce("_src_degraded", F.lit(False))).alias("degraded"),
    )
    if files is not None:
        found = files.select("path").join(found, "path", "left")
    rows = F.coalesce(F.col("rows"), F.lit(0))
    degraded = F.coalesce(F.col("degraded"), F.lit(False))
    status = (
        F.when((rows == 0) | degraded, FAIL)
        .when(F.col("width") != width, WARN)
        .otherwise(OK)
    )
    return found.select("path", rows.alias("rows"), "width", degraded.alias("degraded"), status.alias("status"))


def loaded_review(raw: DataFrame, files: DataFrame) -> DataFrame:
    """Per file of a load: rows, and FAIL if it is degraded or gave none. `files` has a column `path`."""
    found = raw.groupBy(F.col("_src_path").alias("path")).agg(
        F.count("*").alias("rows"), F.bool_or(F.coalesce("_src_degraded", F.lit(False))).alias("degraded")
    )
    rows, degraded = F.coalesce("rows", F.lit(0)), F.coalesce("degraded", F.lit(False))
    status = F.when((rows == 0) | degraded, FAIL).otherwise(OK)
    return files.select("path").join(found, "path", "left").select(
        "path", rows.alias("rows"), degraded.alias("degraded"), status.alias("status")
    )


def sources_outcome(review: DataFrame) -> DataFrame:
    """The review of the sources as one more row of the report."""
    bad = F.count_if(F.col("status") == FAIL)
    none = F.array().cast("array<string>")
    return review.agg(bad.alias("violation_count")).select(
        F.lit("sources").alias("check_name"),
        F.when(F.col("violation_count") > 0, FAIL).otherwise(OK).alias("status"),
        F.when(F.col("violation_count") > 0, F.format_string("%d sources are damaged or empty", "violation_count"))
        .otherwise("every source gave rows").alias("summary"),
        "violation_count",
        F.lit(None).cast("string").alias("details"),
        F.lit(None).cast("string").alias("sample_rows"),
        none.alias("impacted_regions"),
        F.lit(0).cast("long").alias("impacted_records"),
    )


def storage_key_audit(flights: DataFrame) -> DataFrame:
    """Flights that pass deduplication yet share their id with another start time or region."""
    return (
        flights.where(~F.col("superseded"))
        .groupBy("flight_id")
        .agg(
            F.count("*").alias("rows"),
            F.min("start_time_utc").alias("first_start"),
            F.max("start_time_utc").alias("last_start"),
        )
        .where("rows > 1")
    )


def anomalies(rows: DataFrame, year: int | None = None) -> DataFrame:
    """Counts per rule over typed rows (see `normalize.type_rows`), in long form."""
    minutes = F.col("duration_minutes")
    other_year = F.lit(False) if year is None else F.year("start_time_utc") != year
    rules = {
        "zero_duration": minutes == 0,
        "negative_duration": (minutes < 0) | (F.col("end_time_utc") < F.col("start_time_utc")),
        "coordinates_out_of_range": ~F.col("latitude").between(-90, 90)
        | ~F.col("longitude").between(-180, 180),
        "outside_batch_year": other_year,
    }
    counts = rows.agg(
        F.count("*").alias("rows"),
        *[F.count_if(F.coalesce(rule, F.lit(False))).alias(name) for name, rule in rules.items()],
    )
    pairs = F.array(
        *[F.struct(F.lit(name).alias("anomaly"), F.col(name).alias("n")) for name in rules]
    )
    return counts.select("rows", F.inline(pairs))
