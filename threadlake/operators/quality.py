"""Data-quality checks as data: a suite is a list of specs.

All counts of a suite are one Spark query: the plain ones share a single pass,
and key checks (unique, reference) count per key first and run beside it.
Sample ids are fetched only for checks that failed.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadlake.functions.casts import lenient_double
from threadlake.operators.integrity import count_unmatched, key_set, rows_without_key
from threadlake.schemas import CHECK_RESULT, QUALITY_REPORT
from threadlake.session import rows_frame, stage

CRITICAL, WARNING = "critical", "warning"
SAMPLE_SIZE = 10  # fixed value


class QualityError(Exception):
    """A critical check failed."""


@dataclass
class CheckResult:
    name: str
    passed: bool
    severity: str
    description: str
    affected_records: int = 0
    details: dict[str, str] = field(default_factory=dict)
    sample_ids: list[int] = field(default_factory=list)

    def to_dict(self) -> dict:
        return asdict(self)


def _text(value: object) -> str | None:
    """A detail as text; lists as JSON."""
    if value is None or isinstance(value, str):
        return value
    return json.dumps(value)


def _is_missing(df: DataFrame, column: str) -> Column:
    value = F.col(column)
    if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)):
        return value.isNull() | F.isnan(value)
    return value.isNull()


def _any_of(conditions: Sequence[Column]) -> Column:
    combined = conditions[0]
    for condition in conditions[1:]:
        combined = combined | condition
    return combined


def _first_ids(rows: DataFrame, size: int) -> list[int]:
    """The smallest ``size`` ids, repeats included."""
    if "id" not in rows.columns:
        return []
    ids = rows.select(F.col("id").try_cast("bigint").alias("id")).where("id is not null")
    return [row["id"] for row in ids.orderBy("id").limit(size).collect()]


@dataclass(frozen=True)
class NotNull:
    """No nulls in any of the columns."""

    columns: Sequence[str]
    severity: str = CRITICAL
    name = "check_not_null"

    def absent(self, df):
        return [column for column in self.columns if column not in df.columns]

    def bad(self, df):
        return _any_of([_is_missing(df, column) for column in self.columns])

    def count(self, df):
        return F.count_if(self.bad(df))

    def samples(self, df, size):
        return _first_ids(df.where(self.bad(df)), size)

    def details(self, measured):
        return {"columns_checked": list(self.columns)}

    def describe(self):
        return f"nulls in {', '.join(self.columns)}"


@dataclass(frozen=True)
class Unique:
    """No two rows with the same key; nulls are equal. All of them count."""

    columns: Sequence[str]
    severity: str = CRITICAL
    name = "check_unique"

    def absent(self, df):
        return [column for column in self.columns if column not in df.columns]

    def repeated(self, df):
        return df.groupBy(*self.columns).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")

    def query(self, df):
        return self.repeated(df).agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("affected"))

    def samples(self, df, size):
        repeated = self.repeated(df)
        if "id" in self.columns:
            # The key tells the ids: repeat each as often as the sample can hold.
            copies = F.least(F.col("_n"), F.lit(size)).cast("int")
            top = repeated.where("id is not null").orderBy("id").limit(size)
            return _first_ids(top.select("id", F.explode(F.array_repeat(F.lit(1), copies))), size)
        # Staged, so that the rows of a much repeated key can be split over tasks.
        repeated, _ = stage(repeated.select(*self.columns), "repeated")
        match = [df[column].eqNullSafe(repeated[column]) for column in self.columns]
        return _first_ids(df.join(repeated, match, "left_semi"), size)

    def details(self, measured):
        return {"columns_checked": list(self.columns)}

    def describe(self):
        return f"repeated keys ({', '.join(self.columns)})"


@dataclass(frozen=True)
class InRange:
    """Numbers within inclusive bounds; null passes, and so does what is no number."""

    column: str
    min_value: float | None = None
    max_value: float | None = None
    severity: str = WARNING
    name = "check_range"

    def absent(self, df):
        return [] if self.column in df.columns else [self.column]

    def bad(self, df):
        value = F.col(self.column)
        if isinstance(df.schema[self.column].dataType, T.StringType):
            value = lenient_double(value)
        elif isinstance(df.schema[self.column].dataType, (T.DoubleType, T.FloatType)):
            value = F.nanvl(value, F.lit(None).cast("double"))
        outside = [F.lit(False)]
        if self.min_value is not None:
            outside.append(value < F.lit(self.min_value))
        if self.max_value is not None:
            outside.append(value > F.lit(self.max_value))
        return F.coalesce(_any_of(outside), F.lit(False))

    def count(self, df):
        return F.count_if(self.bad(df))

    def samples(self, df, size):
        return _first_ids(df.where(self.bad(df)), size)

    def details(self, measured):
        return {
            "column": self.column, "min_value": self.min_value, "max_value": self.max_value
        }

    def describe(self):
        return f"values of {self.column} out of range"


@dataclass(frozen=True)
class RefersTo:
    """Every child key is a key of ``parent``; a null child key is not."""

    parent: DataFrame
    child_key: str
    parent_key: str
    severity: str = CRITICAL
    name = "check_referential_integrity"

    def absent(self, df):
        return [
            key
            for key, frame in ((self.child_key, df), (self.parent_key, self.parent))
            if key not in frame.columns
        ]

    def query(self, df):
        counts = count_unmatched(df, self.child_key, self.parent, self.parent_key)
        return counts.select(F.struct("unmatched", "parents").alias("counts"))

    def samples(self, df, size):
        keys = key_set(self.parent, key=self.parent_key)
        return _first_ids(rows_without_key(df, self.child_key, keys), size)

    def details(self, measured):
        known = {"child_key": self.child_key, "parent_key": self.parent_key}
        if measured is not None:
            known["valid_parent_count"] = measured["parents"]
        return known

    def describe(self):
        return f"{self.child_key} without a matching {self.parent_key}"


@dataclass(frozen=True)
class Volume:
    """At least ``min_expected`` rows; the shortfall counts as affected."""

    entity: str
    min_expected: int
    severity: str = WARNING
    name = "check_volume"

    def absent(self, df):
        return []

    def details(self, measured):
        return {
            "entity": self.entity, "actual_count": measured, "min_expected": self.min_expected
        }

    def describe(self):
        return f"fewer than {self.min_expected} rows of {self.entity}"


CheckSpec = NotNull | Unique | InRange | RefersTo | Volume


def measurements(df: DataFrame, specs: Sequence[CheckSpec]) -> DataFrame:
    """One row: ``total`` and one column ``m<i>`` per spec that needs counting.

    Checks of keys are answered together, by one scan and one shuffle of the rows: each row
    is stacked as one entry for every check of keys and one for all plain counts, the parents'
    keys come beside them, and entries are counted by check and key. Map tasks combine
    before the shuffle, so a key sends one entry per check and task however often it occurs.
    """
    present = [(n, spec) for n, spec in enumerate(specs) if not spec.absent(df)]
    plain = [(n, spec) for n, spec in present if hasattr(spec, "count")]
    queried = [(n, spec) for n, spec in present if hasattr(spec, "query")]
    stacked = [(n, spec) for n, spec in queried if _stackable(df, spec)]
    beside = [spec.query(df).scalar().alias(f"m{n}") for n, spec in queried if (n, spec) not in stacked]
    if not stacked:
        counted = df.agg(F.count(F.lit(1)).alias("total"), *[spec.count(df).alias(f"m{n}") for n, spec in plain])
    else:
        counted = _stacked_counts(df, plain, stacked)
    return counted.select("*", *beside)


_PLAIN = -1  # the entry of a row that is counted by no key


def _stackable(df: DataFrame, spec: CheckSpec) -> bool:
    """Whether child and parent keys have a common type without reading text as numbers."""
    if not isinstance(spec, RefersTo):
        return True
    kinds = (df.schema[spec.child_key].dataType, spec.parent.schema[spec.parent_key].dataType)
    return kinds[0] == kinds[1] or all(isinstance(kind, T.IntegralType) for kind in kinds)


def _key_kinds(df: DataFrame, spec: CheckSpec) -> list[tuple[str, T.DataType]]:
    if isinstance(spec, RefersTo):
        kinds = [df.schema[spec.child_key].dataType, spec.parent.schema[spec.parent_key].dataType]
        return [(spec.child_key, kinds[0] if kinds[0] == kinds[1] else T.LongType())]
    return [(column, df.schema[column].dataType) for column in spec.columns]


def _stacked_counts(df: DataFrame, plain: list, stacked: list) -> DataFrame:
    kinds = {n: _key_kinds(df, spec) for n, spec in stacked}
    names = {n: [f"_k{n}_{j}" for j in range(len(kinds[n]))] for n in kinds}

    def entry(check: int, keys: dict[str, Column], bad: dict[int, Column]) -> Column:
        """A struct with the same fields for every check; those of others are null."""
        fields = [F.lit(check).alias("_check")]
        for n in kinds:
            for name, (_, kind) in zip(names[n], kinds[n]):
                fields.append(keys.get(name, F.lit(None)).cast(kind).alias(name))
        fields += [bad.get(n, F.lit(0)).cast("long").alias(f"_m{n}") for n, _ in plain]
        return F.struct(*fields)

    flags = {n: F.when(spec.bad(df), 1).otherwise(0) for n, spec in plain}
    entries = [entry(_PLAIN, {}, flags)]
    for n in kinds:
        entries.append(entry(n, {name: F.col(c) for name, (c, _) in zip(names[n], kinds[n])}, {}))
    rows = df.select(F.inline(F.array(*entries))).withColumn("_row", F.lit(1)).withColumn("_parent", F.lit(0))
    for n, spec in stacked:
        if isinstance(spec, RefersTo):
            key = F.col(spec.parent_key)
            own = spec.parent.where(key.isNotNull()).select(F.inline(F.array(entry(n, {names[n][0]: key}, {}))))
            rows = rows.unionByName(own.withColumn("_row", F.lit(0)).withColumn("_parent", F.lit(1)))
    every = [name for n in kinds for name in names[n]]
    grouped = rows.groupBy("_check", *every).agg(
        F.sum("_row").alias("_rows"),
        F.max("_parent").alias("_parent"),
        *[F.sum(f"_m{n}").alias(f"_m{n}") for n, _ in plain],
    )

    def total(value: Column, where: Column) -> Column:
        return F.coalesce(F.sum(F.when(where, value)), F.lit(0)).cast("long")

    check, rows_of, parent = F.col("_check"), F.col("_rows"), F.col("_parent") == 1
    columns = [total(rows_of, check == _PLAIN).alias("total")]
    columns += [total(F.col(f"_m{n}"), check == _PLAIN).alias(f"m{n}") for n, _ in plain]
    for n, spec in stacked:
        if isinstance(spec, RefersTo):
            columns.append(
                F.struct(
                    total(rows_of, (check == n) & ~parent).alias("unmatched"),
                    total(F.lit(1), (check == n) & parent).alias("parents"),
                ).alias(f"m{n}")
            )
        else:
            columns.append(total(rows_of, (check == n) & (rows_of > 1)).alias(f"m{n}"))
    return grouped.agg(*columns)


def run_suite(
    df: DataFrame, specs: Sequence[CheckSpec], sample_size: int = SAMPLE_SIZE
) -> list[CheckResult]:
    """The result of every spec, in order."""
    row = measurements(df, specs).first()
    results = []
    for position, spec in enumerate(specs):
        absent = spec.absent(df)
        measured = row["total"] if isinstance(spec, Volume) else None
        if absent:
            affected = row["total"]
        elif isinstance(spec, Volume):
            affected = max(0, spec.min_expected - measured)
        else:
            measured = row[f"m{position}"]
            affected = measured["unmatched"] if isinstance(spec, RefersTo) else measured
        passed = affected == 0 and not absent
        details = spec.details(measured)
        if absent:
            details["missing_columns"] = absent
        needs_sample = not passed and not absent and hasattr(spec, "samples")
        results.append(
            CheckResult(
                name=spec.name,
                passed=passed,
                severity=spec.severity,
                description=(
                    f"missing columns: {', '.join(absent)}"
                    if absent
                    else ("no " if passed else "") + spec.describe()
                ),
                affected_records=affected,
                details={key: _text(value) for key, value in details.items()},
                sample_ids=spec.samples(df, sample_size) if needs_sample else [],
            )
        )
    return results


# The standard suites.


def story_suite() -> list[CheckSpec]:
    return [
        NotNull(["id", "type", "time", "ingestion_date"]),
        Unique(["id", "ingestion_date"]),
        InRange("score", min_value=0),
        InRange("descendants", min_value=0),
        Volume("stories", 1),
    ]


def comment_suite(parents: DataFrame) -> list[CheckSpec]:
    return [
        NotNull(["id", "type", "time", "parent", "ingestion_date"]),
        Unique(["id", "ingestion_date"]),
        RefersTo(parents, "parent", "id"),
        Volume("comments", 1),
    ]


def enriched_story_suite() -> list[CheckSpec]:
    return [
        NotNull(
            [
                "score_velocity", "comment_velocity", "hours_to_peak",
                "is_long_tail", "observations_in_window",
            ]
        ),
        InRange("hours_to_peak", min_value=0),
        InRange("observations_in_window", min_value=1),
        Volume("stories_enriched", 1),
    ]


def enriched_comment_suite() -> list[CheckSpec]:
    return [
        NotNull(["sentiment_score", "sentiment_label"]),
        InRange("sentiment_score", min_value=-1, max_value=1),
        Volume("comments_enriched", 1),
    ]


# Reports over results.


def check_table(spark: SparkSession, results: Sequence[CheckResult]) -> DataFrame:
    return rows_frame(spark, [result.to_dict() for result in results], CHECK_RESULT)


def build_report(checks: DataFrame, date: str, generated_at: str) -> DataFrame:
    """One row per report: totals, tally per entity, and the checks themselves.

    The entity is taken from a check's details; most carry none ("unknown").
    """
    entity = F.coalesce(F.col("details")["entity"], F.lit("unknown"))
    tally = (
        checks.groupBy(entity.alias("entity"))
        .agg(
            F.count_if("passed").alias("passed"), F.count_if(~F.col("passed")).alias("failed")
        )
        .agg(
            F.map_from_entries(
                F.collect_list(F.struct("entity", F.struct("passed", "failed")))
            ).alias("entities")
        )
    )
    critical = ~F.col("passed") & (F.col("severity") == CRITICAL)
    totals = checks.agg(
        F.count(F.lit(1)).alias("total_checks"),
        F.count_if("passed").alias("passed_checks"),
        F.count_if(~F.col("passed")).alias("failed_checks"),
        (F.count_if(critical) > 0).alias("has_critical_failures"),
        F.collect_list(F.struct(*CHECK_RESULT.fieldNames())).alias("checks"),
    )
    report = totals.select(
        F.lit(date).alias("ingestion_date"),
        F.lit(generated_at).alias("generated_at"),
        "*",
        tally.scalar().alias("entities"),
    )
    return report.select(*QUALITY_REPORT.fieldNames())


def has_critical_failures(results: Sequence[CheckResult]) -> bool:
    return any(not result.passed and result.severity == CRITICAL for result in results)


def gate(results: Sequence[CheckResult], what: str) -> None:
    """Raise if a critical check failed. Save the report before calling this."""
    if has_critical_failures(results):
        failed = [r.name for r in results if not r.passed and r.severity == CRITICAL]
        raise QualityError(f"critical checks failed for {what}: {', '.join(failed)}")
