"""Engagement by a rolling state: the last observations of each id in one row.

A day is merged with the state of an earlier one by a single grouping on id, which
gives the day's engagement and the state that the next day starts from. The
look-back window need not be read again, and the day's rows are shuffled once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadlake.functions.casts import lenient
from threadlake.functions.numbers import (
    hours_between,
    midnight,
    not_below_zero,
    round_half_even,
)
from threadlake.operators.temporal import LONG_TAIL_HOURS
from threadlake.schemas import PARTITION_COLUMN
from threadlake.sources.readers import days_before


def _long(df: DataFrame, column: str) -> Column:
    number = lenient(F.col(column), T.LongType(), df.schema[column].dataType)
    return F.coalesce(number, F.lit(0).cast("long"))


def merge_observations(
    target: DataFrame,
    history: DataFrame | None,
    state: DataFrame | None,
    date: str,
    days: int,
    state_days: Sequence[str] | None = None,
    order: Sequence[str] = (),
) -> DataFrame:
    """One row per id: ``seen`` (day, score, descendants; oldest first), ``today``, ``row``.

    ``target`` holds the rows of ``date``, of which ``row`` is one (null where the
    day has none, ``today`` tells). Earlier days, ``days`` at most, come from
    ``state`` (id, seen), of which only ``state_days`` count if given, and from
    rows of ``history``; both together should name a day once. Of several rows
    of one id and day the greatest by ``order`` counts, in ``history`` then by score
    and descendants. Numbers that are none count as 0; a null id is an id.

    Everything is reduced before the shuffle to a row per id and map task, with
    one place for each day, so neither a hot id nor a repeated row gathers.
    """
    earlier = days_before(date, days)
    kept = earlier if state_days is None else [d for d in earlier if d in set(state_days)]
    places = [f"_place_{k}" for k in range(days)]
    plain = target.where(F.col(PARTITION_COLUMN) == date).withColumns(
        {column: _long(target, column) for column in ("score", "descendants")}
    )
    rank = F.struct(*order) if order else None
    rank_type = plain.select(rank.alias("r")).schema["r"].dataType if order else None

    def place(values: Column, ranked: Column | None) -> Column:
        fields = [values["score"].alias("score"), values["descendants"].alias("descendants")]
        if rank_type is not None:
            fields.insert(0, (F.lit(None) if ranked is None else ranked).cast(rank_type).alias("rank"))
        return F.struct(*fields)

    value_type = T.StructType(
        [T.StructField("score", T.LongType()), T.StructField("descendants", T.LongType())]
    )
    if rank_type is not None:
        value_type = T.StructType([T.StructField("rank", rank_type), *value_type.fields])
    nothing = F.lit(None).cast(value_type)
    row = F.struct(*[F.col(c) for c in plain.columns])
    row_type = plain.select(row.alias("r")).schema["r"].dataType

    def stacked(df: DataFrame, slots: list[Column], of_day: bool) -> DataFrame:
        columns = [F.col("id")] + [
            slot.cast(value_type).alias(name) for name, slot in zip(places, slots, strict=True)
        ]
        columns.append((row if of_day else F.lit(None).cast(row_type)).alias("row"))
        if rank_type is not None:
            columns.append((rank if of_day else F.lit(None).cast(rank_type)).alias("_rank"))
        return df.select(*columns)

    both = stacked(plain, [nothing] * days, True)
    if state is not None:

        def of_state(day: str) -> Column:
            if day not in kept:
                return nothing
            found = F.get(F.filter("seen", lambda s: s["day"] == day), F.lit(0))
            return F.when(found.isNotNull(), place(found, None))

        both = both.unionByName(stacked(state, [of_state(d) for d in earlier], False))
    if history is not None:
        values = F.struct(
            _long(history, "score").alias("score"), _long(history, "descendants").alias("descendants")
        )
        past = history.where(F.col(PARTITION_COLUMN).isin(earlier))
        slots = [F.when(F.col(PARTITION_COLUMN) == d, place(values, rank)) for d in earlier]
        both = both.unionByName(stacked(past, slots, False))

    of_day = F.max_by("row", "_rank") if order else F.first("row", ignorenulls=True)
    merged = both.groupBy("id").agg(of_day.alias("row"), *[F.max(p).alias(p) for p in places])

    def seen(day: str, values: Column) -> Column:
        entry = F.struct(
            F.lit(day).alias("day"), values["score"].alias("score"), values["descendants"].alias("descendants")
        )
        return F.when(values.isNotNull(), entry)

    entries = [seen(d, F.col(p)) for d, p in zip(earlier, places, strict=True)]
    entries.append(seen(date, F.col("row")))
    return merged.select(
        "id", F.array_compact(F.array(*entries)).alias("seen"), F.col("row").isNotNull().alias("today"), "row"
    ).where(F.size("seen") > 0)


def engagement_of(merged: DataFrame) -> DataFrame:
    """The day's rows of ``merge_observations`` with the columns of ``engagement_metrics``."""
    last, before = F.get("seen", F.size("seen") - 1), F.get("seen", F.size("seen") - 2)

    def change(column: str) -> Column:
        return F.coalesce(last[column] - before[column], F.lit(0))

    ranked = F.transform(
        "seen", lambda s: F.struct((-s["score"]).alias("low_first"), s["day"].alias("day"))
    )
    created = F.col("time").cast("timestamp")
    age = hours_between(midnight(F.col(PARTITION_COLUMN)), created)
    to_peak = hours_between(midnight(F.col("_peak")), created)
    return (
        merged.where("today")
        .select(
            "row.*",
            change("score").alias("score_velocity"),
            change("descendants").alias("comment_velocity"),
            F.size("seen").cast("long").alias("observations_in_window"),
            F.array_min(ranked)["day"].alias("_peak"),
        )
        .withColumns(
            {
                "hours_to_peak": not_below_zero(round_half_even(to_peak, 2)),
                "is_long_tail": F.coalesce(age > LONG_TAIL_HOURS, F.lit(False))
                & (F.col("comment_velocity") > 0),
            }
        )
        .drop("_peak")
    )


def state_of(merged: DataFrame, date: str, days: int) -> DataFrame:
    """``id, seen`` as the day after ``date`` needs it: ids without a recent day are gone."""
    needed = {*days_before(date, days)[1:], date}
    oldest = min(needed)
    recent = F.filter("seen", lambda s: s["day"] >= oldest)
    return merged.select("id", recent.alias("seen")).where(F.size("seen") > 0)


def past_count(merged: DataFrame) -> int:
    """How many earlier observations went in."""
    past = F.sum(F.size("seen") - F.col("today").cast("int"))
    return merged.agg(F.coalesce(past, F.lit(0))).first()[0]
