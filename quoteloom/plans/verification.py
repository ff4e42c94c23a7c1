"""One verification report over a landed table: (source, check, status, detail)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators import continuity, quality
from ..operators.blocks import join_keys
from ..operators.gaps import present
from ..sinks.store import read_table
from ..streaming import state


def expected_seconds(exchange: Column, data_type: Column) -> Column:
    """Expected seconds between records; null for sources without an expectation."""
    table = F.create_map(
        *[F.lit(x) for e, d, s in quality.EXPECTED_SECONDS for x in (f"{e}|{d}", s)]
    )
    return F.try_element_at(table, F.concat_ws("|", exchange, data_type))


def is_multi_instrument(exchange: Column, data_type: Column) -> Column:
    out = F.lit(False)
    for e, d in quality.MULTI_INSTRUMENT:
        out = out | ((exchange == e) & (data_type == d))
    return out


def _verdicts(flags: DataFrame, stats: DataFrame, keys: list[str]) -> DataFrame:
    """Status, continuity and coverage rows from one row of figures per source."""
    status = quality.source_status(flags, keys).select(
        *keys,
        F.lit("status").alias("check"),
        "status",
        F.concat(F.col("total_rows").cast("string"), F.lit(" rows")).alias("detail"),
    )
    issues = continuity.continuity_issues(stats, F.col("_sec") * 1000)
    both = continuity.coverage(issues, F.col("_sec"), is_multi_instrument(F.col("exchange"), F.col("data_type")))
    found = F.array(
        F.struct(
            F.lit("continuity").alias("check"),
            F.when(F.size("issues") == 0, "OK").otherwise("WARNING").alias("status"),
            F.array_join("issues", "; ").alias("detail"),
        ),
        F.struct(
            F.lit("coverage").alias("check"),
            F.col("coverage_status").alias("status"),
            F.format_string("%.1f%%", F.col("coverage_pct")).alias("detail"),
        ),
    )
    # The outer form adds no filter on the array, which would be pushed down and repeat it.
    return status.unionByName(both.select(*keys, F.inline_outer(found)))


def _expecting(stats: DataFrame) -> DataFrame:
    expected = stats.withColumn("_sec", expected_seconds(F.col("exchange"), F.col("data_type")))
    return expected.filter(F.col("_sec").isNotNull())


def report(landed: DataFrame, keys: list[str], arrival: str, on: str = "timestamp") -> DataFrame:
    """Status, continuity and coverage of every source as rows of one table.

    Three aggregations of the table (flags; distinct times, which continuity and coverage
    share; arrival order), then only rows per source.
    """
    expecting = _expecting(continuity.continuity_stats(landed, on, keys))
    ordered = join_keys(expecting, continuity.arrival_order(landed, arrival, on, keys), keys, "inner")
    return _verdicts(quality.source_flags(landed, keys, on), ordered, keys)


# -- kept up to date ---------------------------------------------------------------------


def summarise(
    rows: DataFrame, keys: list[str], arrival: str, on: str = "timestamp", day: str = "date", columns: Sequence[str] = quality.NULL_CHECKED
) -> DataFrame:
    """One row per source and date with all that the report asks, in a form that merges over
    dates: counts add up, and the gap and the order between two dates follow from their first
    and last times and arrivals.  Rows without a time are counted, but stand in no order."""
    by = [*keys, day]
    used = [c for c in columns if c in rows.columns]
    timed = rows.where(F.col(on).isNotNull())
    arrived = F.when(F.col(on).isNotNull(), F.col(arrival))
    zero = F.count_if((F.col(on) >= 0) & (F.col(on) < quality.DAY_MS))
    flags = present(rows, used).groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"), F.map_from_arrays(F.array(*map(F.lit, used)), F.array(*map(F.count, used))).alias("present"),
        zero.alias("epoch_zero"), F.min(arrived).alias("first_arrival"), F.max(arrived).alias("last_arrival"),
    )
    stats = continuity.continuity_stats(timed, on, by).drop("dup_count")
    order = continuity.arrival_order(timed, arrival, on, by).drop("backward_steps")
    return join_keys(join_keys(flags, stats, by), order, by)


def refresh(
    batch: DataFrame, table: str, summaries: str, version: int, keys: list[str], arrival: str, parts: list[str] | None = None,
    on: str = "timestamp", day: str = "date",
) -> None:
    """Bring the summaries of a table in line with a batch that was just merged into it.

    Only the partitions of the batch's dates are listed and only the sources and dates that
    it holds are read again; their summary rows are replaced in a state table, as its batch
    ``version`` (numbers grow from one refresh to the next).
    """
    spark, by = batch.sparkSession, [*keys, day]
    touched = batch.select(*by).distinct()
    first, last, undated = touched.agg(F.min(day), F.max(day), F.count_if(F.col(day).isNull())).first()
    inside = F.col(day).between(first, last)
    rows = read_table(spark, table, parts).where(inside | F.col(day).isNull() if undated else inside)
    rows = join_keys(rows, touched, by, "left_semi")
    state.put(summarise(rows, keys, arrival, on, day), version, summaries, by)


def merged(summaries: DataFrame, keys: list[str], day: str = "date") -> DataFrame:
    """The summaries of a source's dates as one: a row per source, of the columns that the
    operators on whole tables give.  The window holds a source's dates, not its rows."""
    dates = Window.partitionBy(*keys or [F.lit(0)]).orderBy(F.col("ts_min").isNull(), "ts_min")
    before = F.lag("ts_max").over(dates)
    follows = F.coalesce(F.col("first_arrival") > F.lag("last_arrival").over(dates), F.lit(True))
    gap = F.struct(F.col("max_gap_ms").alias("gap"), (-F.col("max_gap_at")).alias("at"))
    edge = F.when(before.isNotNull() & F.col("ts_min").isNotNull(), F.struct((F.col("ts_min") - before).alias("gap"), (-before).alias("at")))
    stepped = summaries.withColumns({"_gap": F.greatest(gap, edge), "_follows": F.coalesce("monotonic", F.lit(True)) & follows})
    long = F.explode("present").alias("_column", "_n")
    present_rows = summaries.select(*keys, "rows", long).groupBy(*keys, "_column").agg(F.sum("rows").alias("_rows"), F.sum("_n").alias("_n"))
    many = F.coalesce(F.try_divide(F.col("_rows") - F.col("_n"), F.col("_rows")) > 0.5, F.lit(False))
    warned = present_rows.groupBy(*keys).agg(F.count_if(many).alias("warnings"))
    whole = stepped.groupBy(*keys).agg(
        F.sum("rows").alias("rows"), (F.sum("epoch_zero") > 0).cast("long").alias("errors"),
        F.sum("total_rows").alias("total_rows"), F.sum("unique_ts").alias("unique_ts"),
        F.min("ts_min").alias("ts_min"), F.max("ts_max").alias("ts_max"), F.max("_gap").alias("_gap"), F.bool_and("_follows").alias("monotonic"),
    )
    whole = whole.withColumns(
        {
            "dup_count": F.col("total_rows") - F.col("unique_ts"),
            "max_gap_ms": F.coalesce("_gap.gap", F.lit(0).cast("long")),
            "max_gap_at": F.when(F.col("_gap.gap") > 0, -F.col("_gap.at")),
        }
    ).drop("_gap")
    out = join_keys(whole, warned, keys) if keys else whole.crossJoin(warned)
    return out.withColumn("warnings", F.coalesce("warnings", F.lit(0).cast("long")))


def report_from(summaries: DataFrame, keys: list[str], day: str = "date") -> DataFrame:
    """The report of ``report``, from summaries that ``refresh`` keeps; the table isn't read."""
    whole = merged(summaries, keys, day)
    stats = _expecting(whole.where(F.col("ts_min").isNotNull()))
    return _verdicts(whole.select(*keys, "rows", "warnings", "errors"), stats, keys)
