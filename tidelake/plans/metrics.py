"""Throughput and latency of the pipeline, read from its own tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidelake.operators.percentiles import exact_percentiles
from tidelake.plans.gold import Tables

LEVELS = {"p50_s": 0.50, "p95_s": 0.95, "p99_s": 0.99}
# Upper bounds of the latency histogram, in seconds.
BOUNDS = (0, 5, 10, 25, 50, 75, 100, 250, 500, 750, 1000, 2500, 5000, 7500, 10000)


def seconds_between(first: Column, last: Column) -> Column:
    return (F.unix_micros(last) - F.unix_micros(first)).cast("double") / F.lit(1e6)


def _rates(counted: DataFrame) -> DataFrame:
    """Rows per second over the span, which counts as at least one second."""
    span = seconds_between(F.col("first_at"), F.col("last_at"))
    return counted.withColumns({
        "duration_s": F.round(span, 1),
        "rows_per_sec": F.round(F.col("row_count").cast("double") / F.greatest(span, F.lit(1.0)), 1),
        "is_clamped": span < 1.0,
    }).drop("first_at", "last_at")


def _counted(moment: Column) -> list[Column]:
    return [F.count("*").alias("row_count"), F.min(moment).alias("first_at"), F.max(moment).alias("last_at")]


def log_throughput(events: DataFrame) -> DataFrame:
    """Rows per second into each table of the event log. A span under a second is flagged."""
    counted = events.groupBy(F.col("source_table").alias("table_name")).agg(*_counted(F.col("_cdc_ingested_at")))
    return _rates(counted)


def log_span(events: DataFrame) -> DataFrame:
    """The same over all tables together."""
    return _rates(events.agg(*_counted(F.col("_cdc_ingested_at")))).withColumnRenamed("row_count", "total_rows")


def state_throughput(tables: Tables) -> DataFrame:
    """Rows per second into each current-state table, from the time rows were last updated."""
    moment = F.col("_silver_updated_at").cast("timestamp")
    parts = [
        rows.agg(*_counted(moment)).select(F.lit(name).alias("table_name"), "row_count", "first_at", "last_at")
        for name, rows in tables.items()
    ]
    return _rates(reduce(DataFrame.unionByName, parts).filter(F.col("row_count") > 0))


def _latency_micros() -> Column:
    return F.try_subtract(F.unix_micros("_cdc_ingested_at"), F.try_multiply(F.col("_cdc_source_ts_ms"), F.lit(1000)))


def _measurable(events: DataFrame) -> DataFrame:
    """Events with a commit time; one that is no number of milliseconds (it overflows) is left out,
    which ``measured_rows`` shows."""
    return events.filter((F.col("_cdc_source_ts_ms") > 0) & _latency_micros().isNotNull())


def commit_latency(events: DataFrame) -> DataFrame:
    """Seconds from commit at the source to the log: exact percentiles."""
    exact = exact_percentiles(_measurable(events), _latency_micros(), list(LEVELS.values()), list(LEVELS))
    return exact.select(*[F.round(F.col(n) / 1e6, 2).alias(n) for n in LEVELS], "measured_rows")


def commit_latency_approx(events: DataFrame, accuracy: int = 10_000) -> DataFrame:
    """The same from a mergeable sketch of fixed size; the rank error is at most 1/accuracy."""
    marks = F.percentile_approx(_latency_micros(), list(LEVELS.values()), accuracy)
    found = _measurable(events).agg(marks.alias("marks"), F.count("*").alias("measured_rows"))
    return found.select(
        *[F.round(F.col("marks")[i] / 1e6, 2).alias(n) for i, n in enumerate(LEVELS)], "measured_rows"
    )


def approx_rank_check(events: DataFrame, accuracy: int = 10_000) -> DataFrame:
    """Whether each value of the sketch stands within its rank error: three numbers, then one pass."""
    found = _measurable(events).agg(F.percentile_approx(_latency_micros(), list(LEVELS.values()), accuracy).alias("marks")).first()
    marks = dict(zip(LEVELS, found["marks"] or [None] * len(LEVELS)))
    ranks = _measurable(events).agg(
        F.count("*").alias("measured_rows"),
        *[F.count_if(_latency_micros() < mark).alias(f"{n}_below") for n, mark in marks.items()],
        *[F.count_if(_latency_micros() <= mark).alias(f"{n}_upto") for n, mark in marks.items()],
    )
    slack = F.col("measured_rows") / accuracy + 1

    def in_bounds(name: str, level: float) -> Column:
        rank = F.col("measured_rows") * level
        return (F.col(f"{name}_below") - slack <= rank) & (rank <= F.col(f"{name}_upto") + slack)

    return ranks.select(*[in_bounds(n, level).alias(f"{n}_in_bounds") for n, level in LEVELS.items()], "measured_rows")


# Rank error of a sketch of this size is about 2.3 / SKETCH_SIZE ^ 0.9, in one of a hundred cases more.
SKETCH_SIZE = 400
SKETCH_SLACK = 0.02


def hourly_sketches(events: DataFrame, size: int = SKETCH_SIZE) -> DataFrame:
    """Per table and hour of arrival a quantile sketch of the commit latency: some kilobytes, whatever the rows.

    Sketches are made map-side and can be stored; :func:`span_latency` merges those of any span
    without the events.
    """
    return _measurable(events).groupBy(
        F.col("source_table").alias("table_name"), F.date_trunc("hour", "_cdc_ingested_at").cast("timestamp_ntz").alias("hour")
    ).agg(F.kll_sketch_agg_bigint(_latency_micros(), F.lit(size)).alias("sketch"), F.count("*").alias("measured_rows"))


def span_latency(sketches: DataFrame, *group: str | Column) -> DataFrame:
    """Percentiles in seconds over stored hours, by ``group``."""
    merged = sketches.groupBy(*group).agg(F.kll_merge_agg_bigint("sketch").alias("sketch"), F.sum("measured_rows").alias("measured_rows"))
    marks = [F.round(F.kll_sketch_get_quantile_bigint("sketch", F.lit(level)) / 1e6, 6).alias(name) for name, level in LEVELS.items()]
    return merged.select(*[c for c in merged.columns if c not in ("sketch", "measured_rows")], *marks, "measured_rows")


def sketch_rank_check(events: DataFrame, sketches: DataFrame, slack: float = SKETCH_SLACK) -> DataFrame:
    """Whether each table's percentiles from its sketches stand within ``slack`` of their rank among its events."""
    marks = span_latency(sketches, "table_name")
    seconds = F.round(_latency_micros() / 1e6, 6)
    rows = _measurable(events).select(F.col("source_table").alias("table_name"), seconds.alias("seconds")).join(marks, "table_name")
    below = [F.count_if(F.col("seconds") < F.col(n)).alias(f"{n}_below") for n in LEVELS]
    upto = [F.count_if(F.col("seconds") <= F.col(n)).alias(f"{n}_upto") for n in LEVELS]
    ranks = rows.groupBy("table_name").agg(F.max("measured_rows").alias("measured_rows"), *below, *upto)
    room = F.col("measured_rows") * slack + 1

    def in_bounds(name: str, level: float) -> Column:
        rank = F.col("measured_rows") * level
        return ((F.col(f"{name}_below") - room <= rank) & (rank <= F.col(f"{name}_upto") + room)).alias(f"{name}_in_bounds")

    return ranks.select("table_name", *[in_bounds(n, level) for n, level in LEVELS.items()], "measured_rows")


def stream_latency(now: Column) -> Column:
    """Seconds an event took to arrive; never negative, and zero where the commit time is unknown."""
    committed = F.coalesce(F.col("_cdc_source_ts_ms").cast("double"), F.unix_micros(now) / 1e3)
    return F.greatest(F.lit(0.0), (F.unix_micros(now) / 1e3 - committed) / 1e3)


def latency_by_table(events: DataFrame, now: Column) -> DataFrame:
    """Records and arrival latency of each table in a batch."""
    latency = F.round(stream_latency(now), 3)
    return events.groupBy(F.coalesce("source_table", F.lit("unknown")).alias("table_name")).agg(
        F.count("*").alias("records"), F.min(latency).alias("min_latency_s"),
        F.max(latency).alias("max_latency_s"), F.round(F.avg(latency.cast("decimal(20,3)")), 2).cast("double").alias("avg_latency_s"),
    )


def bound_above(latency: Column, bounds=BOUNDS) -> Column:
    """Position of the first bound that is not below the value; ``len(bounds)`` beyond the last."""
    return reduce(lambda n, b: n + F.when(latency > b, 1).otherwise(0), bounds, F.lit(0))


def _label(position: Column, bounds=BOUNDS) -> Column:
    labels = F.array(*[F.lit(str(b)) for b in bounds], F.lit("+Inf"))
    return F.element_at(labels, position + 1)


def latency_histogram(events: DataFrame, now: Column) -> DataFrame:
    """Number of events of each table in each latency range, named by its upper bound."""
    counted = events.groupBy(
        F.col("source_table").alias("table_name"), bound_above(stream_latency(now)).alias("position")
    ).agg(F.count("*").alias("n"))
    return counted.select("table_name", _label(F.col("position")).alias("le"), "n")


def window_counts(events: DataFrame, clock: str, width: str) -> DataFrame:
    """Number of events per stretch of ``clock``, table and latency range, of a table or of a stream."""
    counted = events.groupBy(
        F.window(clock, width).alias("stretch"), F.col("source_table").alias("table_name"),
        bound_above(stream_latency(F.col(clock))).alias("position"),
    ).agg(F.count("*").alias("n"))
    return counted.select(F.col("stretch.start").cast("timestamp_ntz").alias("window_start"), "table_name", "position", "n")


def label_bounds(counted: DataFrame) -> DataFrame:
    return counted.select("window_start", "table_name", _label(F.col("position")).alias("le"), "n")


def latency_p95_over_time(events: DataFrame, now: Column, width: str = "5 minutes", level: float = 0.95) -> DataFrame:
    """A percentile per stretch of time, interpolated inside the histogram range it falls into.

    A stretch has at most ``len(BOUNDS) + 1`` histogram rows, which bounds the window below.
    """
    counted = events.groupBy(
        F.window(now, width).start.cast("timestamp_ntz").alias("window_start"),
        bound_above(stream_latency(now)).alias("position"),
    ).agg(F.count("*").alias("n"))
    by_bound = Window.partitionBy("window_start").orderBy("position")
    placed = counted.withColumns({
        "upto": F.sum("n").over(by_bound),
        "total": F.sum("n").over(Window.partitionBy("window_start")),
    })
    edges = F.array(*[F.lit(float(b)) for b in BOUNDS])
    last = len(BOUNDS) - 1
    rank = F.lit(level) * F.col("total")
    low = F.when(F.col("position") > 0, F.get(edges, F.col("position") - 1))
    high = F.get(edges, F.col("position"))
    inside = low + (high - low) * (rank - (F.col("upto") - F.col("n"))) / F.col("n")
    value = (
        F.when(F.col("position") > last, F.lit(float(BOUNDS[last])))
        .when(F.col("position") == 0, F.lit(float(BOUNDS[0]))).otherwise(inside)
    )
    holds = (F.col("upto") >= rank) & (F.col("upto") - F.col("n") < rank)
    return placed.filter(holds).select("window_start", F.round(value, 3).alias("p95_s"), F.col("total").alias("n"))
