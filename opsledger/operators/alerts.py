"""Alert states: a condition must hold for some time before it fires."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opsledger.functions.timegrid import floor_to, seconds
from opsledger.functions.workspace import stored

INACTIVE = "inactive"
PENDING = "pending"
FIRING = "firing"

CHUNK_S = 86_400


def streaks(
    evaluations: DataFrame,
    series: list[str],
    step_s: int,
    eval_ts: str = "eval_ts",
    breach: str = "breach",
    chunk_s: int = CHUNK_S,
) -> DataFrame:
    """Add ``active_since``: when the current unbroken run of breaches began.

    A missing evaluation breaks the run like a false one. Evaluations are split by
    (series, time chunk): runs are found inside each chunk, and a chunk that
    opens in the middle of a run takes its start from a table with one row per
    (series, chunk).
    """
    rows = evaluations.withColumn(breach, F.coalesce(F.col(breach), F.lit(False))).withColumn(
        "__chunk", floor_to(eval_ts, chunk_s)
    )
    in_chunk = Window.partitionBy(*series, "__chunk").orderBy(eval_ts)
    before = F.col(eval_ts) - seconds(step_s)
    continues = F.coalesce(
        F.lag(breach).over(in_chunk) & (F.lag(eval_ts).over(in_chunk) == before), F.lit(False)
    )
    local = (
        rows.withColumn("__continues", continues)
        .withColumn(
            "__start",
            F.last(F.when(F.col(breach) & ~F.col("__continues"), F.col(eval_ts)), True).over(
                in_chunk
            ),
        )
        .drop("__continues")
    )

    in_series = Window.partitionBy(*series).orderBy("__chunk")
    tails = local.groupBy(*series, "__chunk").agg(
        F.max(eval_ts).alias("last_ts"),
        F.max_by(F.when(F.col(breach), F.col("__start")), eval_ts).alias("tail_start"),
    )
    linked = F.lag("tail_start").over(in_series).isNotNull() & (
        F.lag("last_ts").over(in_series) == F.col("tail_start") - seconds(step_s)
    )
    origins = (
        tails.withColumn("__linked", F.coalesce(linked, F.lit(False)))
        .withColumn(
            "origin",
            F.last(F.when(~F.col("__linked"), F.col("tail_start")), True).over(in_series),
        )
        .withColumn("origin", F.when(F.col("tail_start").isNotNull(), F.col("origin")))
    )
    carried = origins.select(
        *series,
        "__chunk",
        F.lag("last_ts").over(in_series).alias("__prev_ts"),
        F.lag("origin").over(in_series).alias("__prev_origin"),
    )
    carries_on = (F.col("__start") - seconds(step_s) == F.col("__prev_ts")) & F.col(
        "__prev_origin"
    ).isNotNull()
    since = F.when(F.coalesce(carries_on, F.lit(False)), F.col("__prev_origin")).otherwise(
        F.col("__start")
    )
    return (
        local.join(carried, [*series, "__chunk"], "left")
        .withColumn("active_since", F.when(F.col(breach), since))
        .drop("__chunk", "__start", "__prev_ts", "__prev_origin")
    )


def alert_states(
    evaluations: DataFrame,
    series: list[str],
    step_s: int,
    hold_s: int | str,
    eval_ts: str = "eval_ts",
    breach: str = "breach",
    chunk_s: int = CHUNK_S,
) -> DataFrame:
    """Add ``active_since`` and ``state`` to each evaluation.

    ``hold_s`` is a number of seconds or the name of a column that holds it. An
    alert is pending until its condition has held that long, then firing; the
    first miss makes it inactive. The evaluations are stored first, because finding
    the runs reads them twice and they are far smaller than what they come from.
    """
    evaluations = stored(evaluations, "evaluations")
    hold = F.col(hold_s) if isinstance(hold_s, str) else F.lit(hold_s)
    held = F.col(eval_ts) - F.col("active_since") >= F.make_dt_interval(secs=hold)
    state = (
        F.when(F.col("active_since").isNull(), INACTIVE).when(held, FIRING).otherwise(PENDING)
    )
    runs = streaks(evaluations, series, step_s, eval_ts, breach, chunk_s)
    return runs.withColumn("state", state)


def firing_intervals(states: DataFrame, series: list[str], eval_ts: str = "eval_ts") -> DataFrame:
    """One row per firing alert: from the start of its run to its last evaluation."""
    return (
        states.where(F.col("state") == FIRING)
        .groupBy(*series, F.col("active_since").alias("start_ts"))
        .agg(F.max(eval_ts).alias("end_ts"))
    )
