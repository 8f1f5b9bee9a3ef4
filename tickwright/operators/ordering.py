"""Neighbours, exact positions and top rows in (symbol, event_time, tie) order.

The order of ticks is always symbol, event time (NULL last), tie. ``tie`` is an integer
column that is unique per row: an event id, or ``row_id`` of the table readers.

One symbol may hold most of the rows, so nothing here sorts a symbol in one task once a
table has outgrown ``rows_per_slice``. The rows are then cut into slices of consecutive
instants, and the value that crosses a cut is fetched from a summary with one row per
(symbol, slice).
"""

import math
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickwright.session import written

ROWS_PER_SLICE = 2_000_000
#: Slices grow beyond their share rather than become more than this, so plans and samples stay small.
MOST_SLICES = 4_096
SAMPLED_PER_SLICE = 200
#: Counts that the driver gets at a time when it looks for a position.
BINS = 1 << 16
#: So many rows of a summary, a few numbers each, are sent to every task.
FEW_EDGES = 500_000


def micros(time: str = "event_time") -> Column:
    return F.unix_micros(F.col(time).cast("timestamp"))


def time_order(tie: str, time: str = "event_time") -> list[Column]:
    return [F.col(time).asc_nulls_last(), F.col(tie).asc()]


def _bucket(df: DataFrame, column: str, cuts: list[float]) -> DataFrame:
    """Replace ``column`` by the number of the bucket it falls in; NULL gets the last."""
    edges = [-math.inf, *cuts, math.inf]
    numbered = Bucketizer(
        splits=edges, inputCol=column, outputCol=f"{column}_no", handleInvalid="keep"
    ).transform(df.withColumn(column, F.coalesce(F.col(column), F.lit(math.nan))))
    return numbered.withColumn(column, F.col(f"{column}_no").cast("long")).drop(f"{column}_no")


@dataclass(frozen=True)
class Slices:
    """Cuts of the time axis that leave each slice about the same number of rows.

    An instant that fills whole slices alone (``crowded``), and the rows without an
    instant, are cut again along the tie. However the instants are distributed, no more
    than about two shares of the rows land in a slice, because ties are unique.
    """

    count: int
    time_cuts: tuple[float, ...]
    tie_cuts: tuple[float, ...]
    crowded: tuple[float, ...]

    @staticmethod
    def plan(
        df: DataFrame,
        tie: str,
        time: str = "event_time",
        rows_per_slice: int = ROWS_PER_SLICE,
    ) -> "Slices | None":
        """Cuts for ``df``, or None when the whole table fits one slice.

        On large tables the quantiles come from a sample of the keys. That only moves the
        cuts a little: every row gets its slice, and no result depends on where cuts lie.
        """
        n = df.count()
        wanted = min(math.ceil(n / rows_per_slice), MOST_SLICES)
        if wanted <= 1:
            return None
        shares = [i / wanted for i in range(1, wanted)]
        keys = df.select(
            micros(time).cast("double").alias("at"), F.col(tie).cast("double").alias("tie")
        )
        enough = wanted * SAMPLED_PER_SLICE
        if n > 2 * enough:
            keys = keys.sample(enough / n, seed=1)
        at, ties = keys.approxQuantile(["at", "tie"], shares, 1 / (4 * wanted))
        crowded = sorted({a for a, b in zip(at, at[1:]) if a == b})
        # an instant is a whole number of microseconds, so these two cuts hold it alone
        cuts = sorted({*at, *(a + 1 for a in crowded)})
        anywhere = (0.0,)  # without any instant there is nothing to cut, but a cut is needed
        return Slices(
            wanted, tuple(cuts) or anywhere, tuple(sorted(set(ties))) or anywhere, tuple(crowded)
        )

    def assign(
        self, df: DataFrame, tie: str, time: str = "event_time", tasks: int | None = None
    ) -> DataFrame:
        """Add ``slice_no``, rising with (time, tie): equal plans give equal numbers.

        ``tasks`` adds ``slice_task``, which deals the slices evenly to so many tasks.
        """
        keyed = df.withColumns(
            {"slice_at": micros(time).cast("double"), "slice_tie": F.col(tie).cast("double")}
        )
        # a crowded instant's number, from 1; 0 is for no instant at all
        crowded = F.when(F.col("slice_at").isNull(), 0)
        if self.crowded:
            number = F.array_position(F.array(*map(F.lit, self.crowded)), F.col("slice_at"))
            crowded = crowded.when(number > 0, number)
        keyed = keyed.withColumn("slice_crowded_no", crowded)
        keyed = keyed.withColumn("slice_crowded", F.col("slice_crowded_no").isNotNull())
        keyed = _bucket(keyed, "slice_at", list(self.time_cuts))
        keyed = _bucket(keyed, "slice_tie", list(self.tie_cuts))
        width = len(self.tie_cuts) + 2
        inner = F.when(F.col("slice_crowded"), F.col("slice_tie")).otherwise(F.lit(0))
        found = keyed.withColumn("slice_no", F.col("slice_at") * width + inner)
        if tasks:
            # the slices of whole stretches are counted first, then those within crowded instants
            stretch, within = F.col("slice_at"), F.col("slice_crowded_no") * width + inner
            counted = F.when(F.col("slice_crowded"), len(self.time_cuts) + 2 + within).otherwise(stretch)
            found = found.withColumn("slice_task", F.pmod(counted, F.lit(tasks)).cast("int"))
        return found.drop("slice_at", "slice_tie", "slice_crowded", "slice_crowded_no")


def with_neighbour(
    df: DataFrame,
    value: str,
    out: str,
    tie: str,
    step: str = "next",
    by: str | None = "symbol",
    time: str = "event_time",
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Add the ``value`` of the next (or previous) row of the same ``by`` group.

    The outermost row of a group gets NULL, and so does every row whose ``by`` is NULL.
    Without ``by`` all rows are one group.
    """
    if step not in ("next", "previous"):
        raise ValueError(f"unknown step: {step}")
    look = F.lead if step == "next" else F.lag
    group = [by] if by else []
    belongs = F.col(by).isNotNull() if by else F.lit(True)

    slices = Slices.plan(df, tie, time, rows_per_slice)
    if slices is None:
        # the table is no larger than one slice, so no group is either
        whole = Window.partitionBy(*(group or [F.lit(0)])).orderBy(*time_order(tie, time))
        return df.withColumn(out, F.when(belongs, look(value).over(whole)))

    # a task per slice at least, however few the session asks for; each gets as many slices
    tasks = max(slices.count, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    sliced = slices.assign(df, tie, time, tasks)
    keys = [*group, "slice_no"]
    inside = Window.partitionBy("slice_task", *keys).orderBy(*time_order(tie, time))
    # boxed in a struct, a neighbour whose value is NULL differs from no neighbour at all
    boxed = F.struct(F.col(value).alias("value"))
    back = F.lag if step == "next" else F.lead
    # written, so that the rows are shuffled and sorted once: the edges are read off the table
    laid = written(
        sliced.repartitionById(tasks, F.col("slice_task")).withColumns(
            {
                "beside": look(boxed).over(inside),
                "outermost": back(F.lit(1)).over(inside).isNull(),
            }
        ).drop("slice_task"),
        "neighbours",
    )
    across = Window.partitionBy(*(group or [F.lit(0)])).orderBy("slice_no")
    edges = laid.where("outermost").select(*keys, boxed.alias("edge"))
    beyond = edges.withColumn("beyond", look("edge").over(across)).drop("edge")
    if edges.count() <= FEW_EDGES:
        beyond = F.broadcast(beyond)  # beyond that, the join shuffles
    return (
        laid.join(beyond, keys, "left")
        .withColumn(out, F.when(belongs, F.coalesce("beside", "beyond")["value"]))
        .select(*df.columns, out)
    )


def kth_smallest(df: DataFrame, column: str, k: int, bins: int = BINS):
    """The exact k-th smallest value (from 1) of an integer column, and how many are below.

    The range is divided into up to ``bins`` equal parts by the values' first bits, the part of the
    k-th is found by counts, and divided again: four scans of one column at most for 64 bits, and
    nothing is sorted.
    """
    values = df.select(F.col(column).cast("long").alias("v")).where(F.col("v").isNotNull())
    low, high = values.agg(F.min("v"), F.max("v")).first()
    below = 0
    while low < high:
        # as few of the last bits are left out as still give no more parts than that
        bits = max(0, (high - low).bit_length() - bins.bit_length() + 1)
        part = F.shiftright("v", bits).alias("part")
        counts = values.where(F.col("v").between(low, high)).groupBy(part).count().collect()
        for part, n in sorted(counts):
            if below + n >= k:
                break
            below += n
        low, high = max(low, part << bits), min(high, (part + 1 << bits) - 1)
    return low, below


def split_position(
    df: DataFrame,
    k: int,
    tie: str,
    time: str = "event_time",
    by: str = "symbol",
    bins: int = BINS,
):
    """(symbol, instant in microseconds, tie) of the k-th row in (symbol, time, tie) order.

    Row counts lead to the symbol, then its instants and the ties of one instant are narrowed down
    by counts; no row changes its place for it. A NULL symbol comes after all others, as a
    NULL instant does within its symbol.
    """
    # one row per symbol: the summary is all that is ranked
    running = F.sum("n").over(
        Window.orderBy(F.col(by).asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    )
    symbol, n, timed, upto = (
        df.groupBy(by)
        .agg(F.count(F.lit(1)).alias("n"), F.count(time).alias("timed"))
        .withColumn("upto", running)
        .where(F.col("upto") >= k)
        .orderBy("upto")
        .limit(1)
        .first()
    )
    k -= upto - n
    rows = df.where(F.col(by).eqNullSafe(F.lit(symbol))).select(
        micros(time).alias("at"), F.col(tie).alias("tie")
    )
    if k > timed:
        at, k, rows = None, k - timed, rows.where(F.col("at").isNull())
    else:
        at, below = kth_smallest(rows, "at", k, bins)
        k, rows = k - below, rows.where(F.col("at") == at)
    return symbol, at, kth_smallest(rows, "tie", k, bins)[0]


def at_or_before(
    position, tie: str, time: str = "event_time", by: str = "symbol"
) -> Column:
    """Whether a row comes no later than ``position`` in (symbol, time, tie) order."""
    symbol, at, last_tie = position
    instant = micros(time)
    same_symbol = F.col(by).eqNullSafe(F.lit(symbol))
    earlier_symbol = F.col(by).isNotNull() if symbol is None else F.col(by) < F.lit(symbol)
    earlier_time = instant.isNotNull() if at is None else instant < F.lit(at)
    same_time = instant.eqNullSafe(F.lit(at).cast("long"))
    upto = earlier_symbol | (
        same_symbol & (earlier_time | (same_time & (F.col(tie) <= F.lit(last_tie))))
    )
    return F.coalesce(upto, F.lit(False))


def latest(df: DataFrame, n: int, order: list[str], ties: list[str] = ()) -> DataFrame:
    """The last ``n`` rows by ``order``, shown in rising order.

    The top-n is kept per task and merged; only n rows are sorted again.
    """
    falling = [F.col(c).desc_nulls_last() for c in [*order, *ties]]
    return df.orderBy(*falling).limit(n).orderBy(*order, *ties)
