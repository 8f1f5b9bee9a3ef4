"""Training data: history clean-up, top-up, next-close label, chronological split."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwright import settings
from tickwright.functions.prices import with_spread
from tickwright.operators import ordering
from tickwright.operators.rows import has_rows
from tickwright.schemas import FEATURES, TARGET


def clean_history(history: DataFrame) -> DataFrame:
    """History with its spread, without rows that lack any value."""
    return with_spread(history).dropna()


def top_up(
    silver: DataFrame, history: DataFrame, min_rows: int = settings.MIN_SILVER_ROWS
) -> DataFrame:
    """Silver alone if it has ``min_rows`` rows, else silver and history together."""
    if has_rows(silver, min_rows):
        return silver
    if silver.isEmpty():
        return history
    return silver.unionByName(history, allowMissingColumns=True)


def label_next_close(df: DataFrame, tie: str, **options) -> DataFrame:
    """Add the close of the symbol's next tick as ``next_close``.

    Frames without a symbol column are one series; frames without an event time are
    ordered by the tie alone.
    """
    by = "symbol" if "symbol" in df.columns else None
    if "event_time" in df.columns:
        return ordering.with_neighbour(df, "close", TARGET, tie, by=by, **options)
    stamped = df.withColumn("event_time", F.lit(None).cast("timestamp"))
    return ordering.with_neighbour(stamped, "close", TARGET, tie, by=by, **options).drop(
        "event_time"
    )


def training_rows(labelled: DataFrame, keep: list[str] = ()) -> DataFrame:
    """Features and label of the rows that have all of them (no NULL, no NaN).

    Runs after the label is set, so a row that is dropped here still served as the next
    close of the row before it.
    """
    columns = [*FEATURES, TARGET]
    return labelled.select(*keep, *columns).dropna(subset=columns)


def chrono_split(rows: DataFrame, tie: str, share: float = settings.TRAIN_SHARE, **options):
    """(train, test): the first ``int(share * n)`` rows in (symbol, time, tie) order, the rest.

    ``rows`` is read several times, so hand in a stored table. The split itself is a plain
    comparison with the position of the last training row: no shuffle, no ranking.
    """
    n = rows.count()
    if n < settings.MIN_TRAINING_ROWS:
        raise ValueError(f"{n} labelled rows; at least {settings.MIN_TRAINING_ROWS} are needed")
    last = ordering.split_position(rows, int(n * share), tie, **options)
    in_train = ordering.at_or_before(last, tie)
    return rows.where(in_train), rows.where(~in_train)
