"""Writing, folding and cleaning tables of micro-batches."""

import math
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tickwright.sources import batches, files
from tickwright.sources.batches import GROUP, NOTHING, Entry, Segment

#: So many batches, or segments of one level, are folded into a segment.
FAN = 32
#: Segments of so many bytes are not folded again, and files are about as large as that.
LARGE, FILE = 4 << 30, 128 << 20
#: Readers that began before a folder was replaced have so many seconds to end.
GRACE = 24 * 3600.0

Reduce = Callable[[DataFrame], DataFrame]


def _attempt(batch_id: int) -> str:
    return f"{batch_id:011d}-{uuid.uuid4().hex[:16]}"


def write_batch(df: DataFrame, path: str, batch_id: int) -> int:
    """Store the rows of one micro-batch, with its id, and make it count instead of an earlier try.

    A batch without rows leaves no folder. A batch that was folded cannot be written again: only
    the newest can be repeated by a stream, and that is never folded. Returns the number of rows.
    """
    spark = df.sparkSession
    folded = batches.last_folded(batches.segments(spark, path))
    if batch_id <= folded:
        raise ValueError(f"batch {batch_id} of {path} was folded; batches up to {folded} stay")
    attempt, seen = _attempt(batch_id), Observation()
    rows = df.withColumn("batch_id", F.lit(batch_id).cast("long"))
    rows.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(batches.folder(path, attempt))
    n = seen.get["n"]
    earlier = batches.entries_of(spark, path, f"{batch_id // GROUP:08d}").get(batch_id)
    if not n:
        files.drop_folder(spark, batches.folder(path, attempt))
    if n or earlier:
        nth = earlier.nth + 1 if earlier else 0
        files.mark(spark, Entry(batch_id, nth, attempt if n else NOTHING).marker(path))
    return n


def fold(
    spark: SparkSession, path: str, reduce: Reduce | None = None, fan: int = FAN, large: int = LARGE
) -> list[Segment]:
    """Fold batches and segments, ``fan`` at a time, and return the new segments.

    ``reduce`` leaves out rows that others replace; it has to give the same for rows and for rows
    reduced before. Segments are folded into ones of the next level, so every row is written
    once per level. A fold that ends midway leaves a folder without an entry, which nobody reads.
    The newest batch is left alone, as it may be written again.
    """
    made: list[Segment] = []
    whole = batches.segments(spark, path)
    loose = sorted(batches.entries(spark, path, after=batches.last_folded(whole)).values(), key=lambda e: e.batch_id)
    loose = loose[:-1]
    while len(loose) >= fan:
        first = batches.last_folded(whole) + 1
        names = [e.attempt for e in loose[:fan]]
        whole.append(_merge(spark, path, names, Segment(1, first, loose[fan - 1].batch_id, ""), reduce))
        made.append(whole[-1])
        loose = loose[fan:]
    level = 1
    while any(s.level >= level for s in whole):
        # neighbours only, so that a segment holds all batches of its range
        own = [s for s in whole if s.level == level]
        sizes = [_bytes(spark, path, s.attempt) for s in own] if len(own) >= fan else []
        while len(sizes) >= fan and sum(sizes[:fan]) <= large:
            joined = Segment(level + 1, own[0].first, own[fan - 1].last, "")
            joined = _merge(spark, path, [s.attempt for s in own[:fan]], joined, reduce)
            whole = [s for s in whole if not joined.holds(s)] + [joined]
            made.append(joined)
            own, sizes = own[fan:], sizes[fan:]
        level += 1
    return made


def _bytes(spark: SparkSession, path: str, attempt: str) -> int:
    return sum(n for _, n in files.children(spark, batches.folder(path, attempt)))


def _merge(spark: SparkSession, path: str, names: list[str], into: Segment, reduce: Reduce | None) -> Segment:
    """Write the rows of some folders to one, then make it count."""
    rows = spark.read.option("mergeSchema", True).parquet(*[batches.folder(path, n) for n in names])
    size = sum(_bytes(spark, path, n) for n in names)
    rows = reduce(rows) if reduce else rows
    done = Segment(into.level, into.first, into.last, _attempt(into.last))
    rows.coalesce(max(1, math.ceil(size / FILE))).write.parquet(batches.folder(path, done.attempt))
    files.mark(spark, done.marker(path))
    return done


def vacuum(spark: SparkSession, path: str, grace: float = GRACE) -> list[str]:
    """Remove folders that have not counted for ``grace`` seconds; returns their names.

    A folder's time is up so long after the entry that replaced it, or, if it never had one, so long after it
    was last changed. Entries of folded batches go by whole groups, all but the newest two.
    """
    until = (time.time() - grace) * 1000
    whole = batches.segments(spark, path)
    groups = [name for name, _ in files.children(spark, f"{path}/{batches.LOG}/batches")]
    replaced: dict[str, str] = {}
    counting = {s.attempt for s in whole}
    for name, _ in files.children(spark, f"{path}/{batches.LOG}/segments"):
        level, first, last, attempt = name.split(".")
        own = Segment(int(level), int(first), int(last), attempt)
        replaced |= {attempt: s.marker(path) for s in whole if s.holds(own) and s != own}
    for group in groups:
        last_ones = batches.entries_of(spark, path, group)
        for name, _ in files.children(spark, f"{path}/{batches.LOG}/batches/{group}"):
            batch_id, _, attempt = name.split(".")
            newest = last_ones[int(batch_id)]
            holder = next((s for s in whole if s.first <= int(batch_id) <= s.last), None)
            if newest.attempt != attempt:
                replaced[attempt] = newest.marker(path)
            elif holder:
                replaced[attempt] = holder.marker(path)
            else:
                counting.add(attempt)
    gone = []
    for attempt, _ in files.children(spark, f"{path}/{batches.DATA}"):
        if attempt in counting:
            continue
        since = replaced.get(attempt, batches.folder(path, attempt))
        if files.modified(spark, since) <= until:
            files.drop_folder(spark, batches.folder(path, attempt))
            gone.append(attempt)
    kept = {name for name, _ in files.children(spark, f"{path}/{batches.DATA}")}
    for group in sorted(groups)[:-2]:
        listed = batches.entries_of(spark, path, group).values()
        if all(e.batch_id <= batches.last_folded(whole) and e.attempt not in kept for e in listed):
            files.drop_folder(spark, f"{path}/{batches.LOG}/batches/{group}")
    return gone
