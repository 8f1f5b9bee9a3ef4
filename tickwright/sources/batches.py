"""Tables of micro-batches: immutable folders, and a log of empty files whose names say which count.

Every try of a batch is written to a folder of its own. Once it is complete an entry is made in the log:
an empty file, which exists whole or not at all in any file system, object stores included. The last
entry of a batch names the folder that counts, so a repeated batch replaces an earlier try without a
moment in which readers miss it, and nothing is renamed or changed. Folded batches have a segment, a
folder that holds the rows of a range of them. A reader lists the segments and the entries after the
last of them, however many batches there have been.
"""

from dataclasses import dataclass

from pyspark.sql import SparkSession

from tickwright.sources import files

LOG, DATA = "_log", "data"
#: Entries are kept in a folder per so many batches, so that the newest are found in a short listing.
GROUP = 1000
#: In place of a folder, in the entry of a batch without rows.
NOTHING = "nothing"


@dataclass(frozen=True)
class Entry:
    """The ``nth`` try of a batch, and the name of its folder."""

    batch_id: int
    nth: int
    attempt: str

    def marker(self, path: str) -> str:
        name = f"{self.batch_id:011d}.{self.nth:05d}.{self.attempt}"
        return f"{_batches(path)}/{self.batch_id // GROUP:08d}/{name}"


@dataclass(frozen=True)
class Segment:
    """A folder with the rows of the batches ``first`` to ``last``, folded ``level`` times."""

    level: int
    first: int
    last: int
    attempt: str

    def marker(self, path: str) -> str:
        return f"{_segments(path)}/{self.level:03d}.{self.first:011d}.{self.last:011d}.{self.attempt}"

    def holds(self, other: "Segment") -> bool:
        return self.first <= other.first and other.last <= self.last


def _batches(path: str) -> str:
    return f"{path}/{LOG}/batches"


def _segments(path: str) -> str:
    return f"{path}/{LOG}/segments"


def folder(path: str, attempt: str) -> str:
    return f"{path}/{DATA}/{attempt}"


def logged(spark: SparkSession, path: str) -> bool:
    """Whether there is a table of batches at ``path``."""
    return files.exists(spark, f"{path}/{LOG}")


def segments(spark: SparkSession, path: str) -> list[Segment]:
    """The segments that no larger one holds, oldest batches first."""
    found: list[Segment] = []
    for name, _ in reversed(files.children(spark, _segments(path))):
        level, first, last, attempt = name.split(".")
        own = Segment(int(level), int(first), int(last), attempt)
        if not any(s.holds(own) for s in found):
            found.append(own)
    return sorted(found, key=lambda s: s.first)


def entries_of(spark: SparkSession, path: str, group: str) -> dict[int, Entry]:
    """The last entry of each batch of a group."""
    found: dict[int, Entry] = {}
    for name, _ in files.children(spark, f"{_batches(path)}/{group}"):
        batch_id, nth, attempt = name.split(".")
        found[int(batch_id)] = Entry(int(batch_id), int(nth), attempt)
    return found


def entries(
    spark: SparkSession, path: str, newest: int | None = None, after: int = -1
) -> dict[int, Entry]:
    """The last entries of batches with rows, by batch: those beyond ``after``, the ``newest`` of them.

    Groups are looked through from the newest on, and no further than needed.
    """
    found: dict[int, Entry] = {}
    for group, _ in reversed(files.children(spark, _batches(path))):
        if (int(group) + 1) * GROUP - 1 <= after or newest is not None and len(found) >= newest:
            break
        own = entries_of(spark, path, group)
        found |= {b: e for b, e in own.items() if b > after and e.attempt != NOTHING}
    kept = sorted(found)[-newest:] if newest is not None else sorted(found)
    return {b: found[b] for b in kept}


def last_folded(found: list[Segment]) -> int:
    return max((s.last for s in found), default=-1)


@dataclass(frozen=True)
class Live:
    """Folders to read, oldest batches first; rows of batches before ``since`` are not asked for."""

    folders: list[str]
    since: int | None = None


def live(spark: SparkSession, path: str, newest: int | None = None) -> Live:
    """What holds the rows of all batches, or of the ``newest`` ones that have rows."""
    whole = segments(spark, path)
    folded = last_folded(whole)
    since = None
    if newest is not None:
        wanted = entries(spark, path, newest)
        since = min(wanted, default=0)
        whole = [s for s in whole if s.last >= since]
    loose = entries(spark, path, after=max(folded, -1 if since is None else since - 1))
    names = [s.attempt for s in whole] + [e.attempt for _, e in sorted(loose.items())]
    return Live([folder(path, name) for name in names], since)
