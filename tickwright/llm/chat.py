"""Conversations as training texts: budgeted windows of marked turns, with a loss mask.

Every turn is put between marks, and whatever looks like a mark within a text is escaped. Prefix
sums of the turns' tokens choose the windows: a window repeats the system turn and some whole
turns of history, then takes as many new turns as the budget holds. Only assistant texts that are
new in a window count for the loss; what is repeated is masked.

A conversation is laid out by the task that its rows are shuffled to, once. One that is too long
for a task is sorted by range together with the others like it; sums per task and conversation give
the prefix sums, and it is cut by them into stretches of so many tokens, to which the system turn
and the history before them are copied. Windows begin anew with every stretch in any case, so
they do not depend on the way a conversation took.
"""

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickwright.llm.common import documents, written
from tickwright.llm.tokens import byte_bpe, vocabulary

BUDGET = 2048
#: Windows begin anew after so many budgets of tokens.
STRETCH = 64
#: A conversation of more bytes is cut into stretches before it reaches a task.
LONG = 8 << 20
#: So many long conversations are named to every task; beyond that the join shuffles.
FEW_LONG = 100_000

MARKS = {"system": ("[SYS]", "[/SYS]"), "user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>")}
#: A turn of any other role names it after its mark, up to the first line end.
OTHER = ("[TURN]", "[/TURN]")
#: Before the closing mark of a part of a turn that goes on in a later window.
MORE = "<more>"
LEARNED = "assistant"

_NAMES = r"(?:/?s|more)>", r"/?(?:SYS|INST|TURN)\]"
_MARK = re.compile(rf"<{_NAMES[0]}|\[{_NAMES[1]}")
_LOOKS_LIKE = re.compile(rf"<(?=\\*{_NAMES[0]})|\[(?=\\*{_NAMES[1]})")
_ESCAPED = re.compile(rf"<\\(?=\\*{_NAMES[0]})|\[\\(?=\\*{_NAMES[1]})")
_ROLES = {opening: role for role, (opening, _) in MARKS.items()}


def escape(text: str) -> str:
    """A text without marks: each gets a backslash, and one more if it has some."""
    return _LOOKS_LIKE.sub(r"\g<0>\\", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[0][0], text)


def marked(role: str, text: str, more: bool = False) -> tuple[str, int, int]:
    """A turn between its marks, and where its escaped text begins and ends."""
    opening, closing = MARKS.get(role, OTHER)
    if role not in MARKS:
        opening += escape(role.replace("\\", "\\\\").replace("\n", "\\n")) + "\n"
    body = escape(text)
    return opening + body + MORE * more + closing, len(opening), len(opening) + len(body)


@dataclass
class Piece:
    """A turn, or a part of one that is too long for a window."""

    role: str
    text: str
    cost: int
    #: Whether a turn begins or ends with it.
    begins: bool = True
    ends: bool = True


def pieces(role: str, text: str, cost, most: int) -> list[Piece]:
    """A turn in parts of at most ``most`` tokens, mark and escapes included; mostly it is one.

    A turn whose role alone takes half of that is left whole.
    """
    whole = cost(marked(role, text)[0])
    if whole <= most or 2 * cost(marked(role, "", True)[0]) > most:
        return [Piece(role, text, whole)]
    found, at, share = [], 0, len(text) / whole
    while at < len(text):
        n = max(1, int(share * most))
        while (taken := cost(marked(role, text[at : at + n], True)[0])) > most and n > 1:
            n = max(1, min(n - 1, int(n * most / taken * 0.95)))
        found.append(Piece(role, text[at : at + n], taken, not found, False))
        at += n
    found[-1].ends = True
    found[-1].cost = cost(marked(role, found[-1].text)[0])
    return found


def spans(
    costs: np.ndarray, begins: np.ndarray, first: int, system: int, keep_from: int, budget: int, history: int
) -> list[tuple[int, int, int]]:
    """Windows (context from, new from, to) over pieces, the first new one being ``first``.

    ``system`` is what the repeated system turn costs in each window that does not hold it as new;
    ``keep_from`` is the first piece that may be repeated as history.
    """
    before = np.concatenate([[0], np.cumsum(costs)])
    n = len(costs)
    # the first beginning of a turn at or after each piece
    turn = np.minimum.accumulate(np.where(np.append(begins, True), np.arange(n + 1), n)[::-1])[::-1]
    found = []
    while first < n:
        room = budget - system * (first >= keep_from)
        past = min(history, room - costs[first])
        context = first
        if past >= 0:
            at = np.searchsorted(before, before[first] - past)
            context = min(first, turn[max(at, keep_from)]) if keep_from <= first else first
        end = int(np.searchsorted(before, before[context] + room, "right")) - 1
        end = max(end, first + 1)
        found.append((int(context), first, end))
        first = end
    return found


def windows_of(
    given: list[Piece], first: int, system: Piece | None, keep_from: int, budget: int, history: int
) -> list[tuple]:
    """(text, context, loss, tokens) of a stretch's windows; its pieces before ``first`` are history."""
    costs = np.array([p.cost for p in given], np.int64)
    begins = np.array([p.begins for p in given], bool)
    out = []
    for context, new, end in spans(costs, begins, first, system.cost if system else 0, keep_from, budget, history):
        shown = list(given[context:end])
        repeated = new - context
        if system and new >= keep_from and system.cost + costs[new] <= budget:
            shown.insert(0, system)
            repeated += 1
        texts, loss, at = [], [], 0
        for i, p in enumerate(shown):
            text, start, stop = marked(p.role, p.text, not p.ends)
            if i >= repeated and p.role == LEARNED:
                loss.append({"start": at + start, "end": at + stop})
            texts.append(text)
            at += len(text)
        out.append(("".join(texts), repeated, loss, sum(p.cost for p in shown)))
    return out


def turns_of(text: str) -> Iterator[tuple[str, str, bool]]:
    """(role, text, whether the turn ends) of each piece of a window's text."""
    at = 0
    while at < len(text):
        opening = _MARK.match(text, at)
        closing = _MARK.search(text, opening.end())
        more = closing[0] == MORE
        body = text[opening.end() : closing.start()]
        role = _ROLES.get(opening[0])
        if role is None:
            named, body = body.split("\n", 1)
            role = re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(named))
        yield role, unescape(body), not more
        at = _MARK.match(text, closing.end()).end() if more else closing.end()


_KINDS = pa.struct([("start", pa.int32()), ("end", pa.int32())])
_WINDOWS = "conv {}, stretch long, number int, text string, context int, loss array<struct<start: int, end: int>>, tokens long"


class _Rows:
    """Rows of windows, given out as batches."""

    def __init__(self, kind: pa.DataType) -> None:
        self.kind, self.rows, self.size = kind, [], 0

    def add(self, conv, stretch: int, found: list[tuple]) -> None:
        for number, (text, context, loss, tokens) in enumerate(found):
            self.rows.append((conv, stretch, number, text, context, loss, tokens))
            self.size += len(text)

    def full(self) -> bool:
        return len(self.rows) >= 5_000 or self.size >= 1 << 24

    def batch(self) -> pa.RecordBatch:
        names = ["conv", "stretch", "number", "text", "context", "loss", "tokens"]
        kinds = [self.kind, pa.int64(), pa.int32(), pa.string(), pa.int32(), pa.list_(_KINDS), pa.int64()]
        columns = list(zip(*self.rows)) or [[]] * len(names)
        self.rows, self.size = [], 0
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, list[dict]]]:
    """Neighbouring rows with equal keys, over the ends of batches."""
    key, held = None, []
    for batch in batches:
        for row in batch.to_pylist():
            own = tuple(row[k] for k in keys)
            if held and own != key:
                yield key, held
                held = []
            key = own
            held.append(row)
    if held:
        yield key, held


@dataclass(frozen=True)
class Layout:
    """Token limits of windows: ``history`` and a system turn may take a quarter each."""

    budget: int = BUDGET
    vocabulary_path: str = ""

    @property
    def quarter(self) -> int:
        return self.budget // 4

    @property
    def most(self) -> int:
        return self.budget - self.quarter

    @property
    def stretch(self) -> int:
        return STRETCH * self.budget

    def cost(self):
        encode = byte_bpe(self.vocabulary_path)
        return lambda text: len(encode(text))

    def retained(self, first: Piece) -> bool:
        """Whether a conversation's first piece is repeated in its later windows."""
        return first.role == "system" and first.ends and first.cost <= self.quarter


def _whole(layout: Layout, kind: pa.DataType):
    """Windows of conversations whose rows come one after another, in order."""

    def lay_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cost, out = layout.cost(), _Rows(kind)
        for (conv,), rows in _runs(batches, ["conv"]):
            given = [p for r in rows for p in pieces(r["role"], r["text"], cost, layout.most)]
            system = given[0] if layout.retained(given[0]) else None
            before = np.concatenate([[0], np.cumsum([p.cost for p in given])])[:-1]
            stretch = before // layout.stretch
            for number in np.unique(stretch).tolist():
                first, end = np.searchsorted(stretch, [number, number + 1]).tolist()
                low = int(np.searchsorted(before, number * layout.stretch - layout.quarter)) if number else 0
                # the system turn is never history
                keep = 1 if system else 0
                low = max(low, keep) if number else 0
                own = windows_of(given[low:end], first - low, system, max(0, keep - low), layout.budget, layout.quarter)
                out.add(conv, number, own)
            if out.full():
                yield out.batch()
        yield out.batch()

    return lay_out


def _measured(layout: Layout):
    """Pieces of sorted turns with their cost, and what the task's pieces of the conversation cost before."""
    names = ["conv", "part", "place", "role", "text", "cost", "before", "begins", "ends"]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cost, part = layout.cost(), TaskContext.get().partitionId()
        last, before, place = object(), 0, 0
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                if r["conv"] != last:
                    last, before = r["conv"], 0
                for p in pieces(r["role"], r["text"], cost, layout.most):
                    rows.append((r["conv"], part, place, p.role, p.text, p.cost, before, p.begins, p.ends))
                    before, place = before + p.cost, place + 1
            kinds = [batch.schema.field("conv").type, pa.int32(), pa.int64(), pa.string(), pa.string()]
            kinds += [pa.int64(), pa.int64(), pa.bool_(), pa.bool_()]
            columns = list(zip(*rows)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return measure


def _stretches(layout: Layout, kind: pa.DataType):
    """Windows of stretches whose pieces come one after another: system turn, history, new ones."""

    def lay_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Rows(kind)
        for (conv, stretch), rows in _runs(batches, ["conv", "stretch"]):
            given = [Piece(r["role"], r["text"], r["cost"], r["begins"], r["ends"]) for r in rows]
            system, keep = None, 0
            if stretch and rows[0]["rank"] == 0:
                system, given, rows = given[0], given[1:], rows[1:]
            elif not stretch and layout.retained(given[0]):
                system, keep = given[0], 1
            first = sum(r["rank"] == 1 for r in rows)
            out.add(conv, stretch, windows_of(given, first, system, keep, layout.budget, layout.quarter))
            if out.full():
                yield out.batch()
        yield out.batch()

    return lay_out


def _cut_up(turns: DataFrame, layout: Layout, kind: str, arrow: pa.DataType) -> DataFrame:
    """Windows of long conversations, by prefix sums over tasks."""
    # written, so that the order among equal rows stays
    turns = written(turns.withColumn("tie", F.monotonically_increasing_id()), "turns")
    order = ["conv", F.col("turn").asc_nulls_last(), "role", "hash", "tie"]
    tasks = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = turns.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    spec = f"conv {kind}, part int, place long, role string, text string, cost long, before long, begins boolean, ends boolean"
    measured = written(ranged.select("conv", "role", "text").mapInArrow(_measured(layout), spec), "measured")

    # a conversation goes on in later tasks: one row for each of them, fewer than there are tasks
    own = measured.groupBy("conv", "part").agg(F.sum("cost").alias("cost"))
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = own.select(F.col("conv").alias("c"), F.col("part").alias("p"), F.sum("cost").over(earlier).alias("offset"))
    offsets = F.broadcast(offsets.filter("offset IS NOT NULL"))
    placed = measured.join(offsets, F.col("conv").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p")), "left")
    at = F.coalesce("offset", F.lit(0)) + F.col("before")
    placed = placed.withColumns({"at": at, "stretch": F.floor(at / layout.stretch)}).drop("c", "p", "offset", "before")

    # ranks within a stretch: 0 the system turn, 1 history, 2 its own
    new = placed.withColumn("rank", F.lit(2))
    is_system = (F.col("at") == 0) & (F.col("role") == "system") & F.col("ends") & (F.col("cost") <= layout.quarter)
    late = (F.col("at") >= (F.col("stretch") + 1) * layout.stretch - layout.quarter) & ~is_system
    history = placed.filter(late).withColumns({"stretch": F.col("stretch") + 1, "rank": F.lit(1)})
    last = placed.groupBy(F.col("conv").alias("c")).agg(F.max("stretch").alias("last"))
    system = (
        placed.filter(is_system & F.col("begins"))
        .join(last.filter("last > 0"), F.col("conv").eqNullSafe(F.col("c")))
        .withColumns({"stretch": F.explode(F.sequence(F.lit(1).cast("long"), "last")), "rank": F.lit(0)})
    )
    # history is copied beyond the last stretch, too, where nothing is new
    known = last.select(F.col("c").alias("c"), "last")
    history = history.join(known, F.col("conv").eqNullSafe(F.col("c"))).filter(F.col("stretch") <= F.col("last"))
    columns = ["conv", "stretch", "rank", "part", "place", "role", "text", "cost", "begins", "ends"]
    rows = new.select(columns).unionByName(history.select(columns)).unionByName(system.select(columns))
    sorted_rows = rows.repartition("conv", "stretch").sortWithinPartitions("conv", "stretch", "rank", "part", "place")
    return sorted_rows.mapInArrow(_stretches(layout, arrow), _WINDOWS.format(kind))


@dataclass(frozen=True)
class Formatted:
    """Windows of conversations: ``whole`` has those of one conversation side by side, in order."""

    whole: DataFrame
    cut: DataFrame | None

    def windows(self) -> DataFrame:
        """conv, stretch, number, text, context, loss, tokens: a window's first ``context`` pieces
        are repeated, and ``loss`` holds the spans of its text that are learned."""
        return self.whole if self.cut is None else self.whole.unionByName(self.cut)


def format_conversations(
    conversations: DataFrame,
    *,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    budget: int = BUDGET,
    vocabulary_path: str | None = None,
    long_bytes: int = LONG,
    few_long: int = FEW_LONG,
) -> Formatted:
    """Windows of at most ``budget`` tokens over every conversation's turns.

    A piece's tokens are those of its marked and escaped text, a window's the sum over its pieces.
    Turns come by ``turn`` (NULL last), then role, then a hash of the text; rows that repeat are
    turns of their own. NULL texts and roles are empty ones, NULL ids are one conversation, an empty
    table gives no windows, other columns are left behind. A system turn that comes first and
    takes at most a quarter of the budget is repeated in all windows, a quarter at most goes to
    whole turns of history. A turn of more than three quarters is cut into parts, unless its role
    alone takes half of them: it then has a window to itself, the only one to exceed the budget.
    """
    if budget < 256:
        raise ValueError("a window needs a budget of 256 tokens at least")
    layout = Layout(budget, vocabulary_path or vocabulary())
    given = documents(conversations, conv_col, turn_col, "role", "text").toDF("conv", "turn", "role", "text")
    empty = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text")}
    turns = given.withColumns(empty).withColumn("hash", F.xxhash64("text"))
    kind = turns.schema["conv"].dataType.simpleString()
    arrow = _arrow_type(turns)

    size = F.sum(F.octet_length("text") + F.octet_length("role") + 32)
    sizes = turns.groupBy(F.col("conv").alias("c")).agg(size.alias("size"))
    long = written(sizes.filter(F.col("size") > long_bytes).select("c"), "long")
    n_long = long.count()
    short, cut = turns, None
    if n_long:
        named = F.broadcast(long) if n_long <= few_long else long
        same = F.col("conv").eqNullSafe(F.col("c"))
        short = turns.join(named, same, "left_anti")
        cut = _cut_up(turns.join(named, same, "left_semi"), layout, kind, arrow)
    order = ["conv", F.col("turn").asc_nulls_last(), "role", "hash"]
    together = short.repartition("conv").sortWithinPartitions(*order).select("conv", "role", "text")
    return Formatted(together.mapInArrow(_whole(layout, arrow), _WINDOWS.format(kind)), cut)


def _arrow_type(turns: DataFrame) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(turns.schema["conv"].dataType)


def _reader(kind: pa.DataType):
    names = ["conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        conv, n_windows = None, 0

        def close() -> None:
            if n_windows:
                rows.append((conv, n, turns.hexdigest(), learned, loss.hexdigest(), chars))

        for batch in batches:
            for w in batch.to_pylist():
                if not n_windows or w["conv"] != conv:
                    close()
                    conv, n_windows = w["conv"], 0
                    n = learned = chars = 0
                    turns, loss, within = hashlib.sha256(), hashlib.sha256(), False
                n_windows += 1
                chars += len(w["text"])
                for i, (role, text, ends) in enumerate(turns_of(w["text"])):
                    if i < w["context"]:
                        continue
                    turns.update((("" if within else role + "\n") + text + "\n" * ends).encode())
                    n, within = n + ends, not ends
                for span in w["loss"]:
                    text = unescape(w["text"][span["start"] : span["end"]])
                    learned += len(text)
                    loss.update(text.encode())
            if len(rows) >= 10_000:
                yield batch_of(rows)
                rows.clear()
        close()
        yield batch_of(rows)

    return read


def read_back(formatted: Formatted, conv_col: str = "conv_id") -> DataFrame:
    """What the windows hold of each conversation: turns, their digest, and the text that is learned.

    Each turn is taken from the window where it is new. A task reads conversation after
    conversation and keeps no more than a digest's state of any.
    """
    whole = formatted.whole
    kind = whole.schema["conv"].dataType.simpleString()
    spec = f"conv {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    read = _reader(_arrow_type(whole))
    found = whole.mapInArrow(read, spec)
    if formatted.cut is not None:
        cut = formatted.cut.repartition("conv").sortWithinPartitions("conv", "stretch", "number")
        found = found.unionByName(cut.mapInArrow(read, spec))
    return found.withColumnRenamed("conv", conv_col)
