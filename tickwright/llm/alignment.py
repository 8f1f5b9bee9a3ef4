"""Which tokens of two tokenizers cover the same bytes, and how often they do corpus-wide.

Each text is encoded by both. Their tokens' ends, in bytes, are two rising arrays with the same
last value. Where tokens correspond one to one, equal ends lie at a constant shift between the
arrays' indexes: whole stretches at that shift are compared at once, twice as long each time, and
jumped. What does not correspond is walked through until both end at the same byte, which
gives the shift of the next stretch.

Links are counted per document in the tasks, then over the corpus by Spark, and the counts are
joined back to the documents' distinct pairs.
"""

import functools
import hashlib
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwright.llm.common import documents, written
from tickwright.llm.tokens import byte_bpe, byte_ranks, piece_model, vocabulary

#: So many pairs of ids, three numbers each, are sent to every task; beyond that the join shuffles.
FEW_PAIRS = 2_000_000
#: Remembered words, and tokens of them.
WORDS, TOKENS = 400_000, 4_000_000
#: Words that are aligned at once.
STRETCH = 50_000

_ROW_BITS = 40

Block = tuple[int, int, int, int]

_PLAIN = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
_CUTS = re.compile(r"(?<=\S)(?=[ \n])")
_OTHER_BLANKS = re.compile(r"[^\S \n]")


def words(text: str) -> list[str]:
    """A text cut before runs of blanks and line ends, where both tokenizers always end a token.

    No cut follows another white-space character, with which a blank may share a token.
    """
    return _CUTS.split(text) if _OTHER_BLANKS.search(text) else _PLAIN.findall(text)


def align(a: Sequence[int], b: Sequence[int]) -> tuple[list[Block], list[Block]]:
    """Stretches of one-to-one groups, and the other groups, as (from, to, from, to).

    Both arrays of ends rise and have the same last value. Stretches and groups take turns, a
    stretch of no tokens before a group that has none before it.
    """
    stretches: list[Block] = []
    groups: list[Block] = []
    at, shift, n = 0, 0, len(a)
    while at < n:
        end = at
        if a[at] == b[at + shift]:
            end, step = at + 1, 2
            while end < n and a[end : end + step] == b[end + shift : end + shift + step]:
                end += step
                step *= 2
            if end < n:
                while step := step // 2:
                    if a[end : end + step] == b[end + shift : end + shift + step]:
                        end += step
            else:
                end = n
        stretches.append((at, end, at + shift, end + shift))
        if end == n:
            break
        at, other = end, end + shift
        x, y = a[at], b[other]
        while x != y:
            if x < y:
                at += 1
                x = a[at]
            else:
                other += 1
                y = b[other]
        groups.append((end, at + 1, end + shift, other + 1))
        at, shift = at + 1, other - at
    return stretches, groups


def linked_within(a: np.ndarray, b: np.ndarray, run_a: np.ndarray, run_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of the tokens that overlap outside the one-to-one stretches, given all ends.

    Within a group a pair begins where the one before it ends: wherever either tokenizer ends a token.
    """
    loose = []
    for ends, run in ((a, run_a), (b, run_b)):
        out = np.ones(len(ends), bool)
        out[run] = False
        loose.append(ends[out])
    ends = np.unique(np.concatenate(loose))
    return np.searchsorted(a, ends), np.searchsorted(b, ends)


class _Ids:
    """Lists of ids under one number each, and many of them joined at once."""

    def __init__(self) -> None:
        self.values = np.zeros(1 << 16, np.int64)
        self.starts = np.zeros((1 << 14) + 1, np.int64)
        self.n = 0

    def add(self, values: np.ndarray, ends: np.ndarray) -> None:
        """Lists one after another, by the ends of each."""
        first = self.starts[self.n]
        while first + len(values) > len(self.values):
            self.values = np.concatenate([self.values, np.zeros_like(self.values)])
        while self.n + len(ends) >= len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
        self.values[first : first + len(values)] = values
        self.starts[self.n + 1 : self.n + 1 + len(ends)] = first + ends
        self.n += len(ends)

    def joined(self, numbers: np.ndarray) -> np.ndarray:
        starts, ends = self.starts[numbers], self.starts[numbers + 1]
        counts = ends - starts
        upto = np.cumsum(counts)
        return self.values[np.repeat(starts - upto + counts, counts) + np.arange(upto[-1])]


class Encoders:
    """Ids of both tokenizers, word by word; words met before are remembered."""

    def __init__(self, byte_path: str, piece_path: str) -> None:
        import sentencepiece

        self._bytes = byte_bpe(byte_path)
        ranks = byte_ranks(byte_path)
        self._a_lengths = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, i in ranks.items():
            self._a_lengths[i] = len(token)
        self._pieces = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        pieces = [self._pieces.id_to_piece(i) for i in range(self._pieces.get_piece_size())]
        if any("▁" in p.lstrip("▁") or "\n" in p for p in pieces):
            raise ValueError("a piece holds a blank or line end within: its texts cannot be cut into words")
        byte = re.compile("<0x([0-9A-F]{2})>")
        self._spelt = [
            bytes([int(m[1], 16)]) if (m := byte.fullmatch(p)) else p.replace("▁", " ").encode() for p in pieces
        ]
        self._b_lengths = np.array([*map(len, self._spelt)], np.int64)
        # an id as it stands within its group and as its last one
        self._a_shown = np.array([[f"{i}{s}" for i in range(len(self._a_lengths))] for s in ",|"], object)
        self._b_shown = np.array([[f"{i}{s}" for i in range(len(pieces))] for s in ",;"], object)
        self._blank = self._pieces.piece_to_id("▁")
        self._forget()

    def _forget(self) -> None:
        self._known: dict[str, int] = {}
        self._a, self._b = _Ids(), _Ids()
        # numbers of words that the pieces do not spell as they are
        self._changed: set[int] = set()

    def _by_pieces(self, text: str) -> list[int]:
        """Ids of a text that begins with a blank, which the tokenizer would put there, or a line end."""
        if text == " ":
            return [self._blank]
        return self._pieces.encode(text[1:]) if text[0] == " " else self._pieces.encode(text)[1:]

    def _spells(self, ids: list[int], text: str) -> bool:
        return b"".join([self._spelt[i] for i in ids]) == text.encode()

    def _learn(self, new: list[str]) -> None:
        """Encode words at once: one after another they are cut as each by itself is."""
        text = "".join(new)
        by_bytes, by_pieces = self._bytes(text), self._by_pieces(text)
        if not self._spells(by_pieces, text):
            if len(new) > 1:
                self._learn(new[: len(new) // 2])
                self._learn(new[len(new) // 2 :])
                return
            self._changed.add(len(self._known))
        upto = np.cumsum([len(w.encode()) for w in new])
        for ids, lengths, own in ((by_bytes, self._a_lengths, self._a), (by_pieces, self._b_lengths, self._b)):
            values = np.array(ids, np.int64)
            ends = np.searchsorted(np.cumsum(lengths[values]), upto) + 1 if len(new) > 1 else np.array([len(ids)])
            own.add(values, ends)
        self._known.update(zip(new, range(len(self._known), len(self._known) + len(new))))

    def _numbers(self, found: list[str]) -> np.ndarray:
        """The words' numbers; new words are encoded."""
        if len(self._known) > WORDS or self._a.starts[self._a.n] + self._b.starts[self._b.n] > TOKENS:
            self._forget()
        new = [w for w in dict.fromkeys(found) if w not in self._known]
        # a word of blanks, a text's last, would run into the next one
        whole = [w for w in new if not w[-1].isspace()]
        for group in [whole, *([w] for w in new if w[-1].isspace())]:
            if group:
                self._learn(group)
        return np.fromiter(map(self._known.__getitem__, found), np.int64, len(found))

    def _shown(self, a: np.ndarray, b: np.ndarray, last_a: tuple, last_b: tuple) -> tuple[str, int]:
        """The groups' ids as text, and how many groups there are, by the last tokens of each."""
        closing, first = [], []
        for ids, last in ((a, last_a), (b, last_b)):
            own = np.zeros(len(ids), bool)
            own[np.concatenate(last)] = True
            closing.append(own)
            first.append(np.concatenate([[0], np.flatnonzero(own) + 1]))
        group_a, group_b = (np.cumsum(own) - own for own in closing)
        out = np.empty(len(a) + len(b), object)
        out[np.arange(len(a)) + first[1][group_a]] = self._a_shown[closing[0].astype(np.int8), a]
        out[np.arange(len(b)) + first[0][group_b + 1]] = self._b_shown[closing[1].astype(np.int8), b]
        return "".join(out.tolist()), len(first[0]) - 1

    def aligned(self, text: str):
        """(n_a, n_b, n_groups, digest, linked id pairs, times); None if the bytes differ."""
        n_a = n_b = n_groups = 0
        digest = hashlib.sha256()
        pairs = times = np.zeros(0, np.int64)
        found = words(" " + text)
        for at in range(0, len(found), STRETCH):
            numbers = self._numbers(found[at : at + STRETCH])
            if self._changed and not self._changed.isdisjoint(numbers.tolist()):
                return None
            a, b = self._a.joined(numbers), self._b.joined(numbers)
            ends_a, ends_b = np.cumsum(self._a_lengths[a]), np.cumsum(self._b_lengths[b])
            stretches, groups = align(ends_a.tolist(), ends_b.tolist())
            i, k, j, _ = np.array(stretches, np.int64).T
            run = np.repeat(i - np.cumsum(k - i) + (k - i), k - i) + np.arange((k - i).sum())
            others = run + np.repeat(j - i, k - i)
            _, end_a, _, end_b = np.array(groups or np.zeros((0, 4)), np.int64).T
            shown, number = self._shown(a, b, (run, end_a - 1), (others, end_b - 1))
            # a group ends with a semicolon, a text without
            digest.update(((";" * bool(at)) + shown[:-1]).encode())
            n_a, n_b, n_groups = n_a + len(a), n_b + len(b), n_groups + number
            left, right = linked_within(ends_a, ends_b, run, others)
            linked = np.concatenate([(a[run] << 32) | b[others], (a[left] << 32) | b[right]])
            own, n = np.unique(linked, return_counts=True)
            if not at:
                pairs, times = own, n.astype(np.int64)
                continue
            pairs, where = np.unique(np.concatenate([pairs, own]), return_inverse=True)
            times = np.bincount(where, weights=np.concatenate([times, n]), minlength=len(pairs)).astype(np.int64)
        return n_a, n_b, n_groups, digest.hexdigest(), pairs, times


@functools.cache
def _encoders(byte_path: str, piece_path: str) -> Encoders:
    """One for all tasks of a worker, which so remembers words from task to task."""
    return Encoders(byte_path, piece_path)


def _linker(byte_path: str, piece_path: str):
    names = ["row", "id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"]

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoders = _encoders(byte_path, piece_path)
        number = TaskContext.get().partitionId() << _ROW_BITS
        nothing = (0, 0, 0, "", np.zeros(0, np.int64), np.zeros(0, np.int64))
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = part.column("text").to_pylist()
                found = [(encoders.aligned(t) if t else None) or nothing for t in texts]
                n_a, n_b, n_groups, digests, pairs, times = zip(*found)
                ends = pa.array(np.cumsum([0, *map(len, pairs)]), pa.int32())
                counts = [np.array(n, np.int64) for n in (n_a, n_b, n_groups)]
                arrays = [
                    pa.array(np.arange(number, number + len(found))),
                    part.column("id"),
                    *map(pa.array, [*counts, counts[0] + counts[1] - counts[2]]),
                    pa.array(digests, pa.string()),
                    *(pa.ListArray.from_arrays(ends, np.concatenate(v)) for v in (pairs, times)),
                ]
                number += len(found)
                yield pa.RecordBatch.from_arrays(arrays, names)

    return link


def links(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    byte_path: str | None = None,
    piece_path: str | None = None,
) -> DataFrame:
    """Per document: row, id, n_a, n_b, n_groups, n_links, groups_sha256, and its distinct linked
    id pairs (a's id times 2^32 plus b's) with how often each is linked.

    A group of n and m tokens has n + m - 1 links. A text that is NULL or empty, or whose bytes
    one of the tokenizers changes, has no tokens.
    """
    texts = documents(docs, id_col, text_col).select(
        F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")
    )
    schema = (
        f"row long, id {texts.schema['id'].dataType.simpleString()}, n_a long, n_b long, n_groups long, "
        "n_links long, groups_sha256 string, pairs array<long>, times array<long>"
    )
    return texts.mapInArrow(_linker(byte_path or vocabulary(), piece_path or piece_model()), schema)


def pair_counts(linked: DataFrame) -> DataFrame:
    """pair, n: links that hold the pair; best: whether no pair of its B id has more."""
    each = linked.select(F.inline(F.arrays_zip("pairs", "times")))
    counts = written(each.groupBy(F.col("pairs").alias("pair")).agg(F.sum("times").alias("n")), "pairs")
    b = F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)).alias("b")
    most = counts.groupBy(b).agg(F.max("n").alias("most"))
    return counts.select("*", b).join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def align_corpus(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", few_pairs: int = FEW_PAIRS, **paths
) -> DataFrame:
    """Per document: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    ``n_best`` counts the links whose pair is its B id's most frequent in the corpus, ties included;
    ``count_sum`` adds up the links' counts. Documents without tokens have zeros and the digest ''.
    Rows that repeat, also NULL ids, count and come out each by themselves; an empty table gives no
    rows; other columns are left behind. The pairs' counts are sent to every task while there are
    at most ``few_pairs`` of them, else joined by a shuffle.
    """
    linked = written(links(docs, id_col=id_col, text_col=text_col, **paths), "links")
    counts = written(pair_counts(linked), "counts")
    if counts.count() <= few_pairs:
        counts = F.broadcast(counts)
    each = linked.select("row", F.inline(F.arrays_zip("pairs", "times")))
    sums = (
        each.join(counts, F.col("pairs") == F.col("pair"))
        .groupBy("row")
        .agg(
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
            F.sum(F.col("times") * F.col("n")).alias("count_sum"),
        )
    )
    shown = ["n_a", "n_b", "n_groups", "n_links"]
    return linked.join(sums, "row", "left").select(
        F.col("id").alias(id_col),
        *shown,
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_best", "count_sum")],
        "groups_sha256",
    )
