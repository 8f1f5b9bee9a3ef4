"""Language identification with interpolated Kneser-Ney character trigram models.

Letters in lower case are symbols, everything between words is one boundary symbol, and no
context reaches over a boundary. Three symbols of eight bits make the hash of a trigram (higher
code points are folded into them), so a model has at most 2^24 trigrams a language however
large the corpus it is counted from; what is counted grows with the corpus and is summed
before and after the shuffle. A text's language is the one with the lowest cross-entropy per
symbol. The rejection is calibrated on the counts: a text is rejected if its best model explains
it no better than that model explains the nearest other language.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from tickwright.llm.common import documents, fresh, remainder, slices

UNKNOWN = "und"

#: So many standard errors of its length a text may exceed the calibrated cross-entropy.
ERRORS = 6.0

_PIECE = 1 << 20  # characters at a time
_CELLS = 1 << 23  # looked-up probabilities at a time
_LETTERS = np.zeros(0, bool)


def _letters() -> np.ndarray:
    global _LETTERS
    if not len(_LETTERS):
        _LETTERS = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _LETTERS


def _pieces(texts) -> Iterator[list[tuple[int, str]]]:
    """Lists of (row, part of its text) of about a piece together; parts end between words.

    A run of letters that is longer than a piece is taken for several words.
    """
    batch, size = [], 0
    for row, text in enumerate(texts):
        at = 0
        while text is not None and at < len(text):
            end = len(text)
            if end - at > _PIECE:
                # the last place within the piece where no letter stands
                end = at + _PIECE
                while end > at and text[end].isalpha():
                    end -= 1
                end = end if end > at else at + _PIECE
            batch.append((row, text[at:end].lower()))
            size, at = size + end - at, end
            if size >= _PIECE:
                yield batch
                batch, size = [], 0
    if batch:
        yield batch


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The trigrams (hash) of all texts, and for each the number of its text."""
    joined = "".join(t + "\n" for t in texts)
    codes = np.frombuffer(joined.encode("utf-32-le", "replace"), np.uint32)
    symbols = np.where(_letters()[codes], codes % 251 + 1, 0).astype(np.uint32)
    owner = np.repeat(np.arange(len(texts)), [len(t) + 1 for t in texts])
    before = np.concatenate([np.zeros(1, np.uint32), symbols[:-1]])
    kept = (symbols | before) != 0  # the first of several boundaries stands for all
    symbols, owner = symbols[kept], owner[kept]
    one = np.concatenate([np.zeros(1, np.uint32), symbols[:-1]])
    two = np.concatenate([np.zeros(1, np.uint32), one[:-1]])
    two[one == 0] = 0
    return (two << 16) | (one << 8) | symbols, owner


def count_trigrams(docs: DataFrame) -> DataFrame:
    """(lang, gram, n) over all texts (columns lang, text), summed in each task first."""

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, pd.Series] = {}
        for batch in batches:
            for lang, rows in batch.groupby("lang"):
                for pieces in _pieces(rows["text"]):
                    grams, _ = trigrams([t for _, t in pieces])
                    keys, n = np.unique(grams, return_counts=True)
                    part = pd.Series(n, keys)
                    sums[lang] = part if lang not in sums else sums[lang].add(part, fill_value=0)
        for lang, part in sums.items():
            grams, n = part.index.astype("int32"), part.astype("int64")
            yield from slices(pd.DataFrame({"lang": lang, "gram": grams, "n": n}))

    partial = docs.select("lang", "text").mapInPandas(counted, "lang string, gram int, n long")
    return partial.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class Model:
    """Sorted arrays of trigram, bigram and context hashes with log probabilities by language."""

    def __init__(self, counts: pd.DataFrame):
        self.languages = sorted(counts["lang"].unique())
        size = len(self.languages)
        self.grams = np.unique(counts["gram"].to_numpy(np.int64))
        self.contexts = np.unique(self.grams >> 8)
        self.pairs = np.unique(self.grams & 0xFFFF)
        self.log_gram = np.zeros((len(self.grams), size), np.float32)
        self.log_context = np.zeros((len(self.contexts), size), np.float32)
        self.log_pair = np.zeros((len(self.pairs), size), np.float32)
        self.log_left = np.zeros((256, size), np.float32)
        self.log_symbol = np.zeros((256, size), np.float32)
        self.variance = np.zeros(size)
        own = {lang: rows.sort_values("gram") for lang, rows in counts.groupby("lang")}
        own = [(own[x]["gram"].to_numpy(np.int64), own[x]["n"].to_numpy(float)) for x in self.languages]
        for i, (grams, n) in enumerate(own):
            self._fit(i, grams, n)
        # cross[i, j]: of the texts of language i by the model of language j
        cross = np.array(
            [-(n @ self.log_gram[_places(grams, self.grams)]) / n.sum() for grams, n in own]
        ).reshape(size, size)
        expected = cross.diagonal().copy()
        np.fill_diagonal(cross, np.inf)
        nearest = cross.min(0, initial=np.inf)
        self.limit = np.where(np.isfinite(nearest), np.maximum(nearest, expected), 2 * expected)

    def _fit(self, i: int, grams: np.ndarray, n: np.ndarray) -> None:
        """Probabilities of one language, for all hashes that any language has."""
        pair, continued = np.unique(grams & 0xFFFF, return_counts=True)
        symbol, preceded = np.unique(pair & 0xFF, return_counts=True)
        single = np.full(256, 0.5 / 256)  # half a continuation is spread over all symbols
        single[symbol] += preceded
        single /= single.sum()

        left, left_types = np.unique(pair >> 8, return_counts=True)
        left_total = np.zeros(256)
        np.add.at(left_total, pair >> 8, continued)
        discount = _discount(continued)
        back = np.ones(256)
        back[left] = discount * left_types / left_total[left]
        at = _places(pair, self.pairs)
        p_pair = back[self.pairs >> 8] * single[self.pairs & 0xFF]
        p_pair[at] += (continued - discount) / left_total[pair >> 8]

        context, types = np.unique(grams >> 8, return_counts=True)
        where = _places(context, self.contexts)
        total = np.zeros(len(self.contexts))
        np.add.at(total, _places(grams >> 8, self.contexts), n)
        discount = _discount(n)
        lower = np.ones(len(self.contexts))
        lower[where] = discount * types / total[where]
        p = lower[_places(self.grams >> 8, self.contexts)] * p_pair[_places(self.grams & 0xFFFF, self.pairs)]
        p[_places(grams, self.grams)] += (n - discount) / total[_places(grams >> 8, self.contexts)]

        self.log_gram[:, i] = np.log(p)
        self.log_context[:, i] = np.log(lower)
        self.log_pair[:, i] = np.log(p_pair)
        self.log_left[:, i] = np.log(back)
        self.log_symbol[:, i] = np.log(single)
        own = np.log(p[_places(grams, self.grams)])
        mean = (n * own).sum() / n.sum()
        self.variance[i] = (n * own**2).sum() / n.sum() - mean**2

    def log_probability(self, grams: np.ndarray) -> np.ndarray:
        """By trigram and language, backed off where no language has seen it."""
        grams = grams.astype(np.int64)
        found, seen = _find(grams, self.grams)
        out = self.log_gram[found]
        if not seen.all():
            rest = grams[~seen]
            pair, has_pair = _find(rest & 0xFFFF, self.pairs)
            lower = self.log_left[rest >> 8 & 0xFF] + self.log_symbol[rest & 0xFF]
            lower[has_pair] = self.log_pair[pair[has_pair]]
            context, has_context = _find(rest >> 8, self.contexts)
            out[~seen] = lower + np.where(has_context[:, None], self.log_context[context], 0)
        return out

    def judge(self, texts) -> pd.DataFrame:
        """lang_pred, score, cross_entropy and rejected of each text."""
        rows, size = len(texts), len(self.languages)
        total, n, lettered = np.zeros((rows, size)), np.zeros(rows), np.zeros(rows, bool)
        step = max(1, _CELLS // max(1, size))
        for pieces in _pieces(texts):
            owners = np.array([row for row, _ in pieces])
            grams, part = trigrams([t for _, t in pieces])
            owner = owners[part]
            n += np.bincount(owner, minlength=rows)
            lettered |= np.bincount(owner, grams & 0xFF, rows) > 0
            for at in range(0, len(grams) if size else 0, step):
                logs = self.log_probability(grams[at : at + step])
                who = owner[at : at + step]
                starts = np.flatnonzero(np.r_[True, who[1:] != who[:-1]])
                total[who[starts]] += np.add.reduceat(logs, starts, axis=0, dtype=np.float64)
        known = lettered & (size > 0)
        if not size:
            return pd.DataFrame(
                {"lang_pred": UNKNOWN, "score": 0.0, "cross_entropy": np.nan, "rejected": True},
                index=range(rows),
            )
        entropy = -total / np.maximum(n, 1)[:, None]
        best = entropy.argmin(1)
        least = entropy[np.arange(rows), best]
        score = 1 / np.exp(-(entropy - least[:, None]) * n[:, None]).sum(1)
        allowed = self.limit[best] + ERRORS * np.sqrt(self.variance[best] / np.maximum(n, 1))
        return pd.DataFrame(
            {
                "lang_pred": np.where(known, np.array(self.languages, object)[best], UNKNOWN),
                "score": np.where(known, score, 0.0),
                "cross_entropy": np.where(known, least, np.nan),
                "rejected": ~known | (least > allowed),
            }
        )


def _places(keys: np.ndarray, among: np.ndarray) -> np.ndarray:
    return np.searchsorted(among, keys)


def _find(keys: np.ndarray, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(among, keys), len(among) - 1)
    return at, among[at] == keys


def _discount(counts: np.ndarray) -> float:
    once, twice = (counts == 1).sum(), (counts == 2).sum()
    return min(0.95, once / (once + 2 * twice)) if once and twice else 0.5


def train(docs: DataFrame) -> Model:
    """Fit on every row with a language and a text (columns lang, text)."""
    labelled = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    # at most 2^24 trigrams a language, however many rows
    return Model(count_trigrams(labelled).toPandas())


def predict(model: Model, text: Column | str, spark) -> Column:
    """A struct of lang_pred, score, cross_entropy and rejected."""
    shared = spark.sparkContext.broadcast(vars(model))  # arrays only, as large as the model

    @pandas_udf("lang_pred string, score double, cross_entropy double, rejected boolean")
    def judged(texts: pd.Series) -> pd.DataFrame:
        local = Model.__new__(Model)
        vars(local).update(shared.value)
        return local.judge(texts.to_list())

    return judged(text)


def held_out(doc_id: Column | str) -> Column:
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return remainder(doc_id, 3) == 1


def identify(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score, cross_entropy, rejected.

    Trained on the text and lang of rows that are not held out. NULL texts and texts without
    a letter are ``und`` with score 0 and rejected, as is everything if no row has a language.
    Equal entropies go to the first language by name. Repeated rows come back as often as they
    are there, an empty table gives no rows, other columns are left behind.
    """
    rows = documents(docs, "doc_id", "text", "lang")
    model = train(rows.filter(~held_out("doc_id")))
    found = predict(model, "text", docs.sparkSession)
    return rows.select("doc_id", held_out("doc_id").alias("held_out"), found.alias("f")).select(
        "doc_id", "held_out", "f.*"
    )


def recognised(docs: DataFrame) -> DataFrame:
    """The documents that are not rejected, with all their columns."""
    rows = documents(docs, "doc_id", "text", "lang")
    model = train(rows.filter(~held_out("doc_id")))
    name = fresh(docs, "judged")
    judged = docs.withColumn(name, predict(model, F.col("text"), docs.sparkSession))
    return judged.filter(~F.col(name)["rejected"]).select(*[F.col(f"`{c}`") for c in docs.columns])
