"""Language identification: multinomial logistic regression on TF-IDF of character n-grams, trained with FTRL-proximal.

Texts become lower-cased letters with one blank for anything else; 1-, 2- and 3-grams of these are hashed to FEATURES
columns. Document frequencies are counted over all documents that may be learned from. The weights are trained on a
bounded sample of labelled documents (`sample`, shared out by language, of each those of least doc_id hash) by
follow-the-regularised-leader with L1 and L2 penalties, which leaves most of them zero; a part of each language's sample is
held back to fit the temperature of the softmax. Every language of which a document has letters is learned.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from viewloom.llm.common import query, row_tag, table

FEATURES = 1 << 14
ORDERS = (1, 2, 3)
#: Labelled documents that the weights are trained on, at most unless LEAST of each language are more.
SAMPLE = 6_000
#: Documents of a language that are learned from even where there are more languages than the sample has room for.
LEAST = 5
ALPHA, BETA, L1, L2, EPOCHS = 0.5, 1.0, 0.05, 0.05, 3
BATCH = 16
UNKNOWN = "und"
#: Characters that are hashed at once.
CHUNK = 1 << 20


def has_letter(text: str | None) -> bool:
    return text is not None and any(c.isalpha() for c in text)


_ALPHA = np.array([chr(c).isalpha() for c in range(0x3000)])


def codes(text: str | None) -> np.ndarray:
    """Code points of the lower-cased text, runs of anything but letters as one blank, blanks at both ends."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    low = points < len(_ALPHA)
    letter = np.zeros(len(points), dtype=bool)
    letter[low] = _ALPHA[points[low]]
    if not low.all():
        rest = np.unique(points[~low])
        known = np.array([chr(c).isalpha() for c in rest])
        letter[~low] = known[np.searchsorted(rest, points[~low])]
    kept = np.where(letter, points, 32)
    blank = ~letter
    kept = kept[~(blank & np.r_[False, blank[:-1]])]
    return np.r_[np.uint32(32), kept, np.uint32(32)] if len(kept) else kept


def counts(text: str | None) -> np.ndarray:
    """How often each hashed n-gram occurs in the whole text; all zero without letters."""
    found = np.zeros(FEATURES, dtype=np.int64)
    points = codes(text)
    if not (points != 32).any():
        return found
    for at in range(0, len(points), CHUNK):
        part = points[at : at + CHUNK + max(ORDERS) - 1].astype(np.uint64)
        for n in ORDERS:
            size = min(len(part) - n + 1, CHUNK)
            if size <= 0:
                continue
            key = np.full(size, n, dtype=np.uint64)
            for j in range(n):
                key = (key * np.uint64(0x9E3779B97F4A7C15)) ^ part[j : j + size]
            key = key * np.uint64(0xD6E8FEB86659FD93)
            found += np.bincount((key >> np.uint64(50)).astype(np.int64), minlength=FEATURES)
    return found


def tf_idf(at: np.ndarray, n: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Values, of unit length, of the features `at` that occur `n` times in a text."""
    values = (1 + np.log(n)) * idf[at]
    norm = np.sqrt((values**2).sum())
    return values / norm if norm > 0 else values


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # features x languages
    bias: np.ndarray
    temperature: float

    def chances(self, found: np.ndarray) -> np.ndarray:
        at = np.flatnonzero(found)
        values = tf_idf(at, found[at], self.idf)
        return softmax((values @ self.weights[at] + self.bias) / self.temperature)


def softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def ftrl(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, classes: int) -> tuple[np.ndarray, np.ndarray]:
    """FTRL-proximal with elastic net; the bias is the last, unpenalised row."""
    z, n = np.zeros((FEATURES + 1, classes)), np.zeros((FEATURES + 1, classes))
    bias = FEATURES

    def solved(at: np.ndarray) -> np.ndarray:
        zs, l1 = z[at], np.where(at == bias, 0.0, L1)[:, None]
        return np.where(np.abs(zs) <= l1, 0.0, (np.sign(zs) * l1 - zs) / ((BETA + np.sqrt(n[at])) / ALPHA + L2))

    order = np.random.default_rng(7)
    for _ in range(EPOCHS):
        turn = order.permutation(len(rows))
        for start in range(0, len(rows), BATCH):
            chosen = turn[start : start + BATCH]
            at = np.unique(np.concatenate([rows[i][0] for i in chosen] + [np.array([bias])]))
            w = solved(at)
            slope = np.zeros_like(w)
            for i in chosen:
                own = np.searchsorted(at, rows[i][0])
                p = softmax(rows[i][1] @ w[own] + w[-1])
                p[y[i]] -= 1
                slope[own] += rows[i][1][:, None] * p
                slope[-1] += p
            squares = slope**2
            z[at] += slope - (np.sqrt(n[at] + squares) - np.sqrt(n[at])) / ALPHA * w
            n[at] += squares
    whole = solved(np.arange(FEATURES + 1))
    return whole[:-1], whole[-1]


def temperature_of(scores: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least negative log-likelihood, by golden section over its logarithm."""
    if len(y) == 0:
        return 1.0
    loss = lambda t: -np.log(np.maximum(softmax(scores / np.exp(t))[np.arange(len(y)), y], 1e-12)).mean()
    low, high, ratio = np.log(0.02), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(60):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def fit(found: list[tuple[np.ndarray, np.ndarray]], languages: list[str], idf: np.ndarray) -> Model:
    """Fit on the features of rows and how often they occur, with the rows' languages; every fifth row of a language is for
    the temperature only."""
    names = sorted(set(languages))
    number = {name: i for i, name in enumerate(names)}
    rows = [(at, tf_idf(at, n, idf).astype(np.float32)) for at, n in found]
    y = np.array([number[x] for x in languages])
    back = pd.Series(y).groupby(y).cumcount().to_numpy() % 5 == 4
    own = np.flatnonzero(~back)
    weights, bias = ftrl([rows[i] for i in own], y[own], len(names))
    scores = np.array([rows[i][1] @ weights[rows[i][0]] + bias for i in np.flatnonzero(back)])
    return Model(names, idf, weights, bias, temperature_of(scores, y[back]))


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """In how many of `docs` each feature occurs, and how many have any. Partitions add up their own documents first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(FEATURES, dtype=np.int64), 0
        for batch in batches:
            for text in batch.column("text"):
                own = counts(text.as_py())
                total += own > 0
                rows += bool(own.any())
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[at, FEATURES]), pa.array(np.r_[total[at], rows])], ["feature", "n"])

    sums = docs.select("text").mapInArrow(run, "feature bigint, n bigint").groupBy("feature").agg(F.sum("n").alias("n")).toArrow()
    df = np.zeros(FEATURES + 1, dtype=np.int64)  # FEATURES + 1 numbers at most, whatever the corpus
    df[sums.column("feature").to_numpy()] = sums.column("n").to_numpy()
    return df[:-1], int(df[-1])


def shared_out(ids: DataFrame, sample: int) -> DataFrame:
    """`ids` (doc_id, lang, ...) cut to `sample` rows by language: of each those of least doc_id hash, all of a language that
    has fewer than the others' share, and LEAST of each at least."""
    of_lang = ids.groupBy("lang").agg(F.count(F.lit(1)).alias("size"))
    sizes = sorted((r["size"], r["count"]) for r in of_lang.groupBy("size").count().collect())
    share, room, left = 0, sample, sum(n for _, n in sizes)
    for size, n in sizes:  # smallest languages first; what they leave of their share goes to the others
        share = room // left
        if size > share:
            break
        room, left = room - size * n, left - n
        share = size
    share = max(share, LEAST)
    # A hash that twice the share's number and some more pass leaves few rows to rank, also of a very large language.
    part = F.least(F.lit(1.0), (2.0 * share + 50) / F.col("size"))
    rank = F.xxhash64("doc_id")
    # Sizes are broadcast, so that no language's ids meet before the hash has thinned them: some 50 bytes for each language, of
    # which the driver will hold a row of weights.
    near = ids.join(F.broadcast(of_lang), "lang").where(rank.cast("double") <= part * 2.0**64 - 2.0**63)
    number = F.row_number().over(Window.partitionBy("lang").orderBy(rank, "doc_id"))
    return near.withColumn("__number", number).where(F.col("__number") <= share).drop("__number", "size")


def train(docs: DataFrame, sample: int = SAMPLE) -> Model | None:
    """The model learned from `docs` (doc_id, text, lang), rows without text or lang left out; None if there are none."""
    usable = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull()).select("doc_id", "text", "lang")
    df, rows = document_frequencies(usable)
    idf = np.log((1 + rows) / (1 + df)) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, n = [], []
            for text in batch.column("text"):
                own = counts(text.as_py())
                at.append(np.flatnonzero(own).astype(np.int32))
                n.append(own[at[-1]].astype(np.int32))
            arrays = [batch.column("doc_id"), batch.column("lang"), pa.array(at, pa.list_(pa.int32())), pa.array(n, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "lang", "at", "n"])

    # One row of each doc_id; the chosen can be broadcast, and only their counts go to the driver.
    tagged = usable.where(F.col("doc_id").isNotNull() & F.col("text").rlike(r"\p{L}")).withColumn("tag", row_tag(F.col("text")))
    chosen = shared_out(tagged.groupBy("doc_id").agg(F.min(F.struct("tag", "lang")).alias("own")).select("doc_id", "own.*"), sample)
    once = tagged.join(F.broadcast(chosen), ["doc_id", "tag", "lang"]).groupBy("doc_id", "lang").agg(F.first("text").alias("text"))
    got = once.mapInArrow(run, "doc_id bigint, lang string, at array<int>, n array<int>").toArrow().sort_by("doc_id")
    found = [(at.values.to_numpy(), n.values.to_numpy()) for at, n in zip(got.column("at"), got.column("n"), strict=True)]
    filled = [i for i, (at, _) in enumerate(found) if len(at)]
    if not filled:
        return None
    languages = got.column("lang").to_pylist()
    return fit([found[i] for i in filled], [languages[i] for i in filled], idf)


def detector(spark: SparkSession, model: Model | None):
    """A column function from text to struct(lang_pred, score)."""
    sent = spark.sparkContext.broadcast(model)

    @pandas_udf("lang_pred string, score double")
    def detect(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = sent.value
        for texts in batches:
            names, scores = [], []
            for text in texts:
                if own is None or not has_letter(text):
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                chances = own.chances(counts(text))
                best = int(chances.argmax())
                names.append(own.languages[best])
                scores.append(float(chances[best]))
            yield pd.DataFrame({"lang_pred": pd.Series(names, dtype=object), "score": pd.Series(scores, dtype=float)})

    return detect


def remainder_held(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, learn: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """`docs` with `lang_pred` and `score` (its calibrated probability), as learned from `learn` (doc_id, text, lang).

    Text that is null or has no letter gets `und` and 0, as does any text if there was nothing to learn from. Ties go to
    the language first in order. Repeated rows are judged alike; an empty table gives an empty result. Columns named as
    the added ones are replaced.
    """
    detect = detector(docs.sparkSession, train(learn, sample))
    out = docs.withColumn("__d", detect(F.col("text")))
    return out.withColumns({"lang_pred": F.col("__d.lang_pred"), "score": F.col("__d.score")}).drop("__d")


@query("op7_language_ftrl")
def op7_language_ftrl(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = remainder_held(F.col("doc_id"))
    found = identify(docs.select("doc_id", "text"), docs.where(~held))
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score")
