"""Toxicity as cumulative-link ordinal regression on sparse text features.

P(grade <= k) = sigmoid(threshold[k] - w.x): one weight vector shared by all thresholds, which are kept in order. x holds
hashed words and word beginnings that a document contains. The given labels tell toxic from not; the toxic ones are
graded by how many different marked features (those far more frequent under the toxic label) they hold, so the grades are
0 (not toxic), 1 (toxic) and 2 (severe). A document is rejected if P(grade >= 1) is at least one half.

The model is fitted on a bounded sample of labelled documents (`sample`, those of least doc_id hash, one row of each id). Scores are for whole texts.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from viewloom.llm.common import query, row_tag, scratch, stored, table

#: Labelled documents that the model is fitted on, at most.
SAMPLE = 16_000
BITS = 20
BEGINNINGS = (4, 5, 6, 7)
#: Features kept: those of greatest z between labels, at most so many.
FEATURES = 1 << 14
MIN_Z = 2.5
#: Marked features, whose number grades toxic documents.
MARK_Z = 5.0
ITERATIONS = 300
RIDGE = 1e-4

WORD = re.compile(r"[^\W\d_]+")


def hashed(word: str) -> list[int]:
    """Numbers of the word and of its beginnings."""
    shift = 32 - BITS
    own = [zlib.crc32(word.encode()) >> shift]
    return own + [zlib.crc32(b"^" + word[:n].encode()) >> shift for n in BEGINNINGS if len(word) > n]


def text_features(text: str | None, memo: dict[str, list[int]], weights: np.ndarray | None = None) -> np.ndarray:
    """Distinct feature numbers of a whole text, ascending; with `weights`, only of features that have one. `memo` keeps
    the numbers of words seen, for one and the same `weights`."""
    found: set[int] = set()
    for word in set(WORD.findall((text or "").lower())):
        numbers = memo.get(word)
        if numbers is None:
            if len(memo) > 500_000:
                memo.clear()
            numbers = hashed(word)
            memo[word] = numbers = numbers if weights is None else [x for x in numbers if weights[x]]
        if numbers:
            found.update(numbers)
    return np.fromiter(sorted(found), dtype=np.int32, count=len(found))


@dataclass
class Model:
    weights: np.ndarray  # by feature number
    thresholds: np.ndarray  # ascending; grade > k where the score passes thresholds[k]

    def grades(self, score: np.ndarray) -> np.ndarray:
        """P(grade > k) by row and k."""
        return 1.0 / (1.0 + np.exp(np.clip(self.thresholds[None, :] - score[:, None], -50, 50)))


def fit(features: list[np.ndarray], toxic: np.ndarray) -> Model:
    """Fit on rows of feature numbers and 0/1 labels. With one label only, the model says that label's rate for all."""
    size = 1 << BITS
    weights = np.zeros(size)
    n, bad = len(toxic), int(toxic.sum())
    if bad == 0 or bad == n:
        sure = 20.0 if bad == 0 else -20.0
        return Model(weights, np.array([sure, abs(sure) + 1]))
    rows = np.repeat(np.arange(n), [len(f) for f in features])
    columns = np.concatenate(features)
    of_bad = np.bincount(columns[toxic[rows] == 1], minlength=size).astype(float)
    of_all = np.bincount(columns, minlength=size).astype(float)
    rate = (of_all + 0.5) / (n + 1)
    z = (of_bad - bad * of_all / n) / np.sqrt(np.maximum(bad * rate * (1 - rate), 1e-9))
    z[of_all < 3] = 0
    kept = np.flatnonzero(np.abs(z) >= MIN_Z)
    kept = kept[np.argsort(-np.abs(z[kept]), kind="stable")][:FEATURES]
    number = np.full(size, -1)
    number[kept] = np.arange(len(kept))
    use = number[columns] >= 0
    r, c = rows[use], number[columns[use]]
    marks = np.bincount(r[z[kept[c]] >= MARK_Z], minlength=n) if len(r) else np.zeros(n)
    grade = toxic * (1 + (marks > np.median(marks[toxic == 1])))
    # Gradient descent (Adam) on the mean negative log-likelihood. The second threshold is the first plus exp(gap).
    w, first, gap = np.zeros(len(kept)), 1.0, 0.0
    m, v = np.zeros(len(kept) + 2), np.zeros(len(kept) + 2)
    sigmoid = lambda t: 1.0 / (1.0 + np.exp(-np.clip(t, -50, 50)))
    for step in range(1, ITERATIONS + 1):
        score = np.bincount(r, w[c], minlength=n)
        a, b = sigmoid(first - score), sigmoid(first + np.exp(gap) - score)
        chance = np.maximum(np.select([grade == 0, grade == 1], [a, b - a], 1 - b), 1e-12)
        da = np.select([grade == 0, grade == 1], [a * (1 - a), -a * (1 - a)], 0.0) / chance
        db = np.select([grade == 1, grade == 2], [b * (1 - b), -b * (1 - b)], 0.0) / chance
        by_row = (da + db) / n  # of the log-likelihood, by minus the score
        slope = np.concatenate([np.bincount(c, by_row[r], minlength=len(kept)) + RIDGE * w, [-(da + db).mean(), -(db * np.exp(gap)).mean()]])
        m, v = 0.9 * m + 0.1 * slope, 0.999 * v + 0.001 * slope**2
        move = 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
        w, first, gap = w - move[:-2], first - move[-2], gap - move[-1]
    weights[kept] = w
    return Model(weights, np.array([first, first + np.exp(gap)]))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """The model of the labelled documents. Rows without doc_id or label, and labels other than 0 and 1, are left out."""
    labelled = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    # One row of each doc_id, and only of ids that have a document.
    tagged = docs.select("doc_id", "text", row_tag(F.col("text")).alias("tag")).where(F.col("doc_id").isNotNull())
    present = tagged.groupBy("doc_id").agg(F.min("tag").alias("tag")).join(labelled, "doc_id")
    chosen = present.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)  # at most `sample` rows of three numbers: broadcast

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[str, list[int]] = {}
        for batch in batches:
            found = [text_features(t.as_py(), memo) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(found, pa.list_(pa.int32()))], ["toxic", "features"])

    once = tagged.join(F.broadcast(chosen), ["doc_id", "tag"]).groupBy("doc_id", "toxic").agg(F.first("text").alias("text"))
    rows = once.select(F.col("toxic").cast("int").alias("toxic"), "text")
    schema = "toxic int, features array<int>"
    found = stored(rows.mapInArrow(run, schema), f"{scratch(docs.sparkSession)}/features")
    n, bad = found.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not 0 < bad < n:
        return fit([np.zeros(0, dtype=np.int64)] * n, np.full(n, int(bad > 0)))
    # Only the features that `fit` would keep go to the driver.
    counts = found.select("toxic", F.explode("features").alias("feature")).groupBy("feature").agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("bad"))
    rate = (F.col("n") + 0.5) / F.lit(n + 1)
    z = F.abs((F.col("bad") - F.col("n") * F.lit(bad / n)) / F.sqrt(F.greatest(F.lit(bad) * rate * (1 - rate), F.lit(1e-9))))
    telling = counts.withColumn("z", z).where((F.col("n") >= 3) & (F.col("z") >= MIN_Z)).orderBy(F.desc("z"), "feature").limit(FEATURES)
    kept = np.array(sorted(r["feature"] for r in telling.select("feature").collect()), dtype=np.int32)

    def narrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [np.intersect1d(x.values.to_numpy(), kept, assume_unique=True) for x in batch.column("features")]
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(own, pa.list_(pa.int32()))], ["toxic", "features"])

    got = found.mapInArrow(narrow, schema).toArrow()
    features = [x.values.to_numpy().astype(np.int64) for x in got.column("features")]
    return fit(features, got.column("toxic").to_numpy())


def severity(spark: SparkSession, model: Model):
    """A column function from text to struct(severity, grade, p_toxic)."""
    sent = spark.sparkContext.broadcast((model.weights.astype(np.float32), model.thresholds))

    @pandas_udf("severity double, grade int, p_toxic double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        weights, thresholds = sent.value
        own, memo = Model(weights, thresholds), {}
        for texts in batches:
            sums = np.array([float(weights[text_features(t, memo, weights)].sum(dtype=np.float64)) for t in texts])
            above = own.grades(sums)
            chances = np.column_stack([1 - above[:, :1], above[:, :1] - above[:, 1:], above[:, 1:]])
            yield pd.DataFrame({"severity": above.sum(axis=1), "grade": chances.argmax(axis=1).astype(np.int32), "p_toxic": above[:, 0]})

    return score


def judge(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """`docs` with `severity` (expected grade, 0 to 2), `grade` (the likeliest), `p_toxic` and `toxic` (rejected or not).

    Null or empty text has no features and gets the score of such a text. Without usable labels nothing is toxic. Repeated
    rows are judged alike; an empty table gives an empty result. Columns named as the added ones are replaced.
    """
    score = severity(docs.sparkSession, train(docs, labels, sample))
    scored = docs.withColumn("__s", score(F.col("text")))
    return scored.withColumns({
        "severity": F.col("__s.severity"), "grade": F.col("__s.grade"), "p_toxic": F.col("__s.p_toxic"), "toxic": F.col("__s.p_toxic") >= 0.5,
    }).drop("__s")


@query("op9_ordinal_toxicity")
def op9_ordinal_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return judge(docs, table(spark, sf_dir, "labels")).select("doc_id", "severity", "grade", "p_toxic", "toxic")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not rejected, with their columns as they are."""
    score = severity(spark, train(docs, table(spark, sf_dir, "labels")))
    return docs.withColumn("__s", score(F.col("text"))).where(F.col("__s.p_toxic") < 0.5).select(docs.columns)
