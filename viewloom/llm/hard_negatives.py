"""Hard negatives by Fagin's threshold algorithm.

Rows are dealt out in blocks; a block keeps one candidate list for each dimension, sorted by that component. An anchor reads
the lists of its block from the end that its own component's sign makes best, in step, and scores each row that it meets
for the first time by its whole vector, in whole numbers. No row unmet so far can score more than the threshold, the
anchor's inner product with the values that the lists have come to. Reading stops once the threshold lies strictly below the
kth score of each of the anchor's windows, so ties at the kth place have all been met.

Two passes: the first finds an anchor's positives (one window over the rows of its label), the second its negatives, in one
window for each positive. What the blocks find is ranked once more across blocks. Rows are shuffled once a pass and never
copied; anchors go to every block, and a task holds one block and a batch of anchors.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from viewloom.llm.common import meet, query, scratch, stored, table

#: Rows of a block.
ROWS = 2048
#: Anchors that read a block's lists in step.
AT_ONCE = 128
#: Entries of each list that are read before the threshold is first looked at; doubled after that.
FIRST_DEPTH = 16
SCALE = 256

#: The largest score.
MOST = (1 << 63) - 1

FOUND = "key bigint, anchor_id bigint, place int, vec_id bigint, row bigint, score bigint"


def whole(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, vector, key) of the rows that take part, each once, components as whole numbers. `key` tells rows
    apart that share a vec_id."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != float("inf")))
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(F.col("embedding").isNotNull() & finite, F.lit(False)))
    scaled = F.transform("embedding", lambda x: F.floor(SCALE * x.cast("double")).cast("long"))
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), scaled.alias("vector")).distinct()
    return rows.withColumn("key", F.xxhash64("vec_id", "label", "vector"))


class Lists:
    """A block's rows, and each dimension's candidates sorted by component."""

    def __init__(self, rows: pa.Table, size: int):
        self.ids, self.labels, self.keys = (rows.column(c).to_numpy() for c in ("vec_id", "label", "key"))
        self.vectors = rows.column("vector").combine_chunks().flatten().to_numpy().reshape(len(rows), size)
        self.order = np.argsort(self.vectors, axis=0, kind="stable")
        self.sorted = np.take_along_axis(self.vectors, self.order, axis=0)
        self.largest = int(np.abs(self.vectors).max(initial=0))


def number_type(largest: int, size: int) -> type:
    """The fastest type in which inner products of so many components are whole numbers without error."""
    most = largest * largest * max(size, 1)
    if most > MOST:
        raise ValueError("scores of these vectors don't fit 64 bits")
    return np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else np.int64


def threshold_search(lists: Lists, anchors: np.ndarray, windows: np.ndarray, eligible: np.ndarray, k: int) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
    """(anchor, window, rows, scores) of each window's best k rows, ties to the smaller id: `windows` has the least and greatest
    score (inclusive) of each anchor's windows, none where least > greatest; `eligible` tells which rows an anchor may take."""
    n, size = lists.vectors.shape
    kind = number_type(max(lists.largest, int(np.abs(anchors).max(initial=0))), size)
    low, high = windows[:, :, 0], windows[:, :, 1]
    a, x = anchors.astype(kind), lists.vectors.astype(kind)
    unmet = np.iinfo(np.int64).min
    scores = np.full((len(a), n), unmet, dtype=np.int64)
    met = np.zeros((len(a), n), dtype=bool)
    plus, minus = anchors > 0, anchors < 0
    active = np.flatnonzero((low <= high).any(axis=1) & eligible.any(axis=1))
    at, step = 0, FIRST_DEPTH
    while len(active) and at < n:
        to = min(n, at + step)
        fresh = np.zeros((len(active), n), dtype=bool)
        for d in range(size):  # sorted access, from the end that the anchor's sign makes best
            for side, part in ((plus, lists.order[n - to : n - at, d]), (minus, lists.order[at:to, d])):
                fresh[np.ix_(np.flatnonzero(side[active, d]), part)] = True
        if to == n:  # also rows that no list of a component other than zero leads to
            fresh[:] = True
        fresh &= ~met[active]
        met[active] |= fresh
        who, row = np.nonzero(fresh & eligible[active])
        for cut in range(0, len(who), 1 << 16):  # random access: the whole vectors
            q, r = active[who[cut : cut + (1 << 16)]], row[cut : cut + (1 << 16)]
            scores[q, r] = np.einsum("ij,ij->i", a[q], x[r]).astype(np.int64)
        at, step = to, 2 * step
        if at == n:
            break
        # Zero components add nothing whatever is yet unmet.
        best, worst = lists.sorted[n - 1 - at].astype(kind), lists.sorted[at].astype(kind)
        bar = (np.maximum(a[active], 0) @ best + np.minimum(a[active], 0) @ worst).astype(np.int64)
        going = np.ones(len(active), dtype=bool)
        for i in np.flatnonzero((bar[:, None] < np.where(low <= high, high, np.iinfo(np.int64).max)[active]).all(axis=1)):
            own = scores[active[i]]
            going[i] = any(bar[i] >= kth(own, lo, hi, k) for lo, hi in windows[active[i]] if lo <= hi)
        active = active[going]
    out = []
    for q, w in np.argwhere(low <= high):
        rows = np.flatnonzero((scores[q] != unmet) & (scores[q] >= low[q, w]) & (scores[q] <= high[q, w]))
        rows = rows[np.lexsort((lists.keys[rows], lists.ids[rows], -scores[q, rows]))[:k]]
        if len(rows):
            out.append((q, w, rows, scores[q, rows]))
    return out


def kth(scores: np.ndarray, low: int, high: int, k: int) -> int:
    """The kth score found inside a window; the window's floor while it holds fewer."""
    inside = scores[(scores >= low) & (scores <= high)]
    return int(np.partition(inside, len(inside) - k)[len(inside) - k]) if len(inside) >= k else low


def answers(size: int, k: int, low_percent: int, high_percent: int, positives: bool):
    """What a task does with a batch of anchors that meets a block's lists."""

    def answer(lists: Lists, asking: pa.Table) -> list[pa.RecordBatch]:
        out = []
        for cut in range(0, len(asking), AT_ONCE):
            part = asking.slice(cut, AT_ONCE)
            ids, keys, labels = (part.column(c).to_numpy() for c in ("vec_id", "key", "label"))
            anchors = part.column("vector").combine_chunks().flatten().to_numpy().reshape(len(part), size)
            same = labels[:, None] == lists.labels[None, :]
            if positives:
                windows = np.tile(np.array([[[-MOST, MOST]]]), (len(part), 1, 1))
                eligible = same & (ids[:, None] != lists.ids[None, :])
            else:
                bars = part.column("bars").to_pylist()
                windows = np.tile(np.array([[[1, 0]]]), (len(part), max(map(len, bars)), 1))
                for i, own in enumerate(bars):  # low * p <= 100 * s <= high * p
                    for w, p in enumerate(own):
                        windows[i, w] = max(-(-low_percent * p // 100), -MOST), min(high_percent * p // 100, MOST)
                eligible = ~same
            for q, w, rows, scores in threshold_search(lists, anchors, windows, eligible, k):
                many = len(rows)
                columns = [np.full(many, keys[q]), np.full(many, ids[q]), np.full(many, w, dtype=np.int32), lists.ids[rows], lists.keys[rows], scores]
                out.append(pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key", "anchor_id", "place", "vec_id", "row", "score"]))
        return [b for b in pa.Table.from_batches(out).combine_chunks().to_batches()] if out else []

    return answer


def best(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The blocks' finds ranked across blocks."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(vectors: DataFrame, anchors: Column, positives: int = 5, negatives: int = 5, low_percent: int = 80, high_percent: int = 100) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows of `vectors` (vec_id,
    embedding, label) where `anchors` holds.

    Components count as floor(256 * x); scores are inner products, higher ones first, ties to the smaller vec_id. An anchor's
    positives are its first other rows of the same label; for each, the first rows of other labels whose score times 100 is
    from `low_percent` to `high_percent` times the positive's. Fewer are returned where there are fewer.

    Rows take no part if vec_id or label is null, or the vector is null or holds null or non-finite components, or is of
    another length than most (ties: the longer). Vectors of zeros take part. Repeated rows count once; rows that share a
    vec_id but differ otherwise are rows of their own, but not each other's positives. Components too large for 64-bit
    scores are an error. An empty table gives an empty result. Further columns are not read.
    """
    spark = vectors.sparkSession
    folder = scratch(spark)
    rows = whole(vectors.select("vec_id", "label", "embedding"))
    rows = stored(rows.withColumn("asks", F.coalesce(anchors, F.lit(False))).withColumn("size", F.size("vector")), f"{folder}/rows")
    sizes = rows.groupBy("size").count().orderBy(F.desc("count"), F.desc("size")).first()
    schema = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    if sizes is None:
        return spark.createDataFrame([], schema)
    size, count = sizes["size"], sizes["count"]
    rows = rows.where(F.col("size") == size).select("vec_id", "label", "vector", "key", "asks")
    asking = rows.where("asks").drop("asks")
    rows = rows.drop("asks")
    blocks = -(-count // ROWS)
    prepare = lambda held: Lists(held, size)

    none = F.array().cast("array<bigint>")
    found = meet(rows.withColumn("bars", none), asking.withColumn("bars", none), "key", blocks, prepare, answers(size, positives, 0, 0, True), FOUND)
    first = stored(best(found, ["key"], positives).select("key", "anchor_id", F.col("rank").alias("place"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), f"{folder}/positives")

    bars = first.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("place", "positive_score"))).alias("bars"))
    windowed = asking.join(bars.select("key", F.col("bars.positive_score").alias("bars")), "key")
    found = meet(rows.withColumn("bars", none), windowed, "key", blocks, prepare, answers(size, negatives, low_percent, high_percent, False), FOUND)
    ranked = best(found.withColumn("place", F.col("place") + 1), ["key", "place"], negatives)
    pairs = ranked.select("key", "place", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    return first.join(pairs, ["key", "place"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


ORACLE = """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same,
    list_sum(list_transform(list_zip(a.v, r.v), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM rows a JOIN rows r ON a.vec_id <> r.vec_id
  WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id,
  row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5
"""


@query("op13_hard_negatives", ORACLE)
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(vectors.withColumn("label", moved), F.col("vec_id") % 100 == 0)
