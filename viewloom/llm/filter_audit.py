"""Filter interaction audit: what each filter of a chain removes, in every order of the chain.

A document's fate depends on nothing but which filters it fails, so documents shrink to cells: one row for each part and
set of failed filters (at most 32 a part), with how many documents it holds, how many of them good and toxic. Each cell is
folded across the array of all orders, a literal that Spark broadcasts with the task: `transform` walks the orders and
`aggregate` the steps of one, which gives 600 structs weighted with the cell's counts. A part's cells are then merged by
elementwise sums.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from viewloom.llm.common import query, scratch, stored, table

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
#: Blanks between words: \x20 and \x09 to \x0D.
BLANK, BLANKS = " \t\n\x0b\x0c\r", "[ \\t-\\r]+"
COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]


def text_failures(text: Column, least_words: int = 100, distinct_percent: int = 80, upper_percent: int = 10, marks: str = "#$%&*|") -> list[Column]:
    """The conditions of filters A to D on a text that is not null."""
    bare = F.trim(text, F.lit(BLANK))
    words = F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, BLANKS))
    upper = F.octet_length(text) - F.octet_length(F.regexp_replace(text, "[A-Z]+", ""))
    return [
        F.size(words) < least_words,
        100 * F.size(F.array_distinct(words)) < distinct_percent * F.size(words),
        100 * upper > upper_percent * F.length(text),
        text.rlike("[" + "".join(f"\\{m}" for m in marks) + "]"),
    ]


def bits(conditions: list[Column], first: int = 0) -> Column:
    found = F.lit(0)
    for at, condition in enumerate(conditions, first):
        found = found.bitwiseOR(F.when(condition, 1 << at).otherwise(0))
    return found


def cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents of each part by the set of filters that they fail.

    Filter E compares a document with the least doc_id of its text, which is found by a hash of 128 bits and one of 64. Rows
    that share doc_id, part and text are one row with a count before anything is joined, and the joins are on keys that hold
    the doc_id, so that a text in a third of all documents doesn't meet in one task.
    """
    folder = scratch(docs.sparkSession)
    text = F.coalesce(F.col("text"), F.lit(""))
    seen = docs.select(F.col("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"), text.alias("text"))
    seen = seen.select("doc_id", "part", F.unhex(F.md5("text")).alias("key"), F.xxhash64("text").alias("tag"), bits(text_failures(F.col("text"))).alias("mask"))
    held = stored(seen.groupBy("doc_id", "part", "key", "tag", "mask").agg(F.count(F.lit(1)).alias("n")), f"{folder}/texts")

    known = held.where(F.col("doc_id").isNotNull())
    least = known.groupBy("key", "tag").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    marked = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id")
    marked = marked.agg(*(F.max(F.coalesce(F.col(c) == 1, F.lit(False))).alias(to) for c, to in (("quality", "good"), ("toxic", "toxic"))))
    judged = known.join(least, ["key", "tag", "doc_id"], "left").join(marked, "doc_id", "left")
    later = F.when(F.col("first").isNull(), 1 << FILTERS.index("E")).otherwise(0)
    counted = lambda c: F.when(c, F.col("n")).otherwise(0)
    judged = judged.select("part", F.col("mask").bitwiseOR(later).alias("mask"), "n", counted(F.col("good")).alias("good"), counted(F.col("toxic")).alias("toxic"))
    zero = F.lit(0).cast("long")
    without = held.where(F.col("doc_id").isNull()).select("part", "mask", "n", zero.alias("good"), zero.alias("toxic"))
    return judged.unionByName(without).groupBy("part", "mask").agg(*(F.sum(c).alias(c) for c in ("n", "good", "toxic")))


def folded(mask: Column, weights: dict[str, Column]) -> Column:
    """A cell's 600 structs of COUNTS: for each order of ORDERS, its five steps."""
    zero = F.lit(0).cast("long")

    def step(state: Column, bit: Column) -> Column:
        fails = mask.bitwiseAND(bit) != 0
        there = ~state["gone"]
        counts = F.struct(
            F.when(there & ~fails, weights["n"]).otherwise(zero).alias("kept"),
            F.when(there & fails, weights["n"]).otherwise(zero).alias("removed"),
            F.when(~there & fails, weights["n"]).otherwise(zero).alias("redundant"),
            F.when(mask == bit, weights["n"]).otherwise(zero).alias("unique_fails"),
            F.when(there & fails, weights["good"]).otherwise(zero).alias("good_lost"),
            F.when(there & fails, weights["toxic"]).otherwise(zero).alias("toxic_lost"),
        )
        return F.struct((state["gone"] | fails).alias("gone"), F.concat(state["steps"], F.array(counts)).alias("steps"))

    kind = "array<struct<" + ",".join(f"{c}:bigint" for c in COUNTS) + ">>"
    start = F.struct(F.lit(False).alias("gone"), F.array().cast(kind).alias("steps"))
    orders = F.lit([[1 << FILTERS.index(f) for f in order] for order in ORDERS])
    return F.flatten(F.transform(orders, lambda order: F.aggregate(order, start, step, lambda state: state["steps"])))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, filter_order, step, filter, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley): 600 rows
    for each part of `docs` (doc_id, text, lang), zeros included.

    Filters judge whole texts, null as empty: A fewer than 100 words; B fewer than 80 % distinct words; C over 10 % of
    characters in A-Z; D any of #$%&*|; E the text of a smaller doc_id, in whatever part. Parts are the values of lang, with
    null and empty text as one. Repeated rows count each; rows that share a doc_id aren't each other's copies by that.
    Rows without doc_id are no copy, have none and no labels. An id with several labels is good (toxic) if one of them says
    so. An empty table gives an empty result. Further columns are not read.
    """
    weighted = cells(docs, labels).select("part", folded(F.col("mask"), {c: F.col(c) for c in ("n", "good", "toxic")}).alias("counts"))
    add = lambda a, b: F.struct(*((a[c] + b[c]).alias(c) for c in COUNTS))
    # At most 32 arrays a part.
    merged = weighted.groupBy("part").agg(F.collect_list("counts").alias("all"))
    merged = merged.select("part", F.aggregate(F.slice("all", 2, 1 << len(FILTERS)), F.get("all", F.lit(0)), lambda a, b: F.zip_with(a, b, add)).alias("counts"))
    # A filter's removals over all orders: those of the steps at which it stands.
    place = F.lit([FILTERS.index(f) for order in ORDERS for f in order])
    removed = lambda at: F.aggregate(
        F.zip_with("counts", place, lambda c, f: F.when(f == at, c["removed"]).otherwise(F.lit(0).cast("long"))), F.lit(0).cast("long"), lambda a, b: a + b
    )
    merged = merged.withColumn("shapley", F.transform(F.lit(list(range(len(FILTERS)))), removed))
    rows = merged.select("part", "shapley", F.posexplode("counts").alias("at", "c"))
    order, step = F.get(F.lit(ORDERS), F.floor(F.col("at") / len(FILTERS)).cast("int")), (F.col("at") % len(FILTERS) + 1).cast("int")
    rows = rows.withColumns({"filter_order": order, "step": step}).withColumn("filter", F.substring("filter_order", F.col("step"), F.lit(1)))
    return rows.select("part", "filter_order", "step", "filter", *(F.col("c")[c].alias(c) for c in COUNTS), F.get("shapley", F.position(F.col("filter"), F.lit(FILTERS)) - 1).alias("shapley"))


ORACLE = """
WITH texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents
), worded AS (
  SELECT *, list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w,
    length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS upper_chars, min(doc_id) OVER (PARTITION BY t) AS first_id
  FROM texts
), failed AS (
  SELECT doc_id, part,
    map {'A': len(w) < 100, 'B': 100 * len(list_distinct(w)) < 80 * len(w), 'C': 100 * upper_chars > 10 * length(t),
      'D': regexp_matches(t, '[#$%&*|]'), 'E': coalesce(doc_id > first_id, false)} AS fails
  FROM worded
), marked AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id
), cells AS (
  SELECT part, fails, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
  FROM failed LEFT JOIN marked USING (doc_id) GROUP BY part, fails
), letters AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f
), orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5
), steps AS (
  SELECT filter_order, unnest([1, 2, 3, 4, 5]) AS step FROM orders
), walked AS (
  SELECT part, filter_order, step, substr(filter_order, step, 1) AS filter, n, good, toxic,
    fails[substr(filter_order, step, 1)] AS here,
    len(list_filter(['A', 'B', 'C', 'D', 'E'], lambda x: fails[x])) = 1 AS once,
    len(list_filter(string_split(left(filter_order, step - 1), ''), lambda x: x <> '' AND fails[x])) > 0 AS before
  FROM cells, steps
), summed AS (
  SELECT part, filter_order, step, filter,
    coalesce(sum(n) FILTER (NOT here AND NOT before), 0)::BIGINT AS kept, coalesce(sum(n) FILTER (here AND NOT before), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (here AND before), 0)::BIGINT AS redundant, coalesce(sum(n) FILTER (here AND once), 0)::BIGINT AS unique_fails,
    coalesce(sum(good) FILTER (here AND NOT before), 0)::BIGINT AS good_lost, coalesce(sum(toxic) FILTER (here AND NOT before), 0)::BIGINT AS toxic_lost
  FROM walked GROUP BY part, filter_order, step, filter
)
SELECT *, (sum(removed) OVER (PARTITION BY part, filter))::BIGINT AS shapley FROM summed
"""


@query("op11_filter_audit", ORACLE)
def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
