"""Mixing sources to target weights by Poisson replication.

A source with target share s of n documents out of N has the mean repetition rate s * N / n. Each document draws its number
of copies from a Poisson distribution of that mean, by inverting the distribution at a uniform number that a hash of the
seed and the document's id gives: the same document gets the same number on every run and after every lost executor, and
needs no other document to know it. Documents are exploded by their counts and dealt out and sorted by a hash of id and
copy and of the row's place in the input, which is a shuffle of the whole corpus. The place keeps rows of one id, however
many, from meeting in one task; it is the same after a lost executor, as the rows of a file split come in one order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from viewloom.llm.common import query, row_tag, scratch, stored, table

SEED = 2024
#: Without given weights, a source's share is in proportion to its number of documents to this power.
POWER = 0.5
#: Means above this are drawn as the sum of several smaller ones, as exp(-mean) must not vanish.
LARGEST_MEAN = 400.0
#: Numbers in all distribution tables (8 bytes each) up to which they are broadcast; beyond, the join shuffles.
BROADCAST_NUMBERS = 4_000_000


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) of 52 bits from the MD5 of the parts."""
    digest = F.md5(F.concat_ws(":", *[p.cast("string") for p in parts]))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def distribution(mean: Column) -> Column:
    """P(X <= k) for k = 0, 1, ... until rounding hides the rest."""
    last = F.ceil(mean + 10 * F.sqrt(mean) + 30).cast("int")
    first = F.exp(-mean)
    start = F.struct(first.alias("p"), first.alias("sum"), F.array(first).alias("all"))
    return F.aggregate(
        F.sequence(F.lit(1), last),
        start,
        lambda a, k: F.struct(
            (a["p"] * mean / k).alias("p"), (a["sum"] + a["p"] * mean / k).alias("sum"), F.concat(a["all"], F.array(a["sum"] + a["p"] * mean / k)).alias("all")
        ),
        lambda a: a["all"],
    )


def source_rates(docs: DataFrame, weights: dict[str | None, float] | None = None) -> DataFrame:
    """(source, n, rate) by source; a null source is a source of its own (None in `weights`), and one that `weights` lacks has rate 0."""
    counts = docs.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    if weights is None:
        weighed = counts.withColumn("w", F.pow(F.col("n").cast("double"), F.lit(POWER)))
    else:
        named = [F.lit(x) for source, weight in weights.items() if source is not None for x in (source, float(weight))]
        given = (F.create_map(*named) if named else F.create_map()).cast("map<string,double>")
        of_null = F.when(F.col("source").isNull(), F.lit(float(weights.get(None, 0.0))))
        weighed = counts.withColumn("w", F.coalesce(of_null, given[F.col("source")], F.lit(0.0)))
    all_w, all_n = weighed.agg(F.sum("w"), F.sum("n")).first()
    rate = F.col("w") / F.lit(all_w) * F.lit(all_n) / F.col("n") if all_w else F.lit(0.0)
    return weighed.select("source", "n", rate.alias("rate"))


def mix(docs: DataFrame, weights: dict[str | None, float] | None = None, seed: int = SEED) -> DataFrame:
    """`docs` with each row repeated as often as drawn, in random order, and `copy` (from 1).

    `weights` by source are shared out among the sources that are there; without them, shares follow document counts to the power POWER. Rows that
    share a doc_id draw the same number but are dealt out singly; a row without one draws by its text. `docs` should come from files or
    a stored table, whose rows a task reads in the same order each time. Null and empty texts are rows like others.
    An empty table gives an empty result. A column named `copy` is replaced; names beginning with `__` are reserved.
    """
    spark = docs.sparkSession
    rates = source_rates(docs, weights).withColumn("parts", F.greatest(F.ceil(F.col("rate") / LARGEST_MEAN), F.lit(1)).cast("int"))
    rates = rates.withColumn("cdf", distribution(F.col("rate") / F.col("parts")))
    rates = stored(rates.select(F.col("source").alias("__source"), F.col("parts").alias("__parts"), F.col("cdf").alias("__cdf")), f"{scratch(spark)}/rates")
    if (rates.agg(F.sum(F.size("__cdf"))).first()[0] or 0) <= BROADCAST_NUMBERS:
        rates = F.broadcast(rates)
    ident = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text "), row_tag(F.col("text")).cast("string")))
    below = lambda u: F.size(F.filter("__cdf", lambda c: c <= u))
    drawn = F.when(F.col("__parts") == 1, below(F.col("__u"))).otherwise(
        F.aggregate(F.sequence(F.lit(1), "__parts"), F.lit(0), lambda a, j: a + below(uniform(F.lit(seed), F.col("__ident"), j - 1)))
    )
    keyed = docs.withColumn("__ident", ident).withColumn("__u", uniform(F.lit(seed), F.col("__ident"), F.lit(0)))
    keyed = keyed.withColumn("__place", F.monotonically_increasing_id())
    counted = keyed.join(rates, F.col("source").eqNullSafe(F.col("__source"))).withColumn("__n", drawn).where("__n > 0")
    copies = counted.withColumn("copy", F.explode(F.sequence(F.lit(1), "__n")))
    order = F.xxhash64(F.lit(seed), F.lit("order"), "__ident", "copy", "__place")
    dealt = copies.withColumn("__order", order).repartition("__order").sortWithinPartitions("__order")
    return dealt.select(*[c for c in docs.columns if c != "copy"], "copy")


ORACLE = f"""
WITH RECURSIVE counts AS (SELECT source, count(*) AS n, pow(count(*)::DOUBLE, {POWER}) AS w FROM documents GROUP BY source),
rates AS (SELECT source, w / (SELECT sum(w) FROM counts) * (SELECT sum(n) FROM counts) / n AS rate FROM counts),
cdf AS (
  SELECT source, rate, 0 AS k, exp(-rate) AS p, exp(-rate) AS sum FROM rates
  UNION ALL
  SELECT source, rate, k + 1, p * rate / (k + 1), sum + p * rate / (k + 1) FROM cdf WHERE k < ceil(rate + 10 * sqrt(rate) + 30)
), drawn AS (
  SELECT doc_id, source, (('0x' || substr(md5('{SEED}:' || doc_id || ':0'), 1, 13))::BIGINT)::DOUBLE / {1 << 52} AS u FROM documents
), copies AS (
  SELECT doc_id, count(*) AS n FROM drawn JOIN cdf ON drawn.source IS NOT DISTINCT FROM cdf.source AND cdf.sum <= u GROUP BY doc_id
)
SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, unnest(range(1, n + 1))::INT AS copy FROM documents d JOIN copies USING (doc_id)
"""


@query("op6_poisson_mix", ORACLE)
def op6_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to the target weights, with `copy`."""
    return mix(docs)
