"""Line deduplication with levelled sorted runs of line hashes.

Every line is hashed once: its place and hash are written to the shared folder, from where both the counting and the dropping
read them. Documents are counted in batches. A batch's lines are shrunk to one row per line key (its hash, in how many documents
it was found, the largest doc_id), merge-anti-joined with the keys that the runs know to be common already, and written as a
run of level 0. Once a level holds `fanout` runs they are merged into one run of the next level. A key that is common already
is not stored again, so a line that stands in a third of all documents costs a few rows.

All runs are partitions of one table that is bucketed and sorted by the hash. So a batch is dealt to buckets once and then
merges with the runs where they lie, and runs are merged with each other without any shuffle.

Batches go from large doc_ids to small ones, so the document that keeps a common line is known when the key is first seen.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from viewloom.llm.common import UPPER, ascii_lower, drop_folder, query, row_tag, scratch, stored, table

BLANK = " \t\n\x0b\x0c\r"


#: Lines of a bucket, about, and the least and greatest number of buckets of a run.
BUCKET_LINES, LEAST_BUCKETS, MOST_BUCKETS = 1 << 21, 16, 1 << 14


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_hashes(docs: DataFrame, min_chars: int) -> DataFrame:
    """(doc_id, tag, pos, key) of every line that counts. What makes two lines the same is 128 bits of the line with blanks
    stripped at both ends and A-Z lower-cased; shorter ones don't count."""
    texts = docs.select("doc_id", row_tag(F.col("text")).alias("tag"), lines_of(F.col("text")).alias("lines"))
    lines = texts.select("doc_id", "tag", F.posexplode("lines").alias("pos", "line"))
    bare = lines.select("doc_id", "tag", "pos", F.trim("line", F.lit(BLANK)).alias("line")).where(F.length("line") >= min_chars)
    return bare.select("doc_id", "tag", "pos", F.unhex(F.md5(ascii_lower(F.col("line")))).alias("key"))


class LineRuns:
    """Runs of (key, docs, keeper) rows by level, kept as partitions of a bucketed table at `path`. A key's document count is
    the sum over the runs; `min_docs` is the count from which a key is common."""

    def __init__(self, spark: SparkSession, path: str, min_docs: int, fanout: int = 3, buckets: int = LEAST_BUCKETS):
        self.spark, self.path, self.min_docs, self.fanout, self.buckets = spark, path, min_docs, fanout, buckets
        self.name = f"viewloom_lines_{uuid.uuid4().hex}"
        self.levels: list[list[int]] = [[]]
        self.written = 0

    def _write(self, rows: DataFrame, level: int) -> None:
        """`rows` lie in buckets already: each is written by one task, as one sorted file."""
        self.written += 1
        run = rows.select("key", "docs", "keeper", F.lit(self.written).alias("run"))
        kept = run.write.mode("append").partitionBy("run").bucketBy(self.buckets, "key").sortBy("key")
        kept.option("path", self.path).saveAsTable(self.name)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(self.written)

    def merged(self, runs: list[int]) -> DataFrame:
        """Runs as one, bucket by bucket where they lie."""
        rows = self.spark.table(self.name).where(F.col("run").isin(runs))
        return rows.groupBy("key").agg(F.sum("docs").alias("docs"), F.max("keeper").alias("keeper"))

    def runs(self) -> list[int]:
        return [run for level in self.levels for run in level]

    def common(self) -> DataFrame:
        """Every key that the runs show in `min_docs` documents or more, with the document that keeps it."""
        return self.merged(self.runs()).where(F.col("docs") >= self.min_docs).select("key", "keeper")

    def unknown(self, keys: DataFrame) -> DataFrame:
        """A batch's keys without those that the runs show to be common, in buckets."""
        if not self.runs():
            return keys.repartitionById(self.buckets, F.pmod(F.hash("key"), F.lit(self.buckets)))  # as bucketed tables are dealt
        return keys.join(self.common().select("key").hint("merge"), "key", "left_anti")

    def add(self, keys: DataFrame) -> None:
        """Add a batch's keys, but for those that are known to be common."""
        self._write(self.unknown(keys), 0)
        level = 0
        while len(self.levels[level]) >= self.fanout:
            old = self.levels[level]
            self._write(self.merged(old), level + 1)
            self.levels[level] = []
            for run in old:
                drop_folder(self.spark, f"{self.path}/run={run}")
            self.spark.catalog.refreshTable(self.name)
            level += 1

    def close(self) -> None:
        self.spark.sql(f"DROP TABLE {self.name}")
        drop_folder(self.spark, self.path)


def batch_keys(lines: DataFrame) -> DataFrame:
    """One row per line key. Equal lines of one document count once, as do rows that share a doc_id."""
    return lines.groupBy("key").agg(F.count_distinct("doc_id").alias("docs"), F.max("doc_id").alias("keeper"))


def batch_ranges(docs: DataFrame, batches: int) -> list[tuple[int, int]]:
    """Half-open doc_id ranges, from the largest ids down. Ranges, so that a batch skips the other row groups."""
    low, high = docs.agg(F.min("doc_id"), F.max("doc_id")).first()
    if low is None:
        return []
    cuts = sorted({low + (high + 1 - low) * i // batches for i in range(batches + 1)})
    return list(zip(cuts, cuts[1:], strict=False))[::-1]


def dedup_lines(
    docs: DataFrame, min_docs: int = 3, min_chars: int = 20, batches: int = 4, fanout: int = 3, counts: tuple[str, str] = ("n_lines", "n_dropped")
) -> DataFrame:
    """`docs` with `text` less its common lines, and two columns `counts` with its lines (before) and the dropped ones.

    A line whose key has at least `min_chars` characters and stands in at least `min_docs` documents goes, except in the
    document with the largest doc_id that holds it, where all its copies stay. Null or empty text is one empty line and
    becomes empty text. Documents are told apart by doc_id: rows that share one count once but are each rewritten. A row
    without doc_id neither counts nor keeps, but loses its common lines. An empty table gives an empty result. Columns
    beginning with `__` are reserved; columns named as the two added ones are replaced.
    """
    spark = docs.sparkSession
    folder = scratch(spark)
    ids = docs.select("doc_id", "text")
    lines = stored(line_hashes(ids, min_chars), f"{folder}/lines")
    buckets = min(max(-(-lines.count() // BUCKET_LINES), LEAST_BUCKETS), MOST_BUCKETS)
    runs = LineRuns(spark, f"{folder}/runs", min_docs, fanout, buckets)
    for low, high in batch_ranges(lines, batches):
        runs.add(batch_keys(lines.where((F.col("doc_id") >= low) & (F.col("doc_id") < high))))
    if not runs.runs():
        gone = spark.createDataFrame([], "__id bigint, __tag bigint, __gone array<int>")
    else:
        common = stored(runs.common(), f"{folder}/common")  # so that a hot key's lines can be split
        runs.close()
        hits = lines.join(common, "key").where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
        gone = hits.groupBy(F.col("doc_id").alias("__id"), F.col("tag").alias("__tag")).agg(F.array_sort(F.collect_set("pos")).alias("__gone"))
    keyed = docs.withColumn("__tag", row_tag(F.col("text")))
    joined = keyed.join(gone, keyed["doc_id"].eqNullSafe(gone["__id"]) & (keyed["__tag"] == gone["__tag"]), "left").drop(gone["__tag"])
    text = F.coalesce(F.col("text"), F.lit(""))
    n = F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit(""))) + 1
    out = joined.withColumns(
        {
            counts[0]: n.cast("long"),
            counts[1]: F.coalesce(F.size("__gone"), F.lit(0)).cast("long"),
            "text": F.when(F.size("__gone") > 0, without(text, F.col("__gone"))).otherwise(text),
        }
    )
    return out.select(*[c for c in docs.columns if c not in counts], *counts)


def without(text: Column, gone: Column) -> Column:
    """A text less the lines at the places `gone`, ascending. Kept lines are the stretches between those: linear in the text,
    however many go. Lines and places are bound to a lambda's variable, so that they are worked out once."""

    def kept(x: Column) -> Column:
        lines, cuts = x["lines"], x["cuts"]
        stretches = F.transform(F.sequence(F.lit(0), F.size(cuts) - 2), lambda i: F.slice(lines, F.get(cuts, i) + 2, F.get(cuts, i + 1) - F.get(cuts, i) - 1))
        return F.array_join(F.flatten(stretches), "\n")

    lines = lines_of(text)
    bound = F.transform(F.array(lines), lambda x: F.struct(x.alias("lines"), F.concat(F.array(F.lit(-1)), gone, F.array(F.size(x))).alias("cuts")))
    return F.get(F.transform(bound, kept), 0)


ORACLE = f"""
WITH lines AS (
  SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS pos
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{UPPER.lower()}') AS key FROM lines
), common AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), judged AS (
  SELECT k.*, c.key IS NOT NULL AND k.doc_id <> c.keeper AS gone FROM keyed k LEFT JOIN common c USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""


@query("op4_line_runs", ORACLE)
def op4_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents less their common lines; n_chars follows the text."""
    out = dedup_lines(docs, counts=("__n_lines", "__n_dropped"))
    return out.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


