"""Column helpers and scratch tables that the corpus operators share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Queries of this subpackage by name, and the DuckDB text of those that SQL can express.
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is. `translate` looks at one character at a time, so text that is
    ASCII throughout, where `lower` does the same, takes the fast way."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def row_tag(text: Column) -> Column:
    """Tells rows with one doc_id but different texts apart; with doc_id it is the key of a row."""
    return F.xxhash64(text)


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables: spark.checkpoint.dir, or else the one given to setCheckpointDir. Where neither is
    set, a session in one process, as in tests, gets a local one; on a cluster that is an error, since a folder of one machine
    would lose rows."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base
    context = spark.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        if context.master != "local" and not context.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(f"file://{tempfile.mkdtemp(prefix='viewloom-')}")
    return context._jsc.sc().getCheckpointDir().get()


def scratch(spark: SparkSession) -> str:
    """A new folder in the shared one."""
    return f"{shared_folder(spark).rstrip('/')}/viewloom-{uuid.uuid4().hex}"


def stored(df: DataFrame, path: str) -> DataFrame:
    """The rows written as Parquet and read back: cuts the lineage and survives lost executors."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Most tasks that blocks of rows are dealt to.
MEETING_TASKS = 10_000


def meet(
    rows: DataFrame,
    queries: DataFrame,
    key: str,
    blocks: int,
    prepare: Callable[[pa.Table], object],
    answer: Callable[[object, pa.Table], list[pa.RecordBatch]],
    schema: str,
) -> DataFrame:
    """`answer(prepare(block of rows), batch of queries)` for every block of rows and every query.

    Rows are dealt out in blocks by a hash of `key`, shuffled once and not copied; a query goes to every block. A task reads a
    block's rows, then streams the queries that were sorted behind them, so it holds one block and one batch of queries,
    however many queries there are. Both tables have the same columns.
    """
    own = F.pmod(F.xxhash64(F.lit("block"), F.col(key)), F.lit(blocks)).cast("int")
    data = rows.select(own.alias("block"), F.lit(0).alias("kind"), *rows.columns)
    asked = queries.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(1).alias("kind"), *rows.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, ready = None, [], None
        for batch in batches:
            at = np.c_[batch.column("block").to_numpy(), batch.column("kind").to_numpy()]
            cuts = [0, *(np.flatnonzero((at[1:] != at[:-1]).any(axis=1)) + 1), len(at)]
            for start, end in zip(cuts, cuts[1:], strict=False):
                if start == end:
                    continue
                part = pa.Table.from_batches([batch.slice(start, end - start)])
                if at[start, 0] != block:
                    block, held, ready = at[start, 0], [], None
                if at[start, 1] == 0:
                    held.append(part)
                elif held:
                    ready = ready or prepare(pa.concat_tables(held))
                    yield from answer(ready, part)

    dealt = data.unionByName(asked).repartitionById(min(blocks, MEETING_TASKS), "block")
    return dealt.sortWithinPartitions("block", "kind").mapInArrow(run, schema)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder that this library wrote and that nothing reads any more."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
