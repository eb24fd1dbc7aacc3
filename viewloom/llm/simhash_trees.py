"""SimHash near-duplicates, linked through BK-trees.

Equal fingerprints are one entry. Entries within RADIUS bits agree on at least one of RADIUS + 1 blocks of bits, so each
block value is a shard and every link lies inside a shard. A shard's entries form a BK-tree: children are keyed by their
integer Hamming distance to the parent, and a search follows only edges whose key is within the radius of the distance to
the node. Trees go to the queries of their shard with the shuffle, not through the driver: together they grow with the
corpus, so no broadcast could hold them. A task builds and searches all its shards' trees at once, level by level.

A shard yields not its pairs but one link from each entry to the least entry it is connected to there, so that thousands
of near copies give thousands of links and not millions. Links of all shards are joined up by `components`.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewloom.llm.common import query, row_tag, scratch, stored, table
from viewloom.llm.components import components

SHINGLE = 3
RADIUS = 3
SEED = 42

#: Entries of one tree. A larger shard is cut into trees of about this size, and every two of them meet in a group of their
#: own, so that no task holds more than a few groups of this size.
TREE_ENTRIES = 8192
#: Expected entries of a shard when fingerprints are spread evenly, above which more and finer blocks are used.
SHARD_ENTRIES = 256
#: Pairs (entry, node) of a search that are held at once.
FRONTIER = 1 << 20


def shingle_hashes(text: str | None, size: int) -> np.ndarray:
    """The hash of each shingle of a text, in order; one if there are only `size` words or fewer, none without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # of bytes: A-Z only, ASCII blanks only
    if not words:
        return np.zeros(0, dtype=np.uint64)
    joined = b" ".join(words)
    if len(words) <= size:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        ends = np.cumsum([len(w) + 1 for w in words]) - 1
        begins = [0, *(ends[: len(words) - size] + 1).tolist()]
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], SEED) for a, b in zip(begins, ends[size - 1 :].tolist(), strict=True)]
    return np.array(hashes, dtype=np.uint64)


def fingerprint_of(values: np.ndarray) -> int:
    """SimHash of shingle hashes, as a signed 64-bit number; 0 if there are none."""
    if not len(values):
        return 0
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(values), 1 << 16):
        part = values[at : at + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(values), bitorder="little")
    return int(bits.view(np.int64)[0])


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """SimHash of a text's shingles, as a signed 64-bit number; 0 without words."""
    return fingerprint_of(shingle_hashes(text, size))


def fingerprints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(doc_id, tag, fp) of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t.as_py(), size) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("tag"), pa.array(fps, pa.int64())], ["doc_id", "tag", "fp"])

    return docs.select("doc_id", row_tag(F.col("text")).alias("tag"), "text").mapInArrow(run, "doc_id bigint, tag bigint, fp bigint")


def block_masks(entries: int, radius: int = RADIUS) -> list[int]:
    """Bit masks such that any two fingerprints within the radius agree on one of them at least: of radius + 1 or more
    blocks, those that all but `radius` blocks cover. More blocks make finer shards, and every number is exact."""
    blocks = radius + 1
    while blocks < radius + 4 and entries / 2.0 ** (64 * (blocks - radius) / blocks) > SHARD_ENTRIES:
        blocks += 1
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    parts = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:], strict=False)]
    return [sum(chosen) for chosen in combinations(parts, blocks - radius)]


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


class Trees:
    """BK-trees of many shards as flat arrays. Entry i hangs under `parent[i]`; children of a node with one key make a
    subtree whose root is the first of them."""

    def __init__(self, fps: np.ndarray, shards: np.ndarray):
        """`fps` unsigned, `shards` their shard numbers, ascending from 0."""
        n = len(fps)
        self.fps = fps
        links: list[tuple[np.ndarray, np.ndarray]] = []
        at, group = np.arange(n), shards.astype(np.int64)
        self.roots = np.full(int(shards[-1]) + 1 if n else 0, -1, dtype=np.int64)
        first_level = True
        parent_key = np.zeros(0, dtype=np.int64)
        while len(at):
            # The first entry of each group becomes a node; the others go to the child that their distance to it names.
            starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
            nodes = at[starts]
            if first_level:
                self.roots[group[starts]] = nodes
                first_level = False
            else:
                links.append((parent_key[starts], nodes))
            sizes = np.diff(np.r_[starts, len(at)])
            over = np.repeat(nodes, sizes)
            rest = np.ones(len(at), dtype=bool)
            rest[starts] = False
            at, over = at[rest], over[rest]
            key = over * 65 + np.bitwise_count(fps[at] ^ fps[over]).astype(np.int64)
            order = np.argsort(key, kind="stable")
            at, key = at[order], key[order]
            group = parent_key = key
        keys = np.concatenate([k for k, _ in links]) if links else np.zeros(0, dtype=np.int64)
        kids = np.concatenate([v for _, v in links]) if links else np.zeros(0, dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.kids = keys[order], kids[order]  # by parent and distance

    def near(self, fps: np.ndarray, shards: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query number, entry) arrays of all within the radius, each query against its shard's tree."""
        stack = [(np.arange(len(fps)), self.roots[shards])]
        while stack:
            who, node = stack.pop()
            if len(who) > FRONTIER:
                half = len(who) // 2
                stack += [(who[:half], node[:half]), (who[half:], node[half:])]
                continue
            far = np.bitwise_count(fps[who] ^ self.fps[node]).astype(np.int64)
            hit = far <= radius
            if hit.any():
                yield who[hit], node[hit]
            low = np.searchsorted(self.keys, node * 65 + np.maximum(far - radius, 0), "left")
            high = np.searchsorted(self.keys, node * 65 + np.minimum(far + radius, 64), "right")
            count = high - low
            total = int(count.sum())
            if total:
                begin = np.repeat(low - np.r_[0, np.cumsum(count)[:-1]], count)
                stack.append((np.repeat(who, count), self.kids[begin + np.arange(total)]))


def least_linked(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """For each of n entries the least number among those it is connected to."""
    low = np.arange(n)

    def settle(a: np.ndarray, b: np.ndarray) -> None:
        while True:
            x, y = low[a], low[b]
            differ = x != y
            if not differ.any():
                return
            a, b, x, y = a[differ], b[differ], x[differ], y[differ]
            np.minimum.at(low, np.maximum(x, y), np.minimum(x, y))
            while not np.array_equal(low, up := low[low]):
                low[:] = up

    for a, b in pairs:
        settle(a, b)
    return low


def shard_links(radius: int):
    """mapInArrow over rows (shard, tree, role, fp) that come sorted: of each tree its entries (role 0) and then the
    entries of one other tree of the shard, which only search it (role 1). Yields (a, b) links of fingerprints."""
    out = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def solve(table: pa.Table) -> pa.RecordBatch:
        shard, tree, role, fp = (table.column(c).to_numpy() for c in ("shard", "tree", "role", "fp"))
        new = np.r_[True, (shard[1:] != shard[:-1]) | (tree[1:] != tree[:-1])]
        number = np.cumsum(new) - 1
        values = fp.view(np.uint64)
        own = np.flatnonzero(role == 0)
        trees = Trees(values[own], number[own])
        pairs = ((who, own[node]) for who, node in trees.near(values, number, radius))
        low = least_linked(len(values), pairs)
        linked = low != np.arange(len(low))
        return pa.RecordBatch.from_arrays([pa.array(fp[linked]), pa.array(fp[low[linked]])], schema=out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows < 1 << 17:
                continue
            # Solve all trees but the last, which may go on in the next batch.
            whole = pa.Table.from_batches(held)
            shard, tree = whole.column("shard").to_numpy(), whole.column("tree").to_numpy()
            last = int(np.flatnonzero((shard != shard[-1]) | (tree != tree[-1]))[-1]) + 1 if (shard[0], tree[0]) != (shard[-1], tree[-1]) else 0
            if last:
                yield solve(whole.slice(0, last))
                held = whole.slice(last).to_batches()
                rows = whole.num_rows - last
        if rows:
            yield solve(pa.Table.from_batches(held))

    return run, "a bigint, b bigint"


def links(entries: DataFrame, count: int, folder: str, radius: int = RADIUS) -> DataFrame:
    """Links (a, b) that connect just the entries (column fp, distinct) that chains of steps within the radius connect."""
    masks = block_masks(count, radius)
    sharded = entries.select("fp", F.explode(F.array(*[F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("v")) for i, m in enumerate(masks)])).alias("s"))
    keyed = stored(sharded.select("fp", F.xxhash64("s.t", "s.v").alias("shard")), f"{folder}/shards")
    # Shards of one entry hold no link; large ones are dealt out as several trees.
    sizes = keyed.groupBy("shard").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    trees = F.ceil(F.col("size") / TREE_ENTRIES).cast("int")
    dealt = keyed.join(sizes.select("shard", trees.alias("trees")), "shard")
    own = F.pmod(F.xxhash64(F.lit("tree"), "fp"), F.col("trees")).cast("int")
    pairs = dealt.select("shard", "fp", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("trees") - 1)).alias("other"))
    searched, searching = F.least("own", "other"), F.greatest("own", "other")
    rows = pairs.select(
        "shard", (F.shiftleft(searched.cast("long"), 31) + searching).alias("tree"), (F.col("own") != searched).cast("int").alias("role"), "fp"
    )
    run, schema = shard_links(radius)
    return rows.repartition("shard", "tree").sortWithinPartitions("shard", "tree", "role", "fp").mapInArrow(run, schema)


def near_duplicates(docs: DataFrame, size: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """(doc_id, tag, fp, component_id) for each row of `docs`.

    component_id is the smallest doc_id that links reach, the row's own included. Null or wordless text has fingerprint
    zero, linked like any other. Rows without doc_id are linked too; a group of such rows alone has a null component_id.
    Repeated rows are returned as often as they occur. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    folder = scratch(spark)
    rows = stored(fingerprints(docs, size), f"{folder}/rows")
    entries = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), f"{folder}/entries")
    edges = links(entries, max(entries.count(), 1), folder, radius)
    roots = components(edges, folder)
    grouped = entries.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    of_entry = stored(grouped.join(named, "root").select("fp", "component_id"), f"{folder}/components")
    return rows.join(of_entry, "fp").select("doc_id", "tag", "fp", "component_id")


@query("op8_simhash_trees")
def op8_simhash_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """One row of `docs` for each group of `groups` (doc_id, tag, root; for each row of `docs`): that of the smallest doc_id,
    none being the greatest, then of the least tag. Of rows alike in both one stays, the least by its other columns."""
    key = lambda tag: [F.col("doc_id").isNull().alias("__none"), F.coalesce("doc_id", F.lit(0)).alias("__id"), F.col(tag).alias("__tag")]
    first = groups.groupBy("root").agg(F.min(F.struct(*key("tag"))).alias("least")).select("least.*")
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    rows = docs.withColumn("__row", row_tag(F.col("text")))
    rows = rows.select(*key("__row"), F.struct(*docs.columns).alias("__whole"), F.to_json(F.struct(F.lit(0), *others)).alias("__others"))
    # Equal rows become one in each partition before they meet, so a text that repeats a million times is no burden.
    once = rows.groupBy("__none", "__id", "__tag").agg(F.min_by("__whole", "__others").alias("__whole"))
    return once.join(first, ["__none", "__id", "__tag"], "left_semi").select("__whole.*")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each of op8's groups stays, as `one_of_each` chooses; of groups without any doc_id, one of each
    fingerprint. The pipeline's own stage is `near_copies.stage`."""
    groups = near_duplicates(docs)
    return one_of_each(docs, groups.select("doc_id", "tag", F.struct("component_id", F.when(F.col("component_id").isNull(), F.col("fp")).alias("fp")).alias("root")))
