"""Near copies by Jaccard similarity of five-word shingles: the pipeline's near-dedup stage.

SimHash alone can't find these: at a similarity of 0.8 two 64-bit fingerprints differ by about ten bits, and no blocks of bits
pay for such a radius. So candidates are the links of the BK-trees (SimHash of five-word shingles) and, besides, texts
that share one of BANDS MinHash bands. A link counts only if the exact Jaccard similarity of the two texts' shingles is
at least 0.8; groups are what confirmed links connect.

Members of a band's bucket meet one of them first, so a group of thousands of near copies is joined up by thousands of
comparisons and not millions. In a bucket that still holds members apart, those outside its largest group are strays. If
it has few of them (STRAYS) or is small (SMALL), every member is compared with every stray, once for all buckets of the
same members. The members of other buckets, which many texts of
one template may share, are dealt anew by more MinHash rows, FORESTS times with different ones, and again more often with
still more rows as long as that leaves such buckets: each turn's rows are in proportion to the members, whatever the
size of a bucket, and none is cut off.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewloom.llm.common import row_tag, scratch, stored
from viewloom.llm.components import components
from viewloom.llm.simhash_trees import SEED, fingerprint_of, links, one_of_each

SHINGLE = 5
#: Least similarity of a link, as a fraction of whole numbers.
OVER, UNDER = 4, 5
#: A pair of similarity s shares a band with a chance of 1 - (1 - s ** ROWS) ** BANDS: 0.9999 at 0.8.
BANDS, ROWS = 24, 5
MINIMA = BANDS * ROWS
#: Buckets of so many members, or with so many of them outside the largest group, are compared pair by pair.
SMALL, STRAYS = 32, 8
#: How often members of a larger bucket are dealt anew in the first turn, and that many times more in each that follows; how
#: many MinHash rows each turn adds.
FORESTS, DEEPER = 4, 4
#: Shingles whose hashes under all functions are held at once; words whose hashes a task remembers.
BLOCK, WORDS = 1 << 12, 1 << 18

_random = np.random.default_rng(42)
_FACTORS, _SHIFTS, _MIX = (_random.integers(0, 1 << 64, MINIMA, dtype=np.uint64) for _ in range(3))
_FACTORS, _MIX = _FACTORS | np.uint64(1), (_MIX | np.uint64(1)).reshape(BANDS, ROWS)
_BAND = _random.integers(0, 1 << 64, BANDS, dtype=np.uint64)
_PLACES = _random.integers(0, 1 << 64, SHINGLE, dtype=np.uint64) | np.uint64(1)


class WordHashes(dict):
    """Hashes of words, worked out once each."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word, SEED)
        return value


def shingles(text: str | None, known: WordHashes) -> np.ndarray:
    """The hash of each five-word shingle, in order: words' hashes mixed by place. Fewer words are one shingle, none give none."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # of bytes: A-Z only, ASCII blanks only
    if not words:
        return np.zeros(0, dtype=np.uint64)
    of_words = np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))
    size = min(SHINGLE, len(words))
    mixed = np.full(len(words) - size + 1, size, dtype=np.uint64)
    for at in range(size):
        mixed += of_words[at : len(words) - size + 1 + at] * _PLACES[at]
        mixed ^= mixed >> np.uint64(31)
    mixed *= np.uint64(0x9E3779B97F4A7C15)
    return mixed ^ mixed >> np.uint64(32)


def minima(distinct: np.ndarray) -> np.ndarray:
    """MinHash of a text's distinct shingle hashes."""
    low = np.full(MINIMA, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(distinct), BLOCK):
        part = distinct[at : at + BLOCK]
        np.minimum(low, (_FACTORS[:, None] * part + _SHIFTS[:, None]).min(axis=1), out=low)
    return low ^ low >> np.uint64(29)


def bands(low: np.ndarray) -> np.ndarray:
    """One number for each band."""
    return (low.reshape(BANDS, ROWS) * _MIX).sum(axis=1, dtype=np.uint64) ^ _BAND


def sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, tag, fp, n, bands, rows) of each row: n counts distinct shingles, `rows` has 16 bits of each minimum."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            fps, sizes, keys, rows = [], [], [], []
            for text in batch.column("text"):
                hashes = shingles(text.as_py(), known)
                distinct = np.unique(hashes)
                low = minima(distinct)
                fps.append(fingerprint_of(hashes))
                sizes.append(len(distinct))
                keys.append(bands(low).view(np.int64))
                rows.append((low * _MIX.ravel() >> np.uint64(48)).astype(np.uint16).tobytes())
            arrays = [pa.array(fps, pa.int64()), pa.array(sizes, pa.int64()), pa.array(keys, pa.list_(pa.int64())), pa.array(rows, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("tag"), *arrays], ["doc_id", "tag", "fp", "n", "bands", "rows"])

    schema = "doc_id bigint, tag bigint, fp bigint, n bigint, bands array<bigint>, rows binary"
    return docs.select("doc_id", row_tag(F.col("text")).alias("tag"), "text").mapInArrow(run, schema)


def shingle_sets(texts: DataFrame) -> DataFrame:
    """(tag, shingles) of `texts` (tag, text): the distinct shingle hashes, sorted, 8 bytes each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            sets = [np.unique(shingles(text.as_py(), known)).tobytes() for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("tag"), pa.array(sets, pa.binary())], ["tag", "shingles"])

    return texts.select("tag", "text").mapInArrow(run, "tag bigint, shingles binary")


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sets of distinct hashes have the least similarity; two empty ones do."""
    common = len(np.intersect1d(a, b, assume_unique=True))
    return UNDER * common >= OVER * (len(a) + len(b) - common)


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) of tags whose texts are similar; `sets` has (tag, shingles) once for each tag."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = ([np.frombuffer(x.as_buffer(), dtype=np.uint64) for x in batch.column(c)] for c in ("of_a", "of_b"))
            kept = pa.array([similar(a, b) for a, b in zip(*held, strict=True)], pa.bool_())
            yield batch.select(["a", "b"]).filter(kept)

    both = pairs.join(sets.select(F.col("tag").alias("a"), F.col("shingles").alias("of_a")), "a")
    both = both.join(sets.select(F.col("tag").alias("b"), F.col("shingles").alias("of_b")), "b")
    return both.select("a", "b", "of_a", "of_b").mapInArrow(run, "a bigint, b bigint")


def ranked_pairs(found: DataFrame) -> DataFrame:
    """(a, b) for each pair of `found` (x, y: structs of tag and n) once, b being of least rank, without those that their
    sizes rule out."""
    fits = F.least("x.n", "y.n") * UNDER >= F.greatest("x.n", "y.n") * OVER
    x, y = (F.struct(F.xxhash64(F.col(c)["tag"]).alias("rank"), F.col(c)["tag"].alias("tag")) for c in ("x", "y"))
    met = found.where((F.col("x.tag") != F.col("y.tag")) & fits)
    return met.select(F.greatest(x, y)["tag"].alias("a"), F.least(x, y)["tag"].alias("b")).distinct()


def starred(buckets: DataFrame, turn: int) -> DataFrame:
    """Every member of a bucket (key, tag, n) with the bucket's member of least rank, as (x, y)."""
    first = buckets.groupBy("key").agg(F.min(F.struct(F.xxhash64(F.lit(turn), "tag").alias("rank"), "tag", "n")).alias("to"), F.count(F.lit(1)).alias("size"))
    return buckets.join(first.where("size > 1").select("key", "to"), "key").select(F.struct("tag", "n").alias("x"), F.struct("to.tag", "to.n").alias("y"))


def of_few(buckets: DataFrame) -> DataFrame:
    """Pairs (x, y) of a stray and a member with another root, in buckets (key, tag, n, root, stray)."""
    side = lambda rows, c: rows.select("key", F.struct("tag", "n").alias(c), F.col("root").alias(f"root_{c}"), F.col("stray").alias(f"stray_{c}"))
    met = side(buckets.where("stray"), "x").join(side(buckets, "y"), "key")
    return met.where("root_x <> root_y AND (x.tag < y.tag OR NOT stray_y)").select("x", "y")


def mixed(buckets: DataFrame, roots: DataFrame, met: bool) -> dict[str, DataFrame]:
    """The buckets that hold members of different roots, with `root` and `stray`: those with few strays and those with many.

    Of the former, buckets with the same members (told by a hash of 128 bits) stand there once, as their pairs are the same.
    Where members have `met` their bucket's first, a bucket of two has nothing left to compare.
    """
    named = buckets.join(roots.withColumnRenamed("node", "tag"), "tag", "left").withColumn("root", F.coalesce("root", "tag"))
    marks = [F.xxhash64(F.lit(seed), "tag") for seed in (1, 2)]
    groups = named.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"), *[F.bit_xor(mark).alias(f"m{i}") for i, mark in enumerate(marks)])
    of_key = F.sum("n").alias("size"), F.max(F.struct("n", "root")).alias("home"), F.struct(F.bit_xor("m0"), F.bit_xor("m1")).alias("members")
    sizes = groups.groupBy("key").agg(*of_key)
    strays = F.col("size") - F.col("home.n")
    sizes = sizes.where(strays > 0).withColumn("few", (strays <= STRAYS) | (F.col("size") <= SMALL))
    once = sizes.where(F.col("few") & (F.col("size") > (2 if met else 1))).groupBy("size", "members").agg(F.min(F.struct("key", "home")).alias("of"))
    chosen = once.select("of.key", "of.home.root", F.lit(True).alias("few"))
    sizes = chosen.unionByName(sizes.where(~F.col("few")).select("key", "home.root", "few")).withColumnRenamed("root", "home")
    held = named.join(sizes, "key").withColumn("stray", F.col("root") != F.col("home")).drop("home")
    return {"few": held.where("few").drop("few"), "many": held.where("NOT few").drop("few")}


def dealt_anew(members: DataFrame, turn: int) -> DataFrame:
    """`members` (key, band, tag, n, rows) in finer buckets: each FORESTS * `turn` times, by its bucket and DEEPER * `turn`
    more minima, which are others each time and none of the band's own."""
    rows = F.concat("rows", "rows")  # the minima in a circle
    forests, places = FORESTS * turn, MINIMA - ROWS - DEEPER * turn + 1
    keys = []
    for forest in range(forests):
        at = (F.col("band") + 1) * ROWS + (forest * places // forests + turn) % places
        keys.append(F.xxhash64("key", F.lit(turn), F.lit(forest), F.substring(rows, 2 * at + 1, F.lit(2 * DEEPER * turn))))
    return members.select("band", "tag", "n", F.col("key").alias("base"), F.explode(F.array(*keys)).alias("key"))


def near_copies(docs: DataFrame) -> DataFrame:
    """(doc_id, tag, root) for each row of `docs`: rows of one group share the root, which is the tag of one of them.

    Words are split at ASCII blanks and A-Z lower-cased, as for SimHash; a text of up to five words is one shingle. Null and
    wordless texts are alike. Rows without doc_id are linked like others. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    folder = scratch(spark)
    rows = stored(sketches(docs), f"{folder}/sketches")
    # Rows of one text have one sketch.
    once = (F.first(c).alias(c) for c in ("fp", "n", "bands", "rows"))
    texts = stored(rows.groupBy("tag").agg(*once), f"{folder}/distinct")

    # The BK-trees' links, between the least tags of the fingerprints, and from every other tag to the least.
    entries = stored(texts.groupBy("fp").agg(F.min(F.struct("tag", "n")).alias("to")), f"{folder}/entries")
    of_trees = links(entries.select("fp"), max(entries.count(), 1), folder)
    from_a = entries.select(F.col("fp").alias("a"), F.col("to").alias("x"))
    from_b = entries.select(F.col("fp").alias("b"), F.col("to").alias("y"))
    linked = of_trees.join(from_a, "a").join(from_b, "b").select("x", "y")
    equal = texts.join(entries, "fp").select(F.struct("tag", "n").alias("x"), F.col("to").alias("y"))

    every = texts.select("tag", "n", F.posexplode("bands").alias("band", "key"))
    shared = every.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1").select("key")
    buckets = stored(every.join(shared, "key", "left_semi"), f"{folder}/buckets")

    first = stored(ranked_pairs(linked.unionByName(equal).unionByName(starred(buckets, 0))), f"{folder}/pairs0")
    wanted = buckets.select("tag").unionByName(first.select(F.col("a").alias("tag"))).unionByName(first.select(F.col("b").alias("tag")))
    held = docs.select(row_tag(F.col("text")).alias("tag"), "text").groupBy("tag").agg(F.first("text").alias("text"))
    sets = stored(shingle_sets(held.join(wanted.distinct(), "tag", "left_semi")), f"{folder}/sets")
    compared, edges = first, stored(confirmed(first, sets), f"{folder}/links0")
    roots = components(edges, f"{folder}/parts0")

    # What buckets still hold apart: pair by pair where strays are few, else the members dealt anew.
    few, many = (stored(part, f"{folder}/{name}0") for name, part in mixed(buckets, roots, True).items())
    members, pending = many.select("key", "band", "tag", "n"), [of_few(few)]
    for turn in range(1, (MINIMA - ROWS) // DEEPER + 1):
        dealt = not members.isEmpty()
        if dealt:
            finer = stored(dealt_anew(members.join(texts.select("tag", "rows"), "tag"), turn), f"{folder}/finer{turn}")
            parts = mixed(finer, roots, False)
            pending += [starred(parts["many"], turn), of_few(parts["few"])]
        if not pending:
            break
        fresh = stored(ranked_pairs(reduce(DataFrame.unionByName, pending)).join(compared, ["a", "b"], "left_anti"), f"{folder}/pairs{turn}")
        more = stored(confirmed(fresh, sets), f"{folder}/links{turn}")
        if not more.isEmpty():
            edges = edges.unionByName(more)
            roots = components(edges, f"{folder}/parts{turn}")
        if not dealt:
            break
        compared, pending = compared.unionByName(fresh), []
        members = stored(mixed(finer, roots, True)["many"].select(F.col("base").alias("key"), "band", "tag", "n").distinct(), f"{folder}/members{turn}")
    return rows.select("doc_id", "tag").join(roots.withColumnRenamed("node", "tag"), "tag", "left").select("doc_id", "tag", F.coalesce("root", "tag").alias("root"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, as `one_of_each` chooses."""
    groups = near_copies(docs)
    return one_of_each(docs, groups)
