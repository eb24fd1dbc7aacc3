"""Benchmark decontamination by winnowing.

Every text becomes word hashes, and those k-gram hashes. In each window of `SPAN - K + 1` neighbouring k-grams the least
hash is kept (the last of equal ones). A span of SPAN words holds exactly one such window, so a span that a document and a
benchmark item share yields the same fingerprint at the same place in both: joining fingerprints finds every shared span.
Each hit is then extended to the windows of SPAN words around it, six at most, which are looked up by the hash of their
words and compared by the hashes of the single words: a fingerprint that many items share doesn't multiply the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from viewloom.llm.common import UPPER, ascii_lower, query, row_tag, scratch, stored, table

SPAN = 10
K = 5
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: A fingerprint is packed with its place: a text of under 2^31 bytes has under 2^30 words.
PLACE_BITS = 30
PLACE_MASK = (1 << PLACE_BITS) - 1

#: Rows of the benchmark's window table (about 200 bytes each) up to which it is broadcast; beyond, the join shuffles.
BROADCAST_ROWS = 100_000


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(ascii_lower(text), F.lit("")), F.lit(WORD), F.lit(0))


def word_hashes(text: Column) -> Column:
    return F.transform(words_of(text), lambda w: F.xxhash64(w))


def grams(words: str, k: int) -> Column:
    """Hash of the k words from each place on. `words` names an array of word hashes."""
    w = F.col(words)
    return F.transform(
        F.slice(w, 1, F.greatest(F.size(w) - k + 1, F.lit(0))),
        lambda x, i: F.xxhash64(x, *[F.get(w, i + j) for j in range(1, k)]),
    )


def placed(hashes: str) -> Column:
    """The upper bits of each hash over its place counted down, so that of equal hashes the last is the least."""
    return F.transform(
        F.col(hashes), lambda h, i: F.shiftleft(F.shiftright(h, PLACE_BITS), PLACE_BITS).bitwiseOR(F.lit(PLACE_MASK) - i.cast("long"))
    )


def least_of_windows(packed: str, width: int) -> Column:
    """The least packed hash of every window of `width` neighbours."""
    p = F.col(packed)
    return F.transform(
        F.slice(p, 1, F.greatest(F.size(p) - width + 1, F.lit(0))), lambda x, i: F.least(x, *[F.get(p, i + j) for j in range(1, width)])
    )


def place_of(packed: Column) -> Column:
    return (F.lit(PLACE_MASK) - packed.bitwiseAND(F.lit(PLACE_MASK))).cast("int")


def item_windows(items: DataFrame) -> DataFrame:
    """The windows of benchmark items: (item_id, words, fingerprint, at), `at` being the fingerprint's place in the window.

    An item of fewer than SPAN words is one window of all its words; its fingerprint is the hash of the whole of it.
    """
    long = items.select("item_id", word_hashes(F.col("text")).alias("w")).where(F.size("w") > 0)
    short = long.where(F.size("w") < SPAN).select("item_id", F.col("w").alias("words"), F.xxhash64("w").alias("fingerprint"), F.lit(0).alias("at"))
    spans = (
        long.where(F.size("w") >= SPAN)
        .withColumn("g", grams("w", K))
        .withColumn("p", placed("g"))
        .select("item_id", "w", "g", F.posexplode(least_of_windows("p", SPAN - K + 1)).alias("start", "least"))
        .select(
            "item_id",
            F.slice("w", F.col("start") + 1, F.lit(SPAN)).alias("words"),
            F.get("g", place_of(F.col("least"))).alias("fingerprint"),
            (place_of(F.col("least")) - F.col("start")).alias("at"),
        )
    )
    return spans.unionByName(short)


def fingerprint_rows(docs: DataFrame, short_lengths: list[int]) -> DataFrame:
    """Per document one row of `length` -1 that carries its word count, and one per fingerprint with the words
    around it: (doc_id, tag, n_words, length, fingerprint, place, around, first); `length` SPAN stands for SPAN and more.

    For each length below SPAN that benchmark items have, every run of so many words is a fingerprint.
    """
    reach = SPAN - K
    base = (
        docs.select("doc_id", row_tag(F.col("text")).alias("tag"), word_hashes(F.col("text")).alias("w"))
        .withColumn("g", grams("w", K))
        .withColumn("p", placed("g"))
        .withColumn("least", F.array_distinct(least_of_windows("p", SPAN - K + 1)))
    )
    head = F.array(F.struct(F.lit(-1).alias("length"), F.lit(None).cast("int").alias("place"), F.lit(None).cast("long").alias("fingerprint")))
    spans = F.transform(
        "least",
        lambda x: F.struct(F.lit(SPAN).alias("length"), place_of(x).alias("place"), F.get("g", place_of(x)).alias("fingerprint")),
    )

    def runs(n: int) -> Column:
        one = lambda _, i: F.struct(F.lit(n).alias("length"), i.alias("place"), F.xxhash64(F.slice("w", i + 1, F.lit(n))).alias("fingerprint"))
        return F.transform(F.slice("w", 1, F.greatest(F.size("w") - n + 1, F.lit(0))), one)

    short = [runs(n) for n in short_lengths]
    rows = base.select("doc_id", "tag", "w", F.size("w").alias("n_words"), F.explode(F.concat(head, spans, *short)).alias("f"))
    first = F.greatest(F.col("f.place") - reach, F.lit(0))
    width = F.when(F.col("f.length") == SPAN, F.lit(2 * SPAN - K)).otherwise(F.lit(reach + SPAN))
    return rows.select(
        "doc_id", "tag", "n_words", F.col("f.length").alias("length"), F.coalesce("f.fingerprint", F.xxhash64("doc_id", "tag")).alias("fingerprint"),
        F.col("f.place").alias("place"), first.alias("first"),
        F.when(F.col("f.place").isNotNull(), F.slice("w", first + 1, width)).alias("around"),
    )


def windows_around(rows: DataFrame, known: DataFrame) -> DataFrame:
    """(doc_id, tag, n_words, length, w) of fingerprint_rows: the windows that hold a fingerprint of `known` (fingerprint, size,
    ats: its places in windows), with w = (at, start, words, window: the words' hash). At most SPAN - K + 1 for a fingerprint.

    A head stays as one window of nothing, whose hash is its own: heads meet no item and don't meet each other.
    """
    met = (F.col("d.fingerprint") == F.col("k.fingerprint")) & (F.col("d.length") == F.col("k.size"))
    marked = rows.alias("d").join(known.alias("k"), met, "left")
    is_head = F.col("d.length") == -1

    def window(at: Column) -> Column:
        start = F.col("d.place") - at
        words = F.when(start >= 0, F.slice("d.around", F.greatest(start - F.col("d.first") + 1, F.lit(1)), F.greatest("d.length", F.lit(0))))
        return F.struct(at.alias("at"), start.alias("start"), words.alias("words"), F.xxhash64(words).alias("window"))

    nothing = F.struct(
        F.lit(None).cast("int").alias("at"), F.lit(None).cast("int").alias("start"), F.lit(None).cast("array<bigint>").alias("words"),
        F.col("d.fingerprint").alias("window"),
    )
    ones = F.when(is_head, F.array(nothing)).otherwise(F.transform("k.ats", window))
    return marked.where(is_head | F.col("k.ats").isNotNull()).select("d.doc_id", "d.tag", "d.n_words", "d.length", F.explode(ones).alias("w"))


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row per row of `docs`: doc_id, tag, n_words, n_hit, the sorted item ids (`items`, as strings) and `contaminated`.

    Null or wordless text has no words and no hit. Items without words are nowhere found; items that share an id are one;
    an item without id makes words hit but isn't listed. Rows equal in doc_id and text are judged once and returned as
    often as they occur. With no items nothing is hit; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    folder = scratch(spark)
    windows = stored(item_windows(items), f"{folder}/windows")
    lengths = sorted(n for (n,) in windows.select(F.size("words")).distinct().where(F.size("words") < SPAN).collect())
    distinct = windows.groupBy("fingerprint", "at", "words").agg(F.xxhash64("words").alias("window"))
    distinct = stored(distinct.withColumn("size", F.size("words")), f"{folder}/distinct")
    known = distinct.groupBy("fingerprint", "size").agg(F.collect_set("at").alias("ats"))  # a window has SPAN - K + 1 places
    if distinct.count() <= BROADCAST_ROWS:
        distinct, known = F.broadcast(distinct), F.broadcast(known)
    around = windows_around(fingerprint_rows(docs, lengths), known)
    is_head = F.col("d.length") == -1
    same = [F.col("d.length") == F.col("b.size"), F.col("d.w.window") == F.col("b.window"), F.col("d.w.at") == F.col("b.at"), F.col("d.w.words") == F.col("b.words")]
    found = around.alias("d").join(distinct.alias("b"), same, "left")
    equal = F.col("b.window").isNotNull()
    hits = stored(
        found.where(is_head | equal).select(
            "d.doc_id", "d.tag", "d.n_words", F.when(equal, F.struct(F.col("d.w.start").alias("start"), (F.col("d.w.start") + F.col("b.size")).alias("end"))).alias("span"),
            F.when(equal, F.struct("b.size", "b.window")).alias("window"),
        ),
        f"{folder}/hits",
    )
    # The union of spans: each adds what lies beyond the furthest end so far.
    union = F.aggregate(
        F.array_sort(F.collect_set("span")),
        F.struct(F.lit(0).alias("hit"), F.lit(0).alias("reach")),
        lambda a, s: F.struct(
            (a["hit"] + F.greatest(F.lit(0), s["end"] - F.greatest(s["start"], a["reach"]))).alias("hit"), F.greatest(a["reach"], s["end"]).alias("reach")
        ),
        lambda a: a["hit"].cast("long"),
    )
    spans = hits.groupBy("doc_id", "tag").agg(
        F.max("n_words").cast("long").alias("n_words"), F.count_if(F.col("span").isNull()).alias("copies"), union.alias("n_hit")
    )
    # Windows are told apart by their words' hash; the items of a window join only what was found.
    of_window = windows.select(F.struct(F.size("words").alias("size"), F.xxhash64("words").alias("window")).alias("window"), F.col("item_id").cast("string").alias("item_id"))
    listed = (
        hits.where(F.col("window").isNotNull()).select("doc_id", "tag", "window").distinct()
        .join(of_window.distinct(), "window")
        .groupBy("doc_id", "tag").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    )
    joined = spans.alias("s").join(listed.alias("l"), F.col("s.doc_id").eqNullSafe(F.col("l.doc_id")) & (F.col("s.tag") == F.col("l.tag")), "left")
    return joined.select(
        "s.doc_id", "s.tag", "n_words", "n_hit", F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        (F.col("n_hit") > 0).alias("contaminated"), F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"),
    ).drop("copy")


LETTERS = f"translate(text, '{UPPER}', '{UPPER.lower()}')"
ORACLE = f"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce({LETTERS}, ''), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(coalesce({LETTERS}, ''), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark
), bw AS (
  SELECT DISTINCT item_id, n, w[s:s + n - 1] AS win FROM (
    SELECT item_id, w, least(len(w), {SPAN}) AS n, unnest(range(1, len(w) - least(len(w), {SPAN}) + 2)) AS s FROM b WHERE len(w) > 0)
), dw AS (
  SELECT doc_id, n, s, w[s:s + n - 1] AS win FROM (
    SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)
), hit AS (SELECT doc_id, s, dw.n, item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.win = bw.win),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hit) GROUP BY doc_id),
found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM hit) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN found USING (doc_id)
"""


@query("op5_winnowing", ORACLE)
def op5_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return contamination(docs, items).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any word in a benchmark window."""
    bad = contamination(docs, table(spark, sf_dir, "benchmark")).where("contaminated").select(F.col("doc_id").alias("__id"), F.col("tag").alias("__tag"))
    kept = docs.withColumn("__row", row_tag(F.col("text")))
    return kept.join(bad.distinct(), F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__row") == F.col("__tag")), "left_anti").select(docs.columns)
