"""Line runs, winnowing, near-duplicates, substrings and personal data against brute force, with every awkward input."""

import random

import brute
import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from viewloom.llm import column_bwt, line_runs, near_copies, pii_votes, simhash_trees, winnowing
from viewloom.llm.common import QUERIES, scratch

SCHEMA = "doc_id bigint, text string, key string, n bigint"
SF = "/root/testdata/sf0.001"


def frame(spark, docs, parts=3):
    """Documents with columns whose names clash with those used inside."""
    return spark.createDataFrame([(d, t, "k", 1) for d, t in docs], SCHEMA).repartition(parts)


def bag(rows):
    return sorted((tuple(r) for r in rows), key=repr)


def awkward(seed: int) -> list[tuple]:
    """Shared lines, passages and near copies; null, empty, blank and very long texts; repeated rows; a row without id."""
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("abcdeéß字") for _ in range(r.randint(2, 9))) for _ in range(300)]
    sentence = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    shared = [sentence(12) for _ in range(6)]
    docs = []
    for i in range(40):
        lines = [sentence(r.randint(1, 20)) for _ in range(r.randint(1, 6))]
        for line in r.sample(shared, r.randint(0, 3)):
            lines.insert(r.randint(0, len(lines)), r.choice([line, f"  {line.upper() if line.isascii() else line}\t", line]))
        docs.append((i, "\n".join(lines)))
    docs += [(100 + i, docs[i][1]) for i in range(5)]
    docs += [(110 + i, docs[i][1].replace(" ", "  ", 1) + " more") for i in range(5)]
    docs += [(120, None), (121, ""), (122, "\n"), (123, " \t "), (124, "x" * 3000), (125, "x" * 3000 + "y"), (126, "ab " * 4000)]
    docs += [(127, sentence(5000)), (128, "É" * 60), (129, "É" * 60 + "é"), (None, docs[0][1]), (None, None), (3, docs[3][1]), (3, docs[3][1])]
    return docs


@pytest.mark.parametrize("seed", [1, 2])
def test_lines(spark, seed):
    docs = awkward(seed)
    got = line_runs.dedup_lines(frame(spark, docs), batches=5, fanout=2)
    assert got.columns == ["doc_id", "text", "key", "n", "n_lines", "n_dropped"]
    assert bag(got.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256)).collect()) == bag(brute.line_dedup(docs))


def test_lines_of_one_document_and_of_none(spark):
    line = "a line of over twenty characters"
    docs = [(1, f"{line}\n{line}"), (2, line)]
    assert bag(line_runs.dedup_lines(frame(spark, docs)).select("doc_id", "n_lines", "n_dropped").collect()) == [(1, 2, 0), (2, 1, 0)]
    assert line_runs.dedup_lines(frame(spark, []).limit(0)).count() == 0
    assert line_runs.dedup_lines(frame(spark, [(None, line), (None, line), (None, line)])).where("n_dropped > 0").count() == 0


@pytest.mark.parametrize("seed", [3, 4])
def test_winnowing(spark, seed):
    docs, r = awkward(seed), random.Random(seed)
    texts = [t for _, t in docs if t and len(t.split()) > 14]
    items = [(i, " ".join(r.choice(texts).split()[k : k + n])) for i, (k, n) in enumerate([(0, 10), (1, 12), (2, 9), (0, 1), (3, 3), (0, 40), (0, 11)])]
    items += [(7, None), (8, ""), (9, "..."), (0, "quite another text of ten words that is found nowhere else"), (None, " ".join(texts[0].split()[:11]))]
    items += [(10, items[0][1]), (11, "x" * 3000)]
    got = winnowing.contamination(frame(spark, docs), spark.createDataFrame(items, "item_id bigint, text string"))
    got = got.select("doc_id", "n_words", "n_hit", F.size("items").cast("long"), F.sha2(F.array_join("items", ","), 256), "contaminated")
    assert bag(got.collect()) == bag(brute.contamination(docs, items))


def test_winnowing_by_shuffled_join(spark, monkeypatch):
    monkeypatch.setattr(winnowing, "BROADCAST_ROWS", 0)
    docs = awkward(5)
    items = [(i, t) for i, t in docs if i is not None and i % 7 == 0]
    got = winnowing.contamination(frame(spark, docs), spark.createDataFrame(items, "item_id bigint, text string"))
    want = [(d, n, h) for d, n, h, *_ in brute.contamination(docs, items)]
    assert bag(got.select("doc_id", "n_words", "n_hit").collect()) == bag(want)


def test_winnowing_of_items_with_one_prompt(spark):
    """Items that share their first eleven words differ only in the windows across the prompt's end; rows don't multiply."""
    r = random.Random(6)
    word = lambda: f"w{r.randrange(10_000)}"
    prompt = [word() for _ in range(11)]
    docs = [(i, " ".join([word() for _ in range(5)] + prompt + [word() for _ in range(20)])) for i in range(150)] + [(150, " ".join(prompt[:10]))]
    items = [(i, " ".join(prompt + [word() for _ in range(8)])) for i in range(150)]
    table = spark.createDataFrame(items, "item_id bigint, text string")
    got = winnowing.contamination(frame(spark, docs), table).select("doc_id", "n_words", "n_hit", F.size("items").cast("long"), F.sha2(F.array_join("items", ","), 256), "contaminated")
    assert bag(got.collect()) == bag(brute.contamination(docs, items))
    windows = winnowing.item_windows(table)
    known = windows.groupBy("fingerprint", F.size("words").alias("size")).agg(F.collect_set("at").alias("ats"))
    rows = winnowing.fingerprint_rows(frame(spark, docs), [])
    met = rows.join(known, "fingerprint", "left_semi").count()
    assert 150 <= met and winnowing.windows_around(rows, known).count() <= len(docs) + 6 * met


def test_winnowing_without_items_or_documents(spark):
    none = spark.createDataFrame([], "item_id bigint, text string")
    got = winnowing.contamination(frame(spark, [(1, "a b"), (2, None)]), none)
    assert bag(got.select("doc_id", "n_words", "n_hit", "contaminated").collect()) == [(1, 2, 0, False), (2, 0, 0, False)]
    assert winnowing.contamination(frame(spark, []).limit(0), none).count() == 0


@pytest.mark.parametrize("tree, shard", [(8192, 256), (5, 1)])
def test_near_duplicates(spark, monkeypatch, tree, shard):
    monkeypatch.setattr(simhash_trees, "TREE_ENTRIES", tree)
    monkeypatch.setattr(simhash_trees, "SHARD_ENTRIES", shard)
    docs = awkward(6)
    got = simhash_trees.near_duplicates(frame(spark, docs)).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")), "component_id")
    assert bag(got.collect()) == bag(brute.near_duplicates(docs))
    assert simhash_trees.near_duplicates(frame(spark, []).limit(0)).count() == 0


def test_links_join_up_chains(spark, tmp_path):
    """Fingerprints in a long chain of small steps, all in one shard, and some apart from it."""
    chain = [0]
    for i in range(60):
        chain.append(chain[-1] ^ (0b111 << (3 * (i % 16))) ^ (1 << (3 * (i % 16)) if i >= 16 else 0))
    entries = spark.createDataFrame([(x,) for x in {*chain, 1 << 62, -1}], "fp bigint")
    edges = simhash_trees.links(entries, entries.count(), f"file://{tmp_path}/links")
    got = {r[0]: r[1] for r in simhash_trees.components(edges, f"file://{tmp_path}/parts").collect()}
    want: dict[int, int] = {}
    left = {*chain, 1 << 62, -1}
    while left:
        group, ends = set(), [left.pop()]
        while ends:
            x = ends.pop()
            group.add(x)
            near = {y for y in left if ((x ^ y) & (1 << 64) - 1).bit_count() <= 3}
            left -= near
            ends += near
        want |= {x: min(group) for x in group if len(group) > 1}
    assert len(set(got.values())) == len(set(want.values())) and got.keys() == want.keys()
    assert all((got[a] == got[b]) == (want[a] == want[b]) for a in want for b in want)


def test_stage_keeps_one_of_each_group(spark):
    docs = [(5, "one two three four"), (2, "one two three four"), (9, "ONE  two three four"), (7, "something else entirely"), (8, None), (None, None), (None, "a b c d e")]
    kept = simhash_trees.stage(spark, frame(spark, docs), SF)
    assert kept.columns == ["doc_id", "text", "key", "n"]
    assert bag(kept.select("doc_id").collect()) == bag([(2,), (7,), (8,), (None,)])


def similar_groups(docs: list[tuple]) -> list[set]:
    """The row numbers of each group that links of five-word Jaccard similarity of 0.8 or more connect."""
    sets = []
    for _, text in docs:
        w = (text or "").encode().lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    groups: list[set] = []
    for i, a in enumerate(sets):
        near = [g for g in groups if any(10 * len(a & sets[j]) >= 8 * len(a | sets[j]) for j in g)]
        groups = [g for g in groups if g not in near] + [{i}.union(*near)]
    return groups


def near_and_far_copies() -> list[tuple]:
    """Texts, and copies of each with words replaced here and there: similarities of about 0.6 to 1."""
    r = random.Random(11)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(6))
    docs = []
    for n in (60, 200, 400):
        for changes in [*range(1, 9), *range(1, 9)]:
            base = [word() for _ in range(n)]
            docs.append((len(docs), " ".join(base)))
            for _ in range(max(1, changes * n // 200)):
                base[r.randrange(n)] = word()
            docs.append((len(docs), " ".join(base)))
    chain = [word() for _ in range(300)]
    for _ in range(12):  # each near the next only
        docs.append((len(docs), " ".join(chain)))
        chain = chain[12:] + [word() for _ in range(12)]
    return docs


def test_pipeline_finds_all_near_copies(spark):
    docs = near_and_far_copies() + [(900, None), (901, " "), (902, "a b"), (903, "A  b"), (903, "A  b")]
    stage = dict(corpus_pipeline.STAGES)["simhash near-dedup"]
    kept = [r["doc_id"] for r in stage(spark, frame(spark, docs), SF).select("doc_id").collect()]
    assert sorted(kept) == sorted(min(docs[i][0] for i in g) for g in similar_groups(docs))
    assert near_copies.stage(spark, frame(spark, []).limit(0), SF).count() == 0


def test_pipeline_keeps_one_row_of_each_group(spark):
    """Repeated rows, ids with two near texts, and exact copies without any id."""
    text = " ".join(f"w{i}" for i in range(60))
    docs = [(3, text), (3, text), (3, text + " end"), (None, text), *[(None, "copies without an id of theirs")] * 5, (None, "copies  without an id of theirs")]
    stage = dict(corpus_pipeline.STAGES)["simhash near-dedup"]
    kept = stage(spark, frame(spark, docs), SF)
    assert kept.columns == ["doc_id", "text", "key", "n"]
    got = kept.collect()
    assert sorted((r["doc_id"] or 0 for r in got)) == [0, 3] and all(r["key"] == "k" and r["n"] == 1 for r in got)


@pytest.mark.parametrize("seed", [7, 8])
def test_substrings(spark, monkeypatch, seed):
    monkeypatch.setattr(column_bwt, "CHUNK_BYTES", 20_000)
    monkeypatch.setattr(column_bwt, "BUCKET_BYTES", 30_000)
    docs, r = awkward(seed), random.Random(seed)
    whole = " ".join(t for _, t in docs if t)
    docs += [(200 + i, whole[(k := r.randrange(2000)) : k + 48 + i] + str(i)) for i in range(8)]
    docs += [(300, "ab" * 200), (301, "ba" * 100 + "\0" * 70), (302, "\0" * 60 + "z"), (303, "q" + "\0" * 49)]
    got = column_bwt.dedup_substrings(frame(spark, docs))
    assert bag(got.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)).collect()) == bag(brute.substrings(docs))
    assert column_bwt.dedup_substrings(frame(spark, []).limit(0)).count() == 0
    assert column_bwt.dedup_substrings(frame(spark, [(1, None)])).select("n_bytes").collect() == [(0,)]


PII = [
    "mail a.b@c.d.e, x@y and _@q.io_z@w.xy @@ a@b..c a@b.c.",
    "at 1.2.3.4.5.6.7.8, 256.1.1.1, 007.000.255.1, 1.2.3, 99999999999.1.1.1",
    "cards 4111111111111111 4111-1111-1111-1111 4111 1111 1111 1112 4111  1111 " + "5" * 5000,
    "call +1 (974) 555-3436 or +49-30-123456.7, +1, +123456789012345678, ++4420-7946-0958) and 974-555-3436",
    "é字😀 a@b.co 😀 +33 1 23 45 67 89",
    "a" * 20000 + "@" + "b" * 10,
    "name (at) example (dot) com",
    "1 " * 3000,
    None,
    "",
]


def test_base_spans(spark):
    docs = [*enumerate(PII), (3, PII[3]), (None, PII[0]), *((1000 + d if d is not None else None, t) for d, t in awkward(9))]
    found = pii_votes.find_pii(frame(spark, docs)).collect()
    got = [(r["doc_id"], [f"{s['kind']}:{s['start']}:{s['end']}" for s in r["spans"] if s["base"]]) for r in found]
    assert bag(got) == bag((d, brute.pii(t)) for d, t in docs)
    extra = {(r["doc_id"], s["kind"]) for r in found for s in r["spans"] if not s["base"]}
    assert (6, "email") in extra and (3, "phone") in extra
    assert all([s["kind"] for s in r["spans"]] == sorted((s["kind"] for s in r["spans"]), key=pii_votes.KINDS.index) for r in found)
    assert pii_votes.find_pii(frame(spark, []).limit(0)).count() == 0


def loosely(spark, texts):
    """By text, the kind and match of each accepted span that is not base."""
    found = pii_votes.find_pii(frame(spark, list(enumerate(texts)))).collect()
    return {r["doc_id"]: [(s["kind"], texts[r["doc_id"]][s["start"] : s["end"]]) for s in r["spans"] if not s["base"]] for r in found}


def test_failed_base_matches_keep_nothing_out(spark):
    """Digits fit the raw card pattern, which must not keep out phone numbers without a plus and written-out addresses."""
    texts = ["call 974-555-3436 now", "or (974) 555-3436 now", "x-y 974.555.3436 now", "ask anna42 (at) example (dot) com now", "call +1 974-555-3436 now"]
    want = [("phone", "974-555-3436"), ("phone", "(974) 555-3436"), ("phone", "974.555.3436"), ("email", "anna42 (at) example (dot) com")]
    assert loosely(spark, texts) == {**{i: [w] for i, w in enumerate(want)}, 4: []}


def test_phone_numbers_in_texts_without_a_hyphen(spark):
    numbers = ["974.555.3436", "974 555 3436", "(974) 555 3436", "(974)555.3436"]
    assert loosely(spark, [f"call {x} now" for x in numbers]) == {i: [("phone", x)] for i, x in enumerate(numbers)}


def test_labelers_are_weighed():
    """A number that fails its check needs more than a fitting prefix; a cue word beside it is enough."""
    seen = [((1, 1, 0, 1), 400), ((-1, 1, 0, 1), 300), ((-1, -1, 0, -1), 300), ((1, 1, 1, 1), 60), ((-1, 1, 1, 1), 5), ((-1, -1, -1, -1), 20)]
    posterior = pii_votes.reliabilities(seen)[1]
    bias, *w = pii_votes.classifier(seen, posterior)
    says = {v: bias + sum(a * b for a, b in zip(w, v, strict=True)) > 0 for v, _ in seen}
    assert [says[v] for v, _ in seen] == [True, False, False, True, True, False]


@pytest.mark.parametrize(
    "name, plain",
    [
        ("op4_line_runs", brute.line_dedup),
        ("op8_simhash_trees", brute.near_duplicates),
        ("op10_column_bwt", brute.substrings),
        ("op1_pii_votes", lambda docs: [(d, brute.sha(",".join(brute.pii(t)))) for d, t in docs]),
    ],
)
def test_queries_on_given_tables(spark, name, plain):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES[name](spark, SF)
    if name == "op1_pii_votes":
        got = got.select("doc_id", "base_sha256")
    assert bag(got.collect()) == bag(plain(docs))


def test_runs_merge_where_they_lie(spark):
    """Runs are merged without a shuffle, and a batch is dealt to their buckets once."""
    runs = line_runs.LineRuns(spark, f"{scratch(spark)}/runs", 3, 3)
    keys = lambda low, high: spark.range(low, high).select(F.unhex(F.md5(F.col("id").cast("string"))).alias("key"), F.lit(1).cast("long").alias("docs"), F.col("id").alias("keeper"))
    for at in range(4):
        runs.add(keys(at * 500, 2000))
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    merged = runs.merged(runs.runs())
    assert "Exchange" not in plan(merged) and plan(runs.unknown(keys(0, 9))).count("Exchange hashpartitioning") == 1
    assert merged.count() == 2000 and runs.common().count() == 1000
    assert runs.unknown(keys(900, 1100)).count() == 100
    runs.close()


def test_lines_of_long_texts(spark):
    """Texts of 100,000 lines, all shared: linear in the text, so seconds and not hours."""
    lines = [f"line {i} of twenty characters and more" for i in range(100_000)]
    docs = [(i, "\n".join([*lines, f"own {i}", ""])) for i in range(3)] + [(9, "\n".join(lines[::2]))]
    got = line_runs.dedup_lines(frame(spark, docs, 1)).select("doc_id", "n_lines", "n_dropped", F.length("text")).collect()
    assert bag(got)[:2] == [(0, 100_002, 100_000, 6), (1, 100_002, 100_000, 6)]
    assert bag(got)[2][:3] == (2, 100_002, 50_000) and bag(got)[3][:3] == (9, 50_000, 0)
