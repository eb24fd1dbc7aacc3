"""Mixing, URL rules, nearest neighbours, language and toxicity, and the pipeline over the operators."""

import math

import brute
import corpus_pipeline
import numpy as np
import pytest
from oracle import connect, differences
from pyspark.sql import functions as F

import __spark_entry__ as spark_entry
from viewloom.llm import language_ftrl, line_runs, one_bit_codes, ordinal_toxicity, poisson_mix, simhash_trees, url_rules, winnowing
from viewloom.llm.common import ORACLES, QUERIES, scratch

SF = "/root/testdata/sf0.001"


def bag(rows):
    return sorted((tuple(r) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_against_sql(spark, name):
    assert differences(QUERIES[name](spark, SF), connect(SF), ORACLES[name]) == []


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= spark_entry.queries().keys()


# Mixing


def mixed(spark, rows, **options):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, copy int, rate double")
    return poisson_mix.mix(docs, **options)


def test_rates_and_copies(spark):
    rows = [(i, "t", "big" if i % 10 else "small", None, None) for i in range(20_000)]
    out = mixed(spark, rows, weights={"big": 1, "small": 1, "absent": 5})
    assert out.columns == ["doc_id", "text", "source", "rate", "copy"]
    n = {r["source"]: r["count"] for r in out.groupBy("source").count().collect()}
    assert n["big"] == pytest.approx(10_000, rel=0.1) and n["small"] == pytest.approx(10_000, rel=0.1)
    again = mixed(spark, rows[::-1], weights={"big": 1, "small": 1, "absent": 5})
    assert bag(out.select("doc_id", "copy").collect()) == bag(again.select("doc_id", "copy").collect())
    order = [r["doc_id"] for r in out.select("doc_id").collect()]
    assert order != sorted(order)


def test_means_of_thousands(spark):
    """Far beyond where exp(-mean) is zero, counts still follow the distribution."""
    rows = [(i, "t", "one" if i < 3 else "rest", None, None) for i in range(9_000)]
    out = mixed(spark, rows, weights={"one": 1.0})
    n = [r["count"] for r in out.groupBy("doc_id").count().collect()]
    assert len(n) == 3 and all(abs(x - 3000) < 6 * math.sqrt(3000) for x in n)


def test_mixing_odd_rows(spark):
    rows = [(None, None, None, None, None), (None, "", None, None, None), (1, "a", None, 7, None), (1, "a", None, 7, None)] + [(i, "x", "s", None, None) for i in range(50)]
    out = mixed(spark, rows).groupBy("doc_id", "text", "source").agg(F.count("*").alias("n"), F.max("copy").alias("copies")).collect()
    assert all(r["n"] == r["copies"] * (2 if r["doc_id"] == 1 and r["text"] == "a" else 1) for r in out)
    assert mixed(spark, rows[:1]).limit(0).count() == 0 and mixed(spark, [(1, "t", "s", None, None)], weights={}).count() == 0
    empty = spark.createDataFrame([], "doc_id bigint, text string, source string")
    assert poisson_mix.mix(empty).count() == 0


def test_rows_of_one_id_are_dealt_to_all_tasks(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rows = [(7, "same", "s", None, None)] * 4_000 + [(None, None, "s", None, None)] * 4_000
    out = mixed(spark, rows, weights={"s": 1.0}).withColumn("part", F.spark_partition_id())
    for ident in (F.col("doc_id") == 7, F.col("doc_id").isNull()):
        held = [r["count"] for r in out.where(ident).groupBy("part").count().collect()]
        assert not held or (len(held) > 1 and max(held) < 2 * sum(held) / len(held))
    assert out.count() >= 4_000 and out.count() % 4_000 == 0
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_weight_of_rows_without_source(spark):
    rows = [(i, "t", None if i % 2 else "", None, None) for i in range(2_000)]
    sources = lambda weights: {r["source"] for r in mixed(spark, rows, weights=weights).select("source").distinct().collect()}
    assert sources({"": 1.0}) == {""} and sources({None: 1.0}) == {None} and sources({None: 1.0, "": 1.0}) == {None, ""}


# URL rules

URLS = [
    ("http://a.EXAMPLE.org/es/x?q#f", "a.example.org", "/es/x", "example.org/es/", "block"),
    ("https://example.org/en/12", "example.org", "/en/12", "example.org/en/1", "block"),
    ("https://example.org/en/2", "example.org", "/en/2", "org/", "allow"),
    ("https://notexample.org/es/", "notexample.org", "/es/", "org/", "allow"),
    ("https://example.org", "example.org", "", None, "allow"),
    ("https://x.com/fr/a", "x.com", "/fr/a", "com/fr/", "allow"),
    ("https://x.com/de", "x.com", "/de", None, "allow"),
    ("https://evil.net/a.example.org/es/", "evil.net", "/a.example.org/es/", None, "allow"),
    ("https://www.cheap-pills.net/x", "www.cheap-pills.net", "/x", None, "block"),
    ("https://www.cheap-pills.org/x", "www.cheap-pills.org", "/x", "org/", "allow"),
    ("ftp://h.net/a/b.zip", "h.net", "/a/b.zip", None, "block"),
    ("no scheme.org/", "", "", None, "allow"),
    ("x://a://b/c", "a:", "//b/c", None, "allow"),
    ("://?", "", "", None, "allow"),
    ("http://É.Org/ÉA", "É.org", "/ÉA", "org/", "allow"),
    ("http://h/" + "p" * 50_000, "h", "/" + "p" * 50_000, None, "allow"),
    (None, "", "", None, "allow"),
    ("", "", "", None, "allow"),
]


def test_urls(spark):
    rows = [(i, *u) for i, u in enumerate([*URLS, URLS[0], URLS[0]])]
    pages = spark.createDataFrame([(r[0], r[1], "old") for r in rows], "page_id bigint, url string, rule string")
    got = url_rules.judge_urls(pages)
    assert got.columns == ["page_id", "url", "host", "path", "rule", "verdict"]
    assert bag(got.drop("url").collect()) == bag((r[0], *r[2:]) for r in rows)
    assert url_rules.judge_urls(pages.limit(0)).count() == 0


def test_rules_without_whole_tokens_and_by_shuffled_join(spark, monkeypatch):
    monkeypatch.setattr(url_rules, "BROADCAST_RULES", 0)
    pages = spark.createDataFrame([(i, u[0]) for i, u in enumerate(URLS)], "page_id bigint, url string")
    got = url_rules.judge_urls(pages, pattern_rules=[*url_rules.PATTERN_RULES, ("*vil*", "block")])
    want = {i: "block" if "evil" in (u[0] or "") else u[4] for i, u in enumerate(URLS)}
    assert {r["page_id"]: r["verdict"] for r in got.collect()} == want


# Nearest neighbours


def test_nearest_awkward(spark):
    r = np.random.default_rng(5)
    rows = [(i, r.standard_normal(12).tolist()) for i in range(60)]
    rows += [(100 + i, [1.0] * 12) for i in range(15)] + [(200, None), (300, [0.0] * 12), (400, [float("nan")] * 12), (500, [float("inf")] + [1.0] * 11)]
    rows += [(600, [1.0, 2.0]), (700, [1.0, None] + [0.0] * 10), (800, []), (None, [1.0] * 12), (7, rows[7][1]), (900, [2.0] * 12), (901, [4.0] * 12)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = [(*t[:3], round(t[3], 9)) for t in one_bit_codes.nearest(table, F.col("vec_id") % 100 == 0).collect()]
    assert sorted(got) == sorted(brute.nearest(rows, lambda i: i % 100 == 0))
    few = [(0, [1.0, 0.0]), (100, [0.0, 1.0]), (3, [2.0, 0.0])]
    table = spark.createDataFrame(few, "vec_id bigint, embedding array<float>")
    assert bag(t[:3] for t in one_bit_codes.nearest(table, F.col("vec_id") % 100 == 0).collect()) == [(0, 1, 3), (0, 2, 100), (100, 1, 0), (100, 2, 3)]
    assert one_bit_codes.nearest(table.limit(0), F.lit(True)).count() == 0


def test_recall_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(one_bit_codes, "ROWS", 150)
    monkeypatch.setattr(one_bit_codes, "QUERIES_PER_BLOCK", 2)
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()]
    want = {(q, i) for q, _, i, _ in brute.nearest(rows, lambda i: i % 100 == 0)}
    got = {(r["query_id"], r["vec_id"]) for r in QUERIES["op2_one_bit_codes"](spark, SF).collect()}
    assert len(got) == len(want) and len(got & want) >= 0.9 * len(want)


# Language


def test_language_is_held_out(spark):
    got = QUERIES["op7_language_ftrl"](spark, "/root/testdata/sf0.01")
    truth = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    held = got.where("held_out").join(truth, "doc_id").select((F.col("lang") == F.col("lang_pred")).cast("int").alias("ok"), "score").toPandas()
    assert got.count() == truth.count() and len(held) > 200
    assert held["ok"].mean() > 0.97 and held["score"].between(0, 1).all()


def test_language_of_odd_texts(spark):
    learn = spark.createDataFrame([(i, "the cat and the dog " * 3, "en") for i in range(8)] + [(i, "der hund und die katze " * 3, "de") for i in range(8, 16)] + [(99, None, "en"), (98, "x", None)], "doc_id bigint, text string, lang string")
    docs = spark.createDataFrame([(1, None, 5.0), (2, "", None), (3, "12 34 !?", None), (4, "the dog", None), (4, "the dog", None), (5, "die katze " * 50_000, None), (None, "Ⅷ 漢", None)], "doc_id bigint, text string, score double")
    got = language_ftrl.identify(docs, learn).collect()
    named = [(r["doc_id"], r["lang_pred"]) for r in got]
    assert named[:6] == [(1, "und"), (2, "und"), (3, "und"), (4, "en"), (4, "en"), (5, "de")] and named[6][1] in ("en", "de")
    assert all(0 <= r["score"] <= 1 for r in got)
    assert [r["lang_pred"] for r in language_ftrl.identify(docs, learn.limit(0)).collect()] == ["und"] * 7
    assert language_ftrl.identify(docs.limit(0), learn).count() == 0


def test_rare_languages_are_learned(spark):
    """A language of 6 documents beside one of 3,000, and more languages than were once learned, from a sample of 200."""
    common = [(i, "the cat and the dog " * 3, "en") for i in range(3000)]
    rare = [(5000 + i, "egy kutya meg egy macska " * 3, "hu") for i in range(6)]
    learn = spark.createDataFrame(common + rare, "doc_id bigint, text string, lang string")
    docs = spark.createDataFrame([(1, "egy macska meg kutya"), (2, "the dog and cat")], "doc_id bigint, text string")
    got = language_ftrl.identify(docs, learn, 200).collect()
    assert [(r["doc_id"], r["lang_pred"]) for r in got] == [(1, "hu"), (2, "en")]
    many = spark.createDataFrame([(8 * i + k, chr(0x4E00 + i) * 5, f"x{i:03}") for i in range(250) for k in range(6)], "doc_id bigint, text string, lang string")
    model = language_ftrl.train(many, 200)
    assert model.languages == [f"x{i:03}" for i in range(250)]


def test_temperature_calibrates():
    r = np.random.default_rng(3)
    true = r.standard_normal((4000, 3))
    y = np.array([r.choice(3, p=language_ftrl.softmax(s)) for s in true])
    assert language_ftrl.temperature_of(5 * true, y) == pytest.approx(5, rel=0.1)


def test_long_texts_count_alike(monkeypatch):
    text = "Wörter, die zählen! " * 500
    whole = language_ftrl.counts(text)
    monkeypatch.setattr(language_ftrl, "CHUNK", 64)
    assert (language_ftrl.counts(text) == whole).all() and whole.sum() > 0


# Toxicity


def test_thresholds_share_weights():
    """Grades from three kinds of features: the score orders them, the thresholds stay in order."""
    r = np.random.default_rng(2)
    rows = [np.unique(np.r_[r.integers(0, 500, 20), r.choice([700, 701, 702, 703], k, replace=False) if k else []]).astype(np.int64) for k in (0, 0, 0, 1, 4) for _ in range(80)]
    toxic = np.array([0] * 240 + [1] * 160)
    model = ordinal_toxicity.fit(rows, toxic)
    score = np.array([model.weights[x].sum() for x in rows])
    assert model.thresholds[0] < model.thresholds[1]
    assert ((model.grades(score)[:, 0] >= 0.5) == (toxic == 1)).all()
    assert score[320:].mean() > score[240:320].mean() > score[:240].mean()


def test_toxicity_is_held_out(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    model = ordinal_toxicity.train(docs, labels.where("doc_id % 4 > 0"))
    held = labels.where("doc_id % 4 = 0").join(docs, "doc_id").select("toxic", "text").toPandas()
    memo: dict = {}
    score = np.array([model.weights[ordinal_toxicity.text_features(t, memo)].sum() for t in held["text"]])
    said, true = model.grades(score)[:, 0] >= 0.5, held["toxic"].to_numpy() == 1
    assert (said & true).sum() / true.sum() > 0.7 and (said & ~true).sum() / (~true).sum() < 0.01


def test_toxicity_of_odd_rows(spark):
    labelled = [(i, "you awful person" if i % 2 else "what a fine day") for i in range(40)]
    docs = spark.createDataFrame([*labelled, (90, None), (91, ""), (None, "awful awful"), (1, "you awful person"), (92, "fine " * 100_000)], "doc_id bigint, text string")
    docs = docs.withColumn("grade", F.lit("old"))
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(40)] + [(None, 1, 1), (0, 1, None), (5000, 0, 1), (2, 0, 7)], "doc_id bigint, quality int, toxic int")
    got = ordinal_toxicity.judge(docs, labels)
    assert got.columns == ["doc_id", "text", "grade", "severity", "p_toxic", "toxic"]
    assert {r["doc_id"] for r in got.where("toxic").collect()} == {*range(1, 40, 2), None}
    assert got.where("severity < 0 OR severity > 2 OR p_toxic IS NULL").count() == 0 and got.count() == 45
    assert ordinal_toxicity.judge(docs, labels.limit(0)).where("toxic").count() == 0
    assert ordinal_toxicity.judge(docs.limit(0), labels).count() == 0


def test_samples_hold_one_row_of_each_id(spark, monkeypatch):
    """Repeated rows of an id don't reach the driver, and labels without a document take no place in the sample."""
    seen = {}
    monkeypatch.setattr(ordinal_toxicity, "fit", lambda features, toxic: seen.update(toxic=len(toxic)))
    monkeypatch.setattr(language_ftrl, "fit", lambda found, languages, idf: seen.update(lang=len(languages)))
    rows = [(i, "you awful person" if i % 2 else "what a fine day", "en") for i in range(40)] + [(1, "you awful person", "en")] * 300 + [(1, "another text", "en")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(4)
    labels = spark.createDataFrame([(i, i % 2) for i in range(2000)], "doc_id bigint, toxic int")
    ordinal_toxicity.train(docs, labels, 40)
    language_ftrl.train(docs, 40)
    assert seen == {"toxic": 40, "lang": 40}


# The pipeline


def test_pipeline_stages(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line dedup", "simhash near-dedup", "benchmark decontamination", "mixing to target weights"]
    clean = ordinal_toxicity.stage(spark, docs, sf)
    assert clean.columns == docs.columns
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    kept = clean.join(labels, "doc_id").groupBy("toxic").count().collect()
    n = {r["toxic"]: r["count"] for r in kept}
    assert n[0] == labels.where("toxic = 0").join(docs, "doc_id").count() and n.get(1, 0) <= 8

    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    lines = line_runs.stage(spark, docs, sf)
    assert lines.columns == docs.columns
    assert bag(lines.select("doc_id", F.sha2("text", 256)).collect()) == bag((d, h) for d, _, _, h in brute.line_dedup(rows))
    assert lines.where("n_chars <> length(text)").count() == 0
    single = simhash_trees.stage(spark, docs, sf)
    assert bag(single.select("doc_id").collect()) == bag({(c,) for _, _, c in brute.near_duplicates(rows)})
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    fresh = winnowing.stage(spark, docs, sf)
    assert bag(fresh.select("doc_id").collect()) == bag((r[0],) for r in brute.contamination(rows, items) if not r[-1])


def test_pipeline_is_its_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, SF)
        assert number == 4 or docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    got = corpus_pipeline.run(spark, SF)
    assert bag(got.collect()) == bag(docs.collect()) and got.count() > 0


def test_stages_leave_other_columns_alone(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").selectExpr("*", "doc_id AS toxic", "doc_id AS n_lines", "doc_id AS tag", "doc_id AS items", "doc_id AS fp")
    for _, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        assert out.where("toxic <> doc_id OR n_lines <> doc_id OR tag <> doc_id OR items <> doc_id OR fp <> doc_id").count() == 0


def test_stages_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    path = f"{scratch(spark)}/empty"
    docs.write.parquet(path)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, spark.read.parquet(path), SF).count() == 0
