"""Recall of the near-dedup stage, and work that stays in proportion to a bucket's members."""

import random

import numpy as np
import pytest

from viewloom.llm import near_copies


def words(r: random.Random, n: int) -> list[str]:
    return [f"w{r.randrange(100_000)}" for _ in range(n)]


def near(r: random.Random, text: list[str], changes: int) -> list[str]:
    """A copy with words changed, far enough apart that each costs five shingles."""
    copy = list(text)
    for at in r.sample(range(5, len(text) - 5, 11), changes):
        copy[at] = f"new{r.randrange(100_000)}"
    return copy


def true_pairs(sets: list[set]) -> list[tuple[int, int]]:
    found = []
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if 5 * min(len(a), len(b)) >= 4 * max(len(a), len(b)) and 5 * len(a & b) >= 4 * len(a | b):
                found.append((j, i))
    return found


def grouped(spark, texts: list[list[str]]) -> tuple[list[tuple[int, int]], list[int]]:
    """The pairs that are similar, and each text's root."""
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id bigint, text string").repartition(8)
    roots = {r["doc_id"]: r["root"] for r in near_copies.near_copies(docs).collect()}
    sets = [{tuple(t[i : i + 5]) for i in range(len(t) - 4)} for t in texts]
    return true_pairs(sets), [roots[i] for i in range(len(texts))]


def recall(pairs: list[tuple[int, int]], roots: list[int]) -> float:
    return sum(roots[a] == roots[b] for a, b in pairs) / len(pairs)


def test_recall_of_random_pairs(spark):
    r = random.Random(5)
    texts = []
    for _ in range(300):
        text = words(r, r.randint(160, 200))
        texts += [text, near(r, text, 3)]
    pairs, roots = grouped(spark, texts)
    assert len(pairs) >= 290 and recall(pairs, roots) >= 0.99
    assert len(set(roots)) >= 300  # and none are joined that aren't similar


def test_recall_within_a_template(spark, monkeypatch):
    """Texts of one template, 0.6 to 0.8 alike, fill buckets that stay apart; near copies among them are found all the same."""
    monkeypatch.setattr(near_copies, "SMALL", 8)
    r = random.Random(6)
    template = words(r, 140)
    texts = []
    for i in range(500):
        text = template + words(r, r.randint(24, 36))
        texts.append(text)
        if i % 4 == 0:
            texts.append(near(r, text, 3))
    pairs, roots = grouped(spark, texts)
    assert len(pairs) >= 110 and recall(pairs, roots) >= 0.99
    sizes = np.unique(roots, return_counts=True)[1]
    assert sizes.max() <= 4


@pytest.mark.parametrize("turn", [1, 2, 28])
def test_members_are_dealt_in_proportion(spark, turn):
    rows = np.arange(near_copies.MINIMA, dtype=np.uint16).tobytes()
    members = spark.createDataFrame([(1, i % near_copies.BANDS, i, 10, bytearray(rows)) for i in range(200)], "key bigint, band int, tag bigint, n bigint, rows binary")
    dealt = near_copies.dealt_anew(members, turn)
    assert dealt.count() == 200 * near_copies.FORESTS * turn
    found = dealt.where("band = 3").groupBy("key").count().collect()
    assert len(found) == near_copies.FORESTS * turn and len({r["count"] for r in found}) == 1


def test_buckets_of_the_same_members_are_compared_once(spark):
    rows = [(key, tag, 10) for key in (1, 2, 3) for tag in (5, 6, 7)] + [(4, 5, 10), (4, 6, 10), (5, 6, 10), (5, 8, 10), (5, 9, 10), (6, 5, 10), (6, 7, 10)]
    buckets = spark.createDataFrame(rows, "key bigint, tag bigint, n bigint")
    roots = spark.createDataFrame([(5, 5), (7, 5)], "node bigint, root bigint")
    keys = lambda met: sorted(r["key"] for r in near_copies.mixed(buckets, roots, met)["few"].select("key").distinct().collect())
    assert keys(False) == [1, 4, 5] and keys(True) == [1, 5]  # 6 holds one group only
    pairs = near_copies.of_few(near_copies.mixed(buckets, roots, True)["few"]).select("x.tag", "y.tag").collect()
    assert {tuple(sorted(p)) for p in pairs} == {(5, 6), (6, 7), (6, 8), (6, 9), (8, 9)}


def test_shingles_tell_order_and_length():
    known = near_copies.WordHashes()
    same = lambda a, b: set(near_copies.shingles(a, known).tolist()) == set(near_copies.shingles(b, known).tolist())
    assert same("A b  c\td e f", "a B c d e F") and not same("a b c d e", "a b c e d")
    assert not same("a b", "b a") and not same("a", "a a") and not same("a a a a", "a a a a a")
    assert len(near_copies.shingles(None, known)) == len(near_copies.shingles(" \n", known)) == 0
    assert len(near_copies.shingles("x " * 100, known)) == 96 and len(near_copies.shingles("É é Ö ß 字", known)) == 1
