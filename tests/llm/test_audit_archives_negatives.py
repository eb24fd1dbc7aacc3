"""Filter audit, archives and hard negatives against brute force, with every awkward input, and archives with damage."""

import gzip
import hashlib
import random
import re
import zlib
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from viewloom.llm import filter_audit, hard_negatives, warc_salvage
from viewloom.llm.common import scratch


def bag(rows):
    return sorted((tuple(r) for r in rows), key=repr)


# Filter audit


def fails(text, copies):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    upper = len(re.findall("[A-Z]", text))
    return {
        "A": len(words) < 100,
        "B": 100 * len(set(words)) < 80 * len(words),
        "C": 100 * upper > 10 * len(text),
        "D": re.search(r"[#$%&*|]", text) is not None,
        "E": copies,
    }


def audited(docs, labels):
    least = {}
    for doc, text, _ in docs:
        if doc is not None:
            least[text or ""] = min(least.get(text or "", doc), doc)
    judged = [(part or "", fails(text or "", doc is not None and doc > least[text or ""]), doc) for doc, text, part in docs]
    good = {d for d, q, _ in labels if d is not None and q == 1}
    toxic = {d for d, _, t in labels if d is not None and t == 1}
    out = {}
    for part in {p for p, _, _ in judged}:
        own = [(f, d) for p, f, d in judged if p == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            for step, name in enumerate(order):
                gone = lambda f, before=order[:step]: any(f[b] for b in before)
                here = [(f, d) for f, d in own if not gone(f) and f[name]]
                row = [sum(not gone(f) and not f[name] for f, _ in own), len(here), sum(gone(f) and f[name] for f, _ in own)]
                row += [sum(f[name] and sum(f.values()) == 1 for f, _ in own), sum(d in good for _, d in here), sum(d in toxic for _, d in here)]
                out[part, "".join(order), step + 1] = row
                shapley[name] += len(here)
        for order in permutations("ABCDE"):
            for step, name in enumerate(order, 1):
                out[part, "".join(order), step].append(shapley[name])
    return {(*k, k[1][k[2] - 1], *v) for k, v in out.items()}


def test_audit(spark):
    r = random.Random(4)
    docs = []
    for i in range(150):
        n = r.choice([3, 99, 100, 101, 150])
        words = [f"w{j}" for j in range(n)] if r.random() < 0.6 else [r.choice("abc") for _ in range(n)]
        text = r.choice([" ", "\t", "\x0b \r\n"]).join(words)
        text = text.upper() if r.random() < 0.3 else text
        docs.append((i, text + r.choice(["", "", " #", " 5%|", "\n"]), r.choice(["en", "de", None, ""])))
    docs += [(200 + i, docs[i][1], r.choice(["en", "de"])) for i in range(60)] + [docs[3], docs[3], (3, docs[4][1], "de")]
    docs += [(300, None, "en"), (301, "", None), (302, " \t\n", "fr"), (303, "Wort É " * 40_000, "de"), (304, "A" * 10 + "é" * 90, "de"), (305, "A" * 10 + "é" * 89, "de")]
    docs += [(None, docs[0][1], "en"), (None, docs[0][1], "en"), (None, None, None), (306, "a b " * 60, "en")]
    labels = [(i, r.choice([0, 1, None]), r.choice([0, 1, None])) for i in range(0, 320, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1), (9999, 1, 1)]
    table = spark.createDataFrame([(*d, "k", 7) for d in docs], "doc_id bigint, text string, lang string, key string, n int").repartition(3)
    marks = spark.createDataFrame([(*x, "p") for x in labels], "doc_id bigint, quality int, toxic int, part string")
    got = filter_audit.audit(table, marks)
    assert got.columns[:4] == ["part", "filter_order", "step", "filter"]
    assert {tuple(x) for x in got.collect()} == audited(docs, labels)
    assert got.count() == 600 * 4
    assert {tuple(x) for x in filter_audit.audit(table, marks.limit(0)).collect()} == audited(docs, [])
    assert filter_audit.audit(table.limit(0), marks).count() == 0


# Archives


def page(i: int, n: int) -> str:
    return f"<p>page {i} é</p>" + "".join(random.Random(i).choices("abc <>\r\n", k=n))


@pytest.mark.parametrize("compressed", [True, False])
def test_archives_round_trip(spark, compressed):
    rows = [(i, f"https://a.org/{i} ü\r\n%20?", page(i % 7, 1500)) for i in range(30)] + [(100 + i, "u", "short") for i in range(3)]
    rows += [(200, None, None), (201, "", ""), (202, "x" * 70_000, "WARC/1.1\r\nWARC-Type: response\r\n\r\n" * 60), (None, "u", page(1, 1500)), (None, None, None)]
    rows += [rows[0], rows[0], rows[29], (203, "big", "z" * 3_000_000), (204, "edge", "e" * 1000), (205, "edge", "e" * 1000), (206, "edge", "e" * 999), (207, "edge", "e" * 999)]
    pages = spark.createDataFrame([(*r, "t", 1) for r in rows], "page_id bigint, url string, html string, tag string, n int").repartition(4)
    folder = f"{scratch(spark)}/archives"
    warc_salvage.write_archives(pages, folder, compressed, archive_bytes=20_000)
    found = warc_salvage.read_archives(spark, folder)
    assert found.where("fault IS NOT NULL").count() == 0 and found.select("path").distinct().count() > 4
    last = {}
    for i, _, html in rows:
        if i is not None and len((html or "").encode()) >= 1000:
            last[html] = max(last.get(html, i), i)
    want = []
    for i, _, html in rows:
        data = (html or "").encode()
        of = last.get(html) if i is not None and last.get(html, i) > i else None
        want.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if of else "response", of))
    got = found.select(warc_salvage.page_of("record_id"), "payload_bytes", "payload_digest", "record_type", warc_salvage.page_of("refers_to"))
    assert bag(got.collect()) == bag(want)
    assert found.where("record_type = 'response' AND sha1(payload) <> payload_digest").count() == 0
    empty = f"{scratch(spark)}/archives"
    warc_salvage.write_archives(pages.limit(0), empty, compressed)
    assert warc_salvage.read_archives(spark, empty).count() == 0


def archive(compressed: bool, n: int = 12) -> tuple[bytes, list[tuple[int, int]]]:
    content, places = b"", []
    for i in range(n):
        data = page(i, 400).encode() + (b"WARC/1.1\r\nfake\r\n\r\n" if i % 3 == 0 else b"")
        record = warc_salvage.build(i, "u", data, hashlib.sha1(data).hexdigest(), i + 1 if i == 5 else None)
        record = warc_salvage.member(record) if compressed else record
        places.append((len(content), len(content) + len(record)))
        content += record
    return content, places


def read(content: bytes) -> tuple[list[str], list[tuple[int, int]]]:
    """Record ids, and gaps as (start, end); everything found covers the archive without overlaps."""
    found, at = list(warc_salvage.salvage(content)), 0
    for offset, length, _, _ in found:
        assert offset in (at, offset) and length > 0
        at = offset + length
    return [r.headers["warc-record-id"] for _, _, r, _ in found if r], [(o, o + n) for o, n, r, _ in found if r is None]


@pytest.mark.parametrize("compressed", [True, False])
def test_salvage(compressed):
    whole, places = archive(compressed)
    ids = [f"<urn:page:{i}>" for i in range(12)]
    assert read(whole) == (ids, [])
    assert read(b"") == ([], []) and read(b"nothing here") == ([], [(0, 12)])
    for k in (0, 4, 5, 11):
        start, end = places[k]
        middle = end - 12
        flipped = whole[:middle] + bytes([whole[middle] ^ 1]) + whole[middle + 1 :]
        assert read(flipped) == (ids[:k] + ids[k + 1 :], [(start, end)])  # one bit
        cut = whole[:middle] + whole[end:]
        assert read(cut) == (ids[:k] + ids[k + 1 :], [(start, middle)])  # torn off
        stray = whole[:start] + b"\x1f\x8b\x08 stray WARC/1.1\r\n" + whole[start:]
        assert read(stray) == (ids, [(start, start + len(stray) - len(whole))])
    assert read(whole[: places[7][0] + 9]) == (ids[:7], [(places[7][0], places[7][0] + 9)])
    lost = whole[places[2][0] + 3 : places[9][1]] + whole[places[11][0] :]
    assert read(lost) == (ids[3:10] + ids[11:], [(0, places[2][1] - places[2][0] - 3)])
    for seed in range(20):  # any damage: no crash, and records that it doesn't touch are found
        r = random.Random(seed)
        hurt = bytearray(whole)
        at = {r.randrange(len(hurt)) for _ in range(4)}
        for i in at:
            hurt[i] = r.randrange(256)
        got, _ = read(bytes(hurt))
        assert {i for i, (s, e) in zip(ids, places, strict=True) if not any(s <= x < e for x in at)} <= set(got)
        assert not compressed or set(got) <= set(ids)  # plain headers have no checksum


def test_salvage_of_other_writers():
    whole, _ = archive(False)
    old = whole.replace(b"WARC/1.1\r\nWARC-Type", b"WARC/1.0\r\nWARC-Type")
    assert len(read(old)[0]) == 12
    assert read(gzip.compress(old)) == (read(old)[0], [])  # one member for all
    info = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:x>\r\nX: folded\r\n  on\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    assert read(info + whole)[0][0] == "<urn:x>"
    assert warc_salvage.unlabelled("md5:abc") is None and warc_salvage.unlabelled("sha1:" + "Ab" * 20) == "ab" * 20
    assert zlib.decompress(warc_salvage.member(b"x" * (1 << 24))[:-20], 31) == b"x" * (1 << 24)
    assert warc_salvage.member(b"x" * (1 << 24))[-1] == 0


# Hard negatives


def mined(rows, asks, low=80, high=100, positives=5, negatives=5):
    good = set()
    for i, v, label in rows:
        if i is not None and label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            good.add((i, label, tuple(int(np.floor(256 * float(x))) for x in v)))
    sizes = [len(v) for _, _, v in good]
    size = max(set(sizes), key=lambda s: (sizes.count(s), s)) if sizes else 0
    good = [g for g in good if len(g[2]) == size]
    out = []
    for a, label, v in good:
        if not asks(a):
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w, strict=True)), i, m == label) for i, m, w in good if i != a or m != label)
        for score, p in [(-s, i) for s, i, same in scored if same][:positives]:
            found = [(-s, i) for s, i, same in scored if not same and low * score <= 100 * -s <= high * score][:negatives]
            out += [(a, p, r, i, score, s) for r, (s, i) in enumerate(found, 1)]
    return out


def vectors(spark, rows, kind="double"):
    return spark.createDataFrame([(*r, "k", 1) for r in rows], f"vec_id bigint, embedding array<{kind}>, label int, key string, block int").repartition(3)


@pytest.mark.parametrize("block", [7, 2048])
def test_hard_negatives(spark, monkeypatch, block):
    monkeypatch.setattr(hard_negatives, "ROWS", block)
    monkeypatch.setattr(hard_negatives, "FIRST_DEPTH", 2)
    r = np.random.default_rng(7)
    centres = r.standard_normal((4, 6))
    rows = [(i, (centres[i % 4] + 0.8 * r.standard_normal(6)).tolist(), int(r.integers(0, 3))) for i in range(120)]
    rows += [(200 + i, [1.0, 1.0, 0.0, 0.0, 0.0, -1.0], i % 2) for i in range(30)]  # ties
    rows += [(300, None, 1), (301, [float("nan")] * 6, 1), (302, [float("inf")] + [0.0] * 5, 1), (303, [None] + [0.0] * 5, 1), (304, [0.0] * 6, 1), (305, [1.0], 1), (306, [], 0)]
    rows += [(307, [1.0] * 6, None), (None, [1.0] * 6, 1), rows[10], rows[10], (10, [0.5] * 6, 2), (11, rows[11][1], 2)]
    asks = lambda i: i % 10 == 0
    got = hard_negatives.mine(vectors(spark, rows), F.col("vec_id") % 10 == 0)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert bag(got.collect()) == bag(mined(rows, asks))
    got = hard_negatives.mine(vectors(spark, rows), F.col("vec_id") % 10 == 0, 2, 3, 50, 120)
    assert bag(got.collect()) == bag(mined(rows, asks, 50, 120, 2, 3))


def test_few_and_no_vectors(spark):
    rows = [(0, [1.0, 0.5], 1), (1, [1.0, 0.5], 1), (2, [1.0, 0.25], 2)]
    assert bag(hard_negatives.mine(vectors(spark, rows, "float"), F.lit(True)).collect()) == bag(mined(rows, lambda i: True)) != []
    assert hard_negatives.mine(vectors(spark, rows).limit(0), F.lit(True)).count() == 0
    assert hard_negatives.mine(vectors(spark, rows), F.lit(None).cast("boolean")).count() == 0
    large = [(i, [1e6 * (i + 1), 3.0], i % 2) for i in range(6)]
    assert bag(hard_negatives.mine(vectors(spark, large), F.lit(True)).collect()) == bag(mined(large, lambda i: True))
    assert [hard_negatives.number_type(x, 64) for x in (256, 1 << 20, 1 << 25)] == [np.float32, np.float64, np.int64]
    with pytest.raises(ValueError):
        hard_negatives.number_type(1 << 32, 64)


def test_lists_are_not_read_to_their_ends():
    """Where a few rows lead, the threshold falls below the kth score long before all rows have been met."""
    r = np.random.default_rng(1)
    vectors = np.r_[r.integers(900, 1000, (10, 2)), r.integers(-100, 100, (5000, 2))]
    held = pa.table({"vec_id": np.arange(5010), "label": np.ones(5010, dtype=np.int64), "key": np.arange(5010), "vector": list(vectors)})
    lists = hard_negatives.Lists(held, 2)
    met = []
    eligible = np.ones((1, 5010), dtype=bool)
    real = np.einsum
    try:
        np.einsum = lambda *a: met.append(len(a[1])) or real(*a)
        found = hard_negatives.threshold_search(lists, np.array([[1, 2]]), np.array([[[-(10**9), 10**9]]]), eligible, 5)
    finally:
        np.einsum = real
    scores = vectors @ [1, 2]
    assert sorted(found[0][3]) == sorted(scores)[-5:] and sum(met) < 200
