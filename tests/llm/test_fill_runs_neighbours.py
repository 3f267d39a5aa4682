"""Operators 11 to 13 against brute force on hard cases and on the driver's smallest tables."""

from __future__ import annotations

import hashlib
import os
import random
import re
import zlib
from math import inf, nan

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from routeflow.llm import ann_scan, catalog, fill_in_middle, periodic_runs
from routeflow.llm.oracle import ORACLE
from routeflow.llm.shingles import WordHashes

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")
WORD = re.compile(r"[^\x20\x09-\x0D]+")

TEXTS = [
    (1, None), (2, ""), (3, " "), (4, "a"), (5, "hello, wörld 漢字 1234"), (6, "has <P> inside"), (7, "a<S>"), (8, "<M"), (9, "P><<S <<"),
    (10, "line\nline\r\n\ttab"), (11, "É" * 3000 + "x" * 3000), (12, "same"), (12, "same"), (None, "no id"), (13, "x" * 100_000), (14, "a b " * 20_000),
    (15, "\U0001f600 emoji \u0000 nul"), (16, "\\1 back \\Q slash \\E"),
] + [(100 + k, "Some words, with marks; number %d!" % k) for k in range(60)]


def _fim(i, text, seed="1"):
    text = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    n, x = len(units), hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    h = [int(x[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    if h[3] % 100 < 20:
        return n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


def test_fill_in_middle(spark, monkeypatch):
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in TEXTS], "doc_id long, text string, form string, h1 int")
    out = fill_in_middle.rewrite(df)
    assert out.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    key = lambda r: tuple(str(x) for x in r)
    got = out.withColumn("back", fill_in_middle.restored(F.col("output"), F.col("form"))).collect()
    assert sorted([tuple(r) for r in got], key=key) == sorted([(i, *_fim(i, t), t or "") for i, t in TEXTS], key=key)
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}
    assert fill_in_middle.rewrite(df.where("false")).count() == 0
    clash = fill_in_middle.rewrite(df.withColumnRenamed("form", "z").withColumnRenamed("doc_id", "form"), id_col="form")
    assert clash.columns == ["form", "n", "form_", "prefix_chars", "middle_chars", "output"] and clash.count() == len(TEXTS)


def test_fill_in_middle_in_small_slices(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(fill_in_middle, "SLICE_BYTES", 10)
    batch = pa.RecordBatch.from_arrays([pa.array(range(4)), pa.array(["x" * 25, None, "ab", "c" * 9])], ["k", "t"])
    parts = list(fill_in_middle._slices(batch))
    assert [x for p in parts for x in p.column(0).to_pylist()] == [0, 1, 2, 3] and len(parts) > 1


@needs_data
def test_fill_in_middle_query_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    df = catalog.op11_fill_in_middle(spark, SF)
    want = con.execute(f"SELECT {', '.join(df.columns)} FROM ({ORACLE['op11_fill_in_middle']})").fetchall()
    assert sorted(tuple(r) for r in df.collect()) == sorted(want)


# --- 12 ---------------------------------------------------------------------------------------------------------------


def _lyndon(codes):
    out = []
    for i in range(len(codes)):
        j = i + 1
        while j < len(codes) and codes[j:] > codes[i:]:
            j += 1
        out.append(j - i)
    return out


def _runs(words, least=6, times=4):
    n, out = len(words), []
    for q in range(1, n // times + 1):
        s = 0
        while s + q < n:
            e = s
            while e + q < n and words[e] == words[e + q]:
                e += 1
            length = e - s + q
            if length >= max(least, times * q):
                smaller = any(all(words[x] == words[x + r] for x in range(s, s + length - r)) for r in range(1, q))
                if not smaller:
                    out.append((s, length, q))
            s = max(e, s + 1) if e > s else s + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def _random_words(rng):
    out = []
    while len(out) < rng.choice([0, 3, 8, 30, 60]):
        unit = [rng.choice("abc") for _ in range(rng.choice([1, 1, 2, 3, 5]))]
        out += unit * rng.choice([1, 1, 2, 4, 5, 7]) + unit[: rng.randrange(3)]
    return out


def test_lyndon_lengths_match_their_definition():
    rng = random.Random(3)
    for _ in range(400):
        words = _random_words(rng)
        rank = {w: k for k, w in enumerate(sorted(set(words)))}
        codes = [rank[w] for w in words]
        assert periodic_runs.lyndon_lengths(codes) == _lyndon(codes)
        back = [len(rank) - 1 - c for c in codes]
        assert periodic_runs.lyndon_lengths(back) == _lyndon(back)


def test_runs_match_brute_force():
    rng, hashes = random.Random(4), WordHashes()
    for least, times in ((6, 4), (1, 3), (5, 3), (12, 4), (3, 6)):
        some = 0
        for _ in range(300):
            words = _random_words(rng)
            want = _runs(words, least, times)
            assert periodic_runs.find_runs(words, hashes, least, times) == want, (words, least, times)
            some += bool(want)
        assert some > 20


def test_runs_of_long_and_uniform_texts():
    hashes = WordHashes()
    assert periodic_runs.find_runs(["x"] * 200_000, hashes) == [(0, 200_000, 1)]
    body = [f"w{k}" for k in range(30_000)]
    assert periodic_runs.find_runs(body, hashes) == []
    assert periodic_runs.find_runs(body + body * 3 + body[:10], hashes) == [(0, 120_010, 30_000)]
    assert periodic_runs.find_runs(body * 3, hashes) == []


def _planted(i, words):
    h = zlib.crc32(str(i).encode())
    n, g = len(words), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if k < a else words[a + (k - a) % p] for k, w in enumerate(words)]
    return words


def _expected(i, text):
    words = _planted(i, WORD.findall(text or ""))
    runs = _runs(words)
    gone = {x for s, n, q in runs for x in range(s + q, s + n)}
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2])) if runs else (None,) * 3
    digest = hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
    kept = " ".join(w for k, w in enumerate(words) if k not in gone)
    milli = 1000 * best[1] // best[2] if runs else None
    return (i, len(runs), *best, milli, digest, hashlib.sha256(kept.encode()).hexdigest())


@needs_data
def test_periodic_runs_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = {r["doc_id"]: tuple(r) for r in catalog.op12_periodic_runs(spark, SF).collect()}
    assert len(got) == len(docs)
    small = [(i, t) for i, t in docs if len(t or "") < 6000]
    assert len(small) > 150
    for i, t in small:
        assert got[i] == _expected(i, t)
    assert sum(1 for r in got.values() if r[1]) > 5


def test_collapse_runs_edges(spark):
    rows = [(1, None), (2, ""), (3, " \t"), (4, "a a a a a a"), (5, "a a a a a"), (6, "x a b a b a b a b y"), (6, "x a b a b a b a b y"), (None, "q q q q q q q")]
    df = spark.createDataFrame([(i, t, "mine") for i, t in rows], "doc_id long, text string, runs string")
    out = periodic_runs.collapse_runs(df)
    assert out.columns == ["doc_id", "n_words", "runs", "collapsed_text"]
    got = sorted(((r["doc_id"] or 0, r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed_text"]) for r in out.collect()), key=str)
    ab = (6, 10, [(1, 8, 2)], "x a b y")
    assert got == [(0, 7, [(0, 7, 1)], "q"), (1, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""), (4, 6, [(0, 6, 1)], "a"), (5, 5, [], "a a a a a"), ab, ab]
    assert periodic_runs.collapse_runs(df.where("false")).count() == 0
    clash = periodic_runs.collapse_runs(df.drop("runs").withColumnRenamed("doc_id", "runs"), id_col="runs")
    assert clash.columns == ["runs", "n_words", "runs_", "collapsed_text"] and clash.count() == len(rows)


# --- 13 ---------------------------------------------------------------------------------------------------------------


def _score(a, b):
    total = 0.0
    for x, y in zip(a, b, strict=True):
        total += float(x) * float(y)
    return total


def _exact(rows, queries, k):
    out = {}
    for q, v in queries:
        scored = sorted(((-_score(v, w), i) for i, w in rows if i != q))[:k]
        out[q] = [(i, -s) for s, i in scored]
    return out


def _by_query(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r[0], r[1])):
        out.setdefault(r[0], []).append((r[1], r[2], r[3]))
    return out


def test_neighbours_of_hard_rows(spark):
    v = [1.0, 2.0, -1.0]
    rows = [(20, v), (40, [2.0, 4.0, -2.0]), (1, v), (2, v), (3, [0.0, 0.0, 0.0]), (4, None), (5, [1.0, None, 2.0]), (6, [1.0, nan, 0.0]), (7, [inf, 0.0, 0.0]),
            (8, [1.0, 2.0]), (9, [-1.0, 0.5, 0.25]), (9, [-1.0, 0.5, 0.25]), (60, [0.0, 0.0, 0.0]), (None, v), (100, [1.0, 1.0, 1.0]), (100, [0.5, 1.0, 1.0])]
    df = spark.createDataFrame([(i, x, "mine", 0) for i, x in rows], "vec_id long, embedding array<double>, rank string, tile int")
    got = _by_query(ann_scan.search(df, F.col("vec_id") % 20 == 0, k=20))
    real = [(i, x) for i, x in rows if i is not None and x is not None and len(x) == 3 and all(y is not None and np.isfinite(y) for y in x) and any(x)]
    asked = [(20, v), (40, [2.0, 4.0, -2.0]), (100, [0.5, 1.0, 1.0])]
    want = _exact(real, asked, 20)
    assert {q: [(i, s) for _, i, s in r] for q, r in got.items()} == want
    assert all([rank for rank, _, _ in r] == list(range(1, len(r) + 1)) for r in got.values())
    few = _by_query(ann_scan.search(df, F.col("vec_id") % 20 == 0, k=2))
    assert {q: [(i, s) for _, i, s in r] for q, r in few.items()} == _exact(real, asked, 2)
    assert ann_scan.search(df.where("false"), F.col("vec_id") % 20 == 0).count() == 0
    assert ann_scan.search(df.where("vec_id = 4"), F.col("vec_id") % 20 == 0).count() == 0
    names = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.5, 0.5]), ("c", [0.9, 0.1])], "name string, v array<float>")
    assert [tuple(r) for r in ann_scan.search(names, F.col("name") == "a", k=1, id_col="name", vec_col="v").collect()][0][:3] == ("a", 1, "c")


def test_neighbours_with_a_hot_list_over_several_tiles(spark, monkeypatch):
    rng = np.random.default_rng(5)
    same = rng.standard_normal(16)
    vectors = [same.tolist()] * 300 + (rng.standard_normal((600, 16)) * rng.uniform(0.1, 3, (600, 1))).tolist()
    rows = list(enumerate(vectors))
    monkeypatch.setattr(ann_scan, "TILE_ROWS", 64)
    monkeypatch.setattr(ann_scan, "QUERY_ROWS", 8)
    monkeypatch.setattr(ann_scan, "CHUNK", 5)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = _by_query(ann_scan.search(df, F.col("vec_id") % 20 == 0, k=20))
    want = _exact(rows, [(i, v) for i, v in rows if i % 20 == 0], 20)
    assert got.keys() == want.keys() and all(len(r) == 20 for r in got.values())
    hit = sum(len({i for _, i, _ in got[q]} & {i for i, _ in want[q]}) for q in want) / (20 * len(want))
    assert hit >= 0.9
    for q in range(0, 300, 20):  # ties among 299 copies go to the smallest ids
        assert [(i, s) for _, i, s in got[q]][:5] == want[q][:5]


@needs_data
@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_neighbour_query_recall(spark, sf):
    path = f"/root/testdata/{sf}"
    pdf = spark.read.parquet(f"{path}/embeddings.parquet").toPandas().sort_values("vec_id")
    x, ids = np.stack(pdf["embedding"].tolist()).astype(np.float64), pdf["vec_id"].to_numpy()
    got = _by_query(catalog.op13_nearest_neighbours(spark, path))
    hit = total = 0
    for q, r in got.items():
        scores = x @ x[ids == q][0]
        scores[ids == q] = -np.inf
        best = ids[np.argsort(-scores, kind="stable")[:20]]
        hit += len(set(best.tolist()) & {i for _, i, _ in r})
        total += 20
        for _, i, s in r:
            assert s == _score(x[ids == q][0], x[ids == i][0])
        assert [rank for rank, _, _ in r] == list(range(1, 21)) and [(-s, i) for _, i, s in r] == sorted((-s, i) for _, i, s in r)
    assert len(got) == (ids % 20 == 0).sum() and hit / total >= 0.95


def test_beta_quantile():
    assert abs(ann_scan.beta_quantile(1, 1, 0.25) - 0.25) < 1e-4
    assert abs(ann_scan.beta_quantile(2, 2, 0.5) - 0.5) < 1e-4
    rng = np.random.default_rng(1)
    g = rng.standard_normal((200_000, 9)) ** 2
    share = g[:, :4].sum(1) / g.sum(1)
    assert abs((share <= ann_scan.beta_quantile(2, 2.5, 0.99)).mean() - 0.99) < 0.002
