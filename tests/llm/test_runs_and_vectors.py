"""Periodic runs, near copies of vectors and hard negatives against plain versions."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lakekit.llm import hard_negatives, queries, squares, vector_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# --- periodic runs -----------------------------------------------------------


def plain_runs(w, repeats=4, shortest=6):
    """Every stretch that keeps a period, for every period; of these the ones with a smallest period."""
    found = []
    for q in range(1, len(w) // repeats + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j - i + q >= max(shortest, repeats * q):
                found.append((i, j - i + q, q))
            i = j + 1
    inside = lambda r, s: s[2] < r[2] and r[2] % s[2] == 0 and s[0] <= r[0] and s[0] + s[1] >= r[0] + r[1]
    return sorted(r for r in found if not any(inside(r, s) for s in found))


def repetitive(draw):
    kinds = draw.choice([1, 2, 3, 6])
    w = [draw.randrange(kinds) for _ in range(draw.randint(0, 300))]
    for _ in range(draw.randint(0, 5)):
        if w:
            a, p = draw.randrange(len(w)), draw.randint(1, 50)
            unit = w[a : a + p]
            w = w[:a] + unit * draw.randint(2, 8) + unit[: draw.randint(0, len(unit))] + w[a:]
    for _ in range(draw.randint(0, 3)):
        if w:
            w[draw.randrange(len(w))] = 9
    return w[:1200]


@pytest.mark.parametrize("appended", [1 << 20, 211, 1])
def test_runs_are_found_however_words_are_appended(monkeypatch, appended):
    monkeypatch.setattr(squares, "APPENDED", appended)
    draw = random.Random(appended)
    for _ in range(2 if appended == 1 else 12):
        docs = [repetitive(draw) for _ in range(5)]
        owner, runs = squares.runs_of_texts(
            np.array(sum(docs, []), dtype=np.int64), np.array([len(d) for d in docs])
        )
        got = [[tuple(r) for r in runs[owner == i].tolist()] for i in range(len(docs))]
        assert got == [plain_runs(d) for d in docs]


def test_longer_runs_can_be_asked_for():
    docs = [repetitive(random.Random(i)) for i in range(20)]
    for d in docs:
        _, runs = squares.runs_of_texts(np.array(d, dtype=np.int64), np.array([len(d)]), repeats=6, shortest=20)
        assert [tuple(r) for r in runs.tolist()] == plain_runs(d, 6, 20)
    with pytest.raises(ValueError):
        squares.SquareCatchers(3, repeats=2)


def test_long_repetitive_streams():
    """Catchers within a run of a lower level are let go: else the first of these would hold a million chains."""
    same = np.zeros(300_000, dtype=np.int64)
    blocks = np.tile(np.append(np.ones(500, np.int64), 2), 400)
    long_period = np.tile(np.arange(40_000), 6)
    assert squares.runs_of_texts(same, np.array([len(same)]))[1].tolist() == [[0, 300_000, 1]]
    runs = squares.runs_of_texts(blocks, np.array([len(blocks)]))[1].tolist()
    assert len(runs) == 401 and [0, len(blocks), 501] in runs
    assert squares.runs_of_texts(long_period, np.array([240_000]))[1].tolist() == [[0, 240_000, 40_000]]


def plain_digest(doc_id, text):
    w = WORD.findall(text or "")
    n = len(w)
    if doc_id is not None:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(w)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None,) * 3)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    milli = None if not runs else 1000 * best[1] // best[2]
    kept = " ".join(x for i, x in enumerate(w) if i not in dropped)
    return (doc_id, len(runs), *best, milli, sha(lines), sha(kept))


def documents():
    draw = random.Random(8)
    texts = [" ".join(f"w{x}" for x in repetitive(draw)) for _ in range(30)]
    texts += [" ".join(draw.choice(["the", "The", "été", "中文", "a\x1cb"]) for _ in range(150)) for _ in range(10)]
    texts += [None, "", " \n\t ", "one", "ab\x0bab ab\tab\nab ab", "x " * 9_000, " ".join(str(i) for i in range(9_000))]
    rows = [(i, t, "x", 1) for i, t in enumerate(texts)]
    # Ids whose texts are made to repeat.
    hot = [i for i in range(100, 400) if zlib.crc32(str(i).encode()) % 10 == 0]
    rows += [(i, " ".join(str(draw.randrange(50)) for _ in range(draw.randint(1, 400))), "y", 2) for i in hot]
    rows += [(hot[0], None, "y", 2), (hot[1], "  ", "y", 2), (None, "a a a a a a b", "z", 3)]
    return [*rows, rows[3], rows[3]]


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_query_of_periodic_runs(spark, tmp_path):
    """Nulls, blanks, long texts, repeated rows, columns with the names of results."""
    rows = documents()
    schema = "doc_id long, text string, runs string, best int"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.all_queries()["op11_periodic_runs"](spark, str(tmp_path))
    assert got.columns == COLUMNS
    want = [plain_digest(r[0], r[1]) for r in rows]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    empty = spark.createDataFrame([], schema)
    assert squares.periodic_runs(empty).collect() == []


def test_collapsed_text_and_kept_columns(spark):
    docs = spark.createDataFrame([(1, "s", "x a b a b a b a b y"), (2, None, None)], "doc_id long, source string, text string")
    rows = squares.periodic_runs(docs, keep=["doc_id", "source"]).orderBy("doc_id").collect()
    assert rows[0]["collapsed"] == "x a b y" and tuple(rows[0]["best"]) == (1, 8, 2)
    assert [tuple(r) for r in rows[0]["runs"]] == [(1, 8, 2)]
    assert (rows[1]["collapsed"], rows[1]["best"], rows[1]["runs"], rows[1]["source"]) == ("", None, [], None)


def test_sliced_arrow_texts():
    texts = pa.array(["z z z z z z", "a b", None, "q q q q q q q"]).slice(1)
    runs, best, collapsed = squares.found_runs(texts)
    assert collapsed.to_pylist() == ["a b", "", "q"] and best.to_pylist()[2]["length"] == 7


# --- near copies of vectors --------------------------------------------------


def plain_copies(rows, cosine=0.95):
    fit = [i for i, (k, v) in enumerate(rows) if k is not None and sound(v) and any(v)]
    links = [0] * len(rows)
    names = [k for k, _ in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for x, i in enumerate(fit):
        for j in fit[x + 1 :]:
            u, v = np.array(rows[i][1], dtype=float), np.array(rows[j][1], dtype=float)
            if len(u) == len(v):
                u, v = u / np.abs(u).max(), v / np.abs(v).max()
                if (u * v).sum() / (np.sqrt((u * u).sum()) * np.sqrt((v * v).sum())) >= cosine:
                    links[i] += 1
                    links[j] += 1
                    parent[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    for i, name in enumerate(names):
        if name is not None:
            least[root(i)] = min(least.get(root(i), name), name)
    out = []
    for i, name in enumerate(names):
        component = None if name is None else least[root(i)]
        out.append((name, links[i], component, name is None or name == component))
    return sorted(out, key=str)


def sound(v):
    return v is not None and all(x is not None and np.isfinite(x) for x in v)


def noisy(draw, v, cosine):
    """A vector at about this cosine to ``v``."""
    e = draw.standard_normal(len(v))
    e -= v * (e @ v) / (v @ v)
    e *= np.linalg.norm(v) / np.linalg.norm(e)
    return cosine * v + np.sqrt(1 - cosine**2) * e


def vectors():
    draw = np.random.default_rng(4)
    base = draw.standard_normal((40, 24))
    rows = [*base, *(noisy(draw, b, 0.995) for b in base[:10]), *(noisy(draw, b, 0.90) for b in base[10:20])]
    rows += [noisy(draw, base[0], 0.993) for _ in range(150)] + [base[1]] * 60 + [3.5 * base[1]]
    # Further out than one centre reaches.
    rows += [noisy(draw, base[2], 0.965) for _ in range(12)]
    listed = [(1000 + 7 * i % 997, v.tolist()) for i, v in enumerate(rows)]
    listed += [(5, None), (6, []), (7, [0.0] * 24), (8, [None] * 24), (9, [float("nan")] * 24), (10, [float("inf")] * 24)]
    listed += [(11, base[0][:12].tolist()), (12, (base[3] * 1e300).tolist()), (13, (base[3] * 1e-300).tolist())]
    return [*listed, listed[4], (None, base[0].tolist())]


def test_near_copies(spark):
    rows = vectors()
    df = spark.createDataFrame([(*r, 0) for r in rows], "vec_id long, embedding array<double>, n_links int")
    got = vector_dedup.near_copies(df)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted(map(tuple, got.collect()), key=str) == plain_copies(rows)
    assert vector_dedup.near_copies(df.limit(0)).collect() == []


def test_recall_at_the_threshold(spark):
    """Pairs just above the bound, apart from each other, with the parameters of the query; no pair below it."""
    draw = np.random.default_rng(9)
    base = draw.standard_normal((4000, 32))
    pairs = [noisy(draw, b, 0.952) for b in base[:1000]] + [noisy(draw, b, 0.948) for b in base[1000:2000]]
    rows = [(i, v.tolist()) for i, v in enumerate([*base, *pairs])]
    got = vector_dedup.near_copies(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    linked = {r["vec_id"] for r in got.filter("n_links > 0").collect()}
    assert len(linked & set(range(1000))) >= 950
    assert not linked & set(range(1000, 2000))


def test_borders_between_tasks(spark, monkeypatch):
    """Many tasks with fewer rows than a pass has neighbours: windows reach across their borders."""
    monkeypatch.setattr(vector_dedup, "ROWS_A_PART", 60)
    draw = np.random.default_rng(2)
    base = draw.standard_normal((150, 16))
    rows = [(i, v.tolist()) for i, v in enumerate([*base, *(noisy(draw, b, 0.999) for b in base)])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(map(tuple, vector_dedup.near_copies(df, passes=3).collect()))
    assert got == plain_copies(rows) or got == sorted(plain_copies(rows))


def test_dense_groups_beyond_a_window(spark, monkeypatch):
    """Several centres in one component, and a chain from one to the next."""
    monkeypatch.setattr(vector_dedup, "LOOSE", 3)
    draw = np.random.default_rng(6)
    one = draw.standard_normal(20)
    two = noisy(draw, one, 0.955)
    three = noisy(draw, two, 0.955)
    rows = [(i, noisy(draw, [one, two, three][i % 3], 0.996).tolist()) for i in range(150)]
    got = vector_dedup.near_copies(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), window=8)
    assert sorted(map(tuple, got.collect()), key=str) == plain_copies(rows)


def test_number_of_passes_grows_with_the_table():
    counts = [vector_dedup.passes_for(n, 0.95) for n in (10, 500, 10_000, 10**9)]
    assert counts == sorted(counts) and counts[0] == 1 and counts[-1] < 100


# --- hard negatives ----------------------------------------------------------


def plain_negatives(rows, chosen, k=5):
    known = {}
    for name, label, v in rows:
        if name is not None and label is not None and v and sound(v) and all(abs(256 * x) <= 1 << 25 for x in v):
            whole = [int(np.floor(256 * float(x))) for x in v]
            known[name] = min(known.get(name, (label, whole)), (label, whole))
    out = []
    for anchor in sorted(n for n in known if chosen(n)):
        label, q = known[anchor]
        scored = sorted(
            (-sum(a * b for a, b in zip(q, v, strict=True)), n, la)
            for n, (la, v) in known.items()
            if n != anchor and len(v) == len(q)
        )
        for score, positive, _ in [s for s in scored if s[2] == label][:k]:
            inside = [s for s in scored if s[2] != label and -80 * score <= -100 * s[0] <= -100 * score][:k]
            out += [(anchor, positive, i + 1, n, -score, -s) for i, (s, n, _) in enumerate(inside)]
    return sorted(out)


def labelled():
    draw = random.Random(3)
    plain = lambda: [draw.gauss(0, 1) for _ in range(6)]
    rows = [(i, draw.choice([0, 0, 0, 1, 2]), plain()) for i in range(600)]
    tied = [round(x) / 4 for x in plain()]
    rows += [(700 + i, i % 3, tied) for i in range(40)]
    rows += [(800, 5, tied), (900, 6, plain()), (901, 6, plain()), (910, 7, [0.0] * 6), (920, 7, plain())]
    rows += [(1000, None, tied), (1010, 1, None), (1020, 1, []), (1030, 1, [None] * 6), (1040, 1, [float("nan")] * 6)]
    rows += [(1050, 1, [1e30] * 6), (1060, 1, [1.0, 2.0]), (1070, 1, [1.5, 2.0]), (1080, 2, [1.4, 2.0]), (None, 1, tied)]
    return [*rows, rows[0], rows[10], (20, 2, plain())]


def test_hard_negatives(spark):
    rows = labelled()
    schema = "vec_id long, label int, embedding array<double>, rank string, size string"
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], schema)
    got = hard_negatives.hard_negatives(df, F.col("vec_id") % 10 == 0)
    want = plain_negatives(rows, lambda n: n % 10 == 0)
    assert len(want) > 500 and sorted(map(tuple, got.collect())) == want
    assert hard_negatives.hard_negatives(df.limit(0), F.lit(True)).collect() == []
    assert hard_negatives.hard_negatives(df, F.lit(False)).collect() == []


def test_hard_negatives_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", 50)
    monkeypatch.setattr(hard_negatives, "BLOCK_ANCHORS", 7)
    rows = labelled()
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    got = hard_negatives.hard_negatives(df, F.col("vec_id") % 10 == 0)
    assert sorted(map(tuple, got.collect())) == plain_negatives(rows, lambda n: n % 10 == 0)


def test_index_leaves_out_what_the_bound_covers():
    draw = np.random.default_rng(1)
    x = draw.integers(-200, 200, (400, 12)) * (2 ** np.arange(12, 0, -1)) // 64
    q = x[:30]
    dims = np.argsort(-(x**2).sum(axis=0), kind="stable")
    index = hard_negatives.Index(x, dims)
    scores = q @ x.T
    for share in (0.2, 0.6, 0.9):
        bounds = np.floor(share * scores.max(axis=1)).astype(float)
        a, r, score = hard_negatives.reaching(index, q, bounds, dims, np.ones(scores.shape, dtype=bool))
        want = np.argwhere(scores >= bounds[:, None])
        assert sorted(zip(a.tolist(), r.tolist(), strict=True)) == sorted(map(tuple, want.tolist()))
        assert (score == scores[a, r]).all()
        _, kept = index.over(float(bounds.min()), float(np.sqrt((q**2).sum(axis=1)).max()))
        assert kept.min() < len(dims) and (np.diff(kept) <= 0).all()


def test_registered_queries_of_vectors(spark, tmp_path):
    draw = np.random.default_rng(12)
    rows = [(i, [float(np.float32(x)) for x in draw.standard_normal(8)], int(draw.integers(0, 10))) for i in range(900)]
    rows += [(900 + i, rows[i][1], rows[i][2]) for i in range(100)]
    schema = "vec_id long, embedding array<float>, label int"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "embeddings.parquet"))
    relabelled = [(i, (la + 1) % 10 if i % 7 == 0 else la, v) for i, v, la in rows]
    got = queries.all_queries()["op13_hard_negatives"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got)) == plain_negatives(relabelled, lambda n: n % 100 == 0)
    copies = queries.all_queries()["op12_near_copies"](spark, str(tmp_path))
    assert copies.filter("not kept").count() >= 100 and copies.count() == 1000
