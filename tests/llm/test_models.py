"""Learned operators: accuracy on rows they did not see, recall against brute force, edge cases."""

import zlib

import duckdb
import numpy as np
from strata.llm import language, neighbours, quality
from strata.llm.queries import queries
from tests.llm.conftest import SF


def _crc(i):
    return zlib.crc32(str(i).encode())


def test_languages_held_out(spark):
    lang = dict(duckdb.sql(f"SELECT doc_id, lang FROM '{SF}/documents.parquet'").fetchall())
    rows = queries()["op6_language_id"](spark, SF).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(lang)
    assert all(r["held_out"] == (_crc(r["doc_id"]) % 3 == 1) and 0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in held]) > 0.95
    assert np.mean([r["rejected"] for r in rows]) < 0.02


def test_language_edge_cases(spark, odd_docs, no_docs):
    rows = {(r["doc_id"], r["lang_pred"], r["rejected"]) for r in language.language_of(odd_docs).collect()}
    assert {(3, "und", True), (4, "und", True), (5, "und", True), (7, "und", True), (None, "und", True)} <= rows
    assert language.language_of(odd_docs).count() == odd_docs.count()
    kept = language.keep_identified(odd_docs)
    assert kept.columns == odd_docs.columns and {3, 4, 5, 7}.isdisjoint({r["doc_id"] for r in kept.collect()})
    assert language.language_of(no_docs).count() == 0


def test_outliers_are_no_clusters():
    rng = np.random.default_rng(4)
    x = np.zeros((400, 64), np.float32)
    x[:, :40] = 1 + rng.normal(0, 0.2, (400, 40))
    x[:200, :20] += 1
    x[397:] = np.eye(64)[61:]  # three one-word texts
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    centroids, nearest = language._clusters(x, 4)
    assert len(centroids) > 1 and np.bincount(nearest, minlength=len(centroids)).min() >= 8


def test_a_lone_short_text_sets_no_limit(spark):
    rows = [(i, " ".join(f"{a}{b}" for a in "wordlanguage"[i % 5:] for b in ("an", "ter", "ing")), "en")
            for i in range(120)] + [(500, "Zyx.", "en"), (501, "Qvk.", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.train(docs)
    assert max(model.least) < 0.25


def test_quality_held_out(spark):
    label = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{SF}/labels.parquet'").fetchall())
    rows = queries()["op4_quality_classifier"](spark, SF).collect()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
               and r["held_out"] == (_crc(r["doc_id"]) % 5 == 0) for r in rows)
    held = [r for r in rows if r["held_out"] and r["doc_id"] in label]
    assert np.mean([r["predicted"] == label[r["doc_id"]] for r in held]) > 0.9


def test_quality_edge_cases(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (3, 0, 0), (6, 1, 0), (8, None, 0), (None, 1, 0), (9, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    rows = quality.quality_of(odd_docs, labels).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    unlabelled = quality.quality_of(odd_docs, labels.limit(0)).collect()
    assert {r["score"] for r in unlabelled} == {0.5}
    assert quality.quality_of(no_docs, labels).count() == 0


def test_isotonic_is_the_least_squares_fit():
    rng = np.random.default_rng(0)
    w, y = rng.integers(1, 9, 30).astype(float), np.clip(np.linspace(0, 1, 30) + rng.normal(0, 0.3, 30), 0, 1)
    fit = quality.isotonic(w, w * y)
    # the minimax formula of isotonic regression
    want = [max(min(np.average(y[a:b + 1], weights=w[a:b + 1]) for b in range(i, 30)) for a in range(i + 1))
            for i in range(30)]
    assert np.allclose(fit, want)


def test_neighbours_recall(spark):
    data = dict(duckdb.sql(f"SELECT vec_id, embedding FROM '{SF}/embeddings.parquet'").fetchall())
    _check(data, queries()["op2_nearest_neighbours"](spark, SF).collect(), {i for i in data if i % 100 == 0}, 0.9)


def _check(data, rows, asked, recall):
    ids, x = np.array(sorted(data)), np.array([data[i] for i in sorted(data)], dtype=np.float64)
    lists, hits, total = {}, 0, 0
    for r in rows:
        lists.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(lists) == asked
    for q, found in lists.items():
        found.sort()
        d = np.sqrt(((x - data[q]) ** 2).sum(axis=1))
        want = [(s, i) for s, i in sorted(zip(d.tolist(), ids.tolist())) if i != q][:10]
        assert [n for n, _, _ in found] == list(range(1, len(want) + 1))
        assert [(s, i) for _, i, s in found] == sorted((s, i) for _, i, s in found)
        by_id = dict(zip(ids.tolist(), d.tolist()))
        assert all(abs(by_id[i] - s) < 1e-9 for _, i, s in found)
        hits += len({i for _, i in want} & {i for _, i, _ in found})
        total += len(want)
    assert hits >= recall * total


def test_neighbours_edge_cases(spark):
    rng = np.random.default_rng(1)
    data = {i: rng.normal(size=4).tolist() for i in range(1, 60)}
    data |= {i: [1.0, 0.0, 0.0, 0.5] for i in range(100, 140)}  # a group of equal vectors
    data[200] = [1.0, -0.0, 0.0, 0.5]
    bad = [(300, None), (400, []), (500, [0.0] * 4), (600, [1.0, None, 1.0, 1.0]), (700, [float("nan"), 1.0, 1.0, 1.0]),
           (800, [float("inf"), 1.0, 1.0, 1.0]), (900, [1.0, 2.0]), (None, [1.0, 1.0, 1.0, 1.0])]
    schema = "vec_id long, embedding array<float>, label int, rank string"
    rows = [(i, v, 0, "own") for i, v in data.items()] + [(i, v, None, None) for i, v in bad]
    df = spark.createDataFrame(rows + rows[:5], schema)
    real = {i: np.float32(v).tolist() for i, v in data.items()}
    out = neighbours.search(df, lambda c: c % 20 == 0).collect()
    _check(real, out, {i for i in data if i % 20 == 0}, 0.9)
    group = [r["vec_id"] for r in sorted(out, key=lambda r: r["rank"]) if r["query_id"] == 120]
    assert group == list(range(100, 110))  # ties to the smaller id
    few = neighbours.search(df.filter("vec_id <= 3"), lambda c: c == 2).collect()
    assert sorted(r["vec_id"] for r in few) == [1, 3]
    assert neighbours.search(df.limit(0), lambda c: c > 0).count() == 0


def test_hilbert_neighbours_differ_by_one_step():
    cells = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), axis=-1).reshape(-1, 3)
    key = neighbours.hilbert(cells, 3)
    assert sorted(key.tolist()) == list(range(512))
    path = cells[np.argsort(key)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()
