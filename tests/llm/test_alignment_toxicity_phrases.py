"""Token alignment, toxicity and phrase mining: brute force, held-out accuracy, edge cases."""

import hashlib
import itertools
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from strata.llm import align, collocations, toxicity
from strata.llm.common import vocabulary_path
from strata.llm.encode import token_bytes
from strata.llm.queries import oracle_sql, queries
from tests.llm.conftest import SF

A, B = "byte_bpe_50k.json", "piece_bpe_32k.model"


# ------------------------------------------------------------------ alignment
def _brute_alignment(texts):
    """Per text (n_a, n_b, n_groups, n_links, n_best, count_sum, digest), straight from the two libraries."""
    import sentencepiece
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(vocabulary_path(A))
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=vocabulary_path(B))
    bytes_a, bytes_b = token_bytes(vocabulary_path(A)), align.piece_bytes(second)
    count, found = Counter(), []
    for text in texts:
        a = first.encode(" " + text, add_special_tokens=False).ids if text else []
        b = second.encode(text) if text else []
        raw = (" " + (text or "")).encode()
        if not text or b"".join(bytes_a[i] for i in a) != raw or b"".join(bytes_b[i] for i in b) != raw:
            found.append(None)
            continue

        def spans(ids, table):
            at = list(itertools.accumulate((len(table[i]) for i in ids), initial=0))
            return list(zip(at, at[1:], ids))

        a, b = spans(a, bytes_a), spans(b, bytes_b)
        links = [(i, j) for x, y, i in a for u, v, j in b if x < v and u < y]
        cuts = [0, *sorted({y for _, y, _ in a} & {y for _, y, _ in b})]
        groups = ["|".join(",".join(str(i) for x, y, i in side if p <= x and y <= q) for side in (a, b))
                  for p, q in zip(cuts, cuts[1:])]
        count.update(links)
        found.append((len(a), len(b), groups, links))
    best = {}
    for (_, j), n in count.items():
        best[j] = max(best.get(j, 0), n)
    return [(0, 0, 0, 0, 0, 0, "") if x is None else
            (x[0], x[1], len(x[2]), len(x[3]), sum(count[k] == best[k[1]] for k in x[3]), sum(count[k] for k in x[3]),
             hashlib.sha256(";".join(x[2]).encode()).hexdigest()) for x in found]


def test_alignment_equals_brute_force(spark):
    rng = random.Random(11)
    texts = ["aaaaaaa aaaa ====", " two  spaces", "a▁b", "<|endoftext|> </s>", "Ünïcode 你好 👍🏽", "x" * 300, None, "", "\n\n\t"]
    texts += ["".join(rng.choice(["the", "tion", " ", " ", "a", "==", "é", "12", "ing", "."]) for _ in range(40)) for _ in range(60)]
    texts += texts[:9]
    rows = align.align(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3),
                       vocabulary_path(A), vocabulary_path(B)).collect()
    assert [tuple(r)[1:] for r in sorted(rows)] == _brute_alignment(texts)


def test_alignment_edge_cases(spark, odd_docs, no_docs):
    path = vocabulary_path(A), vocabulary_path(B)
    rows = align.align(odd_docs.withColumnRenamed("score", "n_a"), *path).collect()
    assert len(rows) == odd_docs.count()
    assert sum(r["doc_id"] is None for r in rows) == 2 and {r["n_a"] for r in rows if r["doc_id"] in (3, 4)} == {0}
    assert align.align(no_docs, *path).count() == 0


# ------------------------------------------------------------------ toxicity
def test_kernel_equals_enumeration():
    def vector(unit, length):
        out = Counter()
        for places in itertools.combinations(range(len(unit)), length):
            out["".join(unit[i] for i in places)] += toxicity.DECAY ** (places[-1] - places[0] + 1 - length)
        return out

    units, marks = ["^idiot", "^idxiot", "^scum", "^ab", "^banana", "a"], ["^idiot", "^scum", "^bananas"]
    got = toxicity.kernel(units, marks)
    for i, j in itertools.product(range(len(units)), range(len(marks))):
        parts = []
        for length in toxicity.LENGTHS:
            x, y = vector(units[i], length), vector(marks[j], length)
            below = np.sqrt(sum(v * v for v in x.values()) * sum(v * v for v in y.values()))
            parts.append(sum(v * y[k] for k, v in x.items()) / below if below else 0)
        assert got[i, j] == pytest.approx(np.mean(parts), abs=1e-5)


def test_units_join_what_is_spaced_out():
    assert "^idiot" in toxicity.units_of("you i d i o t") and "^idiot" in toxicity.units_of("I-D-I-O-T!")
    assert toxicity.units_of("...") == [] and len(toxicity.units_of("x" * 100)) == 10


def test_insults_with_gaps_are_found_and_clean_texts_left_alone(spark):
    rng, insults = random.Random(2), ["idiot", "moron", "worthless", "pathetic"]
    words = ["".join(rng.choice(["ba", "lo", "ti", "en", "ra", "shu", "ok"]) for _ in range(rng.randint(1, 4))) for _ in range(300)]

    def text(extra=()):
        out = [" ".join(rng.choice(words) for _ in range(8)) for _ in range(5)]
        return ". ".join(out[:2] + [f"{rng.choice(words)} {x} {rng.choice(words)}" for x in extra] + out[2:]) + "."

    rows = [(i, text([rng.choice(insults), rng.choice(insults)] if i % 4 == 0 else ()), int(i % 4 == 0)) for i in range(600)]
    spaced = ["i d i o t", "mor-on", "worthlesss", "path.etic"]
    rows += [(1000 + i, text([x, x]), None) for i, x in enumerate(spaced)] + [(2000 + i, text(), None) for i in range(40)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in toxicity.toxicity_of(docs, labels, landmarks=64).collect()}
    assert [got[1000 + i]["predicted"] for i in range(len(spaced))] == [1] * len(spaced)
    assert sum(got[2000 + i]["predicted"] for i in range(40)) == 0
    held = [r for r in rows if r[2] is not None and zlib.crc32(str(r[0]).encode()) % 4 == 2]
    assert all(got[r[0]]["held_out"] for r in held) and np.mean([got[r[0]]["predicted"] == r[2] for r in held]) > 0.95


def test_toxicity_edge_cases(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 10)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    rows = toxicity.toxicity_of(odd_docs, labels).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert {r["score"] for r in toxicity.toxicity_of(odd_docs, labels.filter("toxic > 1")).collect()} == {0.0}
    assert toxicity.toxicity_of(no_docs, labels).count() == 0


# ------------------------------------------------------------------ phrases
def _by_sql(docs, least, limit):
    view = duckdb.connect()
    frame = docs.select("text", "lang").toPandas()
    view.register("documents", frame)
    sql = oracle_sql()["op13_phrase_collocations"].replace("n >= 30", f"n >= {least}").replace("rank <= 2000", f"rank <= {limit}")
    got = view.sql(sql)
    return [dict(zip(got.columns, r)) for r in got.fetchall()]


@pytest.mark.parametrize("least,limit", [(3, 2000), (3, 7), (2, 30)])
def test_phrases_equal_sql(spark, least, limit):
    rng = random.Random(least * limit)
    words = [f"w{i}" for i in range(40)]
    fixed = ["new york city hall", "a b a b a b", "x x x x x", "alpha\tbeta  gamma"]
    rows = [(" ".join(rng.choice(words[:rng.randint(2, 40)]) if rng.random() < 0.7 else rng.choice(fixed) for _ in range(30))
             + rng.choice(".,;\n "), rng.choice(["en", "de", None])) for _ in range(120)] + [(None, "en"), ("", None), (" \n", "fr")]
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    got = [r.asDict() for r in collocations.collocations(docs, least=least, limit=limit).collect()]
    want = _by_sql(docs, least, limit)
    key = lambda r: (r["lang"], r["rank"])
    assert sorted(got, key=key) == sorted(want, key=key) and got


def test_phrases_on_the_given_table(spark):
    names = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    got = {tuple(r[n] for n in names) for r in queries()["op13_phrase_collocations"](spark, SF).collect()}
    duckdb.execute(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = duckdb.sql(oracle_sql()["op13_phrase_collocations"])
    assert got == {tuple(dict(zip(want.columns, r))[n] for n in names) for r in want.fetchall()}


def test_phrases_edge_cases(spark, odd_docs, no_docs):
    got = collocations.collocations(odd_docs.withColumnRenamed("score", "phrase"), least=2, limit=50).collect()
    assert got and {r["lang"] for r in got} <= {"en", "und"}
    assert collocations.collocations(no_docs).count() == 0
