from collections import Counter

import corpus_pipeline as pipeline
from pyspark.sql import functions as F
from strata.llm import lines, secrets, simhash
from strata.llm.common import table
from tests.llm.conftest import SF
from tests.llm.test_text_operators import _base, _check_packed, _reference


def test_stages_over_documents(spark):
    docs = table(spark, SF, "documents")
    before, columns = docs.count(), docs.columns
    for name, stage in pipeline.STAGES[:-1]:
        out = pipeline.stored(stage(spark, docs, SF), name)
        assert out.columns == columns, name
        assert out.filter("n_chars <> length(text)").count() == 0
        n = out.count()
        if name == "language_id":
            assert n > 0.98 * before
        elif name == "line_dedup":
            assert n == docs.count()
            assert lines.boilerplate(docs, "source", "text", 0.05, 10).count() == 0 or \
                out.agg(F.sum("n_chars")).first()[0] < docs.agg(F.sum("n_chars")).first()[0]
        elif name == "simhash_near_dedup":
            classes = {r["component_id"] for r in simhash.near_duplicates(docs).collect()}
            assert sorted(r["doc_id"] for r in out.collect()) == sorted(classes)
        else:
            old = {r["doc_id"]: r["text"] for r in docs.collect()}
            for r in out.collect():
                assert ("[SECRET]" in r["text"]) or not _base(old[r["doc_id"]])
                assert "[SECRET]" in r["text"] or r["text"] == old[r["doc_id"]]
        docs = out
    rows = pipeline.STAGES[-1][1](spark, docs, SF).collect()
    encode = _reference("byte_bpe_50k.json")
    _check_packed(rows, [(r["doc_id"], [*encode(r["text"]), 2]) for r in docs.collect()])


def test_stages_on_odd_rows(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for _, stage in pipeline.STAGES[:-1]:
            assert stage(spark, docs, SF).columns == docs.columns
            stage(spark, docs, SF).collect()
        pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert secrets.KINDS[3] == "markov"


_PROSE = "the quick brown fox jumps over a lazy dog near some quiet river bank while seven old men watch".split()


def _prose(i):
    return " ".join(_PROSE[(i * 5 + j * (i % 7 + 1)) % len(_PROSE)] + str((i * j) % 29) * (j % 3 == 0) for j in range(30))


def _line_docs(spark):
    """Two sources with a footer, three groups of copies and a NULL source; ids tell the rows apart."""
    rows = [(i, f"{_prose(i)}\nfooter of big\n\nend {i}", "big") for i in range(60)]
    rows += [(1000 + i, f"copied {i % 2}\n{_prose(900 + i % 2)}\nlast line {i % 2}", "big") for i in range(40)]
    rows += [(2000 + i, f"{_prose(200 + i)}\nfooter of mid", "mid") for i in range(25)]
    rows += [(3000 + i, f"{_prose(950)}\nall alike", "mid") for i in range(15)]
    rows += [(4000, "footer of big", None), (4001, None, "big"), (4002, "footer of mid", "big")]
    return spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")


def _without_boilerplate(rows, least):
    """Texts by id: a line goes where more than 5 % of the source's different texts, and ``least`` of them, hold it."""
    different = {(s, t) for _, t, s in rows if s is not None}
    pages = Counter(s for s, _ in different)
    seen = Counter((s, line) for s, t in different for line in set((t or "").split("\n")) if line.strip())
    return {i: t if t is None else "\n".join(
        line for line in t.split("\n") if not (seen[s, line] >= least and seen[s, line] > 0.05 * pages[s]))
        for i, t, s in rows}


def test_line_stage_keeps_the_text_of_copies(spark):
    docs = _line_docs(spark)
    rows = [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]
    cleaned = pipeline.stored(pipeline.drop_boilerplate(spark, docs, SF), "lines")
    out = {r["doc_id"]: r["text"] for r in cleaned.collect()}
    assert out == _without_boilerplate(rows, 3)
    assert out[1000] == dict((i, t) for i, t, _ in rows)[1000] and "footer of big" not in out[7]
    kept = {r["text"] for r in pipeline.drop_near_duplicates(spark, cleaned, SF).collect()}
    assert {out[1000], out[1001], out[3000]} <= kept  # one of each group of copies, with its whole text


def test_line_stage_of_a_small_source(spark):
    rows = [(i, f"{_prose(i)}\nfooter\nend {i}" + "\nof two" * (i < 2), "en", "small", 0) for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = {r["doc_id"]: r["text"] for r in pipeline.drop_boilerplate(spark, docs, SF).collect()}
    assert out == _without_boilerplate([(r[0], r[1], r[3]) for r in rows], 3)
    assert "footer" not in out[5] and "of two" in out[0]
