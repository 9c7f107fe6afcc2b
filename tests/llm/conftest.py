import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF = "/root/testdata/sf0.001"
WIDE = "doc_id long, text string, lang string, source string, n_chars long, score double, fingerprint string, ids string"


def _row(i, text, lang="en", source="s", n=0):
    return (i, text, lang, source, n, -1.0, "own", "own")


@pytest.fixture
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, extra columns with clashing names."""
    words = "the quick brown fox jumps over a lazy dog near some quiet river bank".split()
    long = " ".join(words[i * 7 % 14] + str(i % 13) for i in range(40_000))
    rows = [_row(1, "A plain text of some words, nothing more."), _row(2, "A plain text of some words, nothing more."),
            _row(2, "A plain text of some words, nothing more."), _row(3, ""), _row(4, None), _row(5, " \n\t "),
            _row(6, long), _row(7, "12345 !!! ???"), _row(8, "password=hunter22secret0 end", None, None, None),
            (None, "no id here at all", None, None, None, None, None, None), (None,) * 8,
            _row(9, "Ünïcode 你好 👍🏽 ß́   end\r\nnew line")]
    return spark.createDataFrame(rows, WIDE)


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], WIDE)
