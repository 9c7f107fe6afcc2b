"""Cross-tokenizer alignment: how the tokens of two vocabularies overlap over the same texts.

Both vocabularies spell a text as the same bytes.  The byte offsets at which a token of either ends cut the tokens into
groups; every pair of tokens whose byte ranges overlap is a link.  How often a pair of ids is linked in the whole corpus is
its count.

Most groups are one token against one token with the same bytes.  An array made once maps each id of the first vocabulary
to the id of the second that has its bytes, so such groups are counted in a vector as long as the vocabulary and never
enter a pair shuffle.  What is left, the links of irregular groups, is counted per block of documents; only these
counts are shuffled by pair.  The total of a pair goes back to the blocks that hold it, never to single documents: a
pair that every document holds is one row per block.

Defined results: NULL and empty texts, and texts that one of the vocabularies does not spell byte by byte (it
normalises them, say), have no tokens: zeros and an empty digest.  NULL ids and repeated rows are rows like any
other; an empty table gives no rows; only ``id_col`` and ``text_col`` are read, so other columns may have any name.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import arrow_schema, map_arrow, ship, stored
from strata.llm.encode import encoder, token_bytes

_BLOCK_BYTES = 4 << 20  # of text: what one block of documents holds at most, but for a longer single document
_DOCUMENT, _IRREGULAR, _REGULAR = 0, 1, 2


def piece_bytes(processor) -> list[bytes]:
    """The bytes of every id of a SentencePiece model: U+2581 is a space, byte pieces are their byte."""
    out = []
    for i in range(processor.vocab_size()):
        name = processor.id_to_piece(i)
        out.append(bytes([int(name[3:5], 16)]) if processor.is_byte(i) else name.replace("▁", " ").encode())
    return out


@dataclass
class Aligned:
    """One text: ids of both sides, the group of each token, which tokens are in regular groups (one against one, of
    the same bytes), and the links of the others as places of tokens."""

    a: np.ndarray
    b: np.ndarray
    group_a: np.ndarray
    group_b: np.ndarray
    regular_a: np.ndarray
    regular_b: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray

    @property
    def groups(self) -> int:
        return int(self.group_a[-1]) + 1 if len(self.a) else 0

    @property
    def ids(self) -> np.ndarray:
        """First ids of the regular groups; each group is one link."""
        return self.a[self.regular_a]

    def codes(self, width: int) -> np.ndarray:
        """Both ids of each link of the irregular groups, as one number."""
        return self.a[self.link_a] * width + self.b[self.link_b]


_NOTHING = Aligned(*(np.empty(0, np.int64),) * 4, *(np.empty(0, bool),) * 2, *(np.empty(0, np.int64),) * 2)


class Pair:
    """Both vocabularies in a worker: ids, byte lengths, the map of same bytes, and the digest's strings."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece

        self.first = encoder(path_a, keep_space=True, special_as_text=True)
        self.second = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes_a, self.bytes_b = token_bytes(path_a), piece_bytes(self.second)
        self.length_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.length_b = np.array([len(x) for x in self.bytes_b], np.int64)
        by_bytes: dict[bytes, int] = {}
        for i, raw in enumerate(self.bytes_b):
            # of several ids with the same bytes a whole piece goes before a byte piece
            if raw and (raw not in by_bytes or self.second.is_byte(by_bytes[raw]) and not self.second.is_byte(i)):
                by_bytes[raw] = i
        self.same = np.array([by_bytes.get(raw, -1) for raw in self.bytes_a], np.int64)
        self.width = len(self.bytes_b)
        a, b = range(len(self.bytes_a)), range(self.width)
        # per id and whether it ends its side of a group; last, per id a whole regular group
        self.words = ([f"{i}," for i in a] + [f"{i}|" for i in a] + [f"{i}," for i in b] + [f"{i};" for i in b]
                      + [f"{i}|{j};" for i, j in enumerate(self.same.tolist())])

    def ids(self, text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of both, or None where there is no text or one of them spells other bytes."""
        if not text:
            return None
        raw = b" " + text.encode()
        b = self.second.encode(text)
        if b"".join(map(self.bytes_b.__getitem__, b)) != raw:
            return None
        a = np.frombuffer(self.first.encode(" " + text), "<u4").astype(np.int64)
        if self.length_a[a].sum() != len(raw):  # a byte-level vocabulary spells every text, unless it is cut short
            return None
        return a, np.array(b, np.int64)

    def align(self, text: str | None) -> Aligned:
        found = self.ids(text)
        if found is None:
            return _NOTHING
        a, b = found
        end_a, end_b = np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b])
        # a token is in the group of the first common end at or after its own end
        shared = np.zeros(end_a[-1] + 1, bool)
        shared[end_b] = True
        cuts = shared[end_a]
        group_a = np.cumsum(cuts) - cuts
        group_b = np.searchsorted(end_a[cuts], end_b)
        alone = (np.bincount(group_a) == 1) & (np.bincount(group_b) == 1)
        regular_a, regular_b = alone[group_a], alone[group_b]
        like = self.same[a[regular_a]] == b[regular_b]
        regular_a[regular_a], regular_b[regular_b] = like, like
        # tokens of b that overlap a token of a are neighbours: from the one that holds its first byte on
        of_a, of_b = np.flatnonzero(~regular_a), np.flatnonzero(~regular_b)
        ends = end_b[of_b]
        first = np.searchsorted(ends, end_a[of_a] - self.length_a[a[of_a]], side="right")
        times = np.searchsorted(ends, end_a[of_a], side="left") - first + 1
        link_a = np.repeat(of_a, times)
        link_b = of_b[np.arange(len(link_a)) - np.repeat(np.cumsum(times) - times, times) + np.repeat(first, times)]
        return Aligned(a, b, group_a, group_b, regular_a, regular_b, link_a, link_b)

    def digest(self, x: Aligned) -> str:
        """SHA-256 of the groups as ``a1,a2|b1;a3|b2,b3``; empty without tokens."""
        if not len(x.a):
            return ""
        n, m = len(self.bytes_a), self.width
        last_a, last_b = np.append(np.diff(x.group_a) > 0, True), np.append(np.diff(x.group_b) > 0, True)
        # in order of group, a before b; a regular group is one word, at the place of its token of a
        b, group_b, last_b = x.b[~x.regular_b], x.group_b[~x.regular_b], last_b[~x.regular_b]
        place_a = np.arange(len(x.a)) + np.searchsorted(group_b, x.group_a, side="left")
        place_b = np.arange(len(b)) + np.searchsorted(x.group_a, group_b, side="right")
        words = np.empty(len(x.a) + len(b), np.int64)
        words[place_a] = np.where(x.regular_a, 2 * n + 2 * m + x.a, x.a + n * last_a)
        words[place_b] = 2 * n + b + m * last_b
        return hashlib.sha256("".join(map(self.words.__getitem__, words.tolist()))[:-1].encode()).hexdigest()


_PAIRS: dict[tuple[str, str], Pair] = {}


def pair(path_a: str, path_b: str) -> Pair:
    """The worker's two vocabularies; loaded once per Python worker."""
    key = (path_a, path_b)
    if key not in _PAIRS:
        _PAIRS[key] = Pair(*key)
    return _PAIRS[key]


def _first_pass(docs: DataFrame, path_a: str, path_b: str, id_type: str) -> DataFrame:
    """One row per document (kind 0), one per block with its irregular pairs (1), one per task with its vector (2)."""
    schema = (f"kind int, block long, doc_id {id_type}, n_a long, n_b long, n_groups long, n_links long, "
              "groups_sha256 string, regular binary, regular_n binary, codes binary, n binary")

    def run(batches):
        both, number = pair(path_a, path_b), 0
        task = TaskContext.get().partitionId() << 32
        vector = np.zeros(len(both.bytes_a), np.int64)
        irregular: dict[int, int] = {}
        size, out = 0, []

        def written():
            return pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in out], arrow)

        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1).to_pylist()):
                x = both.align(text)
                ids, codes = np.unique(x.ids, return_counts=True), np.unique(x.codes(both.width), return_counts=True)
                vector[ids[0]] += ids[1]
                for code, n in zip(*map(np.ndarray.tolist, codes)):
                    irregular[code] = irregular.get(code, 0) + n
                out.append((_DOCUMENT, task + number, doc_id.as_py(), len(x.a), len(x.b), x.groups,
                            int(ids[1].sum()) + len(x.link_a), both.digest(x),
                            *(v.astype("<i8").tobytes() for v in (*ids, *codes))))
                size += len(text or "")
                if size >= _BLOCK_BYTES or len(out) >= 4000:
                    out.append(_block(irregular, task + number))
                    yield written()
                    out, irregular, size, number = [], {}, 0, number + 1
        if out:
            out.append(_block(irregular, task + number))
        seen = np.flatnonzero(vector)
        out.append((_REGULAR, task, *(None,) * 8, seen.astype("<i8").tobytes(), vector[seen].astype("<i8").tobytes()))
        yield written()

    ship(docs.sparkSession)
    frame = docs.sparkSession.createDataFrame([], schema).schema
    names, arrow = frame.names, arrow_schema(frame)
    return map_arrow(docs, run, schema)


def _block(irregular: dict[int, int], block: int) -> tuple:
    codes = np.array(sorted(irregular), "<i8")
    times = np.array([irregular[c] for c in codes.tolist()], "<i8")
    return (_IRREGULAR, block, *(None,) * 8, codes.tobytes(), times.tobytes())


def _exploded(rows: DataFrame) -> DataFrame:
    """(block, code, n) of rows that hold them as two binaries."""
    def run(batches):
        for batch in batches:
            for block, codes, n in zip(batch.column("block").to_pylist(), batch.column("codes").to_pylist(),
                                       batch.column("n").to_pylist()):
                codes, n = np.frombuffer(codes, "<i8"), np.frombuffer(n, "<i8")
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(codes), block, np.int64)), pa.array(codes),
                                                  pa.array(n)], names=["block", "code", "n"])

    return map_arrow(rows.select("block", "codes", "n"), run, "block long, code long, n long")


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    ``path_a`` is a byte-level vocabulary file, which encodes a space and the text; ``path_b`` a SentencePiece model, which
    puts that space itself.  The driver holds vectors as long as the vocabularies, whatever the corpus.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = stored(_first_pass(docs, path_a, path_b, id_type), "aligned")
    both = pair(path_a, path_b)
    same, width = both.same, both.width

    regular = np.zeros(len(same), np.int64)
    for r in _exploded(rows.filter(F.col("kind") == _REGULAR)).groupBy("code").agg(F.sum("n").alias("n")).collect():
        regular[r["code"]] = r["n"]  # one row per id of the first vocabulary
    pairs = _exploded(rows.filter(F.col("kind") == _IRREGULAR))
    totals = stored(pairs.groupBy("code").agg(F.sum("n").alias("total")), "pair_counts")

    # pairs of same bytes that irregular groups hold as well: at most one per id of the first vocabulary
    known = same >= 0
    equal = pd.DataFrame({"code": np.flatnonzero(known) * width + same[known]})
    equal = F.broadcast(docs.sparkSession.createDataFrame(equal, "code long"))
    for r in totals.join(equal, "code", "left_semi").collect():
        regular[r["code"] // width] += r["total"]
    best = np.zeros(width, np.int64)
    np.maximum.at(best, same[known], regular[known])
    for r in totals.groupBy((F.col("code") % width).alias("b")).agg(F.max("total").alias("n")).collect():
        best[r["b"]] = max(best[r["b"]], r["n"])  # one row per id of the second vocabulary

    counted = pairs.select("block", "code").join(totals, "code")
    out = (f"doc_id {id_type}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
           "groups_sha256 string")

    def finish(_, members: pd.DataFrame, counts: pd.DataFrame) -> pd.DataFrame:
        codes = counts["code"].to_numpy(np.int64)
        order = np.argsort(codes)
        codes, total = codes[order], counts["total"].to_numpy(np.int64)[order]
        # pairs of same bytes have their regular groups counted as well
        same_code = same[codes // width] == codes % width
        total = np.where(same_code, regular[codes // width], total)
        top = total == best[codes % width]
        sums, bests = [], []
        for ids, ids_n, own, own_n in zip(members["regular"], members["regular_n"], members["codes"], members["n"]):
            ids, ids_n = np.frombuffer(ids, "<i8"), np.frombuffer(ids_n, "<i8")
            at, n = np.searchsorted(codes, np.frombuffer(own, "<i8")), np.frombuffer(own_n, "<i8")
            sums.append(int((regular[ids] * ids_n).sum() + (total[at] * n).sum()))
            bests.append(int(ids_n[regular[ids] == best[same[ids]]].sum() + n[top[at]].sum()))
        return members.assign(n_best=np.array(bests, np.int64), count_sum=np.array(sums, np.int64))[
            ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]]

    members = rows.filter(F.col("kind") == _DOCUMENT).select(
        "block", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "regular", "regular_n", "codes", "n")
    return members.groupBy("block").cogroup(counted.groupBy("block")).applyInPandas(finish, out)
