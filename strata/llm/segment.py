"""SentencePiece encoding, decoding and sampled segmentations without replacement.

``sampled`` draws, for each text, ``k`` distinct segmentations by Gumbel top-k.  The lattice of a text has an edge for
every piece of the vocabulary that matches; a piece of merge rank r has weight (r + 1) ** -alpha, and a segmentation's
probability is the product of its weights over the sum for all segmentations (exact, from a backward pass).  The search is
A-star over the prefix tree with perturbed bounds: a node's bound is the largest Gumbel-perturbed log-probability
below it, which its best child inherits and the rest of its children get a truncated Gumbel for.  Expanding the
node of the largest bound down to a leaf yields the samples in the order of their perturbed log-probabilities, each path
once.  The bound left at the top after ``k`` samples is the threshold t that gives the inclusion score: a segmentation
of log-probability l is drawn with probability 1 - exp(-exp(l - t)).

No piece holds a space mark after another character, and none holds a line feed, so the lattice is a chain of
small ones, one per word; each distinct word of a batch is built once, and all words of a batch advance together, as do
the bounds beside all its paths.
Random numbers are hashes of (seed, row key, sample, word, step): a row's samples depend on nothing else.

Defined results: NULL counts as empty; an empty text has one segmentation, of no pieces; a text with fewer than ``k``
segmentations gives all of them (inclusion 1); a NULL key is a key like any other; repeated rows give the same
samples; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import heapq
import math
import re
import zlib
from bisect import bisect_right
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import map_arrow, ship

MARK = "▁"  # a space inside pieces
_ALL = 0xFFFFFFFFFFFFFFFF
_BASE = np.uint64(0x9E3779B97F4A7C15)
_NOISE = np.uint64(0xA5A5A5A5A5A5A5A5)  # sets the numbers of the bounds apart from those of the walks


def _mixed(x: np.ndarray) -> np.ndarray:
    """Splitmix64 finaliser."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _counted(seed: np.ndarray, a: np.ndarray) -> np.ndarray:
    return _mixed(seed + a.astype(np.uint64) * _BASE)


def _fraction(x: np.ndarray, b: int) -> np.ndarray:
    x = _mixed(x ^ np.uint64(0xD6E8FEB86659FD93 * (b + 1) & _ALL))
    x >>= np.uint64(11)
    u = x.astype(np.float64)
    u += 0.5
    u *= 2.0 ** -53
    return u


def _uniform(seed: np.ndarray, a: np.ndarray, b: int) -> np.ndarray:
    """In (0, 1), by row seed and two counters."""
    return _fraction(_counted(seed, a), b)


def _one_uniform(seed: int, a: int, b: int) -> float:
    """``_uniform`` of single numbers."""
    x = seed + a * int(_BASE) & _ALL
    for salt in (0xD6E8FEB86659FD93 * (b + 1) & _ALL, 0):
        x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & _ALL
        x = (x ^ x >> 27) * 0x94D049BB133111EB & _ALL
        x ^= x >> 31 ^ salt
    return ((x >> 11) + 0.5) * 2.0 ** -53


def _ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each length, one after the other."""
    end = np.cumsum(length)
    out = np.repeat(start - end + length, length)
    out += np.arange(len(out))
    return out


class _Keys:
    """Whole numbers of 64 bits with a value each, found by their leading bits once these are spread."""

    def __init__(self, values: dict[int, int]):
        keys = np.fromiter(values, dtype=np.uint64, count=len(values)) * _BASE
        order = np.argsort(keys)
        bits = max(len(keys) * 8, 2).bit_length()
        self.shift = np.uint64(64 - bits)
        self.keys = np.append(keys[order], np.uint64(0))
        self.values = np.append(np.fromiter(values.values(), dtype=np.int64, count=len(values))[order], -1)
        self.begin = np.searchsorted(keys[order] >> self.shift, np.arange((1 << bits) + 1, dtype=np.uint64)).astype(np.int32)

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which numbers are keys, and the values of those."""
        h = h * _BASE
        bucket = (h >> self.shift).astype(np.int64)
        place = self.begin[bucket]
        found = self.keys[place] == h
        later = np.flatnonzero(~found)
        later = later[place[later] + 1 < self.begin[bucket[later] + 1]]
        while len(later):
            place[later] += 1
            found[later] = self.keys[place[later]] == h[later]
            later = later[~found[later] & (place[later] + 1 < self.begin[bucket[later] + 1])]
        return found, self.values[place[found]]


def _units(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Texts as the model reads them, cut into words (marks with what follows up to the next mark; line feeds): characters
    and lengths of the distinct words, the number of each word in order, and where the words of each text begin."""
    codes = np.frombuffer("".join([MARK + t if t else "" for t in texts]).encode("utf-32-le"), dtype="<u4").copy()
    codes[codes == ord(" ")] = ord(MARK)
    size = np.fromiter((len(t) + 1 if t else 0 for t in texts), dtype=np.int64, count=len(texts))
    bounds = np.concatenate([[0], np.cumsum(size)])
    mark, begins = codes == ord(MARK), codes == ord("\n")
    begins[1:] |= begins[:-1].copy()
    begins[1:] |= mark[1:] & ~mark[:-1]
    begins[bounds[:-1][size > 0]] = True
    start = np.flatnonzero(begins)
    length = np.diff(np.append(start, len(codes)))
    place = np.arange(len(codes)) - np.repeat(start, length)
    power = np.cumprod(np.full(int(length.max()) if len(length) else 0, _BASE))
    h = np.add.reduceat(codes * power[place], start) if len(start) else np.empty(0, np.uint64)
    word = pd.factorize(_mixed(h))[0]  # numbered as they first come
    first = np.flatnonzero(np.diff(np.maximum.accumulate(word), prepend=-1))
    if not ((length[first][word] == length).all()
            and (codes[np.repeat(start[first][word], length) + place] == codes).all()):  # two words with one hash
        seen: dict[bytes, int] = {}
        word = np.array([seen.setdefault(codes[a:a + n].tobytes(), len(seen)) for a, n in zip(start, length)])
        first = np.unique(word, return_index=True)[1]
    return codes[_ranges(start[first], length[first])], length[first], word, np.searchsorted(start, bounds)


class Pieces:
    """Vocabulary of a SentencePiece model with byte fallback: weights, surfaces, prefix tables."""

    def __init__(self, path: str, alpha: float):
        import sentencepiece

        self.processor = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.vocab_size()
        names = [sp.id_to_piece(i) for i in range(n)]
        self.surface = [b""] * n
        self.byte_ids = np.zeros(256, dtype=np.int64)
        ranks = np.full(n, n, dtype=np.float64)
        tables: list[dict[int, int]] = []
        for i, name in enumerate(names):
            if sp.is_byte(i):
                self.byte_ids[int(name[3:5], 16)] = i
                self.surface[i] = bytes([int(name[3:5], 16)])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                if re.search(f"[^{MARK}]{MARK}|\n", name):
                    raise ValueError(f"piece {name!r} spans words")
                self.surface[i] = name.replace(MARK, " ").encode()
                ranks[i] = -sp.get_score(i)
                h = 0
                for at, c in enumerate(name):
                    h = (h * int(_BASE) + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
                    if at == len(tables):
                        tables.append({})
                    if at == len(name) - 1:
                        tables[at][h] = i
                    else:
                        tables[at].setdefault(h, -1)
        self.weight = -alpha * np.log1p(ranks)
        self.byte_weight = -alpha * np.log1p(float(n))
        self.tables = [_Keys(t) for t in tables]
        self.spelled = np.empty(n, dtype=object)
        self.spelled[:] = self.surface

    def decode(self, ids) -> bytes:
        """UTF-8 of the text that the ids spell, without the space put before it."""
        out = b"".join(self.spelled[np.asarray(ids, dtype=np.int64)].tolist())
        return out[1:] if out[:1] == b" " else out


class Lattice:
    """The lattices of many words: nodes are characters, options are edges, grouped by node."""

    def __init__(self, codes: np.ndarray, length: np.ndarray, pieces: Pieces):
        codes = codes.astype(np.uint64) + np.uint64(1)
        self.start = (np.cumsum(length) - length).astype(np.int64)
        n = len(codes)
        left = np.repeat(self.start + length, length) - np.arange(n)  # characters to the end of the word
        alive, h = np.arange(n), np.zeros(n, dtype=np.uint64)
        nodes, sizes, ids, places = [], [], [], []
        options, odd = np.zeros(n, dtype=np.int64), alive  # of each node so far
        for size, keys in enumerate(pieces.tables, 1):
            if size > 1:
                enough = np.flatnonzero(left[alive] >= size)
                alive, h = alive[enough], h[enough]
            if not len(alive):
                break
            h = h * _BASE
            h += codes[alive + (size - 1)]
            found, value = keys.find(h)
            alive, h = alive[found], h[found]
            whole = np.flatnonzero(value >= 0)
            node = alive[whole]
            place = options[node]
            nodes.append(node)
            sizes.append(np.full(len(node), size))
            ids.append(value[whole])
            places.append(place)
            options[node] = place + 1
            if size == 1:
                odd = np.flatnonzero(options == 0)  # characters without a piece of their own: their bytes
        spelled = [chr(int(c) - 1).encode() for c in codes[odd]]
        nodes.append(odd)
        sizes.append(np.ones(len(odd), np.int64))
        ids.append(-1 - np.arange(len(odd)))
        places.append(options[odd])
        options[odd] += 1
        self.first = np.concatenate([[0], np.cumsum(options)])
        node = np.concatenate(nodes)
        at = self.first[node]
        at += np.concatenate(places)
        size = np.concatenate(sizes)
        piece, follows = np.empty(len(at), np.int32), np.empty(len(at), np.int64)
        piece[at] = np.concatenate(ids)
        follows[at] = np.where(size == left[node], -1, node + size)
        del nodes, sizes, ids, places, at, alive, h, node, size
        self.node = np.repeat(np.arange(n, dtype=np.int32), options)
        # ids an option emits: its piece, or if negative the bytes of a character
        self.odd_size = np.fromiter(map(len, spelled), dtype=np.int64, count=len(spelled))
        self.odd_at = np.cumsum(self.odd_size) - self.odd_size
        self.odd_ids = pieces.byte_ids[np.frombuffer(b"".join(spelled), dtype=np.uint8)]
        weight = pieces.weight[piece]
        bytewise = np.flatnonzero(piece < 0)
        weight[bytewise] = self.odd_size[-1 - piece[bytewise]] * pieces.byte_weight
        # backward pass: log-sum of the weights of all ways to the end of the word, where no node follows and it stays 0
        beta = np.zeros(n + 1)
        longest = int(left.max()) if n else 0
        by_left = np.argsort(left.astype(np.uint16) if longest < 1 << 16 else left, kind="stable")
        cuts = np.cumsum(np.bincount(left)) if n else np.zeros(1, np.int64)
        counts = options[by_left]
        begins = np.concatenate([[0], np.cumsum(counts)])
        order = _ranges(self.first[by_left], counts)
        weight_of, next_of = weight[order], follows[order]
        for a, b in zip(cuts.tolist(), cuts[1:].tolist()):
            begin, end = begins[a], begins[b]
            at = begins[a:b] - begin
            value = weight_of[begin:end] + beta[next_of[begin:end]]
            top = np.maximum.reduceat(value, at)
            value -= np.repeat(top, counts[a:b])
            beta[by_left[a:b]] = top + np.log(np.add.reduceat(np.exp(value, out=value), at))
        del order, weight_of, next_of
        logp = weight + beta[follows]
        logp -= np.repeat(beta[:n], options)
        chance = np.exp(logp)
        order = np.argsort(2.0 * self.node - chance, kind="stable")  # likeliest option of each node first
        self.logp, self.next, self.piece = logp[order], follows[order].astype(np.int32), piece[order]
        self.share = np.cumsum(chance[order])
        self.share -= np.repeat(np.concatenate([[0.0], self.share])[self.first[:-1]], options)
        self.share[self.first[1:] - 1] = 2.0  # the last option takes what rounding leaves
        self.alone = options == 1  # nodes with one option

    def walk(self, node: np.ndarray, seed: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ancestral samples from each node to the end of its word: options, and how many for each."""
        where, picked, active, step = [], [], np.arange(len(node)), 0
        mixed = _counted(seed, word)
        while len(active):
            u = _fraction(mixed, step)
            option = self.first[node]
            later = np.flatnonzero(u >= self.share[option])
            while len(later):
                option[later] += 1
                later = later[u[later] >= self.share[option[later]]]
            where.append(active)
            picked.append(option)
            go = self.next[option]
            on = np.flatnonzero(go >= 0)
            active, node, mixed, step = active[on], go[on], mixed[on], step + 1
        counts = np.zeros(len(seed), np.int64)
        for w in where:
            counts[w] += 1
        out, begin = np.empty(int(counts.sum()), np.int64), np.cumsum(counts) - counts
        for step, (w, option) in enumerate(zip(where, picked)):
            out[begin[w] + step] = option
        return out, counts

    def ids(self, options: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids that paths emit whose options lie one after the other, and where those of each path begin."""
        ids = self.piece[options]
        odd = np.flatnonzero(ids < 0)
        if len(odd):
            which = -1 - ids[odd]
            sizes = np.ones(len(ids), np.int64)
            sizes[odd] = self.odd_size[which]
            end = np.concatenate([[0], np.cumsum(sizes)])
            ids = np.repeat(ids, sizes)
            ids[_ranges(end[odd], self.odd_size[which])] = self.odd_ids[_ranges(self.odd_at[which], self.odd_size[which])]
            cuts = end[cuts]
        return ids.astype(np.uint32), cuts


class _Search:
    """A-star state of one text: its sampled paths and the heap of perturbed bounds."""

    def __init__(self, seed: int, words: np.ndarray):
        self.seed, self.words = seed, words
        self.bound = -math.log(-math.log(self.noise(0, 0)))  # of the root: Gumbel(0)
        self.heap: list[tuple] = []  # (-bound, order, path, step, taken)
        self.paths: list[tuple[np.ndarray, np.ndarray, np.ndarray, float]] = []  # options, word ends, prefix, log-prob
        self.order = 0

    def noise(self, at: int, sample: int) -> float:
        return _one_uniform(self.seed ^ int(_NOISE), at, sample)

    def push(self, bound: float, path: int, step: int, taken: tuple) -> None:
        heapq.heappush(self.heap, (-bound, self.order, path, step, taken))
        self.order += 1

    def branch(self, lattice: Lattice) -> tuple[int, int, int] | None:
        """Takes the largest bound: the path and step to leave, and the option to leave by."""
        if not self.heap:
            return None
        bound, _, path, step, taken = heapq.heappop(self.heap)
        self.bound = -bound
        options, _, prefix, _ = self.paths[path]
        node = int(lattice.node[options[step]])
        begin, end = lattice.first[node:node + 2].tolist()
        free = [o for o in range(begin, end) if o not in taken]
        logp = lattice.logp[begin:end].tolist()
        chance = [math.exp(logp[o - begin]) for o in free]
        whole = sum(chance)
        u = self.noise(step, 1000 + 64 * path + len(taken)) * whole
        choice = min(bisect_right(list(accumulate(chance)), u), len(free) - 1)
        rest = whole - chance[choice]
        if len(free) > 1 and rest > 0:
            loc = float(prefix[step]) + math.log(rest)
            u = self.noise(step, 100_000 + 64 * path + len(taken))
            self.push(loc - math.log(math.exp(min(loc - self.bound, 700)) - math.log(u)), path, step,
                      (*taken, free[choice]))
        return path, step, free[choice]


def _push_rests(searches: list[_Search], path: int, begin: np.ndarray, lattice: Lattice, k: int) -> None:
    """Bounds of what is left beside this path of each search from its step ``begin`` on: truncated Gumbels below the path's
    own bound.

    Only the ``k`` largest can be asked for.  A uniform number of 53 bits has a Gumbel of at most 37, so the
    search along a path ends where no later step can reach them.
    """
    best: list[list[tuple[float, int]]] = [[] for _ in searches]
    end = np.array([len(s.paths[path][0]) for s in searches], dtype=np.int64)
    seed = np.array([s.seed for s in searches], dtype=np.uint64) ^ _NOISE
    bound = np.array([s.bound for s in searches])
    todo = np.flatnonzero(begin < end)
    while len(todo):
        at, n = begin[todo], np.minimum(end[todo] - begin[todo], 128)
        cuts = [(searches[s].paths[path], a, a + m) for s, a, m in zip(todo.tolist(), at.tolist(), n.tolist())]
        options = np.concatenate([p[0][a:b] for p, a, b in cuts])
        prefix = np.concatenate([p[2][a:b] for p, a, b in cuts])
        steps, owner = _ranges(at, n), np.repeat(todo, n)
        some = ~lattice.alone[lattice.node[options]]
        options, prefix, steps, owner = options[some], prefix[some], steps[some], owner[some]
        chance = np.minimum(np.exp(lattice.logp[options]), 1 - 1e-15)
        loc = prefix + np.log1p(-chance)
        noise = _uniform(seed[owner], steps, path + 1)
        value = loc - np.log(np.exp(np.minimum(loc - bound[owner], 700)) - np.log(noise))
        first = np.flatnonzero(np.diff(owner, prepend=-1))
        size = np.diff(np.append(first, len(owner)))
        for _ in range(min(k, int(size.max()) if len(size) else 0)):
            hits = np.flatnonzero(value == np.repeat(np.maximum.reduceat(value, first), size))
            hits = hits[np.isfinite(value[hits])]
            hits = hits[np.flatnonzero(np.diff(owner[hits], prepend=-1))]  # one a path
            for s, v, step in zip(owner[hits].tolist(), value[hits].tolist(), steps[hits].tolist()):
                best[s].append((v, step))
            value[hits] = -np.inf
        begin[todo] += 128
        on = []
        for s in todo[begin[todo] < end[todo]].tolist():
            best[s] = sorted(best[s], reverse=True)[:k]
            if len(best[s]) < k or searches[s].paths[path][2][begin[s]] + 37 >= best[s][-1][0]:
                on.append(s)
        todo = np.array(on, dtype=np.int64)
    for search, found in zip(searches, best):
        for value, step in sorted(found, reverse=True)[:k]:
            search.push(value, path, step, (int(search.paths[path][0][step]),))


def sample(texts: list[str], seeds: np.ndarray, k: int, pieces: Pieces):
    """Per text: ``[(ids, log-probability, log inclusion)]``, distinct, by falling perturbed log-probability."""
    codes, length, word, cuts = _units(texts)
    lattice = Lattice(codes, length, pieces)
    searches = [_Search(seed, word[a:b]) for seed, a, b in zip(seeds.tolist(), cuts[:-1].tolist(), cuts[1:].tolist())]
    todo = [(s, None) for s in range(len(searches))]
    for round_ in range(k):
        nodes, rows, words, kept = [], [], [], []
        for s, leave in todo:
            search = searches[s]
            if leave is None:
                head, ends, first, start = np.empty(0, np.int64), np.empty(0, np.int64), 0, lattice.start[search.words]
            else:
                path, step, option = leave
                options, ends, _, _ = search.paths[path]
                head = np.append(options[:step], option)
                first = int(np.searchsorted(ends, step, side="right"))
                ends, start = ends[:first], lattice.start[search.words[first + 1:]]
                if lattice.next[option] >= 0:
                    start = np.append(lattice.next[option], start)
                else:
                    ends = np.append(ends, step + 1)
                    first += 1
            nodes.append(start)
            words.append(np.arange(first, first + len(start)))
            rows.append((search.seed + round_ * int(_BASE)) & _ALL)
            kept.append((s, leave, head, ends))
        if not kept:
            break
        sizes = np.fromiter(map(len, nodes), dtype=np.int64, count=len(nodes))
        picked, counts = lattice.walk(np.concatenate(nodes), np.repeat(np.array(rows, dtype=np.uint64), sizes),
                                      np.concatenate(words))
        cut = np.concatenate([[0], np.cumsum(counts)])
        at, todo = 0, []
        for (s, leave, head, ends), size in zip(kept, sizes.tolist()):
            options = np.concatenate([head, picked[cut[at]:cut[at + size]]])
            ends = np.concatenate([ends, cut[at + 1:at + size + 1] + (len(head) - cut[at])])
            at += size
            steps = lattice.logp[options]
            total = np.cumsum(steps)
            searches[s].paths.append((options, ends, total - steps, float(total[-1]) if len(total) else 0.0))
        _push_rests([searches[s] for s, _, _, _ in kept], round_,
                    np.array([e[1] + 1 if e else 0 for _, e, _, _ in kept]), lattice, k)
        for s, _, _, _ in kept if round_ + 1 < k else ():
            out = searches[s].branch(lattice)
            if out is not None:
                todo.append((s, out))
    paths = [path[0] for search in searches for path in search.paths]
    cut = np.cumsum([0, *map(len, paths)])
    ids, cut = lattice.ids(np.concatenate(paths) if paths else np.empty(0, np.int64), cut)
    result, ends = [], iter(zip(cut.tolist(), cut[1:].tolist()))
    for search in searches:
        left = -search.heap[0][0] if search.heap else -math.inf
        found = []
        for (_, _, _, logp), (a, b) in zip(search.paths, ends):
            x = logp - left  # inclusion 1 - exp(-exp(x)), as a logarithm
            score = 0.0 if x > 30 else math.log(-math.expm1(-math.exp(x))) if x > -30 else x
            found.append((ids[a:b], logp, score))
        result.append(found)
    return result


_PIECES: dict[tuple[str, float], Pieces] = {}


def pieces_of(path: str, alpha: float = 0.5) -> Pieces:
    if (path, alpha) not in _PIECES:
        _PIECES[path, alpha] = Pieces(path, alpha)
    return _PIECES[path, alpha]


# ------------------------------------------------------------------ operators
def encoded(docs: DataFrame, model: str, text_col: str = "text", out_col: str = "ids") -> DataFrame:
    """``docs`` with the model's own encoding of the text, an array of ids."""
    ship(docs.sparkSession)

    @F.pandas_udf("array<int>")
    def encode(texts: pd.Series) -> pd.Series:
        p = pieces_of(model).processor
        return pd.Series(p.encode([t or "" for t in texts], num_threads=1))

    return docs.withColumn(out_col, encode(F.col(text_col)))


def decoded(rows: DataFrame, model: str, ids_col: str = "ids", out_col: str = "text") -> DataFrame:
    """``rows`` with the text that the ids spell."""
    ship(rows.sparkSession)

    @F.pandas_udf("string")
    def decode(ids: pd.Series) -> pd.Series:
        p = pieces_of(model)
        return pd.Series([None if x is None else p.decode(x).decode("utf-8", "replace") for x in ids])

    return rows.withColumn(out_col, decode(F.col(ids_col)))


def sampled(docs: DataFrame, model: str, k: int = 2, alpha: float = 0.5, seed: int = 1, key_col: str = "doc_id",
            text_col: str = "text", keep_ids: bool = False, batch_chars: int = 1_500_000) -> DataFrame:
    """Per row and sample: doc_id, sample (from 1), n_tokens, ids_crc32, log_prob, log_inclusion, round_trip (whether the
    ids spell the text) and, with ``keep_ids``, ids."""
    rows = docs.select(F.col(key_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                       F.xxhash64(F.col(key_col), F.lit(seed)).alias("seed"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = (f"doc_id {kind}, sample int, n_tokens long, ids_crc32 long, log_prob double, log_inclusion double, "
              "round_trip boolean" + (", ids binary" if keep_ids else ""))

    def part(batch, at, texts, p):
        seeds = batch.column("seed").to_numpy()[at:at + len(texts)].view(np.uint64)
        out = []
        for i, (text, found) in enumerate(zip(texts, sample(texts, seeds, k, p))):
            for n, (ids, logp, score) in enumerate(found, 1):
                raw = ids.astype("<u4").tobytes()
                out.append((at + i, n, len(ids), zlib.crc32(raw), logp, score, p.decode(ids) == text.encode(),
                            raw))
        columns = list(zip(*out))
        arrays = [batch.column("doc_id").take(pa.array(columns[0])), pa.array(columns[1], pa.int32()),
                  *(pa.array(c) for c in columns[2:7]), *([pa.array(columns[7])] if keep_ids else [])]
        return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "sample", "n_tokens", "ids_crc32", "log_prob",
                                                         "log_inclusion", "round_trip", *(["ids"] if keep_ids else [])])

    def draw(batches):
        p = pieces_of(model, alpha)
        for batch in batches:
            texts, at, size = [], 0, 0
            for text in batch.column("text").to_pylist():
                if texts and size + len(text) > batch_chars:
                    yield part(batch, at, texts, p)
                    at, texts, size = at + len(texts), [], 0
                texts.append(text)
                size += len(text)
            if texts:
                yield part(batch, at, texts, p)

    return map_arrow(rows, draw, schema)
