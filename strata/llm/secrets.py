"""Secret scanning: fixed patterns, and character Markov models of random strings and ordinary identifiers.

Everything runs as DataFrame expressions.  The patterns give the base spans.  Further candidates are tokens of 10 or more
characters, of whatever kind; a token is a secret where the log-likelihood ratio of two first-order character
models, one of random strings and one of ordinary identifiers, is at least ``min_ratio`` per character.  Both models
are trained from a labelled sample (token, secret or not): character transitions are counted in Spark, and two tables of
67 x 67 counts reach the driver.

Offsets count code points, ends are exclusive.  Defined results: NULL text is empty (no spans); repeated rows and NULL
ids are rows like any other; an empty table gives no rows; a sample without secrets leaves the random model uniform.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The patterns of the base kinds, in the order in which kinds are listed.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"  # the runs of [0-9a-f]+ with 24 or more characters
KINDS = ("assign", "access", "hex", "markov")
CANDIDATE = r"[A-Za-z0-9+/_=-]{10,}"
SYMBOLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_SPAN = "struct<start:int,end:int,kind:int>"
_SPANS = f"array<{_SPAN}>"


def _walk(text: Column, pattern: str, value_group: int, keep, kind: int) -> Column:
    """Spans of the leftmost non-overlapping matches whose value (a group) ``keep`` accepts.

    The text between the matches comes from a split at the same pattern; running lengths give the offsets.
    """
    items = F.arrays_zip(F.split(text, pattern, -1).alias("gap"),
                         F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"),
                         F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group)).alias("value"))

    def step(done, item):
        start = done["at"] + F.length(item["gap"])
        end = start + F.coalesce(F.length(item["hit"]), F.lit(0))
        span = F.struct(start.alias("start"), end.alias("end"), F.lit(kind).alias("kind")).cast(_SPAN)
        return F.struct(end.alias("at"), F.when(F.coalesce(keep(item["value"]), F.lit(False)),
                                                F.concat(done["spans"], F.array(span)))
                        .otherwise(done["spans"]).alias("spans"))

    nothing = F.array().cast(_SPANS)
    zero = F.struct(F.lit(0).alias("at"), nothing.alias("spans"))
    walked = F.aggregate(items, zero, step, lambda done: done["spans"])
    return F.when(text.rlike(pattern), walked).otherwise(nothing)


def base_spans(text: Column) -> Column:
    """Spans of the three fixed kinds, ordered by start, then kind."""
    found = F.concat(_walk(text, ASSIGN, 2, lambda v: F.length(v) >= 6, 0),
                     _walk(text, ACCESS, 0, lambda v: F.length(v) >= 20, 1),
                     _walk(text, HEX, 0, lambda v: F.length(v) >= 24, 2))
    return _ordered(found)


def _ordered(spans: Column) -> Column:
    by = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"),
                                               s["end"].alias("end")))
    return F.transform(F.array_sort(by), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"),
                                                            s["kind"].alias("kind")))


# ------------------------------------------------------------------ Markov models
def labelled_sample(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    max_docs: int = 20_000) -> DataFrame:
    """``token, secret`` from about ``max_docs`` documents chosen by id hash: what the fixed patterns find is a
    secret; other words of five or more characters are ordinary identifiers, numbers and marks among them, since the
    ratio judges those too."""
    total = docs.count()
    share = min(1.0, max_docs / max(total, 1))
    part = docs.filter(F.pmod(F.xxhash64(id_col), F.lit(1 << 20)) < int(share * (1 << 20)))
    text = F.coalesce(F.col(text_col), F.lit(""))
    hits = F.concat(*(F.regexp_extract_all(text, F.lit(p), F.lit(g)) for p, g in ((ASSIGN, 2), (ACCESS, 0), (HEX, 0))))
    secrets = F.filter(hits, lambda v: F.length(v) >= 16)
    rest = F.regexp_replace(F.regexp_replace(F.regexp_replace(text, ASSIGN, " "), ACCESS, " "), HEX, " ")
    words = F.regexp_extract_all(rest, F.lit(r"[A-Za-z0-9+/_=-]{5,}"), F.lit(0))
    return part.select(F.explode(F.array(F.struct(F.lit(True).alias("secret"), secrets.alias("tokens")),
                                         F.struct(F.lit(False).alias("secret"), words.alias("tokens")))).alias("s")) \
        .select("s.secret", F.explode("s.tokens").alias("token"))


def train(sample: DataFrame, backoff: float = 5.0) -> list[float]:
    """Log-likelihood ratios (random over ordinary) of the transitions, row by row of ``SYMBOLS``.

    A transition's probability backs off, with the weight of ``backoff`` counts, to how frequent the character is; for
    random strings half of that is uniform.  Tokens are counted once per distinct text first, so that a frequent word
    costs one row.
    """
    n = len(SYMBOLS)
    tokens = sample.groupBy("secret", "token").agg(F.count("*").alias("n")).filter(F.length("token") > 1)
    chars = tokens.select("secret", "n", F.split("token", "", -1).alias("c"))
    after = F.arrays_zip(F.slice("c", 1, F.size("c") - 1).alias("a"), F.slice("c", 2, F.size("c") - 1).alias("b"))
    pairs = chars.select("secret", "n", F.explode(after).alias("p")) \
        .groupBy("secret", F.concat("p.a", "p.b").alias("pair")).agg(F.sum("n").alias("n")).collect()
    place = {c: i for i, c in enumerate(SYMBOLS)}
    counts = {True: [[0.0] * n for _ in range(n)], False: [[0.0] * n for _ in range(n)]}
    for row in pairs:
        if row["pair"][0] in place and row["pair"][1] in place:
            counts[row["secret"]][place[row["pair"][0]]][place[row["pair"][1]]] += row["n"]

    def logs(table, uniform):
        every = sum(map(sum, table)) + 0.5 * n
        single = [(sum(r[j] for r in table) + 0.5) / every for j in range(n)]
        single = [uniform / n + (1 - uniform) * x for x in single]
        return [math.log((r[j] + backoff * single[j]) / (sum(r) + backoff)) for r in table for j in range(n)]

    return [a - b for a, b in zip(logs(counts[True], 0.5), logs(counts[False], 0.0))]


def _ratio(token: Column, model: list[float]) -> Column:
    """Mean log-likelihood ratio per transition."""
    n = len(SYMBOLS)
    table = F.split(F.lit(",".join(f"{x:.6f}" for x in model)), ",").cast("array<double>")
    place = F.split(F.lit(",".join(str(SYMBOLS.find(chr(i))) for i in range(128))), ",").cast("array<int>")

    def step(done, c):
        here = F.get(place, F.ascii(c))
        gain = F.when(done["last"] < 0, 0.0).otherwise(F.get(table, done["last"] * n + here))
        return F.struct((done["sum"] + gain).alias("sum"), here.alias("last"))

    # the token is cut into its characters once, so the time grows with its length alone
    start = F.struct(F.lit(0.0).alias("sum"), F.lit(-1).alias("last"))
    total = F.aggregate(F.split(token, "", -1), start, step, lambda done: done["sum"])
    return total / (F.length(token) - 1)


def scan(docs: DataFrame, model: list[float], min_ratio: float = 1.0, text_col: str = "text",
         out_col: str = "secret_spans") -> DataFrame:
    """``docs`` with ``out_col``: array of (start, end, kind), ordered by start, then kind (index into ``KINDS``).

    A Markov span never overlaps a base span; an input column named ``out_col`` is replaced.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.withColumn(out_col, base_spans(text))
    more = _walk(text, CANDIDATE, 0, lambda v: _ratio(v, model) >= F.lit(min_ratio), 3)
    free = F.filter(more, lambda c: ~F.exists(out_col, lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])))
    return base.withColumn(out_col, F.concat(F.col(out_col), free)).withColumn(out_col, _ordered(F.col(out_col)))


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"], s["end"])),
                        ",")


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with each run of overlapping spans as ``mark``; text without spans is returned as it is."""
    def step(done, span):
        gap = text.substr(done["at"] + 1, span["start"] - done["at"])
        fresh = span["start"] >= done["at"]
        return F.struct(F.greatest(done["at"], span["end"]).alias("at"),
                        F.when(fresh, F.concat(done["out"], gap, F.lit(mark))).otherwise(done["out"]).alias("out"))

    walked = F.aggregate(spans, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step,
                         lambda done: F.concat(done["out"], text.substr(done["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, walked).otherwise(text)
