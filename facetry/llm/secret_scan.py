"""Secret scans, in DataFrame operations only.

Base patterns (assignments to password-like names, access keys, hexadecimal runs) and, beyond them, candidate strings in
which a sliding window reaches a high Shannon entropy. Each character class has its own alphabet, window and threshold;
the window's counts are kept incrementally: they stand in a string, one character per letter of the alphabet; one letter
comes in, one goes out, two cells are overlaid and the sum of n * log2(n) follows. What hot windows cover are the spans.
An allow-list suppresses candidates that look random but are no secrets (see ALLOW); it never touches base spans.

Positions are code points. A regular expression's matches lie between the pieces that split() leaves, so their places
are running sums over pieces and matches, taken in a window over the document's own (short) rows; texts aren't shuffled.
redact() works within the row: it joins the pieces and the masked matches again, without a join or shuffle.

Defined cases: a null or empty text has no spans, empty digests of no spans, and keeps its row; repeated rows give
repeated rows; a null doc_id is kept; further columns are ignored by scan() and passed through by redact().
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from facetry.llm.common import text_or_empty

KINDS = ("assign", "access", "hex")
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: class: (candidate pattern, alphabet, window, least bits). A window of 20 can reach 4.32 bits, one of 24 4.58.
CLASSES = {
    "hexlike": (r"[0-9A-Fa-f]{20,}", "0123456789abcdef", 20, 3.0),
    "base64": (r"[A-Za-z0-9+/_=-]{24,}", "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ+/_=-", 24, 3.9),
}
#: Candidates that are let go: digits only, no digit at all (words), a UUID, or one digit or letter over and over.
ALLOW = (r"^[0-9]+$", r"^[^0-9]+$", r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$", r"^(.{1,4})\1+.{0,3}$")
#: What may stand before a candidate that is a published digest.
ALLOW_BEFORE = r"(?i)(sha-?(1|224|256|384|512)|md5|etag|commit|checksum|digest)[\"']?\s*[:=-]?\s*[\"']?$"


def _matches(text: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def _listed(kind: str, text: Column, pattern: str, group: int = 0) -> Column:
    """The matches in order: kind, number, length of the piece before, the match, and its runs (1-based, inclusive) that are spans."""
    found = _matches(text, pattern)
    pieces = F.split(text, pattern, -1)
    extra = _matches(text, pattern, group) if group else F.transform(found, lambda m: m)

    def one(x: Column, i: Column) -> Column:
        n = F.char_length(x["m"])
        return F.struct(F.lit(kind).alias("kind"), i.alias("i"), F.char_length(x["p"]).alias("gap"), n.alias("len"), x["m"].alias("m"), _runs(kind, x["m"], x["e"], F.right(x["p"], F.lit(24)), n).alias("runs"))

    return F.transform(F.arrays_zip(found.alias("m"), F.slice(pieces, F.lit(1), F.size(found)).alias("p"), extra.alias("e")), one)


_RUNS = "array<struct<first:int,last:int>>"


def _runs(kind: str, match: Column, extra: Column, before: Column, n: Column) -> Column:
    """What of a match is a span: all of it or nothing for a base kind, what hot windows cover for the others."""
    none = F.expr(f"cast(array() as {_RUNS})")
    if kind in KINDS:
        least = {"assign": 12, "access": 18, "hex": 16}[kind]
        return F.when((F.char_length(extra) if kind == "assign" else n) >= least, F.array(F.struct(F.lit(1).alias("first"), n.alias("last")))).otherwise(none)
    allowed = before.rlike(ALLOW_BEFORE)
    for p in ALLOW:
        allowed = allowed | match.rlike(p)
    _, alphabet, window, least = CLASSES[kind]
    return F.when(allowed, none).otherwise(hot_runs(F.lower(match) if kind == "hexlike" else match, alphabet, window, least))


def _none() -> Column:
    return F.expr(f"cast(array() as array<struct<kind:string,i:int,gap:int,len:int,m:string,runs:{_RUNS}>>)")


def _once(value: Column, f) -> Column:
    """f(value) with value computed once, though f names it often."""
    return F.element_at(F.transform(F.array(value), f), 1)


def hot_runs(candidate: Column, alphabet: str, window: int, least: float) -> Column:
    """The runs of characters that windows of at least `least` bits cover, 1-based and inclusive, in order."""
    xlog = lambda n: F.when(n > 1, n * F.log2(n.cast("double"))).otherwise(0.0)
    cell = lambda k, at: F.ascii(F.substring(k, at, F.lit(1))) - 64
    put = lambda k, at, n: F.overlay(k, F.char(n + 64), at, F.lit(1))
    code = lambda ch, i: F.instr(F.lit(alphabet), F.element_at(ch, i))

    def counted(acc: Column, at: Column, step: int) -> Column:
        """One letter more or less in the window."""
        n = cell(acc["k"], at)
        return _once(n, lambda n: F.struct(put(acc["k"], at, n + step).alias("k"), (acc["s"] - xlog(n) + xlog(n + step)).alias("s")))

    def moved(ch: Column, acc: Column, i: Column) -> Column:
        entered = counted(acc, code(ch, i), 1)
        return _once(entered, lambda a: F.when(i > window, counted(a, code(ch, i - window), -1)).otherwise(a))

    def judged(acc: Column, a: Column, i: Column) -> Column:
        last = F.try_element_at(acc["runs"], F.lit(-1))
        fresh = F.struct((i - window + 1).alias("first"), i.alias("last"))
        longer = F.concat(F.slice(acc["runs"], F.lit(1), F.size(acc["runs"]) - 1), F.array(F.struct(last["first"].alias("first"), i.alias("last"))))
        grown = F.when((F.size(acc["runs"]) > 0) & (last["last"] >= i - window), longer).otherwise(F.concat(acc["runs"], F.array(fresh)))
        hot = (i >= window) & (math.log2(window) - a["s"] / window >= least - 1e-9)
        return F.struct(a["k"].alias("k"), a["s"].alias("s"), F.when(hot, grown).otherwise(acc["runs"]).alias("runs"))

    def runs(ch: Column) -> Column:
        start = F.struct(F.lit("@" * (len(alphabet) + 1)).alias("k"), F.lit(0.0).alias("s"), F.expr(f"cast(array() as {_RUNS})").alias("runs"))
        return F.aggregate(F.sequence(F.lit(1), F.size(ch)), start, lambda acc, i: _once(moved(ch, acc, i), lambda a: judged(acc, a, i)), lambda acc: acc["runs"])

    return _once(F.split(candidate, ""), runs)


def _found(text: Column) -> dict[str, tuple[Column, str]]:
    """For each kind its matches in a text, and its pattern."""
    return {
        "assign": (F.when(text.contains("=") | text.contains(":"), _listed("assign", text, ASSIGN, 2)).otherwise(_none()), ASSIGN),
        "access": (F.when(text.contains("AKIA"), _listed("access", text, r"AKIA[A-Z0-9]+")).otherwise(_none()), r"AKIA[A-Z0-9]+"),
        "hex": (F.when(text.rlike(r"[0-9a-f]{16}"), _listed("hex", text, r"[0-9a-f]{16,}")).otherwise(_none()), r"[0-9a-f]{16,}"),
        **{name: (F.when(text.rlike(pattern), _listed(name, text, pattern)).otherwise(_none()), pattern) for name, (pattern, *_) in CLASSES.items()},
    }


def spans(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per span and one with null kind per document without: uid, doc_id, kind, start, stop (0-based, exclusive)."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"), F.monotonically_increasing_id().alias("uid"))
    listed = [found for found, _ in _found(F.col("text")).values()]
    slim = F.transform(F.flatten(F.array(*listed)), lambda x: x.dropFields("m"))
    each = rows.select("uid", "doc_id", F.explode_outer(slim).alias("x")).select("uid", "doc_id", "x.*")
    run = Window.partitionBy("uid", "kind").orderBy("i")
    placed = each.withColumn("start", F.sum(F.col("gap") + F.col("len")).over(run) - F.col("len"))
    every = placed.select("uid", "doc_id", "kind", "start", F.explode_outer("runs").alias("r"))
    return every.select("uid", "doc_id", F.when(F.col("r").isNotNull(), F.col("kind")).alias("kind"), (F.col("start") + F.col("r.first") - 1).alias("start"), (F.col("start") + F.col("r.last")).alias("stop"))


def scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: uid, doc_id, n_<kind>, base_sha256, spans as string, and span_list (structs)."""
    found = spans(docs, id_col=id_col, text_col=text_col)
    names = [*KINDS, *CLASSES]
    rank = F.coalesce(*[F.when(F.col("kind") == k, F.lit(i)) for i, k in enumerate(names)])
    one = F.struct("start", rank.alias("rank"), "kind", "stop")
    per_doc = found.groupBy("uid", "doc_id").agg(
        *[F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in names],
        F.array_sort(F.collect_list(F.when(F.col("kind").isNotNull(), one))).alias("span_list"),
    )

    def said(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")

    return per_doc.withColumns({"base_sha256": F.sha2(said(F.filter("span_list", lambda s: s["rank"] < len(KINDS))), 256), "spans": said(F.col("span_list"))})


#: Noncharacters that stand for masked text while kinds are put together; the first that a text doesn't hold is taken.
_BLANKS = "".join(chr(0xFDD0 + i) for i in range(8))


def redact(docs: DataFrame, *, mark: str = "[SECRET]", text_col: str = "text") -> DataFrame:
    """The documents' columns with every span (overlapping or touching ones as one) replaced by `mark`.

    A text that holds all eight noncharacters U+FDD0 to U+FDD7 loses those of the last kind where it holds a secret, too.
    """
    text = text_or_empty(text_col)
    blank = F.coalesce(*[F.when(~text.contains(c), F.lit(c)) for c in _BLANKS[:-1]], F.lit(_BLANKS[-1]))
    found = {kind: (matches, pattern) for kind, (matches, pattern) in _found(text).items()}
    rows = docs.withColumns({f"_m_{kind}": matches for kind, (matches, _) in found.items()} | {"_blank": blank})

    def masked(x: Column) -> Column:
        """A match with its runs blanked."""
        done = F.aggregate(
            x["runs"],
            F.struct(F.lit("").alias("t"), F.lit(0).alias("at")),
            lambda acc, r: F.struct(F.concat(acc["t"], F.substring(x["m"], acc["at"] + 1, r["first"] - acc["at"] - 1), F.repeat(F.col("_blank"), r["last"] - r["first"] + 1)).alias("t"), r["last"].alias("at")),
        )
        return _once(done, lambda d: F.concat(d["t"], F.substring(x["m"], d["at"] + 1, x["len"])))

    versions = []
    for kind, (_, pattern) in found.items():
        hit = F.exists(F.col(f"_m_{kind}"), lambda x: F.size(x["runs"]) > 0)
        joined = F.array_join(F.zip_with(F.split(text, pattern, -1), F.transform(f"_m_{kind}", masked), lambda p, m: F.concat(p, F.coalesce(m, F.lit("")))), "")
        versions.append(F.when(hit, joined))
    rows = rows.withColumn("_versions", F.array_compact(F.array(*versions)))
    both = lambda acc, v: F.array_join(F.zip_with(F.split(acc, ""), F.split(v, ""), lambda a, b: F.when(a == F.col("_blank"), a).otherwise(b)), "")
    one = F.aggregate(F.slice("_versions", F.lit(2), F.size("_versions")), F.element_at("_versions", 1), both)
    out = F.when(F.size("_versions") > 0, F.regexp_replace(one, F.concat(F.col("_blank"), F.lit("+")), F.lit(mark))).otherwise(F.col(text_col))
    return rows.withColumn(text_col, out).drop("_versions", "_blank", *[f"_m_{kind}" for kind in found])
