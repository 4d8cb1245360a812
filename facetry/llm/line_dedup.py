"""Line dedup, in DataFrame operations only.

Lines are exploded, normalised and hashed (two chained 64-bit hashes). Distinct documents per hash are counted in two
steps, so that a line which stands in a third of all documents is first counted per task. A line found in at least
`min_docs` documents is dropped everywhere but in the document with the largest id that holds it; the documents are put
together again by position. Neither the texts nor the lines' text are shuffled for counting, only hashes; the lines that
go are found by joins: those with a thousandth of all rows or more, a thousand keys at most, by a broadcast, the rest by
their hashes.

Defined cases: a null text is an empty text, and both are one empty line. A null doc_id counts as one document, smaller
than any other. Rows with the same id are one document for counting; equal rows give equal results, as often as they
stand there. Other columns are passed through, those named n_lines and n_dropped are replaced. Lines shorter than
`min_chars` always stay, and an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from facetry.llm.common import join_spread, text_or_empty, written

#: The characters [\\x20\\x09-\\x0D], stripped at both ends.
BLANKS = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z, nothing else; lower() does just that where all is ASCII, and faster."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, _UPPER, _LOWER))


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def dedup_lines(docs: DataFrame, *, min_chars: int = 20, min_docs: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents' columns with the kept text, and n_lines, n_dropped."""
    text = text_or_empty(text_col)
    base = docs.drop("n_lines", "n_dropped")
    ident = F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63)))
    rows = docs.select(ident.alias("_id"), F.xxhash64(text).alias("_th"), F.posexplode(F.split(text, "\n")).alias("_pos", "_line"))
    keyed = rows.select("_id", "_th", "_pos", line_key(F.col("_line")).alias("_key")).where(F.char_length("_key") >= min_chars)
    lines = written(keyed.select("_id", "_th", "_pos", F.xxhash64("_key").alias("_h1"), F.xxhash64(F.lit("line"), "_key").alias("_h2")), "lines")
    counted = lines.groupBy("_h1", "_h2", "_id").agg(F.count(F.lit(1)).alias("_n")).groupBy("_h1", "_h2")
    found = written(counted.agg(F.count(F.lit(1)).alias("_docs"), F.sum("_n").alias("_rows"), F.max("_id").alias("_last")).where(F.col("_docs") >= min_docs), "found")
    drops = join_spread(lines, found.select("_h1", "_h2", "_rows", "_last"), ["_h1", "_h2"], lines.count(), "_rows").where(F.col("_id") != F.col("_last"))
    gone = drops.groupBy("_id", "_th").agg(F.array_distinct(F.collect_list("_pos")).alias("_gone")).withColumnsRenamed({"_id": "_gid", "_th": "_gth"})
    keyed_docs = base.withColumns({"_id": ident, "_th": F.xxhash64(text)})
    joined = keyed_docs.join(gone, (F.col("_id") == F.col("_gid")) & (F.col("_th") == F.col("_gth")), "left")
    all_lines = F.split(text, "\n")
    # array_except keeps the order of its first array and works by hashing, and the text is split once, so a long document stays linear
    places = F.array_except(F.sequence(F.lit(0), F.size(all_lines) - 1), F.col("_gone"))
    kept = F.element_at(F.transform(F.array(all_lines), lambda lines: F.transform(places, lambda i: F.element_at(lines, i + 1))), 1)
    out = joined.withColumns({"n_lines": F.size(all_lines).cast("long"), "n_dropped": F.coalesce(F.size("_gone"), F.lit(0)).cast("long"), "_kept": F.when(F.col("_gone").isNull(), text).otherwise(F.array_join(kept, "\n"))})
    return out.withColumn(text_col, F.col("_kept")).drop("_id", "_th", "_gid", "_gth", "_gone", "_kept")


SQL = r"""
WITH lines AS (
  SELECT d.doc_id, u.pos, u.line,
         translate(trim(u.line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM documents d, LATERAL (SELECT unnest(string_split(coalesce(d.text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(d.text, ''), chr(10)), 1) AS pos) u
), found AS (
  SELECT k, max(doc_id) AS last_id FROM lines WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3
), marked AS (
  SELECT l.doc_id, l.pos, l.line, f.k IS NOT NULL AND l.doc_id <> f.last_id AS gone FROM lines l LEFT JOIN found f ON l.k = f.k
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
