"""SimHash document fingerprints, in DataFrame operations only, and permuted block tables to search them.

A term is a run of `words` words; it votes with its length, so that likeness follows the share of text that two
documents have in common. The 64-bit hashes of a document's terms vote on signed bits: a bit is set if the terms that
have it outweigh those that lack it. Votes for bits j and j + 32 are summed in the two halves of one long, so a
document's votes are 32 sums that whole-stage code adds up row by row.

near() finds all pairs of fingerprints within a Hamming radius r: the bits are cut into r + 1 blocks, each block leads
one permuted table, and any pair within r agrees in at least one block; candidates are then compared in full.

Defined cases: a null text is an empty text; a text without words has the fingerprint of zeros; one with fewer words
than a term needs is one term. Equal texts have equal fingerprints. Repeated rows keep rows of their own, the order
among equal ids is that of their texts; a null doc_id stands before all others. An empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from facetry.llm.common import text_or_empty

_PAIR = (1 << 32) | 1


def words_of(text: Column) -> Column:
    """The words between white space; no empty ones."""
    return F.filter(F.split(text, r"[ \t-\r]+"), lambda w: w != "")


def votes(rows: DataFrame, keys: list[str], text: Column, words: int) -> DataFrame:
    """keys and `fp` (64-bit long) for each row of `rows`; keys tell rows apart and hold the partitioning column."""
    w = words_of(text)
    n = F.size("_w")
    places = F.when(n == 0, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.greatest(n - words, F.lit(0))))
    each = rows.select(*keys, w.alias("_w")).select(*keys, "_w", F.explode(places).alias("_i"))
    term = F.concat_ws(" ", *[F.get(F.col("_w"), F.col("_i") + j) for j in range(words)])
    each = each.select(*keys, F.xxhash64(term).alias("_h"), F.when(n > 0, F.char_length(term)).otherwise(0).cast("long").alias("_v"))
    sums = [F.sum(F.col("_v") * F.shiftrightunsigned("_h", j).bitwiseAND(F.lit(_PAIR))).alias(f"_s{j}") for j in range(32)]
    summed = each.groupBy(*keys).agg(F.sum("_v").alias("_all"), *sums)
    fp = F.lit(0).cast("long")
    for j in range(32):
        low = F.col(f"_s{j}").bitwiseAND(F.lit(0xFFFFFFFF)) * 2 > F.col("_all")
        high = F.shiftrightunsigned(f"_s{j}", 32) * 2 > F.col("_all")
        fp = fp.bitwiseOR(F.when(low, F.shiftleft(F.lit(1).cast("long"), j)).otherwise(F.lit(0).cast("long")))
        fp = fp.bitwiseOR(F.when(high, F.shiftleft(F.lit(1).cast("long"), j + 32)).otherwise(F.lit(0).cast("long")))
    return summed.select(*keys, fp.alias("fp"))


def likeness(a: Column, b: Column) -> Column:
    """Cosine of the angle that the differing bits speak of, not below 0: 1 for equal, about 0 for unrelated."""
    angle = F.bit_count(a.bitwiseXOR(b)) * F.lit(3.141592653589793 / 64)
    return F.when(a == b, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.cos(angle)))


def as_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def fingerprints(docs: DataFrame, *, words: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """uid, doc_id, fp of every document."""
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return votes(rows, ["uid", "doc_id"], F.col("text"), words)


def near(prints: DataFrame, radius: int = 3) -> DataFrame:
    """Pairs (fp_a < fp_b) of distinct fingerprints within the radius, by radius + 1 permuted block tables."""
    distinct = prints.select("fp").distinct()
    blocks, cuts = radius + 1, [64 * i // (radius + 1) for i in range(radius + 2)]
    part = [F.shiftrightunsigned("fp", cuts[i]).bitwiseAND(F.lit((1 << (cuts[i + 1] - cuts[i])) - 1)) for i in range(blocks)]
    tables = distinct.select("fp", F.posexplode(F.array(*part)).alias("block", "value"))
    a, b = tables.withColumnRenamed("fp", "fp_a"), tables.withColumnRenamed("fp", "fp_b")
    return a.join(b, ["block", "value"]).where((F.col("fp_a") < F.col("fp_b")) & (F.bit_count(F.col("fp_a").bitwiseXOR(F.col("fp_b"))) <= radius)).select("fp_a", "fp_b").distinct()


def with_next(docs: DataFrame, *, bucket_rows: int = 256, most_buckets: int = 8192, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document with the next one by ascending id (after the last: the first): bucket, uid, doc_id, text, next_text, next_uid.

    Ids are cut at their quantiles into buckets (`most_buckets` cut points at most come to the driver); the first
    document of each bucket also goes to the bucket before, so every document meets its next one in one shuffle.
    """
    ids = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("k"))
    n = ids.count()
    m = max(1, min(most_buckets, n // bucket_rows))
    cuts = ids.agg(F.expr(f"approx_percentile(k, array({', '.join(repr(i / m) for i in range(1, m))}), {10 * m})")).first()[0] if m > 1 else []
    cuts = sorted(set(cuts or []))
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63)))
    bucket = _bucket_of(key, cuts)
    firsts = sorted((r.b, r.k) for r in docs.select(key.alias("k")).groupBy(_bucket_of(F.col("k"), cuts).alias("b")).agg(F.min("k").alias("k")).collect())
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(id_col).cast("long").alias("doc_id"), key.alias("k"), text_or_empty(text_col).alias("text"), bucket.alias("b"))
    before = {firsts[i][0]: firsts[i - 1][0] for i in range(len(firsts))}
    spark = docs.sparkSession
    halo = spark.createDataFrame([(b, k, before[b]) for b, k in firsts], "hb int, hk long, hto int")
    rows = rows.join(F.broadcast(halo), (F.col("b") == F.col("hb")) & (F.col("k") == F.col("hk")), "left")
    goes = F.when(F.col("hto").isNull(), F.array(F.struct(F.col("b").alias("bucket"), F.lit(0).alias("halo")))).otherwise(F.array(F.struct(F.col("b").alias("bucket"), F.lit(0).alias("halo")), F.struct(F.col("hto").alias("bucket"), F.lit(1).alias("halo"))))
    spread = rows.withColumn("g", F.explode(goes)).select("g.bucket", "g.halo", "uid", "doc_id", "k", "text")
    order = Window.partitionBy("bucket").orderBy("halo", "k", "text", "uid")
    led = spread.withColumns({"next_text": F.lead("text").over(order), "next_uid": F.lead("uid").over(order)})
    return led.where(F.col("halo") == 0).select("bucket", "uid", "doc_id", "text", "next_text", "next_uid")


def _bucket_of(key: Column, cuts: list[int]) -> Column:
    """How many cut points are <= key, by binary search over a literal array."""
    if not cuts:
        return F.lit(0)
    steps = (len(cuts)).bit_length()
    found = F.aggregate(
        F.sequence(F.lit(1), F.lit(steps)),
        F.struct(F.lit(0).alias("lo"), F.lit(len(cuts)).alias("hi")),
        lambda acc, _: _halved(acc, key, F.array(*[F.lit(c).cast("long") for c in cuts])),
        lambda acc: acc["lo"],
    )
    return found


def _halved(acc: Column, key: Column, cuts: Column) -> Column:
    mid = F.floor((acc["lo"] + acc["hi"]) / 2).cast("int")
    right = (acc["lo"] < acc["hi"]) & (F.get(cuts, mid) <= key)
    return F.struct(F.when(right, mid + 1).otherwise(acc["lo"]).alias("lo"), F.when(right | (acc["lo"] >= acc["hi"]), acc["hi"]).otherwise(mid).alias("hi"))


def with_edited(docs: DataFrame, *, words: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edited text, whose last half is the start of the next document's.

    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.
    """
    rows = with_next(docs, id_col=id_col, text_col=text_col)
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half))
    rows = rows.select("bucket", "uid", "doc_id", "next_uid", n.cast("long").alias("n_chars"), "text", edited.alias("edited"))
    both = rows.select("bucket", "uid", "doc_id", "next_uid", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), F.posexplode(F.array("text", "edited")).alias("which", "t"))
    keys = ["bucket", "uid", "doc_id", "next_uid", "n_chars", "edited_sha256", "which"]
    voted = votes(both, keys, F.col("t"), words)
    per = voted.groupBy(*keys[:-1]).agg(F.max(F.when(F.col("which") == 0, F.col("fp"))).alias("fp"), F.max(F.when(F.col("which") == 1, F.col("fp"))).alias("efp"))
    return per


def digest(per: DataFrame) -> DataFrame:
    """The rows of with_edited with the next document's fingerprint joined in, as they are reported."""
    following = per.select(F.col("uid").alias("nuid"), F.col("fp").alias("nfp"))
    joined = per.join(following, F.col("next_uid") == F.col("nuid"), "left")
    return joined.select("doc_id", "n_chars", "edited_sha256", as_hex(F.col("fp")).alias("fingerprint"), as_hex(F.col("efp")).alias("edited_fingerprint"), likeness(F.col("fp"), F.col("efp")).alias("near_edited"), likeness(F.col("fp"), F.col("nfp")).alias("near_next"))
