"""Fingerprints, secret scans and line dedup: against plain Python, and without Python in their plans."""

import hashlib
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from facetry.llm import line_dedup, secret_scan, simhash
from tests.llm.fixtures import SF, TEXTS, docs, words

ASSIGN = re.compile(r"""((?:(?i:password|passwd|secret|token|api_?key)))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)


def base_secrets(t):
    t = t or ""
    out = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 12]
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 16]
    return sorted(out)


def _native(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan), plan


def test_secrets_match_brute_force(spark):
    rng = random.Random(5)
    parts = ["token", "Secret", "api_key", "=", ":", " ", '"', "AKIA", "ABCDEFGHJKMNPQR1", "0123456789abcdef", "ff", "é", "\n", "🙂", "password=", "a-b.c/d+e_f="]
    texts = TEXTS + ["".join(rng.choice(parts) for _ in range(rng.randint(1, 14))) for _ in range(400)]
    df = secret_scan.scan(docs(spark, texts))
    _native(df)
    got = {r.doc_id: r for r in df.collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts, 10):
        want = base_secrets(t)
        said = ",".join(f"{k}:{s}:{e}" for s, _, k, e in want)
        assert got[i].base_sha256 == hashlib.sha256(said.encode()).hexdigest(), (t, got[i].spans, said)
        assert [got[i].n_assign, got[i].n_access, got[i].n_hex] == [sum(x[2] == k for x in want) for k in ("assign", "access", "hex")]
        assert set(said.split(",")) - {""} <= set(got[i].spans.split(","))


def _entropy(s):
    return -sum(c / len(s) * math.log2(c / len(s)) for c in (s.count(x) for x in set(s)))


def test_entropy_windows(spark):
    rng = random.Random(6)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    cands = ["".join(rng.choice(alphabet) for _ in range(rng.randint(24, 60))) for _ in range(30)] + ["Aa1" * 12, "Zq" * 20 + "x9K2mQ7vTbL4nR8sWc3dYf6g", "0" * 30 + "Zk3Qp8Xv2Lm7Tn5Rb9Wd4Hs6", "Zk3Qp8Xv2Lm7Tn5Rb9Wd4Hs6" + "a1" * 40 + "Yk3Qp8Xv2Lm7Tn5Rb9Wd4Hs7z"]
    got = {r.doc_id: r.spans for r in secret_scan.scan(docs(spark, ["x " + c + " y" for c in cands])).collect()}
    _, _, w, least = secret_scan.CLASSES["base64"]
    for i, c in enumerate(cands, 10):
        hot = [k for k in range(len(c) - w + 1) if _entropy(c[k : k + w]) >= least - 1e-9]
        allowed = any(re.search(p, c) for p in secret_scan.ALLOW)
        runs = []
        for k in hot if not allowed else ():
            if runs and k <= runs[-1][1]:
                runs[-1][1] = k + w
            else:
                runs.append([k, k + w])
        assert [s for s in got[i].split(",") if s.startswith("base64")] == [f"base64:{2 + a}:{2 + b}" for a, b in runs], c


def test_allow_list(spark):
    texts = ["id 123e4567-e89b-12d3-a456-426614174000 end", "sha256: 9F86D081884C7D659A2FEAA0C55AD015A3BF4F1B", "key 9F86D081884C7D659A2FEAA0C55AD015A3BF4F1B"]
    got = [r.n_hexlike + r.n_base64 for r in secret_scan.scan(docs(spark, texts)).orderBy("doc_id").collect()]
    assert got[:2] == [0, 0] and got[2] > 0


def test_redaction(spark):
    df = secret_scan.redact(docs(spark).drop("n", "fp", "keep"))
    assert df.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    got = {r.doc_id: r.text for r in df.collect()}
    assert len(got) == len(TEXTS)
    for i, t in enumerate(TEXTS, 10):
        assert base_secrets(got[i]) == []
        if not base_secrets(t):
            assert got[i] == t
    assert "3f76bb" not in got[18] and got[18].count("[SECRET]") >= 3 and got[18].startswith("[SECRET]")


def test_redaction_masks_what_scan_finds(spark):
    rng = random.Random(11)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    parts = ["token=", " ", "AKIA", "ABCDEFGHJKMNPQR1", "0123456789abcdef", "\ue000", "\ufdd0", "🙂", "secret: ", "".join(rng.choice(alphabet) for _ in range(40)), "a1" * 20]
    texts = TEXTS + ["".join(rng.choice(parts) for _ in range(rng.randint(1, 9))) for _ in range(150)]
    scanned = {r.doc_id: r.spans for r in secret_scan.scan(docs(spark, texts)).collect()}
    df = secret_scan.redact(docs(spark, texts))
    _native(df)
    assert "Join" not in df._jdf.queryExecution().executedPlan().toString()
    got = {r.doc_id: r.text for r in df.collect()}
    for i, t in enumerate(texts, 10):
        covered = sorted(tuple(map(int, x.split(":")[1:])) for x in scanned[i].split(",") if x)
        merged = []
        for a, b in covered:
            if merged and a <= merged[-1][1]:
                merged[-1][1] = max(b, merged[-1][1])
            else:
                merged.append([a, b])
        want, at = "", 0
        for a, b in merged:
            want, at = want + t[at:a] + "[SECRET]", b
        assert got[i] == (want + t[at:] if merged else t), t


def lines_brute(rows):
    key = lambda s: s.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})
    found = {}
    for i, t in rows:
        for x in (t or "").split("\n"):
            if len(key(x)) >= 20:
                found.setdefault(key(x), set()).add(i)
    out = []
    for i, t in rows:
        ls = (t or "").split("\n")
        kept = [x for x in ls if not (len(key(x)) >= 20 and len(found[key(x)]) >= 3 and i != max(found[key(x)]))]
        out.append((i, len(ls), len(ls) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out)


def test_lines_match_brute_force(spark):
    rng = random.Random(7)
    pool = ["This line stands in very many documents.", "  THIS line stands in very many documents.\r", "ÉTÉ comme hiver, une ligne assez longue", "été comme hiver, une ligne assez longue", "short", "", "\x1cthis line stands in very many documents.", "x" * 19, "y" * 20]
    texts = ["\n".join(rng.choice(pool + [words(rng, 6)]) for _ in range(rng.randint(1, 8))) for _ in range(120)] + TEXTS
    ids = [*range(len(texts) - 3), 5, 5, None]
    texts[-3], texts[-2] = texts[5], "y" * 20 + "\n" + pool[0]
    df = line_dedup.dedup_lines(docs(spark, texts, ids)).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))
    _native(df)
    low = -(10**30)
    want = lines_brute([(low if i is None else i, t) for i, t in zip(ids, texts)])
    got = sorted((low if r.doc_id is None else r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in df.collect())
    assert got == want


def test_long_document_of_lines(spark):
    long = "\n".join(f"line number {i % 500:05d} of the long text" for i in range(20_000))
    rows = list(enumerate([long, long + "\nend", "line number 00007 of the long text", None]))
    df = line_dedup.dedup_lines(docs(spark, [t for _, t in rows], [i for i, _ in rows])).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("s"))
    assert sorted(map(tuple, df.collect())) == lines_brute(rows)


def simhash_brute(t, k=3):
    import numpy as np
    import xxhash

    w = [x for x in re.split(r"[ \t-\r]+", t or "") if x]
    terms = [" ".join(w[i : i + k]) for i in range(max(1, len(w) - k + 1))] if w else []
    h = np.array([xxhash.xxh64_intdigest(x, 42) for x in terms], np.uint64)
    v = np.array([len(x) for x in terms])
    return sum(1 << b for b in range(64) if len(h) and 2 * v[(h >> np.uint64(b)) & np.uint64(1) == 1].sum() > v.sum())


def test_fingerprints(spark):
    df = simhash.fingerprints(docs(spark))
    _native(df)
    got = {r.doc_id: r.fp & (2**64 - 1) for r in df.collect()}
    assert got == {i: simhash_brute(t) for i, t in enumerate(TEXTS, 10)}


@pytest.mark.parametrize("bucket_rows", [1, 3, 256])
def test_next_document(spark, bucket_rows):
    rng = random.Random(8)
    texts = [words(rng, rng.randint(0, 12)) for _ in range(40)] + TEXTS
    ids = rng.sample(range(-1000, 10**12), len(texts))
    got = {r.doc_id: r.next_text for r in simhash.with_next(docs(spark, texts, ids), bucket_rows=bucket_rows).collect()}
    rows = sorted(zip(ids, [t or "" for t in texts]))
    assert got == {i: rows[(k + 1) % len(rows)][1] for k, (i, _) in enumerate(rows)}


def test_edited_digest(spark):
    texts = TEXTS + ["only one more text " * 9]
    df = simhash.digest(simhash.with_edited(docs(spark, texts)))
    _native(df)
    got = {r.doc_id: r for r in df.collect()}
    for k, t in enumerate(texts):
        t, nxt = t or "", texts[(k + 1) % len(texts)] or ""
        h = len(t) // 2
        e, r = t[: len(t) - h] + nxt[:h], got[10 + k]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(e.encode()).hexdigest())
        assert int(r.fingerprint, 16) == simhash_brute(t) and int(r.edited_fingerprint, 16) == simhash_brute(e)
        assert 0 <= r.near_edited <= 1 and (r.near_edited == 1 or e != t)
    assert simhash.digest(simhash.with_edited(docs(spark, []))).count() == 0
    one = simhash.digest(simhash.with_edited(docs(spark, ["alone here"]))).first()
    assert one.edited_sha256 == hashlib.sha256(b"alonealone").hexdigest() and one.n_chars == 10
    assert one.near_next == 1.0
    nulls = simhash.digest(simhash.with_edited(docs(spark, ["b b b", "a a a", None, "c"], [None, None, 3, 4])))
    assert [(r.doc_id, r.n_chars) for r in nulls.orderBy("doc_id", "n_chars").collect()] == [(None, 5), (None, 5), (3, 0), (4, 1)]


def test_permuted_tables(spark):
    rng = random.Random(9)
    base = [rng.getrandbits(64) for _ in range(150)]
    fps = base + [b ^ sum(1 << x for x in rng.sample(range(64), rng.randint(0, 5))) for b in base]
    sign = lambda x: x - 2**64 if x >> 63 else x
    got = {(r.fp_a, r.fp_b) for r in simhash.near(spark.createDataFrame([(sign(x),) for x in fps], "fp long"), 3).collect()}
    d = sorted({sign(x) for x in fps})
    want = {(a, b) for i, a in enumerate(d) for b in d[i + 1 :] if bin((a ^ b) & (2**64 - 1)).count("1") <= 3}
    assert got == want


def test_queries_on_table(spark):
    from facetry.llm import queries as q

    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    for f in (q.op5_simhash, q.op6_secrets, q.op7_line_dedup):
        assert f(spark, SF).count() == n


def test_empty_tables(spark):
    e = docs(spark, [])
    assert secret_scan.scan(e).count() == line_dedup.dedup_lines(e).count() == secret_scan.redact(e).count() == 0
