"""Personal data by weak supervision.

Candidates come from patterns: the four base kinds (email, ip, card, phone), and forms that these miss (spelled-out mail
addresses, national phone numbers, social security numbers, IBANs). Five labelers vote on each candidate for, against or
not at all: what its form says, a gazetteer of endings, country codes, issuer digits and reserved ranges, the words before
it, its neighbours on either side, and how plain its digits are; they often disagree. Votes are counted over all documents
as patterns of votes and features (a bounded table), expectation-maximisation over these counts estimates each labeler's
reliability and each kind's share, and a logistic span classifier is trained on the posteriors. Beside the votes' evidence
it sees what no labeler looks at: length, separators, the word before (hashed into WORDS buckets) and what follows. In the
second pass the classifier decides on the candidates beyond the base; base spans stay whatever it says.

Defined cases: null and empty texts have no spans but keep their row; repeated rows give repeated rows; null ids stay;
with no candidates at all there is nothing to train on and nothing is added; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from facetry.llm.bpe import slices

BASE = ("email", "ip", "card", "phone")
MORE = ("spelled", "national", "ssn", "iban")
KINDS = BASE + MORE

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_IP_RUN = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_SPELLED = re.compile(r"[A-Za-z0-9._%+-]{1,64} ?(?:\(at\)|\[at\]|\{at\}| at ) ?[A-Za-z0-9-]{1,63}(?: ?(?:\(dot\)|\[dot\]|\{dot\}| dot ) ?[A-Za-z0-9-]{2,63})+", re.IGNORECASE | re.ASCII)
_NATIONAL = re.compile(r"(?<![0-9.+-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9-])")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_DIGIT = re.compile("[0-9]")

# Words and numbers that the gazetteer and context labelers know.
MAIL_ENDINGS = frozenset("com org net edu gov mil int info biz io co uk de fr es it nl eu ch at us ca au jp in br".split())
FOR_WORDS = frozenset("email mail mailto contact reach write phone tel telephone call mobile cell fax whatsapp card visa mastercard amex credit debit pay ip address host login ssn social security iban account bank".split())
AGAINST_WORDS = frozenset("version release chapter section figure table page pages isbn issn order invoice item sku ref serial model build port line lines equation".split())
ISSUERS = ("4", "51", "52", "53", "54", "55", "34", "37", "6011", "65", "35", "36", "38")

COUNTRY_CODES = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "4", "5", "60", "61", "62", "63", "64", "65", "66", "81", "82", "84", "86", "90", "91", "92", "93", "94", "95", "98", "2", "3", "8", "9")

LABELERS = ("form", "gazetteer", "context", "neighbours", "variety")
WORDS = 8


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of the base pattern, found from each @ outwards."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            end = m.end()
            out.append((start, end))
        at = text.find("@", max(end, at + 1))
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end), sorted."""
    out = [(s, 0, e) for s, e in emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        # runs of digits and dots first: matches lie within them, so that long ones stay linear
        for run in _IP_RUN.finditer(text):
            if run[0].count(".") >= 3:
                for m in _IP.finditer(text, run.start(), run.end()):
                    if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m[0].split(".")):
                        out.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 12:
                d = m[0].replace(" ", "").replace("-", "")
                if 12 <= len(d) <= 19 and luhn(d):
                    out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                    out.append((m.start(), 3, m.end()))
        out.sort()
    return out


def more_spans(text: str) -> list[tuple[int, int, int]]:
    """Candidates of the further kinds."""
    out = []
    low = text.lower() if "at" in text or "AT" in text or "At" in text else ""
    if "dot" in low:
        out += [(m.start(), 4, m.end()) for m in _SPELLED.finditer(text)]
    if _DIGIT.search(text):
        for kind, pattern in ((5, _NATIONAL), (6, _SSN), (7, _IBAN)):
            out += [(m.start(), kind, m.end()) for m in pattern.finditer(text)]
    return sorted(out)


def _iban_ok(s: str) -> bool:
    s = s.replace(" ", "")
    return 15 <= len(s) <= 34 and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def _form(name: str, s: str, digits: str) -> int:
    """Whether a candidate is made as its kind should be."""
    if name == "email":
        local, _, domain = s.partition("@")
        bad = local[0] in ".-" or local[-1] in ".-" or ".." in local or any(x[:1] == "-" or x[-1:] == "-" for x in domain.split(".")) or not domain.rsplit(".", 1)[-1].isalpha()
        return -1 if bad else 1
    if name == "ip":
        return -1 if any(len(p) > 1 and p[0] == "0" for p in s.split(".")) else 1
    if name == "card":
        return 1 if len(digits) in (13, 14, 15, 16, 19) and len(set(re.findall("[ -]", s))) < 2 else -1
    if name == "phone":
        return (1 if len(digits) == 11 and digits[1] not in "01" and digits[4] not in "01" else -1) if digits[0] == "1" else (1 if len(digits) >= 10 else 0)
    if name == "spelled":
        return 1 if "(at)" in s.lower() or "[at]" in s.lower() else 0
    if name == "national":
        return 1 if digits[0] not in "01" and digits[3] not in "01" else -1
    if name == "ssn":
        return 1 if digits[:3] not in ("000", "666") and digits[0] != "9" and digits[3:5] != "00" and digits[5:] != "0000" else -1
    return 1 if _iban_ok(s) else -1


def votes(text: str, span: tuple[int, int, int]) -> tuple[int, ...]:
    """-1, 0 or 1 from each of LABELERS."""
    start, kind, end = span
    s = text[start:end]
    digits = "".join(c for c in s if "0" <= c <= "9")
    name = KINDS[kind]
    gazetteer = 0
    if name in ("email", "spelled"):
        gazetteer = 1 if re.split(r"[. \])}]+", s.lower())[-1] in MAIL_ENDINGS else -1
    elif name == "card":
        gazetteer = 1 if digits.startswith(ISSUERS) else -1
    elif name == "ip":
        gazetteer = -1 if s.split(".")[0] in ("0", "10", "127", "255") else 1
    elif name == "phone":
        gazetteer = 1 if digits.startswith(COUNTRY_CODES) else -1
    before = re.findall(r"[a-z]+", text[max(0, start - 40) : start].lower())[-4:]
    context = 1 if FOR_WORDS.intersection(before) else -1 if AGAINST_WORDS.intersection(before) else 0
    left, right = text[start - 1 : start] if start else "", text[end : end + 1]
    neighbours = -1 if left.isalnum() or right.isalnum() or left in "/_=#" and left else 1
    variety = 0 if not digits else (-1 if len(set(digits)) <= 2 else 1)
    return _form(name, s, digits), gazetteer, context, neighbours, variety


def features(text: str, span: tuple[int, int, int], v: tuple[int, ...] | None = None) -> tuple[int, ...]:
    """What the span classifier sees, as the places of its ones."""
    start, kind, end = span
    v = v or votes(text, span)
    n, s = end - start, text[start:end]
    last = re.findall(r"[^\W\d_]+", text[max(0, start - 24) : start].lower())[-1:]
    out = [kind]
    at = len(KINDS)
    out.append(at + (n > 11) + (n > 17) + (n > 26))
    at += 4
    out += [at + i for i, c in enumerate(" -.(") if c in s]
    at += 4
    out.append(at + (zlib.crc32(last[0].encode()) % WORDS if last else WORDS))
    at += WORDS + 1
    out.append(at + (0 if end >= len(text) or text[end].isspace() else 1 if text[end] in ".,;:!?)" else 2))
    at += 3
    out += [at + 2 * i + (x < 0) for i, x in enumerate(v) if x]
    return tuple(out)


FEATURES = len(KINDS) + 4 + 4 + WORDS + 1 + 3 + 2 * len(LABELERS)


def _row(ones: tuple[int, ...]) -> np.ndarray:
    out = np.zeros(FEATURES)
    out[list(ones)] = 1
    return out


def expectation_maximisation(patterns: list[tuple[int, tuple[int, ...], float]], rounds: int = 60) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """From (kind, votes, count): each pattern's posterior, each labeler's reliability, each kind's share.

    For each kind a labeler has chances of its own for each vote, silence included, on true and on false candidates. A
    labeler that always says the same thus tells nothing. It starts from votes against the mean vote of the kind; a few
    made-up rows say that votes are rather right than wrong.
    """
    kind = np.array([p[0] for p in patterns])
    v = np.array([p[1] for p in patterns], int)
    n = np.array([p[2] for p in patterns], float)
    share, post = np.full(len(KINDS), 0.6), np.zeros(len(patterns))
    made_up = {1: np.array([0.5, 1.0, 2.0]), 0: np.array([2.0, 1.0, 0.5])}
    for k in set(kind.tolist()):
        at = kind == k
        mean = (n[at, None] * v[at]).sum(0) / n[at].sum()
        p = 1 / (1 + np.exp(-np.clip(1.5 * (v[at] - mean).sum(1) + 0.4, -30, 30)))
        is_vote = [v[at] == u for u in (-1, 0, 1)]
        for _ in range(rounds):
            share[k] = ((n[at] * p).sum() + 1.2) / (n[at].sum() + 2)
            odds = np.full(at.sum(), np.log(share[k] / (1 - share[k])))
            for y, w in ((1, n[at] * p), (0, n[at] * (1 - p))):
                for u in range(3):
                    chance = ((w[:, None] * is_vote[u]).sum(0) + made_up[y][u]) / (w.sum() + 3.5)
                    odds += (is_vote[u] * np.log(chance)).sum(1) * (1 if y else -1)
            p = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        post[at] = p
    right = ((n * post)[:, None] * (v > 0) + (n * (1 - post))[:, None] * (v < 0)).sum(0) / np.maximum((n[:, None] * (v != 0)).sum(0), 1e-9)
    return post, right, share


def train(x: np.ndarray, y: np.ndarray, n: np.ndarray, ridge: float = 1.0, rounds: int = 25) -> np.ndarray:
    """Weights (the last is the constant) of a logistic model, by Newton's method over counted rows."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (n * (p - y)) + ridge * w
        hess = (x * (n * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        w -= np.linalg.solve(hess, grad)
    return w


def _texts(column: pa.Array) -> Iterator[str]:
    for part in slices(column):
        yield from part.to_pylist()


def candidates(text: str) -> list[tuple[int, int, int]]:
    base = base_spans(text)
    out, at, reach = list(base), 0, 0
    for span in more_spans(text):  # both lists ascend by start, so one walk finds overlaps with the base
        while at < len(base) and base[at][0] < span[2]:
            reach, at = max(reach, base[at][2]), at + 1
        if reach <= span[0]:
            out.append(span)
    return out


def fit(docs: DataFrame, text_col: str = "text") -> dict:
    """Labeler reliabilities and classifier weights from the votes over all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for b in batches:
            for t in _texts(b.column(0)):
                for span in candidates(t):
                    v = votes(t, span)
                    seen[",".join(map(str, (span[1], *v, *features(t, span, v))))] += 1
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["pattern", "n"])

    counted = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "pattern string, n long").groupBy("pattern").agg(F.sum("n").alias("n"))
    rows = sorted((tuple(map(int, r.pattern.split(","))), r.n) for r in counted.collect())  # kinds x votes x features: bounded
    if not rows:
        return {"weights": None, "reliability": {}, "share": {}}
    m = len(LABELERS)
    post, right, share = expectation_maximisation([(r[0], r[1 : 1 + m], n) for r, n in rows])
    w = train(np.array([_row(r[1 + m :]) for r, _ in rows]), post, np.array([n for _, n in rows], float))
    return {"weights": w, "reliability": dict(zip(LABELERS, right.round(3).tolist())), "share": dict(zip(KINDS, share.round(3).tolist()))}


def _said(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def detect(docs: DataFrame, *, model: dict | None = None, least: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_<base kind>, base_sha256, spans, n_added of every document."""
    model = model or fit(docs, text_col)
    weights = model["weights"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counts, digests, said, added = [], [], [], []
            for t in _texts(b.column(1)):
                found = candidates(t)
                base = [s for s in found if s[1] < len(BASE)]
                more = [s for s in found if s[1] >= len(BASE) and weights is not None and 1 / (1 + np.exp(-float(weights[list(features(t, s))].sum() + weights[-1]))) >= least]
                counts.append([sum(s[1] == k for s in base) for k in range(len(BASE))])
                digests.append(hashlib.sha256(_said(base).encode()).hexdigest())
                said.append(_said(sorted(base + more)))
                added.append(len(more))
            cols = [b.column(0), *(pa.array([c[k] for c in counts], pa.int64()) for k in range(len(BASE))), pa.array(digests, pa.string()), pa.array(said, pa.string()), pa.array(added, pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", *(f"n_{k}" for k in BASE), "base_sha256", "spans", "n_added"])

    ddl = "doc_id long, " + ", ".join(f"n_{k} long" for k in BASE) + ", base_sha256 string, spans string, n_added long"
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, ddl)
