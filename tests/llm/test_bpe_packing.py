import hashlib
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from facetry.llm import bpe, packing
from facetry.llm.queries import vocabulary
from tests.llm.fixtures import SF, TEXTS, docs


@pytest.fixture(scope="module")
def tok():
    return Tokenizer.from_file(vocabulary())


def _ids(tok, t):
    return np.array(tok.encode(t or "", add_special_tokens=False).ids, "<u4")


def test_automaton_is_exact_and_shares_suffixes():
    rng = random.Random(1)
    words = sorted({"".join(rng.choice("abcd") for _ in range(rng.randint(1, 7))).encode() + b"ing" for _ in range(3000)})
    a = bpe.build_automaton(words)
    lex = bpe.Lexicon(a | {"id_offsets": np.zeros(1, np.int64), "ids": np.zeros(0, "<u4")})
    assert lex.places(words).tolist() == list(range(len(words)))
    assert (lex.places([b"", b"zz", b"abing!", b"in", b"abcdabcdabcd"]) == -1).all()
    assert len(a["final"]) < sum(map(len, words)) / 4


def test_fuzz_against_library(tok):
    rng = random.Random(2)
    parts = ["a", "B", "é", "é", "'s", "'LL", "<|endoftext|>", "<|startoftext|>", "<|endof", "12", " ", "\n", "　", "ß", "Σ", "中", "!!!", ".", "\x1c", "\x85", "ﬁ", "İ", "🙂"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(3000)] + [t or "" for t in TEXTS]
    model = bpe.load_model(vocabulary())
    enc = bpe.Encoder(bpe.compile_blob(model, [b"a", b"the", b"12"]))
    for t, got in zip(texts, enc.encode(texts)):
        want = _ids(tok, t)
        assert want.tobytes() == got, t
        assert enc.decode(got) == tok.decode(want.tolist(), skip_special_tokens=False)


@pytest.mark.parametrize("lexicon", [0, 50, 100_000])
def test_operator_edges(spark, tok, lexicon):
    got = bpe.encode_decode(docs(spark), vocabulary(), lexicon_words=lexicon).collect()
    assert len(got) == len(TEXTS)
    by = {r.doc_id: r for r in got}
    for i, t in enumerate(TEXTS, 10):
        want = _ids(tok, t)
        assert by[i].n_tokens == len(want) and bytes(by[i].ids) == want.tobytes()
        assert by[i].ids_sha256 == hashlib.sha256(want.tobytes()).hexdigest()
        assert by[i].decoded_sha256 == hashlib.sha256(tok.decode(want.tolist(), skip_special_tokens=False).encode()).hexdigest()


def test_empty_table(spark):
    assert bpe.encode_decode(docs(spark, []), vocabulary()).count() == 0
    assert packing.pack(docs(spark, []), vocabulary()).count() == 0


@pytest.mark.parametrize("window", [16, 4096])
def test_packing(spark, tok, window):
    rows = packing.pack(docs(spark).repartition(3), vocabulary(), window=window).collect()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    for i, t in enumerate(TEXTS, 10):
        want, at = np.append(_ids(tok, t), [2]).astype("<u4"), 0
        for r in sorted(by[i], key=lambda r: r.start):
            piece = want[at : at + r.length]
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(want), zlib.crc32(piece.tobytes())) and bytes(r.ids) == piece.tobytes()
            at += r.length
        assert at == len(want)
    run = sorted((r.sequence_id * window + r.offset, r.length) for r in rows)
    assert run[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(run, run[1:])) and all(r.offset + r.length <= window for r in rows)


def test_whole_table(spark, tok):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in d.select("doc_id", "text").collect()}
    for r in bpe.encode_decode(d, vocabulary(), lexicon_words=2000, keep_ids=False).collect():
        assert r.ids_sha256 == hashlib.sha256(_ids(tok, texts[r.doc_id]).tobytes()).hexdigest()
