"""BPE encoding and decoding with a minimal acyclic transducer as the lexicon of frequent words.

The frequent words of the corpus are counted over all documents, and the `lexicon_words` most frequent are compiled,
with the ids they encode to, into a minimal acyclic automaton. Words share prefixes and suffixes; each edge carries a
number, and the numbers along a word's path add up to the word's place in a table of id sequences. The file of arrays is
broadcast (its size is bounded by `lexicon_words`), memory-mapped by each Python worker and walked for whole batches of
words at once. A word that the lexicon lacks is merged exactly, pair by pair, in the order of the merge table.

The vocabulary file is a parameter; any `tokenizers` JSON of this make works: NFC, white space to one blank, lower
case, pieces by a pattern, byte-level BPE with a word-end suffix, no post-processor and no decoder.

Letters, numbers and lower case follow Python's Unicode tables (15.1); characters that came later may be cut otherwise.

Nulls count as empty texts; an empty text has no ids and decodes to the empty string. Rows are independent: repeated
rows give repeated rows, further columns are ignored, and an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import mmap
import os
import re
import tempfile
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from facetry.llm.common import written

#: Bounds of a worker's memory, not of the result: entries in each of the two generations of the memo, characters of the
#: longest chunk that is kept there, chunks that are learnt at once, and bytes of words that are merged at once.
MEMO, KEPT, AT_ONCE, _BLOCK = 120_000, 48, 60_000, 120_000
#: Bytes of text that are cut and looked up at once.
SLICE = 4 << 20
#: Stands between chunks that are cut into words together; chunks that hold it are cut alone.
_SEP, _SEP_ID = "\ue000", 0xFFFFFFFF
#: White space as the vocabulary's pattern means it (Unicode White_Space); str.split() takes four more.
_MORE_SPACE = re.compile("[\x1c-\x1f]")
_SPACE = regex.compile(r"\p{White_Space}+")
_LONG = 256


def _byte_names() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    names, spare = {b: chr(b) for b in plain}, 256
    for b in range(256):
        if b not in names:
            names[b], spare = chr(spare), spare + 1
    return [names[b] for b in range(256)]


class IntMap:
    """A read-only hash map from int64 to int64, probed for whole arrays. Absent keys give -1."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.keys, self.values = keys, values
        self.shift = np.uint64(64 - (len(keys).bit_length() - 1))

    @classmethod
    def build(cls, keys: np.ndarray, values: np.ndarray) -> IntMap:
        bits = max(4, int(len(keys) * 2).bit_length())
        out = cls(np.full(1 << bits, -1, np.int64), np.full(1 << bits, -1, np.int64))
        todo = np.arange(len(keys))
        at = out._slot(keys)
        while len(todo):
            free = out.keys[at] == -1
            first = np.unique(np.where(free, at, -1 - np.arange(len(at))), return_index=True)[1]
            put = first[free[first]]
            out.keys[at[put]], out.values[at[put]] = keys[todo[put]], values[todo[put]]
            rest = np.ones(len(todo), bool)
            rest[put] = False
            todo, at = todo[rest], (at[rest] + 1) & (len(out.keys) - 1)
        return out

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        at = self._slot(keys)
        got = self.keys[at]
        out = np.where(got == keys, self.values[at], -1)
        todo = np.flatnonzero((got != keys) & (got != -1))
        while len(todo):
            at_todo = (at[todo] + 1) & (len(self.keys) - 1)
            at[todo] = at_todo
            got, want = self.keys[at_todo], keys[todo]
            hit = got == want
            out[todo[hit]] = self.values[at_todo[hit]]
            todo = todo[~hit & (got != -1)]
        return out


def _pack(arrays: dict[str, np.ndarray], meta: dict) -> bytes:
    """One file: the length of a JSON head, the head, then the arrays, each at a multiple of 16."""
    places, at, body = {}, 0, []
    for name, a in arrays.items():
        data = np.ascontiguousarray(a).tobytes()
        places[name] = [str(a.dtype), len(a), at]
        pad = -len(data) % 16
        body += [data, b"\0" * pad]
        at += len(data) + pad
    head = json.dumps({"arrays": places, "meta": meta}).encode()
    head += b" " * (-(len(head) + 8) % 16)
    return len(head).to_bytes(8, "little") + head + b"".join(body)


def _mapped(blob: bytes) -> tuple[dict[str, np.ndarray], dict]:
    """Memory-map a packed file from the worker's own temporary folder; the name goes at once, the map stays."""
    fd, path = tempfile.mkstemp(prefix="lexicon")
    try:
        with os.fdopen(fd, "wb") as f:
            f.write(blob)
        with open(path, "rb") as f:
            held = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
    finally:
        os.unlink(path)
    n = int.from_bytes(held[:8], "little")
    head = json.loads(held[8 : 8 + n])
    return {k: np.frombuffer(held, np.dtype(t), c, 8 + n + at) for k, (t, c, at) in head["arrays"].items()}, head["meta"]


class Merger:
    """Exact merging: in each word, again and again, the leftmost of the pairs that stand first in the merge table."""

    def __init__(self, pairs: IntMap, made: np.ndarray, inner: np.ndarray, last: np.ndarray, size: int):
        self.pairs, self.made, self.inner, self.last, self.size = pairs, made, inner, last, size

    def words(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word as little-endian unsigned 32-bit integers; block by block, so that memory stays bounded."""
        out = [b""] * len(words)
        block: list[int] = []
        held = 0
        for i, w in enumerate(words):
            if len(w) > _LONG:
                out[i] = self.long(w).astype("<u4").tobytes()
            elif w:
                block.append(i)
                held += len(w)
                if held > _BLOCK:
                    self._batch(words, block, out)
                    block, held = [], 0
        if block:
            self._batch(words, block, out)
        return out

    def _batch(self, words: list[bytes], block: list[int], out: list[bytes]) -> None:
        mine = [words[i] for i in block]
        lens = np.fromiter(map(len, mine), np.int64, len(mine))
        flat = np.frombuffer(b"".join(mine), np.uint8)
        ends = np.cumsum(lens)
        sym = self.inner[flat].astype(np.int64)
        sym[ends - 1] = self.last[flat[ends - 1]]
        who, big = np.arange(len(mine)), np.int64(1) << 62
        while len(who):
            starts, ends = np.cumsum(lens) - lens, np.cumsum(lens)
            best = np.full(len(sym), big)
            if len(sym) > 1:
                rank = self.pairs.get(sym[:-1] * self.size + sym[1:])
                best[:-1] = np.where(rank >= 0, (rank << 32) | np.arange(len(sym) - 1), big)
                best[ends - 1] = big
            low = np.minimum.reduceat(best, starts)
            done = low == big
            if done.any():
                ids = sym[np.repeat(done, lens)].astype("<u4").tobytes()
                to = np.cumsum(lens[done]) * 4
                for k, a, b in zip(who[done].tolist(), [0, *to[:-1].tolist()], to.tolist()):
                    out[block[k]] = ids[a:b]
            go = low[~done]
            at = go & 0xFFFFFFFF
            sym[at] = self.made[go >> 32]
            keep = np.repeat(~done, lens)
            keep[at + 1] = False
            who, lens = who[~done], lens[~done] - 1
            sym = sym[keep]

    def long(self, word: bytes) -> np.ndarray:
        """The same for one long word, by a heap over a linked list: n log n."""
        sym = [int(self.inner[b]) for b in word]
        sym[-1] = int(self.last[word[-1]])
        n = len(sym)
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        ranks = self.pairs.get(np.array(sym[:-1], np.int64) * self.size + np.array(sym[1:], np.int64))
        heap = [(int(r), i, sym[i], sym[i + 1]) for i, r in enumerate(ranks) if r >= 0]
        heapq.heapify(heap)
        memo: dict[int, int] = {}

        def push(i: int, j: int) -> None:
            key = sym[i] * self.size + sym[j]
            if key not in memo:
                memo[key] = int(self.pairs.get(np.array([key]))[0])
            if memo[key] >= 0:
                heapq.heappush(heap, (memo[key], i, sym[i], sym[j]))

        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if sym[i] != a or j < 0 or sym[j] != b:
                continue
            sym[i], sym[j], after[i] = int(self.made[r]), -1, after[j]
            if after[i] >= 0:
                before[after[i]] = i
                push(i, after[i])
            if before[i] >= 0:
                push(before[i], i)
        return np.array([s for s in sym if s >= 0], np.int64)


def build_automaton(words: Iterable[bytes]) -> dict[str, np.ndarray]:
    """The minimal acyclic automaton of distinct words, as arrays.

    Words come in ascending order; a suffix that no later word can extend is replaced at once by an equal one that
    stands already. edges: state * 256 + label -> target * 2 ** 32 + the number of words that sort before the edge's.
    """
    states: list[list] = [[False, {}]]  # final, label -> state
    register: dict[tuple, int] = {}
    free: list[int] = []
    path: list[int] = [0]
    last = b""

    def settle(down_to: int) -> None:
        for depth in range(len(path) - 1, down_to, -1):
            s, parent, label = path.pop(), path[depth - 1], last[depth - 1]
            key = (states[s][0], tuple(states[s][1].items()))
            if key in register:
                states[parent][1][label] = register[key]
                free.append(s)
            else:
                register[key] = s

    for word in words:
        common = len(os.path.commonprefix([word, last]))
        settle(common)
        for label in word[common:]:
            if free:
                new = free.pop()
                states[new] = [False, {}]
            else:
                new = len(states)
                states.append([False, {}])
            states[path[-1]][1][label] = new
            path.append(new)
        states[path[-1]][0] = True
        last = word
    settle(0)
    counts: dict[int, int] = {}
    order, stack = [], [(0, False)]
    while stack:
        s, seen = stack.pop()
        if seen:
            counts[s] = states[s][0] + sum(counts[t] for t in states[s][1].values())
            order.append(s)
        elif s not in counts:
            stack.append((s, True))
            stack += [(t, False) for t in states[s][1].values() if t not in counts]
    name = {s: i for i, s in enumerate(reversed(list(dict.fromkeys(order))))}
    keys, values = [], []
    for s, i in name.items():
        before = int(states[s][0])
        for label, t in sorted(states[s][1].items()):
            keys.append(i * 256 + label)
            values.append((name[t] << 32) | before)
            before += counts[t]
    edges = IntMap.build(np.array(keys, np.int64), np.array(values, np.int64))
    final = np.zeros(len(name), np.int8)
    for s, i in name.items():
        final[i] = states[s][0]
    return {"edge_keys": edges.keys, "edge_values": edges.values, "final": final, "start": np.array([name[0]], np.int64)}


class Lexicon:
    """Walks the memory-mapped automaton for many words at once."""

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.edges = IntMap(arrays["edge_keys"], arrays["edge_values"])
        self.final, self.start = arrays["final"], int(arrays["start"][0])
        self.offsets, self.ids = arrays["id_offsets"], arrays["ids"]

    def places(self, words: list[bytes]) -> np.ndarray:
        """Each word's place in the sorted list of the lexicon's words, -1 if it isn't there."""
        lens = np.fromiter(map(len, words), np.int64, len(words))
        flat = np.frombuffer(b"".join(words) + b"\0", np.uint8).astype(np.int64)
        starts = np.cumsum(lens) - lens
        state, place = np.full(len(words), self.start, np.int64), np.zeros(len(words), np.int64)
        live, step = np.flatnonzero(lens > 0), 0
        while len(live):
            edge = self.edges.get(state[live] * 256 + flat[starts[live] + step])
            ok = edge >= 0
            place[live[~ok]] = -1
            live, edge = live[ok], edge[ok]
            state[live], step = edge >> 32, step + 1
            place[live] += edge & 0xFFFFFFFF
            live = live[lens[live] > step]
        return np.where((place >= 0) & (self.final[state] == 1), place, -1)

    def entry(self, place: int) -> bytes:
        return self.ids[self.offsets[place] : self.offsets[place + 1]].tobytes()


class Memo:
    """A map of two generations: when the young one is full, it becomes the old one, and what is asked for again comes back."""

    def __init__(self, most: int):
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.most = most

    def turn(self) -> None:
        if len(self.young) > self.most:
            self.old, self.young = self.young, {}


class Encoder:
    """Encodes texts and decodes ids; what the blob holds is memory-mapped."""

    def __init__(self, blob: bytes, memo: int = MEMO):
        arrays, meta = _mapped(blob)
        self.merger = Merger(IntMap(arrays["pair_keys"], arrays["pair_values"]), arrays["made"], arrays["inner"], arrays["last"], meta["size"])
        self.lexicon = Lexicon(arrays) if meta["lexicon"] else None
        self.special = {k: int(v).to_bytes(4, "little") for k, v in meta["special"].items()}
        self.tokens = pa.array([t.encode() for t in meta["tokens"]], pa.binary())
        self.pieces = Pieces(meta["pattern"], list(self.special))
        self.chunks, self.words = Memo(memo), Memo(memo // 2)

    def word_ids(self, words: set[str]) -> dict[str, bytes]:
        """The ids of each word: by the memo, by the lexicon, and by merging what isn't there."""
        known, old = self.words.young, self.words.old
        new = []
        for w in words.difference(known):
            if w in old:
                known[w] = old[w]
            else:
                new.append(w)
        if not new:
            return known
        spelled = [w.encode() for w in new]
        places = self.lexicon.places(spelled).tolist() if self.lexicon else [-1] * len(new)
        for w, p in zip(new, places):
            if p >= 0:
                known[w] = self.lexicon.entry(p)
        missing = [i for i, p in enumerate(places) if p < 0]
        for i, ids in zip(missing, self.merger.words([spelled[i] for i in missing])):
            known[new[i]] = ids
        return known

    def learn(self, chunks: list[str]) -> list[bytes]:
        """The ids of chunks that the memo lacks. They are cut into words as one text, with a mark between."""
        apart = [i for i, c in enumerate(chunks) if _SEP in c or (self.pieces.cut and "<" in c)]
        alone = set(apart)
        together = [c for i, c in enumerate(chunks) if i not in alone] if alone else chunks
        words = self.pieces.words(f" {_SEP} ".join(together))
        distinct = set(words)
        distinct.discard(_SEP)
        get = self.word_ids(distinct).__getitem__
        mark = _SEP_ID.to_bytes(4, "little")
        ids = b"".join([mark if w == _SEP else get(w) for w in words])
        cuts = (np.flatnonzero(np.frombuffer(ids, "<u4") == _SEP_ID) * 4).tolist()
        got = [ids[a:b] for a, b in zip([0, *[c + 4 for c in cuts]], [*cuts, len(ids)])]
        if alone:
            rest = iter(got)
            got = [self._alone(c) if i in alone else next(rest) for i, c in enumerate(chunks)]
        return got

    def _alone(self, chunk: str) -> bytes:
        parts = [p for p in (self.pieces.cut.split(chunk) if self.pieces.cut else [chunk]) if p]
        out = []
        for p in parts:
            if p in self.special:
                out.append(self.special[p])
            else:
                words = self.pieces.words(p)
                known = self.word_ids(set(words))
                out += [known[w] for w in words]
        return b"".join(out)

    def encode(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        for ids, ends in self.columns(pa.array(texts, pa.string())):
            for a, b in zip([0, *ends[:-1].tolist()], ends.tolist()):
                yield ids[a:b].tobytes()

    def columns(self, column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For some rows of a column of texts at a time: all their ids, and where each row's end."""
        return map(self._encoded, slices(column))

    def _encoded(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        chunks = self.pieces.split(texts)
        rows = chunks.offsets.to_numpy().astype(np.int64)
        coded = chunks.flatten().dictionary_encode()
        taken = pa.array(self.ids_of(coded.dictionary.to_numpy(zero_copy_only=False).tolist()), pa.large_binary()).take(coded.indices)
        _, offsets, data = taken.buffers()
        end = np.frombuffer(offsets, "<i8", len(taken) + 1) >> 2 if len(taken) else np.zeros(1, np.int64)
        ids = np.frombuffer(data, "<u4", int(end[-1])) if end[-1] else np.zeros(0, "<u4")
        return ids, end[rows[1:] - rows[0]]

    def ids_of(self, distinct: list[str]) -> list[bytes]:
        """The ids of distinct chunks: by the memo, and by learning what it lacks."""
        young, old = self.chunks.young, self.chunks.old
        out, new = list(map(young.get, distinct)), []
        for i in [i for i, ids in enumerate(out) if ids is None]:
            c = distinct[i]
            if (ids := old.get(c)) is None:
                new.append(i)
            else:
                young[c] = out[i] = ids
        for at in range(0, len(new), AT_ONCE):
            part = new[at : at + AT_ONCE]
            for i, ids in zip(part, self.learn([distinct[i] for i in part])):
                out[i] = ids
                if len(distinct[i]) <= KEPT:
                    young[distinct[i]] = ids
            self.words.turn()
        self.chunks.turn()
        return out

    def decode(self, ids: bytes) -> str:
        """The tokens joined by blanks, as a tokenizer without a decoder does."""
        return self.decoded(np.frombuffer(ids, "<u4"), np.array([len(ids) >> 2]))[0].decode()

    def decoded(self, ids: np.ndarray, ends: np.ndarray) -> list[bytes]:
        """The same for rows of ids, in UTF-8."""
        if len(ids) > SLICE:  # one very long row: its text may be beyond what an Arrow array of 32-bit offsets holds
            named = self.tokens.to_pylist()
            return [b" ".join([named[i] for i in row.tolist()]) for row in np.split(ids, ends[:-1])]
        tokens = self.tokens.take(pa.array(ids.astype(np.int64)))
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), tokens), b" ").to_pylist()


class Pieces:
    """From a text to the words that merging works on.

    White space ends every piece, so a text is cut at white space first; the chunks between are encoded one by one
    and kept in a memo.
    """

    def __init__(self, pattern: str, special: list[str]):
        self.find = regex.compile(pattern).findall
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(special, key=len, reverse=True))) + ")") if special else None

    def chunks(self, text: str) -> list[str]:
        return [c for c in _SPACE.split(text) if c] if _MORE_SPACE.search(text) else text.split()

    def split(self, texts: pa.Array) -> pa.Array:
        """The chunks of each text as lists; there may be empty ones."""
        if pc.any(pc.match_substring_regex(texts, "[\x1c-\x1f]")).as_py():
            return pa.array([self.chunks(t) for t in texts.to_pylist()], pa.list_(pa.string()))
        return pc.utf8_split_whitespace(texts)

    def words(self, part: str) -> list[str]:
        """The words of a text without special tokens."""
        if not part.isascii():
            part = unicodedata.normalize("NFC", part).replace("Σ", "σ")
        return self.find(part.lower())


def load_model(path: str) -> dict:
    """What a vocabulary file says, as far as it matters here; other makes are refused."""
    with open(path, encoding="utf-8") as f:
        t = json.load(f)
    kinds = [n["type"] for n in t["normalizer"]["normalizers"]]
    split = t["pre_tokenizer"]["pretokenizers"][0]
    m = t["model"]
    if kinds != ["NFC", "Replace", "Lowercase"] or not split["invert"] or m["type"] != "BPE" or m["end_of_word_suffix"] != "</w>" or t["decoder"] or t["post_processor"]:
        raise ValueError(f"{path}: not a byte-level BPE vocabulary with word ends")
    return {"pattern": split["pattern"]["Regex"], "vocab": m["vocab"], "merges": m["merges"], "special": {a["content"]: a["id"] for a in t["added_tokens"]}}


def compile_blob(model: dict, words: Iterable[bytes] = ()) -> bytes:
    """The file that workers map: the merge table, the token strings, and the automaton of `words` with their ids."""
    vocab, names = model["vocab"], _byte_names()
    size = max([*vocab.values(), *model["special"].values()]) + 1
    tokens = [""] * size
    for k, i in [*vocab.items(), *model["special"].items()]:
        tokens[i] = k
    left, right, made = (np.array(x, np.int64) for x in zip(*((vocab[a], vocab[b], vocab[a + b]) for a, b in model["merges"])))
    keys = left * size + right
    first = np.unique(keys, return_index=True)[1]
    pairs = IntMap.build(keys[first], first.astype(np.int64))
    inner = np.array([vocab[n] for n in names], np.int64)
    last = np.array([vocab[n + "</w>"] for n in names], np.int64)
    arrays = {"pair_keys": pairs.keys, "pair_values": pairs.values, "made": made, "inner": inner, "last": last}
    words = sorted(set(words) - {b""})
    if words:
        ids = Merger(pairs, made, inner, last, size).words(words)
        arrays |= build_automaton(words)
        arrays |= {"id_offsets": np.concatenate([[0], np.cumsum([len(x) // 4 for x in ids])]).astype(np.int64), "ids": np.frombuffer(b"".join(ids), "<u4")}
    return _pack(arrays, {"size": size, "lexicon": bool(words), "special": model["special"], "tokens": tokens, "pattern": model["pattern"]})


_ENCODERS: dict[tuple[str, int], Encoder] = {}


def encoder(blob: bytes, memo: int = MEMO) -> Encoder:
    """The worker's encoder for this blob; one is kept between tasks."""
    key = (hashlib.sha256(blob).hexdigest(), memo)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(blob, memo)
    return _ENCODERS[key]


def release() -> None:
    """Give up the worker's encoder, for tasks that need the memory for something else."""
    _ENCODERS.clear()


def slices(column: pa.Array, most: int = SLICE) -> Iterator[pa.Array]:
    """A column of texts, at most so many bytes or one row at a time; nulls are empty texts."""
    size = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64).cumsum()
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + most, "right")))
        yield pc.fill_null(column.slice(at, to - at), "")
        at = to


def frequent_words(docs: DataFrame, model: dict, lexicon_words: int, text_col: str = "text") -> list[bytes]:
    """The most frequent words over all documents, `lexicon_words` of them at most; words are counted in each task first."""
    pattern, special = model["pattern"], list(model["special"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, seen = Pieces(pattern, special), Counter()

        def out() -> Iterator[pa.RecordBatch]:
            words: Counter = Counter()
            for chunk, n in seen.items():
                parts = pieces.cut.split(chunk) if pieces.cut and "<" in chunk else [chunk]
                for w in (w for p in parts if p and p not in special for w in pieces.words(p)):
                    if len(w) <= KEPT:
                        words[w] += n
            seen.clear()
            yield pa.RecordBatch.from_arrays([pa.array([w.encode() for w in words], pa.binary()), pa.array(list(words.values()), pa.int64())], ["word", "n"])

        for b in batches:
            for chunk in slices(b.column(0)):
                counts = pieces.split(chunk).flatten().value_counts()
                seen.update(dict(zip(counts.field(0).to_pylist(), counts.field(1).to_pylist())))
                if len(seen) > MEMO:
                    yield from out()
        yield from out()

    counted = written(docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")), "words")
    # a histogram of counts (some hundred cells) gives the least count; only words of the lexicon reach the driver
    cells = sorted(((r.c, r.n, r.least) for r in counted.groupBy(F.floor(F.log2("n") * 16).alias("c")).agg(F.count(F.lit(1)).alias("n"), F.min("n").alias("least")).collect()), reverse=True)
    least, held = None, 0
    for _, n, low in cells:
        if held + n > lexicon_words:
            break
        least, held = low, held + n
    return [] if least is None else [bytes(r.word) for r in counted.where(F.col("n") >= least).select("word").collect()]


def lexicon_blob(docs: DataFrame, vocabulary: str, lexicon_words: int = 65_536, text_col: str = "text") -> bytes:
    model = load_model(vocabulary)
    return compile_blob(model, frequent_words(docs, model, lexicon_words, text_col) if lexicon_words else ())


def encode_decode(docs: DataFrame, vocabulary: str, *, lexicon_words: int = 65_536, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = True, blob: bytes | None = None) -> DataFrame:
    """Encode every whole text and decode the ids again: doc_id, n_tokens, ids_sha256, decoded_sha256[, ids, decoded]."""
    blob = blob or lexicon_blob(docs, vocabulary, lexicon_words, text_col)
    sent = docs.sparkSession.sparkContext.broadcast(blob)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(sent.value)
        for b in batches:
            at = 0
            for ids, ends in enc.columns(b.column(1)):
                texts, held = enc.decoded(ids, ends), ids.tobytes()
                starts = [0, *ends[:-1].tolist()]
                mine = [held[a * 4 : e * 4] for a, e in zip(starts, ends.tolist())]
                out = [b.column(0).slice(at, len(mine)), pa.array(ends - np.array(starts), pa.int64()), pa.array([hashlib.sha256(x).hexdigest() for x in mine], pa.string()), pa.array([hashlib.sha256(x).hexdigest() for x in texts], pa.string())]
                if keep_ids:
                    out += [pa.array(mine, pa.binary()), pa.array(texts, pa.binary()).cast(pa.string())]
                at += len(mine)
                yield pa.RecordBatch.from_arrays(out, names)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    ddl = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids binary, decoded string" * keep_ids
    names = [x.split()[0] for x in ddl.split(", ")]
    return rows.mapInArrow(run, ddl)
