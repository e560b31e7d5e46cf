"""BPE encoding and decoding with a tokenization automaton."""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Callable, Iterable, Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from cellweave.llm.common import small_batches

#: Words whose ids a worker remembers, and ids; beyond that it starts afresh, which changes no result.
CACHE_WORDS = 150_000
CACHE_IDS = 16 * CACHE_WORDS
#: Resolved arcs that a worker remembers.
CACHE_ARCS = 200_000
#: Words that are turned into ids at once.
STEP_WORDS = 30_000
#: New words that go through the automaton side by side, and the bytes such a word has at most; longer ones go alone.
SIDE_WORDS = 8192
SIDE_BYTES = 64
#: Places for resolved arcs of words that go side by side, as a power of two.
SIDE_ARCS = 17

#: Fixed value: the pre-tokenizer's pattern.
WORD = r"'s|'t|'re|'ve|'m|'ll|'d|{L}+|{N}|{other}+"
SUFFIX = "</w>"
_SPACE = regex.compile(r"\p{White_Space}+")
_SEPARATORS = re.compile("[\x1c-\x1f]")
#: Lower forms of capitals newer than Python's own tables, first and last capital and distance.
NEW_CAPITALS = [
    (0x1C89, 0x1C89, 1), (0xA7CB, 0xA7CB, 0x264 - 0xA7CB), (0xA7CC, 0xA7CC, 1), (0xA7CE, 0xA7CE, 1),
    (0xA7D2, 0xA7D2, 1), (0xA7D4, 0xA7D4, 1), (0xA7DA, 0xA7DA, 1), (0xA7DC, 0xA7DC, 0x19B - 0xA7DC),
    (0x10D50, 0x10D65, 0x20), (0x16EA0, 0x16EB8, 0x1B),
]


#: Letters and digits of Unicode 17, first and last of each run; the definition's library knows Unicode 16.
NEWER = """
558 58B-58C 88F C5C CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D 107BB-107BF 10940-10959
10EC5-10EC7 10ED9-10EEE 11B0A 11DB0-11DDB 11DE0-11DE9 11DF1 1246F 12475-1247F 12550-12686 16EA0-16EB8 16EBB-16ED3
16FF2-16FF6 187F8-187FF 18CD6-18CDA 18D09-18D20 18D80-18DF2 18E00-19191 191A0-191D2 1B123-1B128 1B168 1D6A6
1DF1F-1DF24 1DF2B-1DF81 1DF90-1DF96 1DFCD-1DFFF 1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED 1E6F0-1E6F4
1E6FE-1E6FF 2B73A-2B73F 2B81E 2CEA2-2CEAD 323B0-33479 3D000-3FC3F
"""


def _patterns() -> tuple[regex.Pattern, regex.Pattern, regex.Pattern]:
    """The words of texts without ``NEWER`` characters, those of any text, and what tells them apart.

    The pattern library counts them as letters and digits, the tokenizer as other characters.
    """
    runs = [run.split("-") for run in NEWER.split()]
    odd = "".join(rf"\U{int(r[0], 16):08x}-\U{int(r[-1], 16):08x}" for r in runs)
    capitals = "".join(rf"\U{first:08x}-\U{last:08x}" for first, last, _ in NEW_CAPITALS)
    letters, digits, other = rf"[\p{{L}}--[{odd}]]", rf"[\p{{N}}--[{odd}]]", rf"[{odd}]"
    exact = WORD.format(L=letters, N=digits, other=rf"[[^\p{{White_Space}}\p{{L}}\p{{N}}]||{other}]")
    plain = WORD.format(L=r"\p{L}", N=r"\p{N}", other=r"[^\p{White_Space}\p{L}\p{N}]")
    return regex.compile(plain), regex.compile(exact, regex.V1), regex.compile(f"[{odd}{capitals}]")


def byte_letters() -> list[str]:
    """The printable character that stands for each byte: itself if visible, else the next free code point."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b if b in visible else next(spare)) for b in range(256)]


def labels_of(spec: dict) -> list[str]:
    """The label of every id."""
    named = [*spec["model"]["vocab"].items(), *((x["content"], x["id"]) for x in spec["added_tokens"])]
    labels = [""] * (1 + max(i for _, i in named))
    for text, i in named:
        labels[i] = text
    return labels


def _places(keys: np.ndarray, bits: int) -> np.ndarray:
    """Where keys are in a table of ``2 ** bits`` places."""
    return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - bits)).astype(np.int64)


def _runs(flat: np.ndarray, starts: np.ndarray, counts: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The runs ``rows`` of ``flat``, one after the other."""
    each = counts[rows]
    return flat[np.arange(each.sum()) + np.repeat(starts[rows] - (np.cumsum(each) - each), each)]


class Numbers:
    """A fixed mapping of whole numbers that is looked up for many at once."""

    def __init__(self, mapping: dict[int, int]):
        n = len(mapping)
        keys = np.fromiter(mapping.keys(), np.int64, n)
        values = np.fromiter(mapping.values(), np.int32, n)
        self.bits = max(10, (2 * n).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, -1, np.int32)
        at = _places(keys, self.bits)
        while len(keys):
            free = self.keys[at] < 0
            self.keys[at[free]] = keys[free]  # one of those that meet at a place stays
            here = self.keys[at] == keys
            self.values[at[here]] = values[here]
            keys, values, at = keys[~here], values[~here], (at[~here] + 1) & ((1 << self.bits) - 1)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The numbers of ``keys``, -1 for others."""
        at = _places(keys, self.bits)
        held = self.keys[at]
        out = self.values[at]  # -1 at an empty place
        other = np.flatnonzero((held != keys) & (held >= 0))
        while len(other):
            at[other] = (at[other] + 1) & ((1 << self.bits) - 1)
            held = self.keys[at[other]]
            out[other] = self.values[at[other]]
            other = other[(held != keys[other]) & (held >= 0)]
        return out


class Automaton:
    """Deterministic automaton over tokens that accepts exactly the tokenizations the merges lead to.

    It begins as one state with a loop for every byte.  Merges are taken in rank order, and each
    adds a gadget.  The gadget of ``u v -> t`` at rank ``r``

    * cuts the arc ``v`` from the state after ``u``, as the pair cannot stand any more,
    * adds an arc ``t`` to every state that still has its arc ``u``,
    * makes the state after ``t`` a copy of the state after ``v`` as it was before the cut.

    The full arc table would have (tokens x tokens) entries, so it stays in the form of its gadgets:
    ``left``, ``right`` and ``rank`` of every token and the cuts ``pair -> rank``.  An arc is
    looked up by walking back to the gadgets that made or cut it, once; the answer is kept.

    As the automaton is deterministic and each text has one tokenization, every prefix of a word
    ends in exactly one state.  A word is encoded left to right: from the state of a position
    all labels that start there are read off a trie, and those with an arc name the state of the
    position they end at.  Work is linear in the word for bounded labels.

    ``encode_all`` takes many words side by side, position by position.  The labels that end at a
    position are read off suffix links of the trie there, longest first, and the first with an arc
    from the state where it starts is the one.
    """

    def __init__(self, definition: str):
        spec = json.loads(definition)
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.labels = labels_of(spec)
        self.plain, self.exact, self.newer = _patterns()
        self.lower = {c: c + by for first, last, by in NEW_CAPITALS for c in range(first, last + 1)}
        n = len(self.labels)
        self.left, self.right, self.rank = [-1] * n, [-1] * n, [-1] * n
        self.cut: dict[int, int] = {}
        self.arcs: dict[int, bool] = {}
        letters = byte_letters()
        spelled: list[tuple[int, ...] | None] = [None] * n
        for b, letter in enumerate(letters):
            spelled[vocab[letter]] = (b,)
            spelled[vocab[letter + SUFFIX]] = (b + 256,)
        for r, pair in enumerate(model["merges"]):
            u, v = (vocab[x] for x in (pair if isinstance(pair, list) else pair.split(" ")))
            t = vocab[self.labels[u] + self.labels[v]]
            if max(self.rank[u], self.rank[v]) >= r or spelled[u] is None or spelled[v] is None:
                raise ValueError(f"merge {r} uses a token that no earlier merge has made")
            stands = self._arc(u, v, r - 1)
            self.cut.setdefault(u * n + v, r)
            if stands and spelled[t] is None:
                self.left[t], self.right[t], self.rank[t] = u, v, r
                spelled[t] = spelled[u] + spelled[v]
        # trie of the labels: a node has an entry (node << 9 | symbol), its token or -1
        self.step: dict[int, int] = {}
        self.token = [-1]
        for t, symbols in enumerate(spelled):
            if symbols is not None:
                at = 0
                for s in symbols:
                    nxt = self.step.get(at << 9 | s)
                    if nxt is None:
                        nxt = self.step[at << 9 | s] = len(self.token)
                        self.token.append(-1)
                    at = nxt
                self.token[at] = t
        self._link(spelled)

    def _arc(self, x: int, t: int, until: int) -> bool:
        """Whether the state after ``x`` has the arc ``t`` once merges up to rank ``until`` have been built in."""
        cut, rank, n = self.cut, self.rank, len(self.labels)
        while True:
            if cut.get(x * n + t, until + 1) <= until:
                return False
            rx, rt = rank[x], rank[t]
            if rx < 0 and rt < 0:
                return True
            if rx > rt:  # the state was copied from the one after its right part
                x, until = self.right[x], rx - 1
            elif rt > rx:  # the arc was added where its left part had one
                t, until = self.left[t], rt
            else:
                x, t, until = self.right[x], self.left[t], rx - 1

    def encode(self, word: bytes) -> tuple[int, ...]:
        """Token ids of one pre-split word."""
        n = len(word)
        if n == 0:
            return ()
        step, token, arcs, size, most = self.step, self.token, self.arcs, len(self.labels), len(self.cut)
        ends = [-1] * (n + 1)
        ends[0] = -2
        back = [0] * (n + 1)
        for i in range(n):
            state = ends[i]
            if state == -1:
                continue
            node, j = 0, i
            while j < n:
                node = step.get(node << 9 | (word[j] + 256 if j == n - 1 else word[j]), -1)
                if node < 0:
                    break
                j += 1
                t = token[node]
                if t >= 0 and ends[j] == -1:
                    if state >= 0:
                        key = state * size + t
                        arc = arcs.get(key)
                        if arc is None:
                            if len(arcs) >= CACHE_ARCS:
                                arcs.clear()
                            arc = arcs[key] = self._arc(state, t, most)
                        if not arc:
                            continue
                    ends[j], back[j] = t, i
        out, j = [], n
        while j > 0:
            out.append(ends[j])
            j = back[j]
        return tuple(reversed(out))

    def _link(self, spelled: list[tuple[int, ...] | None]) -> None:
        """Tables for words side by side.

        ``back`` names the node of a node's longest proper suffix in the trie, ``best`` the longest token that ends
        at a node, and ``shorter`` the longest other token that a token ends with.
        """
        step, token = self.step, self.token
        back, best, shorter = [0] * len(token), list(token), [-1] * len(self.labels)
        depth = [0] * len(token)
        for key, node in step.items():
            depth[node] = depth[key >> 9] + 1
        for key, node in sorted(step.items(), key=lambda arc: depth[arc[1]]):
            at, s = key >> 9, key & 511
            while at:
                at = back[at]
                if (at << 9 | s) in step:
                    back[node] = step[at << 9 | s]
                    break
            other = best[back[node]] if back[node] else -1
            if token[node] >= 0:
                shorter[token[node]] = other
            else:
                best[node] = other
        self.steps, self.cuts = Numbers(step), Numbers(self.cut)
        self.back, self.best, self.shorter = (np.array(x, np.int32) for x in (back, best, shorter))
        # the last entry, for no token, is longer than any word
        self.length = np.array([*(len(symbols or ()) for symbols in spelled), SIDE_BYTES + 1], np.int32)
        self.lefts, self.rights, self.ranks = (np.array(x, np.int64) for x in (self.left, self.right, self.rank))
        self.seen = np.full(1 << SIDE_ARCS, -1, np.int64)

    def _resolved(self, keys: np.ndarray) -> np.ndarray:
        """``_arc`` with all merges, of keys ``state * tokens + token``."""
        x, t = np.divmod(keys, len(self.labels))
        until = np.full(len(keys), len(self.cut), np.int64)
        out, rows = np.zeros(len(keys), bool), np.arange(len(keys))
        while len(rows):
            cut = self.cuts.get(x * len(self.labels) + t)
            rx, rt = self.ranks[x], self.ranks[t]
            stands = (cut < 0) | (cut > until)
            out[rows[stands & (rx < 0) & (rt < 0)]] = True
            on = np.flatnonzero(stands & ((rx >= 0) | (rt >= 0)))
            rows, x, t, rx, rt = rows[on], x[on], t[on], rx[on], rt[on]
            x, t = np.where(rx >= rt, self.rights[x], x), np.where(rt >= rx, self.lefts[t], t)
            until = np.where(rx >= rt, rx - 1, rt)
        return out

    def _have_arc(self, keys: np.ndarray) -> np.ndarray:
        """``_resolved``, with a bounded memory: of the keys that share a place it holds the last."""
        at = _places(keys, SIDE_ARCS)
        held = self.seen[at]
        out = (held & 1).astype(bool)
        new = np.flatnonzero(held >> 1 != keys)
        if len(new):
            out[new] = self._resolved(keys[new])
            self.seen[at[new]] = keys[new] << 1 | out[new]
        return out

    def encode_all(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of pre-split words, one after the other, and their number per word; each word has a byte."""
        lengths = np.array([len(word) for word in words], np.int64)
        order = np.argsort(-lengths, kind="stable")
        n_long = int(np.count_nonzero(lengths > SIDE_BYTES))
        found = [np.array(self.encode(words[i]), np.int32) for i in order[:n_long].tolist()]
        counts = [np.array([len(ids) for ids in found], np.int64)]
        for a in range(n_long, len(order), SIDE_WORDS):
            rows = order[a : a + SIDE_WORDS]
            ids, each = self._side_by_side([words[i] for i in rows.tolist()], lengths[rows])
            found.append(ids)
            counts.append(each)
        flat, each = np.concatenate([np.empty(0, np.int32), *found]), np.concatenate(counts)
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        return _runs(flat, np.cumsum(each) - each, each, back), each[back]

    def _side_by_side(self, words: list[bytes], lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``encode_all`` of words that are ordered by length, the longest first."""
        n, size, length = len(words), len(self.labels), self.length
        most = int(lengths[0])
        symbols = np.frombuffer(b"".join(word.ljust(most, b"\0") for word in words), np.uint8).reshape(n, most).T.astype(np.int64)
        symbols[lengths - 1, np.arange(n)] += 256
        ends = np.zeros((most + 1, n), np.int32)  # the token that ends after so many bytes
        node = np.zeros(n, np.int64)
        for j in range(1, most + 1):
            n = int(np.searchsorted(-lengths, -j, "right"))  # words with as many bytes
            node, s = node[:n], symbols[j - 1, :n]
            found = self.steps.get(node << 9 | s)
            lost = np.flatnonzero(found < 0)
            while len(lost):
                node[lost] = self.back[node[lost]]
                found[lost] = self.steps.get(node[lost] << 9 | s[lost])
                lost = lost[found[lost] < 0]
            node = found.astype(np.int64)
            last = self.best[node]
            rows = np.flatnonzero(length[last] < j)
            while len(rows):
                t = last[rows]
                state = ends[j - length[t], rows].astype(np.int64)
                rows = rows[(state < 0) | ~self._have_arc(np.maximum(state, 0) * size + t)]
                last[rows] = self.shorter[last[rows]]
                rows = rows[length[last[rows]] < j]
            ends[j, :n] = last
        # back from the ends of the words
        rows, at, taken = np.arange(len(words)), lengths.copy(), []
        while len(rows):
            t = ends[at[rows], rows]
            taken.append((rows, t))
            at[rows] -= length[t]
            rows = rows[at[rows] > 0]
        counts = np.bincount(np.concatenate([r for r, _ in taken]), minlength=len(words))
        stop = np.cumsum(counts)
        flat = np.empty(stop[-1], np.int32)
        for k, (r, t) in enumerate(taken, 1):
            flat[stop[r] - k] = t
        return flat, counts

    def lowered(self, text: str) -> str:
        """Normal form of a text without special tokens."""
        text = unicodedata.normalize("NFC", text)
        if "Σ" in text:
            text = text.replace("Σ", "σ")  # letters are lowered one by one, without a final form
        return text.lower()

    def words(self, text: str) -> list[str]:
        """Pre-split words of a normal text."""
        if text.isascii() or not self.newer.search(text):
            return self.plain.findall(text)
        return self.exact.findall(text.translate(self.lower))


class Encoder:
    """The automaton with a bounded memory of what lies between white space."""

    def __init__(self, definition: str):
        self.automaton = Automaton(definition)
        self.spelled = [label.encode() for label in self.automaton.labels]
        special = "|".join(map(regex.escape, sorted(self.automaton.special, key=len, reverse=True)))
        self.special = regex.compile(f"({special})") if special else None
        self._forget()

    def _forget(self) -> None:
        """Knows special tokens only, each by its id."""
        ids = sorted(set(self.automaton.special.values()))
        self.known: dict[str | int, int] = {i: row for row, i in enumerate(ids)}
        self.flat = np.array(ids, np.int32)
        self.counts = np.ones(len(ids), np.int64)

    def _add(self, chunks: list[str], flat: np.ndarray, counts: np.ndarray) -> None:
        self.known.update(zip(chunks, range(len(self.counts), len(self.counts) + len(chunks)), strict=True))
        self.flat, self.counts = np.concatenate([self.flat, flat]), np.concatenate([self.counts, counts])

    def _of(self, chunks: Iterable[str | int]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of known chunks, one after the other, and their number per chunk."""
        rows = np.fromiter(map(self.known.__getitem__, chunks), np.int64)
        return _runs(self.flat, np.cumsum(self.counts) - self.counts, self.counts, rows), self.counts[rows]

    def _chunks(self, text: str) -> Iterator[list[str | int]]:
        """What lies between white space of a text in its normal form, and the ids of special tokens."""
        segments = self.special.split(text) if self.special and "<|" in text else [text]
        for segment in segments:
            if segment in self.automaton.special:
                yield [self.automaton.special[segment]]
                continue
            # no word goes over white space; the separators that Python adds to it are ordinary characters here
            lowered = self.automaton.lowered(segment)
            chunks = iter(_SPACE.split(lowered) if _SEPARATORS.search(lowered) else lowered.split())
            while some := list(islice(chunks, STEP_WORDS)):
                yield some

    def _learn(self, chunks: list[str | int]) -> list[str]:
        """Makes all chunks known; returns those that are too long to be remembered."""
        new = set(chunks).difference(self.known)
        if len(self.counts) + len(new) > CACHE_WORDS or len(self.flat) > CACHE_IDS:
            self._forget()
            new = set(chunks).difference(self.known)
        mixed = [chunk for chunk in new if not (chunk.isascii() and chunk.isalpha())]  # others are words
        words = self.automaton.words(" ".join(mixed))
        new.difference_update(mixed)
        new.update(words)
        new.difference_update(self.known)
        listed = list(new)
        self._add(listed, *self.automaton.encode_all([word.encode() for word in listed]))
        # words leave out nothing of a chunk, so lengths tell which are its own
        stops = np.cumsum(np.array([0, *map(len, words)], np.int64))
        last = np.searchsorted(stops, np.cumsum(np.array([len(chunk) for chunk in mixed], np.int64)))
        flat, counts = self._of(words)
        sums = np.concatenate([[0], np.cumsum(counts)])[np.concatenate([[0], last])]
        rows = [row for row, chunk in enumerate(mixed) if chunk not in self.known]
        joined = [mixed[row] for row in rows]
        counts = np.diff(sums)
        self._add(joined, _runs(flat, sums[:-1], counts, np.array(rows, np.int64)), counts[rows])
        return [chunk for chunk in chain(listed, joined) if len(chunk) > 64]

    def ids(self, texts: Iterable[str]) -> tuple[bytearray, list[int]]:
        """The ids of all texts as 32-bit numbers, and where each text's end."""
        out, ends = bytearray(), [0]
        held: list[str | int] = []
        stops: list[int] = []  # of texts that end among these chunks

        def flush() -> None:
            long = self._learn(held)
            flat, counts = self._of(held)
            sums = np.concatenate([[0], np.cumsum(counts)]) + len(out) // 4
            ends.extend(sums[stops].tolist())
            out.extend(flat.tobytes())
            for chunk in long:
                del self.known[chunk]
            held.clear()
            stops.clear()

        for text in texts:
            for chunks in self._chunks(text):
                held += chunks
                if len(held) >= STEP_WORDS:
                    flush()
            stops.append(len(held))
        flush()
        return out, ends


_LOADED: dict[tuple[str, int], object] = {}


def _loaded(make: Callable, definition: str):
    """What ``make`` builds of a definition; a worker builds it once."""
    key = (make.__name__, hash(definition))
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = make(definition)
    return _LOADED[key]


def _labels(definition: str) -> list[bytes]:
    return [label.encode() for label in labels_of(json.loads(definition))]


def _definition(spark: SparkSession, path: str):
    """The tokenizer file, read by the driver and sent once to every executor; a few megabytes at most."""
    with open(path, encoding="utf-8") as f:
        text = f.read()
    if len(text) > 64 << 20:
        raise ValueError(f"{path} is no tokenizer file")
    return spark.sparkContext.broadcast(text)


def _encoded(encode: Encoder, texts: pa.Array) -> pa.ListArray:
    ids, ends = encode.ids(text.as_py() or "" for text in texts)  # one buffer that Arrow takes as it is
    flat = pa.Array.from_buffers(pa.int32(), ends[-1], [None, pa.py_buffer(ids)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)


def _decoded(labels: list[bytes], ids: pa.Array) -> pa.StringArray:
    ids = ids.combine_chunks() if isinstance(ids, pa.ChunkedArray) else ids
    offsets = ids.offsets.to_numpy()
    values = ids.values.to_numpy(zero_copy_only=False)
    if len(values) and (values.min() < 0 or values.max() >= len(labels)):
        raise ValueError("an id is outside the vocabulary")
    out, ends = bytearray(), [0]
    for a, b in zip(offsets, offsets[1:], strict=False):
        out += b" ".join([labels[i] for i in values[a:b].tolist()])
        ends.append(len(out))
    return pa.StringArray.from_buffers(len(ids), pa.py_buffer(np.array(ends, np.int32)), pa.py_buffer(out))


def encoder(spark: SparkSession, path: str) -> Callable[[Column | str], Column]:
    """A function from a text column to ``array<int>``: the ids of the whole text.

    ``path`` names the definition of a byte-level BPE with word ends.  NULL and empty texts have
    no ids.  Special tokens in the text become their ids.  Any length of text or word is
    handled; work is linear in it.
    """
    small_batches(spark)
    sent = _definition(spark, path)

    def run(texts: pa.Array) -> pa.Array:
        return _encoded(_loaded(Encoder, sent.value), texts)

    # a plan that uses the ids twice would encode twice, were the function called deterministic
    return F.arrow_udf(run, "array<int>").asNondeterministic()


def decoder(spark: SparkSession, path: str) -> Callable[[Column | str], Column]:
    """A function from ids to text: the arc labels one after the other, joined by a space.

    That is the text of a definition without a decoder, word ends and special tokens included.
    NULL and empty arrays give an empty text; an id outside the vocabulary raises an error.
    """
    sent = _definition(spark, path)

    def run(ids: pa.Array) -> pa.Array:
        return _decoded(_loaded(_labels, sent.value), ids)

    return F.arrow_udf(run, "string")


def round_trip(spark: SparkSession, path: str) -> Callable[[Column | str], Column]:
    """A function from a text column to ``struct<ids, decoded>``: what ``encoder`` gives, and ``decoder`` for these ids.

    Both run in one Python worker of a task; as two functions they keep one each, and the ids pass through the JVM.
    """
    small_batches(spark)
    sent = _definition(spark, path)

    def run(texts: pa.Array) -> pa.Array:
        encode = _loaded(Encoder, sent.value)
        ids = _encoded(encode, texts)
        return pa.StructArray.from_arrays([ids, _decoded(encode.spelled, ids)], ["ids", "decoded"])

    return F.arrow_udf(run, "ids array<int>, decoded string").asNondeterministic()
