"""Byte-level BPE as a deterministic automaton over tokens.

The automaton accepts exactly the token strings that BPE produces.  It is
built by one gadget per merge, in order.  At first there is one state with an
arc to itself for every byte.  The gadget of the merge (u, v) -> uv looks at
the paths ``s -u-> p -v-> q``: it adds the arc ``s -uv-> q`` beside each, and
splits ``p`` into a copy without the arc ``v``, to which the ``u`` arcs are
led instead, so the path of the two unmerged tokens is gone.

In every step of this construction all arcs with one label lead to one state,
so a state is named by the tokens that lead to it and copying it means one
record: (u, v) -> k, the state behind ``u`` lost its arc ``v`` at merge k.  The
state behind a token uv starts as the state behind v was at that merge, so the
losses of a state are those of u, of its right part before u was made, of that
part's right part, and so on; an arc uv exists where the arc u did when uv was
made, so an arc is gone if it, or one of its left parts before it was made, is
among the losses.  ``arc`` reads these records and its answers are tabled.

Encoding reads a pre-split word byte by byte.  Every prefix has exactly one
accepted token string, so a position keeps its last token only.  The next
byte's arc is taken if the state has it.  If a gadget removed it, the merge
(r, t) of that gadget put the arc rt beside the path r, t: the reader goes back
to where r began and follows that arc, as often as needed.  These steps are a
function of the state and the label alone and are tabled.  Decoding emits the
labels of the arcs.

Whole texts of any length are handled; the words of a text are looked up in a
bounded table of words seen before.  Defined results: a null text is an empty
text and has no tokens; special tokens' strings in a text become their ids;
decoding skips null ids and raises on unknown ones; rows are independent, so
repeated rows, ties and extra columns change nothing.
"""

from __future__ import annotations

import gc
import json
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: the pattern that splits a text before the merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Words and steps kept in a worker's tables; a full one is emptied, which costs time only.
WORDS_KEPT, STEPS_KEPT = 600_000, 300_000


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in byte-level vocabularies.

    Printable bytes stand for themselves; the others, in order, get the
    letters from code point 256 on.
    """
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


_NEVER = 1 << 60


class Automaton:
    """The tokenization automaton of a list of merges over byte strings."""

    def __init__(self, ids: dict[bytes, int], merges: list[tuple[bytes, bytes]]):
        self.byte = [ids.get(bytes([b]), -1) for b in range(256)]
        self.size = {i: len(t) for t, i in ids.items()}
        self.made: dict[int, int] = {}  # merge -> its token
        self.born: dict[int, int] = {ids[bytes([b])]: 0 for b in range(256) if bytes([b]) in ids}
        self.left: dict[int, int] = {}
        self.right: dict[int, int] = {}
        self.lost: dict[int, int] = {}  # (state of u, arc v) as u << 32 | v -> merge
        self.known: dict[int, int] = {}
        for k, (u, v) in enumerate(merges, 1):
            self._gadget(k, ids[u], ids[v], ids[u + v])

    def _gadget(self, k: int, u: int, v: int, token: int) -> None:
        if token in self.born or u not in self.born or v not in self.born or not self.arc(u, v):
            return  # no path u, v is left, or uv is there: the merge changes nothing
        self.lost[u << 32 | v] = k
        self.made[k] = token
        self.born[token], self.left[token], self.right[token] = k, u, v

    def arc(self, state: int, token: int) -> bool:
        """Whether the state behind the token ``state`` has an arc labelled ``token``."""
        lost, left, right, born = self.lost, self.left, self.right, self.born
        before = _NEVER
        while True:
            t, until = token, _NEVER
            while True:
                k = lost.get(state << 32 | t, _NEVER)
                if k < before and k <= until and k < _NEVER:
                    return False
                if t not in left:
                    break
                until, t = born[t], left[t]
            if state not in right:
                return True
            before, state = born[state], right[state]

    def step(self, state: int, token: int) -> int:
        """The label to follow instead if the state behind ``state`` lost its arc ``token`` itself, else -1."""
        lost, right, born = self.lost, self.right, self.born
        first, at, before = _NEVER, -1, _NEVER
        while True:
            k = lost.get(state << 32 | token, _NEVER)
            if k < before and k < first:
                first, at = k, state
            if state not in right:
                break
            before, state = born[state], right[state]
        return self.made[first] if at >= 0 else -1

    def word(self, w: bytes) -> tuple[int, ...]:
        """Ids of the one accepted token string that spells ``w``."""
        known, size, byte = self.known, self.size, self.byte
        n = len(w)
        last, starts = [0] * (n + 1), [0] * (n + 1)
        end = 0
        for b in w:
            start, end, t = end, end + 1, byte[b]
            while start:
                key = last[start] << 32 | t
                instead = known.get(key)
                if instead is None:
                    if len(known) >= STEPS_KEPT:
                        known.clear()
                    instead = known[key] = self.step(last[start], t)
                if instead < 0:
                    break
                t = instead
                start = end - size[t]
            last[end], starts[end] = t, start
        out = []
        while end:
            out.append(last[end])
            end = starts[end]
        return tuple(out[::-1])  # a tuple of numbers is no work for the garbage collector


class Tokenizer:
    """Encodes and decodes whole texts with a vocabulary file's automaton."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        raw = lambda s: bytes(letters[c] for c in s)
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ids = {raw(t): i for t, i in spec["model"]["vocab"].items() if t not in special}
        pairs = (m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"])
        self.automaton = Automaton(ids, [(raw(a), raw(b)) for a, b in pairs])
        self.special = special
        by_id = {i: t for t, i in ids.items()} | {i: t.encode() for t, i in special.items()}
        self.labels = [by_id.get(i) for i in range(max(by_id, default=-1) + 1)]
        self.split = regex.compile(PATTERN).findall
        names = sorted(special, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, names)) + ")").split if names else None
        self.words: dict[str, tuple[int, ...]] = {}

    def encode(self, text: str | None) -> list[int]:
        out: list[int] = []
        words, add, special = self.words, out.extend, self.special
        for piece in self.cut(text or "") if self.cut else [text or ""]:
            if piece in special:
                out.append(special[piece])
                continue
            for w in self.split(piece):
                ids = words.get(w)
                if ids is None:
                    ids = self.automaton.word(w.encode("utf-8"))
                    if len(w) <= 64:
                        if len(words) >= WORDS_KEPT:
                            words.clear()
                        words[w] = ids
                add(ids)
        return out

    def decode(self, ids) -> str:
        labels = self.labels
        return b"".join([labels[i] for i in ids if i is not None]).decode("utf-8", errors="replace")


@lru_cache(maxsize=2)
def tokenizer(path: str) -> Tokenizer:
    """The tokenizer of a file, compiled once in each worker."""
    return Tokenizer(path)


def encode(text: Column, path: str | None = None) -> Column:
    """array<int> of token ids of each whole text."""

    def batches(texts: pa.Array) -> pa.Array:
        t = tokenizer(path or default_vocabulary())
        flat, ends = array("i"), [0]
        gc.disable()  # nothing here makes cycles; the collector would walk the table of words again and again
        try:
            for x in texts.to_pylist():
                flat.extend(t.encode(x))
                ends.append(len(flat))
        finally:
            gc.enable()
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(flat, np.int32)))

    return F.arrow_udf(batches, "array<int>")(text)


def decode(ids: Column, path: str | None = None) -> Column:
    """The text that token ids stand for; a null list is an empty one."""

    def batches(lists: pa.Array) -> pa.Array:
        t = tokenizer(path or default_vocabulary())
        return pa.array([t.decode(x.values.to_numpy().tolist() if x.is_valid else []) for x in lists], pa.string())

    return F.arrow_udf(batches, "string")(ids)
