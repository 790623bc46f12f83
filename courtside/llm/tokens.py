"""Token ids of whole texts with the tokenizers library, each distinct chunk encoded once.

A tokenizer whose splitting rule drops white space gives the ids of a text as
the ids of its space-separated chunks in turn, and those of a chunk as the ids of
its runs of letters and of other characters.  For such a tokenizer each
distinct run of many texts goes through the library once and a bounded store
per Python worker keeps its ids, found again by 64-bit hashes; any other
tokenizer encodes each text whole.  Both ways return the library's own ids.
"""

from __future__ import annotations

import json
import re
from codecs import charmap_decode
from itertools import chain

import numpy as np
import xxhash
from tokenizers import Tokenizer

from courtside.llm.hashing import stretch_hashes

#: Distinct chunks that a worker keeps.
CACHE_CHUNKS = 500_000
BATCH_CHUNKS = 1000
#: Texts encoded at once.
GROUP_BYTES = 1 << 21
LONG_CHUNK = 256

# Fixed value: the splitting rule under which chunks are independent (every part excludes white space).
SPLIT_RULE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

_CHUNKS = bytes(c + 32 if 0x41 <= c <= 0x5A else 0x20 if c in b"\t\n\r" else c for c in range(256))
# A byte may stand before (after) the split of a letter and a sign, or of a sign and a letter.
_LETTER_SIGN, _SIGN_LETTER = 1, 2
_SIGNS = [0x21 <= c <= 0x7E and not chr(c).isalpha() for c in range(256)]
_BEFORE = np.array([_LETTER_SIGN * (0x61 <= c <= 0x7A) | _SIGN_LETTER * (_SIGNS[c] and c != 0x27) for c in range(256)], np.uint8)
_AFTER = np.array([_SIGN_LETTER * (0x61 <= c <= 0x7A) | _LETTER_SIGN * _SIGNS[c] for c in range(256)], np.uint8)
# Pairs with a first byte of the two-byte letters up to U+017F that are no letters, or more than one when lower-cased or composed.
_NO_LETTERS = (0xC397, 0xC3B7, 0xC4B0, 0xC589)

# Letters beyond these may be composed, split or lower-cased in ways of their own.
_OTHER = re.compile("[^a-zA-Z\u00c0-\u012f\u0131-\u0148\u014a-\u017e]")


class Encoder:
    """Ids of UTF-8 texts as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            config = json.load(f)
        self.tokenizer = Tokenizer.from_file(path)
        split = ((config.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
        lower = {"type": "Lowercase"} in ((config.get("normalizer") or {}).get("normalizers") or [])
        self.by_chunk = lower and split.get("pattern") == {"Regex": SPLIT_RULE} and split.get("behavior") == "Removed" and bool(split.get("invert"))
        self._forget()
        # Single digits are always split off, so one can stand between chunks that don't have it.
        self.marks = [(d.encode(), self._ids(d)) for d in "0123456789"]
        self.by_chunk &= all(len(ids) == 1 for _, ids in self.marks)
        # the byte-level alphabet: printable Latin-1 stands for itself, other bytes for letters from U+0100 on
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        letters = {b: 0x100 + k for k, b in enumerate(b for b in range(256) if b not in plain)}
        self.letters = "".join(chr(letters.get(b, b)) for b in range(256))

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)  # sorted hashes of known chunks
        self.at, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)  # their ids in the store
        self.store, self.used = np.zeros(1 << 16, np.uint32), 0

    def _library(self, chunks: list[bytes]) -> dict[bytes, list[int]]:
        """The library's ids of each chunk; plain words go straight to its model, others together."""
        out, rest = {}, []
        tokenize = self.tokenizer.model.tokenize
        for c in chunks:
            if c.isalpha():  # one word as the splitting rule has it; of bytes these are the letters A to Z
                out[c] = [t.id for t in tokenize(c.decode())]
            elif (word := c.decode()).isalpha() and not _OTHER.search(word):
                out[c] = [t.id for t in tokenize(charmap_decode(word.lower().encode(), "strict", self.letters)[0])]
            else:
                rest.append(c)
        for mark, (mark_id,) in self.marks:
            own = [c for c in rest if mark not in c]
            rest = [c for c in rest if mark in c]
            for k in range(0, len(own), BATCH_CHUNKS):
                part = own[k:k + BATCH_CHUNKS]
                ids = self._ids((b" " + mark + b" ").join(part).decode())
                cut = [-1, *[i for i, x in enumerate(ids) if x == mark_id], len(ids)]
                out.update(zip(part, [ids[s + 1:e] for s, e in zip(cut, cut[1:])], strict=True))
            if not rest:
                break
        return out | {c: self._ids(c.decode()) for c in rest}

    def _learn(self, keys: np.ndarray, chunks: list[bytes]) -> None:
        """Add chunks with their hashes (sorted, not known yet)."""
        found = self._library(list(set(chunks)))
        ids = [found[c] for c in chunks]
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        need = self.used + int(size.sum())
        if need > len(self.store):
            self.store = np.concatenate([self.store[:self.used], np.zeros(2 * need - self.used, np.uint32)])
        self.store[self.used:need] = np.fromiter(chain.from_iterable(ids), np.uint32, int(size.sum()))
        where = np.searchsorted(self.keys, keys)
        self.at = np.insert(self.at, where, self.used + np.cumsum(size) - size)
        self.size = np.insert(self.size, where, size)
        self.keys = np.insert(self.keys, where, keys)
        self.used = need

    def _encode_group(self, texts: list[bytes]) -> list[bytes]:
        raw = b" ".join(texts).translate(_CHUNKS)
        t = np.frombuffer(raw, np.uint8)
        space = np.concatenate([[True], t == 0x20, [True]])
        # Between a letter and a sign or digit the splitting rule always splits (after a quote mark a clitic may go on): chunks end there too.
        # No part of it is a combining mark, so both sides are normalised apart.
        before, after = _BEFORE[t], _AFTER[t]
        at = np.flatnonzero((t >= 0xC3) & (t <= 0xC5))
        at = at[~np.isin(t[at].astype(np.int32) << 8 | t[at + 1], _NO_LETTERS)]
        before[at + 1], after[at] = _LETTER_SIGN, _SIGN_LETTER
        stop = np.zeros(len(space), bool)
        stop[2:-1] = before[:-1] & after[1:]
        start = np.flatnonzero(~space[1:-1] & (space[:-2] | stop[1:-1]))
        end = np.flatnonzero(~space[1:-1] & (space[2:] | stop[2:])) + 1
        keys = stretch_hashes(t, start, end)
        long = np.flatnonzero(end - start > LONG_CHUNK)
        for k in long:  # too long to trust a polynomial: by a hash of its own
            keys[k] = xxhash.xxh3_64_intdigest(raw[start[k]:end[k]])
        order = np.argsort(keys)
        ranked = keys[order]
        fresh = np.ones(len(ranked), bool)
        fresh[1:] = ranked[1:] != ranked[:-1]
        number = np.empty(len(ranked), np.int64)
        number[order] = np.cumsum(fresh) - 1
        distinct, example = ranked[fresh], order[fresh]
        if len(self.keys) > CACHE_CHUNKS:
            self._forget()
        where = np.minimum(np.searchsorted(self.keys, distinct), max(0, len(self.keys) - 1))
        new = self.keys[where] != distinct if len(self.keys) else np.ones(len(distinct), bool)
        if new.any():
            first = example[new]
            self._learn(distinct[new], [raw[s:e] for s, e in zip(start[first].tolist(), end[first].tolist())])
            where = np.searchsorted(self.keys, distinct)
        at, size = self.at[where][number], self.size[where][number]
        before = np.concatenate([[0], np.cumsum(size)])
        ids = self.store[np.repeat(at - before[:-1], size) + np.arange(before[-1])]
        edges = np.cumsum([0] + [len(x) + 1 for x in texts])
        edge = before[np.searchsorted(start, edges)]
        raw_ids = ids.astype("<u4").tobytes()
        return [raw_ids[4 * s:4 * e] for s, e in zip(edge[:-1].tolist(), edge[1:].tolist())]

    def encode(self, texts: list[bytes | None]) -> list[bytes]:
        """Id bytes of each text; null is empty."""
        out: list[bytes] = [b""] * len(texts)
        group: list[int] = []
        size = 0
        for k, t in enumerate(texts):
            if not t:
                continue
            # Lower-casing first is safe unless a combining mark could join a letter, or a special token is spelt out.
            if not self.by_chunk or b"\xcc" in t or b"\xcd" in t or b"<|" in t:
                out[k] = np.array(self._ids(t.decode()), "<u4").tobytes()
                continue
            group.append(k)
            size += len(t)
            if size >= GROUP_BYTES or k == len(texts) - 1:
                for i, ids in zip(group, self._encode_group([texts[i] for i in group])):
                    out[i] = ids
                group, size = [], 0
        for i, ids in zip(group, self._encode_group([texts[i] for i in group]) if group else []):
            out[i] = ids
        return out


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a tokenizer file; it is kept between tasks."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
