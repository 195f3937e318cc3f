"""Token ids of many texts by a tokenizer file of the ``tokenizers`` library.

Where the file's rules allow it, texts are cut at places that its own
pre-tokenizer always cuts at, each distinct chunk is encoded once by the
library, and a text is a gather of known chunks. Chunks are told apart by
64-bit hashes; the memory of a worker is bounded and emptied when full.
"""

from __future__ import annotations

import json

import numpy as np

from .text import LOWER, word_hashes

MOST_CHUNKS = 3_000_000
LEARN = 4096
_loaded: dict[tuple[str, bool], "Ids"] = {}
#: Fixed value: the pattern of pre-tokens for which the cuts below are right.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

# classes of bytes: 0 white space, 1 letter, 2 digit, 3 punctuation, 4 all that depends on what stands beside it
_KIND = np.full(256, 4, np.uint8)
_KIND[[0x20, *range(0x09, 0x0E)]] = 0
_KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = 1
_KIND[0x30:0x3A] = 2
_KIND[[*range(0x21, 0x27), *range(0x28, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = 3
_CUT = np.zeros((5, 5), bool)
for _a, _b in ((1, 2), (2, 1), (1, 3), (3, 1), (2, 2), (2, 3), (3, 2)):
    _CUT[_a, _b] = True
_CUT = _CUT.reshape(-1)


def tokenizer(path: str, plain_specials: bool = False) -> "Ids":
    """One per worker and file. ``plain_specials``: strings of special tokens are ordinary text."""
    if (path, plain_specials) not in _loaded:
        _loaded[path, plain_specials] = Ids(path, plain_specials)
    return _loaded[path, plain_specials]


class Ids:
    def __init__(self, path: str, plain_specials: bool = False):
        from tokenizers import Tokenizer

        self.tok, self.plain = Tokenizer.from_file(path), plain_specials
        self.tok.encode_special_tokens = plain_specials
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        split = ((spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
        lower = [x.get("type") for x in (spec.get("normalizer") or {}).get("normalizers", [])]
        self.cuts = split.get("pattern") == {"Regex": PATTERN} and split.get("behavior") == "Removed" and split.get("invert") is True and lower == ["NFC", "Replace", "Lowercase"]
        self.specials = [x["content"].encode() for x in spec.get("added_tokens", [])]
        self._forget()

    def _forget(self) -> None:
        self.known, self.at = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.flat, self.offs = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def _learn(self, hashes: np.ndarray, chunks: list[str]) -> None:
        """Sorted new hashes and their chunks."""
        ids, size = [], []
        for lo in range(0, len(chunks), LEARN):
            got = [e.ids for e in self.tok.encode_batch_fast(chunks[lo : lo + LEARN], add_special_tokens=False)]
            size += map(len, got)
            ids.append(np.array([x for g in got for x in g], np.uint32))
        n = len(self.offs) - 1
        self.flat = np.concatenate([self.flat, *ids])
        self.offs = np.concatenate([self.offs, self.offs[-1] + np.cumsum(size)])
        place = np.searchsorted(self.known, hashes)
        self.known = np.insert(self.known, place, hashes)
        self.at = np.insert(self.at, place, np.arange(n, n + len(hashes)))

    def _whole(self, raw: bytes) -> np.ndarray:
        return np.array(self.tok.encode(raw.decode(errors="replace"), add_special_tokens=False).ids, np.uint32)

    def encode(self, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in ``buf``, and the offsets of each text."""
        n = len(offs) - 1
        if not self.cuts:
            parts = [self._whole(buf[a:b].tobytes()) for a, b in zip(offs[:-1], offs[1:], strict=True)]
            return np.concatenate([np.zeros(0, np.uint32), *parts]), np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
        kind = _KIND[buf]
        start = kind != 0
        if len(buf):
            start[1:] &= (kind[:-1] == 0) | _CUT[kind[:-1] * np.uint8(5) + kind[1:]]
            first = offs[:-1][offs[:-1] < len(buf)]
            start[first] = kind[first] != 0
        starts = np.flatnonzero(start)
        blank = np.flatnonzero(kind == 0)
        # a chunk ends at the next chunk, the next blank or its text's end
        ends = np.append(starts[1:], len(buf))
        if len(blank):
            at = np.searchsorted(blank, starts)
            ends = np.minimum(ends, np.where(at < len(blank), blank[np.minimum(at, len(blank) - 1)], len(buf)))
        ends = np.minimum(ends, offs[np.searchsorted(offs, starts, "right")] if len(starts) else ends)
        h = word_hashes(LOWER[buf], starts, ends) if len(starts) else np.zeros(0, np.uint64)
        distinct, one, back = np.unique(h, return_index=True, return_inverse=True)
        if len(self.known) > MOST_CHUNKS:
            self._forget()
        place = np.minimum(np.searchsorted(self.known, distinct), max(len(self.known) - 1, 0))
        new = self.known[place] != distinct if len(self.known) else np.ones(len(distinct), bool)
        if new.any():
            raw = buf.tobytes()
            self._learn(distinct[new], [raw[starts[i] : ends[i]].decode(errors="replace") for i in one[new]])
        chunk = self.at[np.searchsorted(self.known, distinct)][back] if len(distinct) else np.zeros(0, np.int64)
        size = self.offs[chunk + 1] - self.offs[chunk]
        stop = np.cumsum(size)
        place = np.arange(int(stop[-1]) if len(stop) else 0)
        place += np.repeat(self.offs[chunk] - (stop - size), size)
        ids = self.flat[place]
        edge = np.concatenate([[0], stop])[np.searchsorted(starts, offs)].astype(np.int64)
        if self.plain or not any(s in buf.tobytes() for s in self.specials):
            return ids, edge
        texts = [buf[offs[i] : offs[i + 1]].tobytes() for i in range(n)]
        parts = [self._whole(t) if any(s in t for s in self.specials) else ids[edge[i] : edge[i + 1]] for i, t in enumerate(texts)]
        return np.concatenate([np.zeros(0, np.uint32), *parts]), np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
