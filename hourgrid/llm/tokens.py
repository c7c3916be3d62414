"""Token ids of whole texts with a public BPE tokenizer, by a cache of units.

The tokenizer lower-cases, drops white space, joins nothing across it, and its splitting pattern
parts letters and digits from signs, but for contractions. So a text may be cut at ASCII white space, and
between an ASCII letter or digit and an ASCII sign other than the apostrophe: no piece and no
composed character reaches across. These units repeat much more than texts. Array code
finds and hashes them (64 bits of the unit with A-Z lower-cased), a table of fixed size holds the ids of units met
before, and the library encodes each new unit once. A text that holds a special token's
string, in any case, goes to the library as it is. The ids equal those of the library over the
whole text, unless two units share a hash (one in 10**13 lookups at a full table).
The table lasts as long as the worker.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa

from hourgrid.llm.common import LOWER, SPACE, slabs, span_hash

UNITS = 700_000         # units kept by a worker; when full, the first two thirds stay
SLOT_BITS = 21
#: Lower-case Latin letters: one piece, which ends with the only id that ends a piece.
_ONE_PIECE = re.compile("[a-zß-öø-ÿĀ-įı-ňŊ-ž]+")
_LETTER, _SIGN = 1, 2
_CLASS = np.zeros(256, np.uint8)
_CLASS[[*range(48, 58), *range(65, 91), *range(97, 123)]] = _LETTER
_CLASS[[c for c in range(33, 127) if not chr(c).isalnum() and c != 39]] = _SIGN


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the units and each text's place in them (n + 1 entries)."""
    inside = ~SPACE[data]
    kind = _CLASS[data]
    fresh = np.ones(len(data) + 1, bool)            # a unit may begin here
    fresh[1:-1] = ~inside[:-1] | (kind[1:] + kind[:-1] == _LETTER + _SIGN) & (kind[1:] * kind[:-1] == _LETTER * _SIGN)
    fresh[offsets] = True
    starts = np.flatnonzero(inside & fresh[:-1])
    after = np.zeros(len(data), bool)
    after[:-1] = ~inside[1:]
    ends = np.flatnonzero(inside & (fresh[1:] | after)) + 1
    return starts, ends, np.searchsorted(starts, offsets)


class UnitEncoder:
    """Ids of texts as bytes of little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.low_specials = [s.lower().encode() for s in self.specials]
        vocabulary = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)     # ids that end a piece
        self.last[[i for s, i in vocabulary.items() if s.endswith("</w>")]] = True
        self._reset(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, "<u4"))

    # The table: hashes in one of two slots each, with the unit's number.

    def _reset(self, hashes: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> None:
        self.slot_hash = np.zeros((2, 1 << SLOT_BITS), np.uint64)
        self.slot_unit = np.full((2, 1 << SLOT_BITS), -1, np.int32)
        self.hashes, self.starts, self.ids = np.zeros(0, np.uint64), np.zeros(1, np.int64), np.zeros(0, "<u4")
        self._put(hashes, sizes, ids)

    def _put(self, hashes: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> None:
        number = np.arange(len(self.hashes), len(self.hashes) + len(hashes), dtype=np.int32)
        self.hashes = np.concatenate([self.hashes, hashes])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])
        self.ids = np.concatenate([self.ids, ids])
        first, _ = self._places(hashes)
        free = self.slot_unit[0, first] < 0
        self.slot_hash[0, first[free]] = hashes[free]
        self.slot_unit[0, first[free]] = number[free]
        left = self.slot_hash[0, first] != hashes       # the slot was taken, before or by another new unit
        _, second = self._places(hashes[left])
        self.slot_hash[1, second] = hashes[left]
        self.slot_unit[1, second] = number[left]

    @staticmethod
    def _places(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        mask = np.uint64((1 << SLOT_BITS) - 1)
        return (hashes & mask).astype(np.int64), ((hashes >> np.uint64(SLOT_BITS)) & mask).astype(np.int64)

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        first, second = self._places(hashes)
        unit = np.where(self.slot_hash[0, first] == hashes, self.slot_unit[0, first], -1)
        missing = np.flatnonzero(unit < 0)
        place = second[missing]
        unit[missing] = np.where(self.slot_hash[1, place] == hashes[missing], self.slot_unit[1, place], -1)
        return unit

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, hashes: np.ndarray, words: list[str]) -> None:
        if len(self.hashes) + len(words) > UNITS:
            keep = min(len(self.hashes), UNITS * 2 // 3)
            self._reset(self.hashes[:keep], np.diff(self.starts[: keep + 1]), self.ids[: self.starts[keep]])
        simple = [k for k, w in enumerate(words) if _ONE_PIECE.fullmatch(w)]
        alone = np.ones(len(words), bool)
        found: list = [None] * len(words)
        for at in range(0, len(simple), 512):
            part = simple[at: at + 512]
            ids = np.array(self.tokenizer.encode(" ".join([words[k] for k in part]), add_special_tokens=False).ids, "<u4")
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) == len(part) and ends[-1] == len(ids):
                for k, piece in zip(part, np.split(ids, ends[:-1])):
                    found[k] = piece
                alone[part] = False
        rest = np.flatnonzero(alone)
        for k, ids in zip(rest, self._whole([words[k] for k in rest])):
            found[k] = ids
        self._put(hashes, np.array([len(x) for x in found], np.int64), np.concatenate([np.zeros(0, "<u4"), *found]))

    def encode(self, texts) -> list[bytes]:
        """Of each text (list, or Arrow array of strings); null is empty."""
        column = texts if isinstance(texts, (pa.Array, pa.ChunkedArray)) else pa.array(texts, pa.large_string())
        out: list[bytes] = []
        for _, _, data, offsets in slabs(column, 1 << 20):
            out += self._slab(data, offsets)
        return out

    def _slab(self, data: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        lower = LOWER[data]
        starts, ends, place = units(data, offsets)
        hashes = span_hash(lower, starts, ends)
        unit = self._find(hashes)
        missing = np.flatnonzero(unit < 0)
        if len(missing):
            new, first = np.unique(hashes[missing], return_index=True)
            at = missing[np.sort(first)]         # in the order met: frequent units come early
            raw = lower.tobytes()
            self._learn(hashes[at], [raw[s:e].decode("utf-8", "replace") for s, e in zip(starts[at].tolist(), ends[at].tolist())])
            unit = self._find(hashes)
        lost = np.flatnonzero(unit < 0)         # pushed out of both slots by units of this slab
        sizes = self.starts[unit + 1] - self.starts[unit]
        extra = []
        if len(lost):
            raw = lower.tobytes()
            extra = self._whole([raw[starts[k]: ends[k]].decode("utf-8", "replace") for k in lost])
            sizes[lost] = [len(x) for x in extra]
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        source = np.repeat(self.starts[unit] - bounds[:-1], sizes) + np.arange(bounds[-1])
        if len(lost):
            source = np.minimum(source, max(len(self.ids) - 1, 0))
        ids = self.ids[source]
        for k, x in zip(lost, extra):
            ids[bounds[k]: bounds[k + 1]] = x
        cut = (4 * bounds[place]).tolist()
        flat = ids.tobytes()
        out = [flat[a:b] for a, b in zip(cut, cut[1:])]
        whole = lower.tobytes() if self.low_specials else b""
        if any(s in whole for s in self.low_specials):
            for k, (a, b) in enumerate(zip(offsets.tolist(), offsets[1:].tolist())):
                if any(s in whole[a:b] for s in self.low_specials):
                    out[k] = self._whole([data[a:b].tobytes().decode()])[0].tobytes()
        return out


_ENCODERS: dict[str, UnitEncoder] = {}


def encoder(path: str) -> UnitEncoder:
    """The worker's encoder: kept between tasks, as its table is."""
    if path not in _ENCODERS:
        _ENCODERS[path] = UnitEncoder(path)
    return _ENCODERS[path]


def with_end(encoded: bytes, end_id: int) -> bytes:
    return encoded + int(end_id).to_bytes(4, "little")
