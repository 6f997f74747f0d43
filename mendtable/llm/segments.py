"""Text cut into segments that byte-level tokenizers treat alone, each encoded once per worker.

A text may be cut before any space that a character other than white space follows, between a letter
or digit and a punctuation mark, and around a single line break between a mark or letter and a letter:
the pattern that makes words puts a border there whatever else stands around. Borders within special
tokens are left alone. Segments are found, hashed and looked up
for a whole batch at once; only segments not met before go to the encoder. The table of known
segments keeps their bytes, and what is found by hash is compared with them: a segment that shares
another one's hash is encoded each time it is met.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np

from .common import ranges
from .hashing import distinct_spans, equal_spans

#: A table of more segments (about 50 bytes each) forgets those not met since it last did; so does one of
#: more than ``ROOM`` times as many ids or bytes.
REMEMBERED = 700_000
ROOM = 16

#: Encodes segments, none empty: all ids one after the other, and how many each segment has.
Encoder = Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]

# A space is no border before these bytes: control bytes and spaces, and the first bytes of the
# letters that may be white space outside ASCII.
_NO_BORDER = np.zeros(256, bool)
_NO_BORDER[: 0x21] = True
_NO_BORDER[[0xC2, 0xE1, 0xE2, 0xE3]] = True

# ASCII letters; letters and digits; punctuation; all of these
_LETTERS = np.array([chr(b).isalpha() and b < 0x80 for b in range(256)])
_SIGNS = np.array([chr(b).isalnum() and b < 0x80 for b in range(256)])
_PLAIN = np.array([0x20 < b < 0x7F for b in range(256)])
_MARKS = _PLAIN & ~_SIGNS


class SegmentTable:
    def __init__(self, encode: Encoder, remembered: int = REMEMBERED, special: Iterable[bytes] = ()):
        self.encode_new = encode
        self.marks, self.breaks = _MARKS.copy(), True
        for token in special:
            self.breaks &= b"\n" not in token
            for before, mark in zip(token, token[1:]):
                if _SIGNS[before]:
                    self.marks[mark] = False
        self.remembered = remembered
        self._clear()

    def _clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        # for each key: where its ids start and how many they are, the same for its bytes, if met again
        self.starts, self.sizes, self.places, self.lengths = (np.zeros(0, np.int64) for _ in range(4))
        self.met = np.zeros(0, bool)
        self.ids, self.used = np.zeros(1 << 18, np.int32), 0
        self.text, self.written = np.zeros(1 << 18, np.uint8), 0

    def _forget(self) -> None:
        kept = np.flatnonzero(self.met)
        ids, text = self.ids[ranges(self.starts[kept], self.sizes[kept])], self.text[ranges(self.places[kept], self.lengths[kept])]
        if 2 * max(len(kept), len(ids) // ROOM, len(text) // ROOM) > self.remembered:
            self._clear()
            return
        self.keys, self.sizes, self.lengths = self.keys[kept], self.sizes[kept], self.lengths[kept]
        self.starts, self.places = np.cumsum(self.sizes) - self.sizes, np.cumsum(self.lengths) - self.lengths
        self.met = np.zeros(len(kept), bool)
        self.ids, self.used = np.concatenate([ids, np.zeros(1 << 18, np.int32)]), len(ids)
        self.text, self.written = np.concatenate([text, np.zeros(1 << 18, np.uint8)]), len(text)

    def encode(self, raw: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Encode the texts raw[ends[i]:ends[i + 1]]: all ids, and the text borders among them."""
        if len(raw) == 0:
            return np.zeros(0, np.int32), np.zeros(len(ends), np.int64)
        border = np.zeros(len(raw), bool)
        border[:-1] = (raw[:-1] == 0x20) & ~_NO_BORDER[raw[1:]]
        border[1:] |= _SIGNS[raw[:-1]] & self.marks[raw[1:]]
        if self.breaks and len(raw) > 2:
            line = np.flatnonzero((raw[1:-1] == 0x0A) & _PLAIN[raw[:-2]] & _LETTERS[raw[2:]]) + 1
            border[line] = border[line + 1] = True
        border[ends[:-1][ends[:-1] < ends[1:]]] = True
        starts = np.flatnonzero(border)
        stops = np.append(starts[1:], len(raw))
        seen, first, number = distinct_spans(raw, starts, stops)
        begins, sizes = (of_distinct[number] for of_distinct in self._look_up(seen, raw, starts[first], stops[first]))
        ids = self.ids[ranges(begins, sizes)]
        total = np.concatenate([[0], np.cumsum(sizes)])
        return ids, total[np.searchsorted(starts, ends)]

    def _look_up(self, seen, raw, starts, stops) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of different segments start, and how many they are; the first have the hashes ``seen``."""
        if max(len(self.keys), self.used // ROOM, self.written // ROOM) > self.remembered:
            self._forget()
        begins, sizes = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
        lengths = stops - starts
        at = np.searchsorted(self.keys, seen)
        hashed = np.zeros(len(seen), bool)
        inside = at < len(self.keys)
        hashed[inside] = self.keys[at[inside]] == seen[inside]
        known = np.flatnonzero(hashed)
        known = known[self.lengths[at[known]] == lengths[known]]
        known = known[equal_spans(raw, starts[known], self.text, self.places[at[known]], lengths[known])]
        self.met[at[known]] = True
        begins[known], sizes[known] = self.starts[at[known]], self.sizes[at[known]]
        unknown = np.ones(len(starts), bool)
        unknown[known] = False
        todo = np.flatnonzero(unknown)
        if len(todo):
            data = raw.tobytes()
            ids, sizes[todo] = self.encode_new([data[s:e] for s, e in zip(starts[todo].tolist(), stops[todo].tolist())])
            begins[todo] = self._append("ids", "used", ids) + np.cumsum(sizes[todo]) - sizes[todo]
            new = np.flatnonzero(~hashed)
            places = self._append("text", "written", raw[ranges(starts[new], lengths[new])]) + np.cumsum(lengths[new]) - lengths[new]
            for name, values in (("keys", seen), ("starts", begins), ("sizes", sizes), ("lengths", lengths)):
                setattr(self, name, np.insert(getattr(self, name), at[new], values[new]))
            self.places = np.insert(self.places, at[new], places)
            self.met = np.insert(self.met, at[new], False)
        return begins, sizes

    def _append(self, name: str, count: str, values: np.ndarray) -> int:
        """Write values behind those of a growing array; where they start."""
        start, room = getattr(self, count), getattr(self, name)
        if start + len(values) > len(room):
            room = np.concatenate([room, np.zeros(max(len(room), len(values)), room.dtype)])
            setattr(self, name, room)
        room[start : start + len(values)] = values
        setattr(self, count, start + len(values))
        return start
