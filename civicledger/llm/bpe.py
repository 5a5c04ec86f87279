"""Token ids of whole texts by the ``tokenizers`` library.

Byte-level pre-tokenisation never joins a letter with a following full stop or comma, nor anything with a single space
that another character follows. Texts are cut there, every different piece is encoded once per Python worker, and the
ids are put together again; the result is that of encoding the whole text. A text that spells one of the tokenizer's
added tokens is encoded as a whole, since these are found before any pre-tokenisation.
"""

from __future__ import annotations

import itertools
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from civicledger.llm import textbytes as tb

MOST_PIECES = 1_000_000
SLOT_BITS = 20

_SPACE = ~tb.NOT_SPACE
#: Bytes that white space may begin with outside ASCII, or that are white space: nothing is cut before these.
_MAYBE = _SPACE.copy()
_MAYBE[[0x1C, 0x1D, 0x1E, 0x1F, 0xC2, 0xE1, 0xE2, 0xE3]] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_STOP = np.zeros(256, bool)
_STOP[[0x2C, 0x2E]] = True
_encoders: dict[str, Encoder] = {}


class Encoder:
    """Ids of pieces, found by the hash of their bytes in a table with two places for each; bounded, never wrong.

    A piece that was pushed out is encoded again; everything is forgotten when there are over ``MOST_PIECES``.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.forget()

    def forget(self) -> None:
        self.ids, self.used = np.empty(1 << 20, np.uint32), 0
        self.place, self.pieces = np.zeros(1 << 20, np.int32), 0
        self.keys = [np.zeros(1 << SLOT_BITS, np.uint64) for _ in range(2)]
        self.at = [np.zeros(1 << SLOT_BITS, np.int32) for _ in range(2)]

    def slots(self, hashed: np.ndarray) -> list[np.ndarray]:
        return [(hashed >> np.uint64(64 - SLOT_BITS)).astype(np.int32), (hashed & np.uint64((1 << SLOT_BITS) - 1)).astype(np.int32)]

    def add(self, pieces: list[str]) -> np.ndarray:
        """Encodes pieces; their numbers."""
        start = self.pieces
        for at in range(0, len(pieces), 20_000):
            got = [x.ids for x in self.tokenizer.encode_batch_fast(pieces[at : at + 20_000], add_special_tokens=False)]
            lengths = np.fromiter(map(len, got), np.int64, len(got))
            flat = np.fromiter(itertools.chain.from_iterable(got), np.uint32, int(lengths.sum()))
            ends = self.used + np.cumsum(lengths)
            self.ids = _room(self.ids, int(ends[-1]))
            self.ids[self.used : ends[-1]] = flat
            self.place = _room(self.place, self.pieces + len(got) + 1)
            self.place[self.pieces + 1 : self.pieces + len(got) + 1] = ends
            self.used, self.pieces = int(ends[-1]), self.pieces + len(got)
        return np.arange(start, self.pieces, dtype=np.int32)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and where each text's ids start (and the last end)."""
        whole = np.zeros(len(column), bool)
        for name in self.added:
            whole |= pc.fill_null(pc.match_substring(column, name), False).to_numpy(zero_copy_only=False)
        if not whole.any():
            return self._by_pieces(column)
        ids, at = self._by_pieces(pc.if_else(pa.array(whole), pa.scalar("", column.type), column))
        rows = np.flatnonzero(whole)
        own = [np.array(self.tokenizer.encode(column[i].as_py(), add_special_tokens=False).ids, np.uint32) for i in rows.tolist()]
        lengths = np.diff(at)
        lengths[rows] = [len(x) for x in own]
        parts = [part for k, i in enumerate(rows.tolist()) for part in (ids[at[rows[k - 1]] if k else 0 : at[i]], own[k])]
        return np.concatenate([*parts, ids[at[rows[-1]] :]]), np.r_[0, np.cumsum(lengths)]

    def _by_pieces(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        data, offsets = tb.buffer(column)
        if not len(data):
            return np.empty(0, np.uint32), np.zeros(len(offsets), np.int64)
        following, before = np.r_[data[1:], np.uint8(32)], np.r_[np.uint8(32), data[:-1]]
        plain = ~_MAYBE[following]
        edge = (data == 0x20) & plain
        edge |= _STOP[data] & _LETTER[before]
        edge |= (data == 0x0A) & (before < 0x80) & ~_MAYBE[before]
        last = (data == 0x0A) & plain  # the last of a run of white space stands alone
        edge |= last
        edge[1:] |= last[:-1]
        edge[offsets[:-1][offsets[:-1] < len(data)]] = True
        starts = np.flatnonzero(edge)
        ends = np.r_[starts[1:], len(data)]
        hashed = tb.cut(tb.prefix(data), starts, ends)
        if self.pieces > MOST_PIECES:
            self.forget()
        one, two = self.slots(hashed)
        at = self.at[0][one]
        missed = np.flatnonzero(self.keys[0][one] != hashed)
        if len(missed):
            at[missed] = self.at[1][two[missed]]
            missed = missed[self.keys[1][two[missed]] != hashed[missed]]
        if len(missed):
            distinct, first, which = np.unique(hashed[missed], return_index=True, return_inverse=True)
            new = self.add([data[starts[j] : ends[j]].tobytes().decode() for j in missed[first].tolist()])
            at[missed] = new[which]
            one, two = self.slots(distinct)
            free = self.keys[0][one] == 0
            for table, slot, chosen in ((0, one, free), (1, two, ~free)):
                slot, last = np.unique(slot[chosen][::-1], return_index=True)  # of several for one slot one stays
                self.keys[table][slot] = distinct[chosen][::-1][last]
                self.at[table][slot] = new[chosen][::-1][last]
        place = self.place[at].astype(np.int64)
        counts = self.place[at + 1] - place
        before_piece = np.r_[0, np.cumsum(counts)]
        ids = self.ids[np.repeat(place - before_piece[:-1], counts) + np.arange(before_piece[-1])]
        return ids, before_piece[np.searchsorted(starts, offsets)]


def _room(array: np.ndarray, size: int) -> np.ndarray:
    return array if size <= len(array) else np.concatenate([array, np.zeros(max(len(array) // 2, size - len(array)), array.dtype)])


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
