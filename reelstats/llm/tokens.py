"""Whole-text token ids with the tokenizers library, and their digests.

Both vocabularies used here never merge across the start of a white-space run:
their pre-tokenizers cut there. A text is therefore cut into pieces, each
distinct piece is encoded once per Python worker (ids are cached by the piece's
64-bit hash), and the ids are laid out with numpy. New pieces go to the library
joined by a separator whose id ends a piece; pieces for which that would not be
exact (they hold the separator or an unusual white-space run) go one by one.
Texts with Unicode white space beyond ASCII, where a run could go on across a
cut, are encoded whole.

With added_tokens, added tokens of the vocabulary ('<|endoftext|>') found in a
text get their own ids, as the library does by default, and texts that hold one
are encoded whole; without, they are text like any other.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from reelstats.llm import arrowtext as at

CACHE_PIECES = 600_000
CHUNK_BYTES = 3 << 20
#: White space in Unicode beyond ASCII, and the control characters some engines count as such.
OTHER_SPACE = "[\u0085\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\u001c-\u001f]"


class Encoder:
    """Encodes string columns; tokenizer and piece cache live in the Python worker.

    keeps_space: the vocabulary has tokens with a leading space (byte-level
    BPE); else white space is dropped and only words are pieces.
    """

    def __init__(self, path: str, added_tokens: bool = False):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        state = at.process_cache(f"tokenizer {path} {added_tokens}")
        if "tok" not in state:
            tok = Tokenizer.from_file(path)
            tok.encode_special_tokens = not added_tokens
            # special tokens too, if added_tokens; the others are always found
            added = [t for t in tok.get_added_tokens_decoder().values() if added_tokens or not t.special]
            state["whole"] = "|".join([OTHER_SPACE, *(re.escape(t.content) for t in added)])
            if any(t.normalized for t in added) and tok.normalizer is not None:
                state["whole"] = ""  # matched in the normalized text: every text is encoded whole
            state["keeps_space"] = len(tok.encode("a  b", add_special_tokens=False).ids) > 2
            state["separator"] = b"\n" if state["keeps_space"] else b"~"
            state["tok"] = tok
            self._reset(state)
        self.state = state
        self.keeps_space, self.separator = state["keeps_space"], state["separator"]
        (self.end_of_piece,) = self._encode([self.separator.decode()])[0]

    @staticmethod
    def _reset(state: dict) -> None:
        state["hash"] = np.zeros(0, at.U64)  # sorted
        state["at"] = np.zeros(0, np.int64)
        state["len"] = np.zeros(0, np.int64)
        state["pool"] = np.zeros(0, np.uint32)

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.state["tok"].encode_batch_fast(texts, add_special_tokens=False)]

    def _pieces(self, buf: np.ndarray, off: np.ndarray):
        """(start, end, row, simple) of the pieces, in text order; a row's pieces cover all that gives ids."""
        start, end, counts = at.words(buf, off)
        row = at.rows_of(counts)
        if not self.keeps_space:
            return start, end, row, np.ones(len(start), bool)
        # the white-space run before each word, from the word before it or the row's start
        before = np.empty_like(start)
        before[1:] = end[:-1]
        has = counts > 0
        first = (np.cumsum(counts) - counts)[has]
        before[first] = off[:-1][has]
        lead = start - before
        lone = buf[np.maximum(start - 1, 0)]
        newline = (lead == 1) & (lone == 10)
        simple = (lead == 0) | ((lead == 1) & ((lone == 32) | newline))
        begin = np.where(newline, start, before)
        # white space after a row's last word, or all of a blank row
        last = off[:-1].copy()
        last[has] = end[np.cumsum(counts)[has] - 1]
        tail = np.flatnonzero(off[1:] > last)
        nl = np.flatnonzero(newline)
        s = np.concatenate([begin, start[nl] - 1, last[tail]])
        e = np.concatenate([end, start[nl], off[1:][tail]])
        r = np.concatenate([row, row[nl], tail])
        ok = np.concatenate([simple, np.zeros(len(nl) + len(tail), bool)])
        order = np.argsort(s, kind="stable")
        return s[order], e[order], r[order], ok[order]

    def _learn(self, buf: np.ndarray, s: np.ndarray, e: np.ndarray, simple: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids per piece) of pieces that the cache doesn't have."""
        sep = np.zeros(len(buf) + 1, np.int64)
        np.cumsum(buf == self.separator[0], out=sep[1:])
        joint = simple & (sep[e] == sep[s])
        glue = np.frombuffer(self.separator if self.keeps_space else b" " + self.separator + b" ", np.uint8)
        size = np.zeros(len(s), np.int64)
        parts: list[np.ndarray] = [np.zeros(0, np.uint32)] * 2
        j = np.flatnonzero(joint)
        if len(j):
            n = e[j] - s[j]
            text = np.empty(int(n.sum()) + len(j) * len(glue), np.uint8)
            begin = np.cumsum(n + len(glue)) - n - len(glue)
            text[at.flat(begin, n)] = buf[at.flat(s[j], n)]
            for k, byte in enumerate(glue):
                text[begin + n + k] = byte
            # strings of some thousand pieces each
            cut = np.concatenate([begin[::4000], [len(text)]])
            data = text.tobytes()
            ids = np.concatenate([np.array(x, np.uint32) for x in self._encode([data[a:b].decode() for a, b in zip(cut[:-1].tolist(), cut[1:].tolist())])])
            ends = np.flatnonzero(ids == self.end_of_piece)
            if len(ends) != len(j):
                raise AssertionError("separator ids and pieces differ in number")
            size[j] = np.diff(np.concatenate([[-1], ends])) - 1
            parts[0] = ids[ids != self.end_of_piece]
        o = np.flatnonzero(~joint)
        if len(o):
            data = buf.tobytes()
            alone = self._encode([data[a:b].decode() for a, b in zip(s[o].tolist(), e[o].tolist())])
            size[o] = [len(x) for x in alone]
            parts[1] = np.array([i for x in alone for i in x], np.uint32)
        # back to the order of the pieces
        place = np.empty(len(s), np.int64)
        both = np.concatenate([j, o])
        run = size[both]
        place[both] = np.cumsum(run) - run
        return np.concatenate(parts)[at.flat(place, size)], size

    def _lookup(self, buf: np.ndarray, s: np.ndarray, e: np.ndarray, simple: np.ndarray):
        """(pool, place, length): ids of piece i are pool[place[i] : place[i] + length[i]]."""
        key, where, inverse = np.unique(at.span_hash(buf, s, e), return_index=True, return_inverse=True)
        c = self.state
        pos = np.minimum(np.searchsorted(c["hash"], key), max(len(c["hash"]) - 1, 0))
        known = c["hash"][pos] == key if len(c["hash"]) else np.zeros(len(key), bool)
        new = np.flatnonzero(~known)
        if len(new):
            ids, size = self._learn(buf, s[where[new]], e[where[new]], simple[where[new]])
            if len(c["hash"]) + len(new) > CACHE_PIECES and len(c["hash"]):
                # start anew with what this chunk uses
                old, n_old = c["at"][pos[known]], c["len"][pos[known]]
                pool = c["pool"][at.flat(old, n_old)]
                c["hash"], c["at"], c["len"], c["pool"] = key[known], np.cumsum(n_old) - n_old, n_old, pool
            base = len(c["pool"])
            c["pool"] = np.concatenate([c["pool"], ids])
            merged = np.concatenate([c["hash"], key[new]])
            order = np.argsort(merged, kind="stable")
            c["hash"] = merged[order]
            c["at"] = np.concatenate([c["at"], base + np.cumsum(size) - size])[order]
            c["len"] = np.concatenate([c["len"], size])[order]
            pos = np.searchsorted(c["hash"], key)
        return c["pool"], c["at"][pos][inverse], c["len"][pos][inverse]

    def batch(self, arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids as uint32, ids per row); null counts as empty."""
        arr = pc.fill_null(arr.cast(pa.large_string()), "")
        buf, off = at.utf8(arr)
        rows = len(arr)
        odd = pc.match_substring_regex(arr, self.state["whole"]).to_numpy(zero_copy_only=False).astype(bool)
        s, e, row, simple = self._pieces(buf, off)
        if odd.any():
            plain = ~odd[row]
            s, e, row, simple = s[plain], e[plain], row[plain], simple[plain]
        pool, place, length = self._lookup(buf, s, e, simple)
        ids = pool[at.flat(place, length)]
        per_row = np.bincount(row, weights=length, minlength=rows).astype(np.int64)
        if not odd.any():
            return ids, per_row
        which = np.flatnonzero(odd).tolist()
        whole = {i: np.array(x, np.uint32) for i, x in zip(which, self._encode([arr[i].as_py() for i in which]))}
        cut = np.concatenate([[0], np.cumsum(per_row)])
        parts = [whole[i] if i in whole else ids[cut[i] : cut[i + 1]] for i in range(rows)]
        return np.concatenate(parts), np.array([len(p) for p in parts], np.int64)

    def with_end(self, arr: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """As batch, with end_id after the ids of every row; gives (ids, row offsets)."""
        ids, n = self.batch(arr)
        off = np.concatenate([[0], np.cumsum(n + 1)])
        out = np.full(off[-1], end_id, np.uint32)
        keep = np.ones(off[-1], bool)
        keep[off[1:] - 1] = False
        out[keep] = ids
        return out, off
