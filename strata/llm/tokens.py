"""Token ids of whole texts by a tokenizer file, with a cache of text pieces in each Python worker.

A BPE tokenizer treats each pre-token alone, so a text may be cut wherever two pre-tokens must part, and its ids are those of the
cuts, one after the other. Cuts repeat far more often than texts do: a batch is cut by numpy, its cuts are looked up by hash, all at once, and
compared byte by byte with what they are taken for; only those the worker doesn't know go to the tokenizer. Every text gets the ids
that the tokenizers library gives by default, special tokens' names included; tokenizers of another make encode whole texts.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np

#: Limits of a worker's cache: cuts, bytes of text and ids (70 MB in all). A full cache is emptied.
MOST_CUTS, MOST_BYTES, MOST_IDS = 700_000, 1 << 23, 1 << 22
_SLOT_BITS = 21
_U = np.uint64


def _table(*codes) -> np.ndarray:
    t = np.zeros(256, bool)
    t[list(codes)] = True
    return t


# what no cut is made beside: ASCII white space and separators; first bytes of wider white space
_ODD, _WIDE = _table(*range(9, 14), *range(28, 33)), _table(0xC2, 0xE1, 0xE2, 0xE3)
_GAP, _LETTER, _MARK = _table(32, 10), _table(*range(65, 91), *range(97, 123)), _table(*b".,;:!?")
_THIRD = _table(*range(0x80, 0x8B), 0xA8, 0xA9, 0xAF)


#: Pieces of ASCII after one space or line feed, without the start of a special token's name: put in a row, they part where each begins.
_PLAIN = re.compile(rb"[ \n](?:[!-;=-~]|<(?!\|))+").fullmatch


def _white(data: np.ndarray) -> np.ndarray:
    """Whether each byte belongs to white space, Unicode's included."""
    white = _ODD[data]
    at = np.flatnonzero(_WIDE[data])
    if len(at):
        a = data[at]
        b, c = data[np.minimum(at + 1, len(data) - 1)], data[np.minimum(at + 2, len(data) - 1)]
        two = (a == 0xC2) & ((b == 0x85) | (b == 0xA0))
        three = ((a == 0xE1) & (b == 0x9A) & (c == 0x80)) | ((a == 0xE2) & (b == 0x80) & _THIRD[c]) | ((a == 0xE2) & (b == 0x81) & (c == 0x9F)) | ((a == 0xE3) & (b == 0x80) & (c == 0x80))
        white[at[two | three]] = True
        white[at[two | three] + 1] = True
        white[at[three] + 2] = True
    return white


def cuts(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where the cuts of a batch begin: at each text, at a single space or line feed between other characters, and at a mark after an ASCII letter."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    edge = np.zeros(n + 1, bool)
    edge[ends] = True
    white = _white(data)
    starts = edge[:-1].copy()
    at = np.flatnonzero(_GAP[data[1:-1]]) + 1 if n > 2 else np.zeros(0, np.int64)
    starts[at[~(white[at - 1] | white[at + 1] | edge[at] | edge[at + 1])]] = True
    starts[1:] |= _LETTER[data[:-1]] & _MARK[data[1:]]
    return np.flatnonzero(starts)


class Encoder:
    """``ids(texts)`` gives the ids of an Arrow array of strings, ``encode(texts)`` those of each text of a list as bytes."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.tok = Tokenizer.from_file(path)
        self.by_cut = self._by_cut(spec)
        self.lower = bool(spec.get("normalizer"))  # white space is dropped, words end in a suffix
        if self.by_cut:
            suffix = spec["model"].get("end_of_word_suffix") or ""
            self.size = np.zeros(1 + max(spec["model"]["vocab"].values()), np.int64)  # bytes that each id stands for
            for token, i in spec["model"]["vocab"].items():
                self.size[i] = len(token.removesuffix(suffix) if suffix else token)
        self._clear()

    @staticmethod
    def _by_cut(spec: dict) -> bool:
        """Whether the file is a BPE of a make whose pre-tokens always part at our cuts."""
        pre, norm = spec.get("pre_tokenizer") or {}, spec.get("normalizer")
        if spec["model"]["type"] != "BPE" or spec["model"].get("dropout"):
            return False
        for t in spec.get("added_tokens", ()):
            if not t["content"].startswith("<|") or t.get("lstrip") or t.get("rstrip") or t.get("single_word") or t.get("normalized") or any(c.isspace() or c in ".,;:!?" for c in t["content"]):
                return False
        if norm is None and pre.get("type") == "ByteLevel":
            return bool(pre.get("use_regex")) and not pre.get("add_prefix_space")
        if pre.get("type") == "Sequence" and norm and norm.get("type") == "Sequence":
            cut, level = pre["pretokenizers"][:1], pre["pretokenizers"][1:]
            pattern = str(cut[0].get("pattern", {}).get("Regex")) if cut else ""
            return (
                [n["type"] for n in norm["normalizers"]] == ["NFC", "Replace", "Lowercase"] and [x.get("type") for x in level] == ["ByteLevel"] and not level[0].get("use_regex")
                and cut[0].get("type") == "Split" and cut[0].get("behavior") == "Removed" and bool(cut[0].get("invert")) and pattern.endswith(r"|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
            )
        return False

    def _clear(self) -> None:
        self.slot = np.full(1 << _SLOT_BITS, -1, np.int32)
        self.n, self.n_bytes, self.n_ids = 0, 0, 0
        self.hash, self.byte_at, self.id_at = np.zeros(1, _U), np.zeros(2, np.int64), np.zeros(2, np.int64)
        self.text, self.known = np.zeros(0, np.uint8), np.zeros(0, "<u4")

    @staticmethod
    def _grown(a: np.ndarray, n: int) -> np.ndarray:
        return a if len(a) >= n else np.concatenate([a, np.zeros(max(n, 2 * len(a)) - len(a), a.dtype)])

    def _whole(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, how many each has) by the library."""
        found = [e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]
        counts = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter((i for ids in found for i in ids), "<u4", int(counts.sum())), counts

    def _together(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, how many each piece has) of plain pieces, encoded a thousand to a text: each id stands for known bytes, which tell the pieces apart."""
        joined = [b"".join(pieces[i : i + 1000]).decode() for i in range(0, len(pieces), 1000)]
        flat, _ = self._whole(joined)
        ends = np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)) - (1 if self.lower else 0))
        at = np.searchsorted(np.cumsum(self.size[flat]), ends) + 1
        return flat, np.diff(at, prepend=0)

    def _fresh(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces, how many each has), plain ones first encoded together."""
        simple = np.fromiter((_PLAIN(p) is not None for p in pieces), bool, len(pieces))
        counts = np.zeros(len(pieces), np.int64)
        flat, counts[simple] = self._together([p for p, ok in zip(pieces, simple.tolist(), strict=True) if ok])
        if simple.all():
            return flat, counts
        other, counts[~simple] = self._whole([p.decode() for p, ok in zip(pieces, simple.tolist(), strict=True) if not ok])
        out, owner = np.empty(len(flat) + len(other), "<u4"), np.repeat(simple, counts)
        out[owner], out[~owner] = flat, other
        return out, counts

    def _learn(self, hashes: np.ndarray, pieces: list[bytes]) -> np.ndarray:
        """Add cuts; returns their entries."""
        new, counts = self._fresh(pieces)
        first, last = self.n, self.n + len(pieces)
        self.hash, self.byte_at, self.id_at = self._grown(self.hash, last), self._grown(self.byte_at, last + 1), self._grown(self.id_at, last + 1)
        self.hash[first:last] = hashes
        self.byte_at[first + 1 : last + 1] = self.n_bytes + np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)))
        self.id_at[first + 1 : last + 1] = self.n_ids + np.cumsum(counts)
        raw = np.frombuffer(b"".join(pieces), np.uint8)
        self.text, self.known = self._grown(self.text, self.n_bytes + len(raw)), self._grown(self.known, self.n_ids + len(new))
        self.text[self.n_bytes : self.n_bytes + len(raw)] = raw
        self.known[self.n_ids : self.n_ids + len(new)] = new
        self.n, self.n_bytes, self.n_ids = last, self.n_bytes + len(raw), self.n_ids + len(new)
        return np.arange(first, last)

    def ids(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, where each text's begin and the last's end) of an Arrow array of strings; null is empty."""
        from strata.llm.wordhash import span_hashes, text_bytes

        if not self.by_cut:
            flat, counts = self._whole([t or "" for t in texts.to_pylist()])
            return flat, np.concatenate([[0], np.cumsum(counts)])
        data, ends = text_bytes(texts)
        start = cuts(data, ends)
        if not len(start):
            return np.zeros(0, "<u4"), np.zeros(len(ends), np.int64)
        if self.n > MOST_CUTS or self.n_bytes > MOST_BYTES or self.n_ids > MOST_IDS:
            self._clear()
        end = np.append(start[1:], len(data))
        h = span_hashes(data, start, end)
        at = (h >> _U(64 - _SLOT_BITS)).astype(np.int64)
        entry = self.slot[at].astype(np.int64)
        miss = np.flatnonzero((entry < 0) | (self.hash[entry] != h))

        def pieces(which):
            return [data[i:j].tobytes() for i, j in zip(start[which].tolist(), end[which].tolist(), strict=True)]

        if len(miss):
            unique, first = np.unique(h[miss], return_index=True)
            made = self._learn(unique, pieces(miss[first]))
            self.slot[(unique >> _U(64 - _SLOT_BITS)).astype(np.int64)] = made
            entry[miss] = made[np.searchsorted(unique, h[miss])]
        # equal hashes are not yet equal bytes
        size = end - start
        same = self.byte_at[entry + 1] - self.byte_at[entry] == size
        if same.all():
            equal = self.text[np.repeat(self.byte_at[entry] - start, size) + np.arange(len(data))] == data
            if not equal.all():
                same[np.searchsorted(start, np.flatnonzero(~equal), side="right") - 1] = False
        else:
            same &= np.array([p == self.text[i:j].tobytes() for p, i, j in zip(pieces(slice(None)), self.byte_at[entry].tolist(), self.byte_at[entry + 1].tolist(), strict=True)])
        if not same.all():
            other = np.flatnonzero(~same)
            entry[other] = self._learn(h[other], pieces(other))
        count = self.id_at[entry + 1] - self.id_at[entry]
        before = np.concatenate([[0], np.cumsum(count)])
        flat = self.known[np.repeat(self.id_at[entry] - before[:-1], count) + np.arange(before[-1])]
        return flat, before[np.searchsorted(start, ends)]

    def encode(self, texts: list[str]) -> list[bytes]:
        import pyarrow as pa

        flat, at = self.ids(pa.array(texts, pa.string()))
        raw = flat.tobytes()
        return [raw[4 * i : 4 * j] for i, j in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder for each file and Python worker."""
    if path not in _encoders:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        _encoders[path] = Encoder(path)
    return _encoders[path]


def slices(batches, text_col: str, most: int = 1 << 20):
    """Record batches cut to about ``most`` bytes of text each, so memory doesn't follow the batch size."""
    import pyarrow.compute as pc

    for b in batches:
        if not b.num_rows:
            continue
        n = np.cumsum(pc.fill_null(pc.binary_length(b[text_col]), 0).to_numpy(zero_copy_only=False)) // most
        cuts = [0, *(np.flatnonzero(np.diff(n)) + 1).tolist(), b.num_rows]
        for i, j in zip(cuts, cuts[1:], strict=False):
            yield b.slice(i, j - i)


def default_path(name: str) -> str:
    """A public vocabulary file by its name."""
    import public_tokenizers

    return public_tokenizers.path(name)
