"""Unigram segmentation over a SentencePiece vocabulary: the best-scoring split of a text.

Scores are fixed-point integers, so sums are exact and the order of adding them never matters. Of
two splits with equal scores the one wins whose last piece is longer (the sequential Viterbi's
first-come rule), at every position.

A text is cut into *units* at places that no piece spans: before a run of spaces, and around a
line end where no piece holds one. A unit's best split does not depend on its neighbours, so equal
units are solved once, and units with a common prefix share the forward scores of that prefix:
``solve`` walks a trie of the distinct units level by level with numpy, one vector operation per
level and piece length.
"""

from __future__ import annotations

import re
from functools import cached_property

import numpy as np

from .common import process_cache

#: Scores are multiples of 1 / SCALE.
SCALE = 1 << 10
_BASE = np.uint64(0x9E3779B97F4A7C15 & ~3 | 5)  # odd, 5 mod 8: differences of powers stay rich
_NONE = np.int64(-(1 << 62))
#: Longer units are solved one by one instead of in the trie.
LONG_UNIT = 96


def _mix(x: np.ndarray) -> np.ndarray:
    """A fixed pseudo-random 64-bit value for every code point."""
    x = x.astype(np.uint64) + np.uint64(0x632BE59BD9B4E019)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def load_pieces(path: str) -> dict:
    """Plain arrays of a SentencePiece model file, to be broadcast (its size is the vocabulary's)."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = sp.get_piece_size()
    normal = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) or sp.is_byte(i))]
    return {"pieces": [sp.id_to_piece(i).replace("▁", " ") for i in range(n)], "normal": normal,
            "scores": [sp.get_score(i) for i in range(n)], "unk": sp.unk_id(),
            "bytes": [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]}


class Unigram:
    """Lookup tables of a vocabulary, built once per worker process."""

    def __init__(self, loaded: dict):
        with np.errstate(over="ignore"):
            self._build(loaded)

    def _build(self, loaded: dict) -> None:
        self.pieces, normal = loaded["pieces"], loaded["normal"]
        self.unk = loaded["unk"]
        self.byte_ids = loaded["bytes"] if self.unk not in loaded["bytes"] else None
        self.byte_of = {i: b for b, i in enumerate(self.byte_ids or [])}
        fixed = np.array([round(s * SCALE) for s in loaded["scores"]], dtype=np.int64)
        self.score = {self.pieces[i]: (int(fixed[i]), i) for i in normal}
        #: As the library: an unknown character costs ten more than the worst piece.
        self.unk_score = int(min(fixed[i] for i in normal)) - 10 * SCALE
        self.max_len = max(len(self.pieces[i]) for i in normal)
        self.powers = np.ones(self.max_len + 1, dtype=np.uint64)
        for k in range(self.max_len):
            self.powers[k + 1] = self.powers[k] * _BASE
        hashes = np.zeros(len(normal), dtype=np.uint64)
        for k, i in enumerate(normal):
            h = np.zeros(1, dtype=np.uint64)
            for m in _mix(code_points(self.pieces[i])):
                h = h * _BASE + m
            hashes[k] = h[0]
        order = np.argsort(hashes)
        self.hashes, self.ids = hashes[order], np.array(normal, dtype=np.int32)[order]
        self.fixed = fixed
        self.seen = np.zeros(1 << 20, dtype=bool)
        self.seen[hashes >> np.uint64(44)] = True
        spans_space = any(" " in p.lstrip(" ") for p in self.score)
        spans_line = any("\n" in p for p in self.score)
        word = r"[^ \n]" if not spans_line else r"[^ ]"
        tail = "|\n" if not spans_line else ""
        self.units = re.compile(r"(?s).+" if spans_space else rf" *{word}+| +{tail}").findall

    def prepared(self, text: str) -> str:
        """Text as the pieces spell it: a leading space, spaces for U+2581."""
        return " " + text.replace("▁", " ") if text else ""

    def lookup(self, sub: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions, piece ids) of the substring hashes that are pieces."""
        at = np.flatnonzero(self.seen[sub >> np.uint64(44)])
        where = np.minimum(np.searchsorted(self.hashes, sub[at]), len(self.hashes) - 1)
        hit = self.hashes[where] == sub[at]
        return at[hit], self.ids[where[hit]]

    def char_ids(self, char: str) -> list[int]:
        """Ids of an unknown character: its bytes, or the unknown piece without byte pieces."""
        if self.byte_ids is None:
            return [self.unk]
        return [self.byte_ids[b] for b in char.encode("utf-8", "surrogatepass")]

    # -- one long unit or chunk -------------------------------------------------------------

    def forward(self, text: str, entry: list[int], starts: int) -> tuple[list[int], list[int]]:
        """Best score of reaching every position of ``text`` from the entry scores (position ->
        score, ``_NONE`` if not entered there), with pieces that start before ``starts``; and the
        start of the last piece (-1: entered here, -2: not reached)."""
        n, none = len(text), int(_NONE)
        best = [none] * (n + 1)
        back = [-2] * (n + 1)
        for s, v in enumerate(entry[: n + 1]):
            if v > none:
                best[s], back[s] = v, -1
        get, longest = self.score.get, self.max_len
        for i in range(min(starts, n)):
            here = best[i]
            if here == none:
                continue
            single = False
            for j in range(i + 1, min(i + longest, n) + 1):
                found = get(text[i:j])
                if found is not None:
                    single |= j == i + 1
                    if here + found[0] > best[j]:
                        best[j], back[j] = here + found[0], i
            if not single and here + self.unk_score > best[i + 1]:
                best[i + 1], back[i + 1] = here + self.unk_score, i
        return best, back

    def path(self, text: str, back: list[int], end: int) -> tuple[list[int], int]:
        """Ids of the pieces up to ``end``, and the position at which the path entered."""
        spans = []
        while back[end] >= 0:
            spans.append((back[end], end))
            end = back[end]
        ids: list[int] = []
        for i, j in reversed(spans):
            found = self.score.get(text[i:j])
            ids.extend([found[1]] if found else self.char_ids(text[i:j]))
        return ids, end

    # -- many distinct units ----------------------------------------------------------------

    def solve(self, units: list[str], want_ids: bool = True) -> tuple:
        """(token count per unit, score per unit, offsets, flat ids) of distinct non-empty units."""
        with np.errstate(over="ignore"):
            return self._solve(units, want_ids)

    def _solve(self, units: list[str], want_ids: bool) -> tuple:
        n_units = len(units)
        counts, scores = np.zeros(n_units, dtype=np.int64), np.zeros(n_units, dtype=np.int64)
        pieces_of: dict[int, list[int]] = {}
        for k, u in enumerate(units):
            if len(u) > LONG_UNIT:
                best, back = self.forward(u, [0], len(u))
                pieces_of[k], _ = self.path(u, back, len(u))
                counts[k], scores[k] = len(pieces_of[k]), best[-1]
        order = sorted((k for k in range(n_units) if k not in pieces_of), key=units.__getitem__)
        texts = [units[k] for k in order]
        order = np.array(order, dtype=np.int64)
        chars = code_points("".join(texts))
        lens = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        offsets = np.cumsum(lens) - lens
        size = len(chars) + 1  # at most one trie node for each character
        parent, hashed = np.zeros(size, dtype=np.int32), np.zeros(size, dtype=np.uint64)
        best, tokens = np.full(size, _NONE), np.zeros(size, dtype=np.int32)
        piece, prev = np.zeros(size, dtype=np.int32), np.zeros(size, dtype=np.int32)
        best[0] = 0
        node = np.zeros(len(texts), dtype=np.int32)
        made, depth, active = 1, 0, np.arange(len(texts))
        while True:
            active = active[lens[active] > depth]
            if not len(active):
                break
            c, up = chars[offsets[active] + depth], node[active]
            depth += 1
            new = np.ones(len(active), dtype=bool)
            new[1:] = (c[1:] != c[:-1]) | (up[1:] != up[:-1])
            node[active] = made - 1 + np.cumsum(new)
            c, up = c[new], up[new]
            here = slice(made, made + len(c))
            parent[here] = up
            h = hashed[up] * _BASE + _mix(c)
            hashed[here] = h
            top, last, start = np.full(len(c), _NONE), np.full(len(c), -1, dtype=np.int32), up.copy()
            idx = up
            for length in range(1, min(depth, self.max_len) + 1):
                if length > 1:
                    idx = parent[idx]
                at, ids = self.lookup(h - hashed[idx] * self.powers[length])
                if length == 1:  # unknown unless the character itself is a piece
                    top = best[idx] + self.unk_score
                    top[at] = _NONE
                score = best[idx[at]] + self.fixed[ids]
                better = score >= top[at]  # equal scores: the longer last piece
                at, ids = at[better], ids[better]
                top[at], last[at], start[at] = score[better], ids, idx[at]
            best[here], piece[here], prev[here] = top, last, start
            more = np.ones(len(c), dtype=np.int32)
            if self.byte_ids is not None:
                unknown = last < 0
                more[unknown] = 1 + (c[unknown] > 0x7F) + (c[unknown] > 0x7FF) + (c[unknown] > 0xFFFF)
            tokens[here] = tokens[start] + more
            made += len(c)
        counts[order], scores[order] = tokens[node], best[node]
        ends = np.cumsum(counts)
        if not want_ids:
            return counts, scores, ends - counts, None
        flat = np.zeros(int(ends[-1]) if n_units else 0, dtype=np.int32)
        for k, ids in pieces_of.items():
            flat[ends[k] - counts[k]: ends[k]] = ids
        cur, put = node.copy(), ends[order] - 1
        char_at = offsets + lens - 1  # last character not yet covered
        live = np.flatnonzero(cur > 0)
        while len(live):
            at, p = cur[live], piece[cur[live]]
            flat[put[live]] = p
            step = tokens[at] - tokens[prev[at]]
            for k in np.flatnonzero(p < 0):
                w = live[k]
                ids = self.char_ids(chr(chars[char_at[w]]))
                flat[put[w] - len(ids) + 1: put[w] + 1] = ids
            # characters covered by the piece
            covered = np.where(p < 0, 1, self.piece_len[np.maximum(p, 0)])
            char_at[live] -= covered
            put[live] -= step
            cur[live] = prev[at]
            live = live[cur[live] > 0]
        return counts, scores, ends - counts, flat

    # -- back to text -----------------------------------------------------------------------

    def decode(self, ids: list[int]) -> str:
        """The text of a document's ids: pieces joined, byte runs decoded, the leading space off."""
        byte_of, spelled = self.byte_of, self.spelled
        parts = [spelled[i] for i in ids]
        if None in parts:  # bytes beyond ASCII: decode their runs
            out, run = [], bytearray()
            for i, part in zip(ids, parts, strict=True):
                if i in byte_of:
                    run.append(byte_of[i])
                    continue
                if run:
                    out.append(run.decode("utf-8", "replace"))
                    run = bytearray()
                out.append(part)
            if run:
                out.append(run.decode("utf-8", "replace"))
            parts = out
        text = "".join(parts)
        return text[1:] if text.startswith(" ") else text

    @cached_property
    def spelled(self) -> list[str | None]:
        """What a piece id stands for; None for bytes that are no character by themselves."""
        return [p if i not in self.byte_of else chr(self.byte_of[i]) if self.byte_of[i] < 128 else None
                for i, p in enumerate(self.pieces)]

    @cached_property
    def piece_len(self) -> np.ndarray:
        return np.fromiter(map(len, self.pieces), dtype=np.int64, count=len(self.pieces))


class UnitIndex(dict):
    """unit -> its number, in order of first sight."""

    def __missing__(self, unit: str) -> int:
        self[unit] = number = len(self)
        return number


def vocabulary(loaded) -> Unigram:
    """The tables of a broadcast vocabulary, one copy per worker process."""
    cache = process_cache()
    key = ("unigram", loaded.value["path"])
    if key not in cache:
        cache[key] = Unigram(loaded.value)
    return cache[key]
