"""Byte-level BPE ids of many texts with the tokenizers library.

Merges never cross a pre-token, so a text's ids are its pre-tokens' ids in order, and each distinct
pre-token of a batch is encoded once by the library. Pre-tokens are found with numpy by character
class; that covers texts whose code points are below ``LATIN`` (their classes never changed between
Unicode versions). All other texts, and tokenizers with another pre-tokenizer, are handed to the
library whole.
"""

from __future__ import annotations

import json
import os
import unicodedata

import numpy as np

from .shingles import same_spans, span_hashes

LATIN = 0x250
#: Distinct pre-tokens whose ids a worker process remembers (only saves work).
REMEMBERED = 800_000
#: And the characters they have together.
REMEMBERED_CHARS = 16_000_000
_OTHER, _LETTER, _NUMBER, _SPACE = 0, 1, 2, 3


def _classes() -> np.ndarray:
    out = np.zeros(LATIN, dtype=np.uint8)
    for c in range(LATIN):
        kind = unicodedata.category(chr(c))
        if 9 <= c <= 13 or c in (0x20, 0x85, 0xA0):
            out[c] = _SPACE
        elif kind[0] == "L":
            out[c] = _LETTER
        elif kind[0] == "N":
            out[c] = _NUMBER
    return out


class ByteBPE:
    def __init__(self, definition: str, special_as_text: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(definition)
        self.library.encode_special_tokens = special_as_text
        rules = json.loads(definition)
        self.special = [] if special_as_text else [t["content"] for t in rules["added_tokens"]]
        pre = rules["pre_tokenizer"] or {}
        self.plain = (pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
                      and rules["normalizer"] is None)
        self.classes = _classes()
        #: Pre-tokens of earlier batches by hash, their characters and their ids.
        self.known, self.known_ids = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.uint32)
        self.known_at, self.known_n = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        self.known_chars = np.zeros(0, dtype=np.uint16)
        self.known_from, self.known_len = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)

    hashes = staticmethod(span_hashes)

    def starts(self, chars: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Flags of the characters that begin a pre-token; ``first`` flags the texts' first ones.

        Fixed pattern of the format: contractions 's 't 're 've 'm 'll 'd, runs of letters, of
        numbers and of other characters with one space in front, runs of white space without the
        last one before something else."""
        kind = self.classes[chars]
        n = len(chars)
        space = kind == _SPACE
        change = np.ones(n, dtype=bool)
        change[1:] = (kind[1:] != kind[:-1]) | first[1:]
        start = change.copy()
        last_of_text = np.zeros(n, dtype=bool)
        last_of_text[:-1] = first[1:]
        last_of_text[-1:] = True
        # the last white space before something else stands apart; a space joins what follows
        ends_run = np.zeros(n, dtype=bool)
        ends_run[:-1] = space[:-1] & ~space[1:]
        ends_run &= ~last_of_text
        start |= ends_run
        joined = ends_run & (chars == 32)
        start[1:] &= ~joined[:-1]
        # contractions: a lone apostrophe that begins a token
        quote = np.flatnonzero((chars == 39) & start & change)
        quote = quote[(quote + 1 < n)]
        quote = quote[~first[quote + 1] & (kind[quote + 1] == _LETTER)]
        if len(quote):
            a = chars[quote + 1]
            b = np.where(quote + 2 < n, chars[np.minimum(quote + 2, n - 1)], 0)
            b = np.where((quote + 2 < n) & ~first[np.minimum(quote + 2, n - 1)], b, 0)
            one = np.isin(a, [ord(x) for x in "stmd"])
            two = ((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l")))
            for hit, length in ((quote[one], 2), (quote[two], 3)):
                start[hit + 1] = False
                after = hit + length
                start[after[after < n]] = True
        return start

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        out: list = [None] * len(texts)
        fast, parts = [], []
        for k, text in enumerate(texts):
            if not text:
                out[k] = np.zeros(0, dtype=np.uint32)
                continue
            chars = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
            if self.plain and chars.max() < LATIN and not any(s in text for s in self.special):
                fast.append(k)
                parts.append(chars)
        slow = [k for k in range(len(texts)) if texts[k] and k not in set(fast)] if len(fast) < len(texts) else []
        if slow:
            for k, e in zip(slow, self.library.encode_batch([texts[k] for k in slow], add_special_tokens=False), strict=True):
                out[k] = np.array(e.ids, dtype=np.uint32)
        if fast:
            for k, ids in zip(fast, self._fast(parts), strict=True):
                out[k] = ids
        return out

    def _fast(self, parts: list[np.ndarray]) -> list[np.ndarray]:
        chars = np.concatenate(parts).astype(np.uint16)
        lens = np.array([len(p) for p in parts])
        begins = np.cumsum(lens) - lens
        first = np.zeros(len(chars), dtype=bool)
        first[begins] = True
        at = np.flatnonzero(self.starts(chars, first))
        ends = np.append(at[1:], len(chars))
        raw = chars.view(np.uint8)
        distinct, example, which = np.unique(self.hashes(raw, 2 * at, 2 * ends), return_index=True, return_inverse=True)
        like = example[which]
        if not ((ends - at == ends[like] - at[like]) & same_spans(raw, 2 * at, raw, 2 * at[like], 2 * (ends - at))).all():
            # two pre-tokens of the batch share a hash: the library takes the texts whole
            texts = [p.tobytes().decode("utf-32-le") for p in parts]
            return [np.array(e.ids, dtype=np.uint32) for e in self.library.encode_batch(texts, add_special_tokens=False)]
        offsets, counts, flat = self._ids_of(distinct, at[example], ends[example], chars)
        n = counts[which]
        stops = np.cumsum(n)
        ids = flat[np.repeat(offsets[which] - (stops - n), n) + np.arange(int(stops[-1]))]
        cuts = np.searchsorted(at, begins)  # the pre-token at which each text begins
        return np.split(ids, (stops - n)[cuts][1:])

    def _ids_of(self, hashes: np.ndarray, a: np.ndarray, b: np.ndarray, chars: np.ndarray) -> tuple:
        """(offset, count, flat ids) of distinct pre-tokens: those of earlier batches from memory,
        if their characters are the same, the others from the library."""
        where = np.searchsorted(self.known, hashes)
        old = where < len(self.known)
        old[old] = self.known[where[old]] == hashes[old]
        hit = np.flatnonzero(old)
        if len(hit):
            place, size = where[hit], b[hit] - a[hit]
            same = self.known_len[place] == size
            same[same] = same_spans(chars.view(np.uint8), 2 * a[hit][same], self.known_chars.view(np.uint8),
                                    2 * self.known_from[place][same], 2 * size[same])
            old[hit[~same]] = False
        new = np.flatnonzero(~old)
        offsets, counts = np.zeros(len(hashes), dtype=np.int64), np.zeros(len(hashes), dtype=np.int64)
        offsets[old], counts[old] = self.known_at[where[old]], self.known_n[where[old]]
        if not len(new):
            return offsets, counts, self.known_ids
        whole = chars.astype(np.uint32).tobytes().decode("utf-32-le")
        tokens = [whole[i:j] for i, j in zip(a[new].tolist(), b[new].tolist(), strict=True)]
        encoded = self.library.encode(tokens, is_pretokenized=True, add_special_tokens=False)
        counts[new] = np.bincount(np.array(encoded.word_ids, dtype=np.int64), minlength=len(tokens))
        offsets[new] = len(self.known_ids) + np.cumsum(counts[new]) - counts[new]
        flat = np.concatenate([self.known_ids, np.array(encoded.ids, dtype=np.uint32)])
        size = b[new] - a[new]
        if len(self.known) + len(new) <= REMEMBERED and len(self.known_chars) + int(size.sum()) <= REMEMBERED_CHARS:
            known = np.concatenate([self.known, hashes[new]])
            order = np.argsort(known, kind="stable")
            stops = np.cumsum(size)
            spelled = chars[np.repeat(a[new] - (stops - size), size) + np.arange(int(stops[-1]))]
            begin = len(self.known_chars) + stops - size
            self.known = known[order]
            self.known_at = np.concatenate([self.known_at, offsets[new]])[order]
            self.known_n = np.concatenate([self.known_n, counts[new]])[order]
            self.known_from = np.concatenate([self.known_from, begin])[order]
            self.known_len = np.concatenate([self.known_len, size])[order]
            self.known_chars = np.concatenate([self.known_chars, spelled])
            self.known_ids = flat
        return offsets, counts, flat
