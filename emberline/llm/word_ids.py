"""Identifiers of texts under a word-level byte-pair vocabulary, merged for many words at a time."""

from __future__ import annotations

import functools
import gc
import json
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from emberline.llm.token_counts import byte_characters

CACHED_WORDS = 400_000
LONGEST = 128
SINGLE = 512
CLOSING = ".,;:!?)"
NEVER = np.int32(np.iinfo(np.int32).max)
LATIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
WORD = "^[a-zß-öø-ÿ]+$"
# Fixed value: the pre-tokenizer of the vocabulary, for lower-cased texts of the characters of LATIN.
PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")


class Merges:
    """Looks up many symbol pairs at once; the rank of a merge also names the symbol it makes."""

    def __init__(self, vocab: dict[str, int], merges: list):
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in merges]
        left, right, made = (np.array(c, np.int64) for c in zip(*((vocab[a], vocab[b], vocab[a + b]) for a, b in pairs), strict=True))
        keys = left << 16 | right
        by = np.argsort(keys, kind="stable")
        small = (left < SINGLE) & (right < SINGLE)
        self.single = np.full((SINGLE, SINGLE), NEVER, np.int32)  # pairs of the symbols that words start from
        self.single[left[small], right[small]] = np.flatnonzero(small)
        self.made, self.keys, self.ranks = made.astype(np.int32), keys[by], by.astype(np.int32)
        bits = int(len(keys)).bit_length() + 3
        self.shift = np.uint64(64 - bits)
        place = self.place(self.keys)
        self.slot_key, self.slot_rank = np.full(1 << bits, -1, np.int64), np.full(1 << bits, NEVER, np.int32)
        self.slot_key[place], self.slot_rank[place] = self.keys, self.ranks
        self.shared = np.zeros(1 << bits, bool)
        self.shared[place[self.slot_key[place] != self.keys]] = True

    def place(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.int64) << 16 | right
        place = self.place(keys)
        hit = self.slot_key[place] == keys
        out = np.where(hit, self.slot_rank[place], NEVER)
        again = ~hit & self.shared[place]
        if again.any():
            k = keys[again]
            at = np.minimum(np.searchsorted(self.keys, k), len(self.keys) - 1)
            out[again] = np.where(self.keys[at] == k, self.ranks[at], NEVER)
        return out

    def merge(self, symbols: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """(row numbers, symbols) of rows of equal length after all merges, lowest rank and leftmost first.

        In a round every row that can still merge loses one symbol, so the rows stay of one width; rows that
        cannot are put out.
        """
        rows, done = np.arange(len(symbols)), []
        ranks = self.single[symbols[:, :-1], symbols[:, 1:]] if symbols.max(initial=0) < SINGLE else self.rank(symbols[:, :-1], symbols[:, 1:])
        while len(rows):
            if symbols.shape[1] == 1:
                done.append((rows, symbols))
                break
            at = ranks.argmin(1)
            best = np.take_along_axis(ranks, at[:, None], 1)[:, 0]
            live = best != NEVER
            if not live.all():
                done.append((rows[~live], symbols[~live]))
                rows, symbols, ranks, at, best = rows[live], symbols[live], ranks[live], at[live], best[live]
                if not len(rows):
                    break
            width, here = symbols.shape[1], np.arange(len(rows))
            skip = np.arange(width - 1)
            symbols = np.take_along_axis(symbols, skip + (skip > at[:, None]), 1)
            symbols[here, at] = self.made[best]
            skip = skip[:-1]
            ranks = np.take_along_axis(ranks, skip + (skip >= at[:, None]), 1)
            before, after = at > 0, at < width - 2
            ranks[here[before], at[before] - 1] = self.rank(symbols[here[before], at[before] - 1], symbols[here[before], at[before]])
            ranks[here[after], at[after]] = self.rank(symbols[here[after], at[after]], symbols[here[after], at[after] + 1])
        return done


def gathered(flat: np.ndarray, lengths: np.ndarray, picks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretches ``picks`` of ``flat``, which holds stretches of these lengths in a row, and where each ends."""
    n = lengths[picks]
    ends = np.cumsum(n)
    starts = (np.cumsum(lengths) - lengths)[picks]
    return flat[np.repeat(starts - ends + n, n) + np.arange(n.sum())], ends


class WordIds:
    """Identifiers as little-endian 16-bit numbers, as the tokenizers library gives them without special tokens.

    The vocabulary drops white space and case, so what ASCII white space separates in a lowered slice is told
    apart once, by Arrow. Words of ASCII and Western letters and the closing marks behind them are pre-tokens of
    their own; other pieces of those characters are split here, and all new pre-tokens of a slice are merged
    together. Any other piece, and a text that names a special token, goes through the library. Of what is
    kept, the words and pieces met since the cache was last full stay.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        self.merges = Merges(vocab, spec["model"]["merges"])
        letters = byte_characters()
        self.inner = np.array([vocab[c] for c in letters], np.int32)
        self.last = np.array([vocab[c + "</w>"] for c in letters], np.int32)
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.young: dict[bytes, bytes] = {b"": b""}
        self.old: dict[bytes, bytes] = {}

    def parts(self, words: list[bytes]) -> dict[bytes, bytes]:
        """The identifiers of lower-case pre-tokens."""
        found, by_length = {}, {}
        for w in words:
            by_length.setdefault(len(w), []).append(w)
        for n, names in by_length.items():
            loose = np.frombuffer(b"".join(names), np.uint8).reshape(-1, n)
            symbols = self.inner[loose]
            symbols[:, -1] = self.last[loose[:, -1]]
            for rows, ids in self.merges.merge(symbols):
                size, flat = 2 * ids.shape[1], ids.astype("<u2").tobytes()
                found.update((names[r], flat[i:i + size]) for r, i in zip(rows.tolist(), range(0, len(flat), size), strict=True))
        return found

    def library(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u2").tobytes() for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def kept(self, names: list[bytes], make) -> list[bytes]:
        """The identifiers of ``names``; ``make`` gives those of the ones that are not in the cache."""
        young, old = self.young, self.old
        new = [w for w in names if w not in young]
        young.update((w, old[w]) for w in new if w in old)
        young.update(make([w for w in new if w not in old]))
        return list(map(young.__getitem__, names))

    def pieces(self, new: list[bytes]) -> dict[bytes, bytes]:
        """The identifiers of lowered pieces of any kind."""
        split, other = {}, []
        for w in new:
            s = w.decode("utf-8", "replace")
            if len(w) <= LONGEST and LATIN.fullmatch(s):  # rows of merges are moved whole, which suits words only
                split[w] = [p.encode() for p in PARTS.findall(s.lower())]
            else:
                other.append((w, s))
        loose = list({p for parts in split.values() for p in parts})
        ids = dict(zip(loose, self.kept(loose, self.parts), strict=True))
        found = {w: b"".join(map(ids.__getitem__, parts)) for w, parts in split.items()}
        found.update(zip((w for w, _ in other), self.library([s for _, s in other]), strict=True))
        return found

    def vocabulary(self, names: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """(identifiers, their number for each) of different lowered pieces."""
        cores = pc.ascii_rtrim(names, CLOSING)
        plain = pc.and_(pc.match_substring_regex(cores, WORD), pc.less_equal(pc.binary_length(cores), LONGEST))
        words = cores.filter(plain).dictionary_encode()
        plain = plain.to_numpy(zero_copy_only=False)
        ends = pc.binary_length(cores).to_numpy()
        closed = np.flatnonzero(plain & (ends < pc.binary_length(names).to_numpy()))
        marks: dict[bytes, int] = {b"": 0}
        closing = [marks.setdefault(w[end:], len(marks)) for w, end in zip(
            names.take(closed).cast(pa.binary()).to_pylist(), ends[closed].tolist(), strict=True)]
        ids = self.kept(words.dictionary.cast(pa.binary()).to_pylist(), self.parts)
        n_words = len(ids)
        ids += self.kept(names.filter(~plain).cast(pa.binary()).to_pylist(), self.pieces)
        n_known = len(ids)
        ids += self.kept(list(marks), self.pieces)
        pairs = np.full((len(names), 2), n_known)
        pairs[plain, 0] = words.indices.to_numpy()
        pairs[~plain, 0] = np.arange(n_words, n_known)
        pairs[closed, 1] += np.array(closing, np.int64)
        lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // 2
        flat, _ = gathered(np.frombuffer(b"".join(ids), "<u2"), lengths, pairs.ravel())
        return flat, lengths[pairs].sum(1)

    def encode(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """(identifiers, borders): those of all texts (UTF-8 bytes) in a row, ``end`` after each, and where texts begin and end.

        Nothing made here has cycles, so their collector rests.
        """
        collecting = gc.isenabled()
        gc.disable()
        try:
            return self.encoded(texts, end)
        finally:
            if collecting:
                gc.enable()

    def encoded(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        texts = pa.Array.from_buffers(pa.string(), len(texts), texts.buffers(), offset=texts.offset)
        low = pc.ascii_lower(texts)
        special = np.flatnonzero(functools.reduce(pc.or_, (pc.match_substring(low, s.lower()) for s in self.special)).to_numpy(zero_copy_only=False))
        if len(special):
            low = pc.if_else(pa.array(np.isin(np.arange(len(texts)), special)), "", low)
        split = pc.ascii_split_whitespace(low)
        borders = split.offsets.to_numpy().astype(np.int64)
        words = split.flatten().dictionary_encode()
        flat, lengths = self.vocabulary(words.dictionary)
        own = self.library([w.decode("utf-8", "replace") for w in texts.take(special).cast(pa.binary()).to_pylist()])
        flat = np.concatenate([flat, np.array([end], "<u2"), np.frombuffer(b"".join(own), "<u2")])
        last = len(lengths)
        lengths = np.concatenate([lengths, [1], np.array([len(o) // 2 for o in own], np.int64)])
        at = np.concatenate([borders[special + 1], borders[1:]])
        codes = np.insert(words.indices.to_numpy(), at, np.concatenate([np.arange(last + 1, len(lengths)), np.full(len(texts), last)]))
        counts = np.diff(borders) + 1
        counts[special] += 1
        tokens, ends = gathered(flat, lengths, codes)
        if len(self.young) > CACHED_WORDS:
            self.young, self.old = {b"": b""}, self.young
        return tokens, np.concatenate([[0], ends[np.cumsum(counts) - 1]])


@functools.cache
def word_ids(path: str) -> WordIds:
    """One encoder for each Python worker."""
    return WordIds(path)
