"""A wavelet matrix of token identifiers in one compressed file: access, rank and select without unpacking it.

Layout, little-endian: magic, header (see ``HEADER``), the directory (zstd), then the blocks of the bit-planes,
each packed where that makes it smaller. The directory holds the documents (identifier, whether null, first
token), for each plane its number of zeros, and for each block the ones before it and where it ends.
"""

from __future__ import annotations

import struct

import numpy as np
import zstandard

MAGIC = b"EWM1"
HEADER = struct.Struct("<QIBxHIqqQ")  # tokens, documents, planes, bytes of a block, spare, group, number, bytes of the directory
BLOCK_BYTES = 4096
KEPT_BLOCKS = 256


def planes_of(tokens: np.ndarray, levels: int) -> list[tuple[np.ndarray, int]]:
    """(packed bits, number of zeros) by level, the highest bit first; each level moves its zeros before its ones."""
    planes = []
    for bit in range(levels - 1, -1, -1):
        ones = (tokens & tokens.dtype.type(1 << bit)) != 0
        planes.append((np.packbits(ones), len(tokens) - int(np.count_nonzero(ones))))
        tokens = np.concatenate([tokens[~ones], tokens[ones]])
    return planes


def encode(tokens: np.ndarray, doc_ids: np.ndarray, missing: np.ndarray, starts: np.ndarray, group: int = 0, number: int = 0) -> bytes:
    """The file of a shard. ``starts`` has one entry more than there are documents; ``missing`` marks null identifiers."""
    pack = zstandard.ZstdCompressor(level=1)
    levels = max(1, int(tokens.max(initial=0)).bit_length())
    directory = [doc_ids.astype("<i8").tobytes(), missing.astype("u1").tobytes(), starts.astype("<u8").tobytes()]
    blocks, end = [], 0
    for bits, zeros in planes_of(tokens, levels):
        padded = np.zeros(-(-len(bits) // BLOCK_BYTES) * BLOCK_BYTES, np.uint8)
        padded[:len(bits)] = bits
        ones = np.bitwise_count(padded.reshape(-1, BLOCK_BYTES)).sum(1, np.int64)
        ends = []
        for at in range(0, len(bits), BLOCK_BYTES):
            raw = bits[at:at + BLOCK_BYTES].tobytes()
            made = pack.compress(raw)
            blocks.append(made if len(made) < len(raw) else raw)
            end += len(blocks[-1])
            ends.append(end)
        directory += [struct.pack("<Q", zeros), np.cumsum(ones).astype("<u8").tobytes(), np.array(ends, "<u8").tobytes()]
    packed = pack.compress(b"".join(directory))
    header = HEADER.pack(len(tokens), len(doc_ids), levels, BLOCK_BYTES, 0, group, number, len(packed))
    return b"".join([MAGIC, header, packed, *blocks])


class Plane:
    """One bit-plane with rank and select; blocks are opened when they are needed and a few are kept."""

    def __init__(self, content: memoryview, size: int, block_bytes: int, zeros: int, ones: np.ndarray, begins: np.ndarray):
        self.content, self.size, self.block_bytes, self.zeros = content, size, block_bytes, zeros
        self.ones, self.begins = ones, begins
        self.zeros_before = np.minimum(np.arange(len(ones)) * block_bytes * 8, size) - ones
        self.kept: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def raw(self, block: int) -> bytes:
        held = self.content[self.begins[block]:self.begins[block + 1]]
        want = min(self.block_bytes, -(-self.size // 8) - block * self.block_bytes)
        return bytes(held) if len(held) == want else zstandard.ZstdDecompressor().decompress(held, max_output_size=want)

    def block(self, block: int) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of a block and the ones before each."""
        if block not in self.kept:
            if len(self.kept) >= KEPT_BLOCKS:
                self.kept.clear()
            bits = np.frombuffer(self.raw(block), np.uint8)
            self.kept[block] = bits, np.concatenate([[0], np.cumsum(np.bitwise_count(bits), dtype=np.int64)])
        return self.kept[block]

    def by_block(self, at: np.ndarray):
        for b in np.unique(at).tolist():
            yield b, np.flatnonzero(at == b)

    def bits_and_ranks(self, positions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each position its bit (0 at the end) and the ones before it."""
        bit, rank = np.zeros(len(positions), np.int64), np.empty(len(positions), np.int64)
        inside = positions < self.size
        rank[~inside] = self.ones[-1]
        where = np.flatnonzero(inside)
        for b, those in self.by_block(positions[where] // (8 * self.block_bytes)):
            those = where[those]
            bits, before = self.block(b)
            at = positions[those] - b * 8 * self.block_bytes
            byte, low = bits[at >> 3], (at & 7).astype(np.uint8)
            bit[those] = byte >> (7 - low) & 1
            rank[those] = self.ones[b] + before[at >> 3] + np.bitwise_count(byte >> (8 - low.astype(np.uint16)))
        return bit, rank

    def select(self, ordinals: np.ndarray, bit: int) -> np.ndarray:
        """The positions of the ordinal-th (from 0) bits of this kind."""
        before = self.ones if bit else self.zeros_before
        found = np.empty(len(ordinals), np.int64)
        for b, those in self.by_block(np.searchsorted(before, ordinals, "right") - 1):
            bits, ones = self.block(b)
            places = np.flatnonzero(np.unpackbits(bits) == bit)
            found[those] = b * 8 * self.block_bytes + places[ordinals[those] - before[b]]
        return found

    def unpacked(self) -> np.ndarray:
        """All bits, as booleans."""
        whole = b"".join(map(self.raw, range(len(self.begins) - 1)))
        return np.unpackbits(np.frombuffer(whole, np.uint8), count=self.size).view(bool)


class WaveletMatrix:
    """A shard as ``encode`` wrote it; bytes after its end are ignored."""

    def __init__(self, content: bytes):
        view = memoryview(content)
        if bytes(view[:4]) != MAGIC:
            raise ValueError("not a token file")
        self.size, docs, self.levels, block_bytes, _, self.group, self.number, packed = HEADER.unpack_from(view, 4)
        at = 4 + HEADER.size
        directory = zstandard.ZstdDecompressor().decompress(view[at:at + packed])
        data, at = view[at + packed:], 0

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(directory, kind, n, at)
            at += found.nbytes
            return found

        self.doc_ids, self.missing, self.starts = take("<i8", docs), take("u1", docs).astype(bool), take("<u8", docs + 1).astype(np.int64)
        blocks, self.planes, begin = -(-self.size // (8 * block_bytes)), [], 0
        for _ in range(self.levels):
            zeros = int(take("<u8", 1)[0])
            ones, ends = (take("<u8", blocks).astype(np.int64) for _ in range(2))
            begins = np.concatenate([[begin], ends])
            self.planes.append(Plane(data, self.size, block_bytes, zeros, np.concatenate([[0], ones]), begins))
            begin = int(begins[-1])

    def access(self, positions) -> np.ndarray:
        """The tokens at these positions."""
        at = np.atleast_1d(np.asarray(positions, np.int64))
        if len(at) and (at.min() < 0 or at.max() >= self.size):
            raise IndexError("no such token")
        tokens = np.zeros(len(at), np.int64)
        for plane in self.planes:
            bit, rank = plane.bits_and_ranks(at)
            tokens = tokens << 1 | bit
            at = np.where(bit == 1, plane.zeros + rank, at - rank)
        return tokens

    def tokens(self) -> np.ndarray:
        """All tokens, by undoing the moves of each level from the lowest bit up."""
        kind = np.uint16 if self.levels <= 16 else np.uint32
        found = np.zeros(self.size, kind)
        for bit, plane in enumerate(reversed(self.planes)):
            ones = plane.unpacked()
            above = np.empty_like(found)
            np.place(above, ~ones, found[:plane.zeros])
            np.place(above, ones, found[plane.zeros:] | kind(1 << bit))
            found = above
        return found

    def interval(self, token: int, low: int, high: int) -> tuple[int, int]:
        """Where the occurrences of a token among [low, high) end up below the last level."""
        if not 0 <= token < 1 << self.levels:
            return 0, 0
        for level, plane in enumerate(self.planes):
            _, (a, b) = plane.bits_and_ranks(np.array([low, high], np.int64))
            low, high = (plane.zeros + a, plane.zeros + b) if token >> (self.levels - 1 - level) & 1 else (low - a, high - b)
        return int(low), int(high)

    def count(self, token: int, low: int = 0, high: int | None = None) -> int:
        """How often a token stands in [low, high)."""
        a, b = self.interval(token, low, self.size if high is None else high)
        return b - a

    def rank(self, token: int, position: int) -> int:
        return self.count(token, 0, position)

    def occurrences(self, token: int, low: int = 0, high: int | None = None) -> np.ndarray:
        """The positions of a token in [low, high), ascending."""
        a, b = self.interval(token, low, self.size if high is None else high)
        at = np.arange(a, b, dtype=np.int64)
        for level, plane in enumerate(reversed(self.planes)):
            at = plane.select(at - plane.zeros, 1) if token >> level & 1 else plane.select(at, 0)
        return at

    def select(self, token: int, ordinal: int) -> int:
        """The position of the ordinal-th (from 0) occurrence of a token."""
        a, b = self.interval(token, 0, self.size)
        if not 0 <= ordinal < b - a:
            raise IndexError("no such occurrence")
        at = np.array([a + ordinal], np.int64)
        for level, plane in enumerate(reversed(self.planes)):
            at = plane.select(at - plane.zeros, 1) if token >> level & 1 else plane.select(at, 0)
        return int(at[0])
