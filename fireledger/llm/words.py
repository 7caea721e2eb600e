"""Words of whole texts as 64-bit hashes, in numpy arrays, for use inside Spark tasks.

Texts are joined with a line end between them and handled about ``PIECE`` bytes at a
time, so memory stays bounded however many texts a batch has. A single longer text is a
piece of its own. Hashes depend on the bytes of a word only: words of up to ``LONG`` bytes
have a scrambled polynomial modulo 2 ** 64, longer ones, among which some fixed pairs have
the same polynomial for every odd base, a digest of 64 bits. Two given words share a hash with
probability of about 2 ** -64, some regular ones of up to ``LONG`` bytes of 2 ** -38 at most.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np

PIECE = 1 << 18
LONG = 64
BASE = 0x9E3779B97F4A7C15 | 1
BYTE_VALUES = np.random.default_rng(20240501).integers(1, 1 << 63, 256, dtype=np.uint64)

WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
#: Everything in ASCII but letters and digits parts words.
NOT_ALNUM = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


def mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A fixed scrambling of 64-bit numbers."""
    x = x + np.uint64((salt * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    """BASE to the power 0, 1, 2, ... modulo 2**64, and the inverses."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            for name, base in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))
        return self.up[:n], self.down[:n]


POWERS = _Powers()


def pieces(texts: Iterable[str | bytes | None], limit: int = PIECE) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of texts as UTF-8, each with the place of its first text."""
    first, size, run = 0, 0, []
    for text in texts:
        data = b"" if text is None else text.encode("utf-8", "surrogatepass") if isinstance(text, str) else bytes(text)
        if run and size + len(data) > limit:
            yield first, run
            first, size, run = first + len(run), 0, []
        run.append(data)
        size += len(data)
    if run:
        yield first, run


@dataclass
class Words:
    """Hashes of the words of a run of texts; words of text i are ``bounds[i]:bounds[i + 1]``."""

    hashes: np.ndarray
    bounds: np.ndarray

    @property
    def text(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def window_hashes(buf: np.ndarray) -> np.ndarray:
    """Prefix sums; the bytes ``s:e`` have the hash ``(sums[e] - sums[s]) * down[s]``."""
    sums = np.zeros(len(buf) + 1, np.uint64)
    up, _ = POWERS.upto(len(buf) + 1)
    np.cumsum(BYTE_VALUES[buf] * up[: len(buf)], out=sums[1:])
    return sums


def words_of(run: Sequence[bytes], apart: np.ndarray = WHITE, lower: bool = True) -> Words:
    buf = np.frombuffer(b"\n".join(run) + b"\n", np.uint8)
    if lower:
        buf = LOWER[buf]
    space = apart[buf]
    edges = np.diff(space.astype(np.int8), prepend=np.int8(1))
    starts, ends = np.flatnonzero(edges == -1), np.flatnonzero(edges == 1)
    ends = ends[-len(starts):] if len(starts) else ends[:0]
    sums = window_hashes(buf)
    _, down = POWERS.upto(len(buf) + 1)
    hashes = mixed((sums[ends] - sums[starts]) * down[starts], 1)
    for i in np.flatnonzero(ends - starts > LONG):
        digest = blake2b(buf[starts[i] : ends[i]].tobytes(), digest_size=8).digest()
        hashes[i] = int.from_bytes(digest, "little")
    limits = np.cumsum([0] + [len(x) + 1 for x in run])
    return Words(hashes, np.searchsorted(starts, limits))


def joined(words: Words, offsets: Sequence[int]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words at ``i + offset`` for each i, and their texts; all within one text."""
    reach = max(offsets)
    n = len(words.hashes) - reach
    text = words.text
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = np.zeros(n, np.uint64)
    for k, offset in enumerate(offsets):
        total = mixed(total ^ words.hashes[offset : offset + n], 2 + k)
    keep = text[:n] == text[reach:]
    return total[keep], text[:n][keep]
