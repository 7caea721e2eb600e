"""Prefix-free parsing of texts into phrases at rolling-hash triggers, in numpy.

A trigger is a string of ``TRIGGER`` bytes. Of the triggers within a window of ``width``
bytes, the one with the least hash (the first of equals) owns the window; a phrase is a
longest run of windows with one owner. So neighbouring phrases overlap by ``width - 1``
bytes, each window lies in exactly one phrase, and equal windows lie in phrases of the
same trigger, wherever they occur.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np

from fireledger.llm.words import POWERS, mixed, window_hashes

TRIGGER = 20


@dataclass
class Phrases:
    """Phrases of a run of texts joined in ``buf``; windows start at ``first`` to ``last``."""

    buf: np.ndarray
    limits: np.ndarray
    first: np.ndarray
    last: np.ndarray
    owner: np.ndarray
    trigger: np.ndarray
    phrase: np.ndarray


def parsed(run: Sequence[bytes], width: int) -> Phrases:
    buf = np.frombuffer(b"\n".join(run) + b"\n", np.uint8)
    limits = np.cumsum([0] + [len(x) + 1 for x in run])
    n = len(buf) - TRIGGER + 1
    windows = len(buf) - width + 1
    if windows <= 0:
        none = np.zeros(0, np.int64)
        return Phrases(buf, limits, none, none, none, none.astype(np.uint64), none.astype(np.uint64))
    sums = window_hashes(buf)
    _, down = POWERS.upto(len(buf) + 1)
    hashes = mixed((sums[TRIGGER:] - sums[:n]) * down[:n], 60)
    bits = np.uint64(len(buf).bit_length())
    keys = (hashes >> bits << bits) | np.arange(n, dtype=np.uint64)
    least, span, reach = keys, 1, width - TRIGGER + 1
    while span < reach:
        step = min(span, reach - span)
        least = np.minimum(least[: len(least) - step], least[step:])
        span += step
    at = (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    text = np.repeat(np.arange(len(run)), np.diff(limits))
    # The byte behind a text is a separator and belongs to no window.
    inside = np.arange(windows) + width <= limits[1:][text[:windows]] - 1
    new = np.empty(windows, bool)
    new[0] = True
    new[1:] = (at[1:] != at[:-1]) | ~inside[:-1]
    first = np.flatnonzero(new & inside)
    ends = np.empty(windows, bool)
    ends[-1] = True
    ends[:-1] = new[1:] | ~inside[1:]
    last = np.flatnonzero(ends & inside)
    stop = last + width
    whole = mixed(mixed((sums[stop] - sums[first]) * down[first], 61) ^ (stop - first).astype(np.uint64), 62)
    return Phrases(buf, limits, first, last, text[first], hashes[at[first]], whole)
