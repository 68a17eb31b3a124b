"""Words of whole texts as numbers, for the operators that compare words by position."""

from __future__ import annotations

from itertools import count

import numpy as np

#: Words are runs of other characters than space and \t to \r, the six that ``bytes.split()`` splits at.
WORD = r"[^\x20\x09-\x0D]+"


def numbered(documents: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """``(ids, starts)``: all documents' words as one array of numbers, and where each document begins.

    Equal words of one document have equal numbers, words of different documents
    never. Each document is followed by a number of its own that nothing equals, so
    no comparison of neighbours or of words a lag apart reaches over a border.
    ``starts`` has one entry more than there are documents.
    """
    parts, starts, fresh, total = [], np.zeros(len(documents) + 1, np.int64), 0, 0
    for n, words in enumerate(documents):
        number = dict(zip(dict.fromkeys(words), count(fresh)))
        parts.append(np.fromiter(map(number.__getitem__, words), np.int64, len(words)))
        fresh += len(number)
        parts.append(np.array([fresh], np.int64))
        fresh += 1
        total += len(words) + 1
        starts[n + 1] = total
    return np.concatenate(parts) if parts else np.zeros(0, np.int64), starts


def paired(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Numbers of the pairs ``(left[i], right[i])``: equal ones exactly for equal pairs, from 0 without gaps."""
    if not len(left):
        return np.zeros(0, np.int64)
    return np.unique(left * (int(right.max()) + 1) + right, return_inverse=True)[1].reshape(-1)
