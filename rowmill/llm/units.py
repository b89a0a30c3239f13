"""Texts cut into units that tokenizers never join, as dictionary codes.

Cuts fall, found byte by byte without reading words one at a time:

* before a space that no space precedes and a non-blank follows,
* around a newline that a non-blank follows, and before one that an ASCII non-blank precedes,
* between an ASCII letter and a closing punctuation mark.

The pre-tokens of a byte-level BPE end at each of these places, and what stands beyond a cut
doesn't change them. Blanks outside ASCII and bytes that may begin one count as neither blank
nor non-blank, so no cut falls beside them. A pair of letter and mark for which ``joined``
holds is not cut: other tokenizers may have pieces that hold both.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from rowmill.llm.common import offsets_of

#: Bytes that surely begin a character which is no blank, in any reading of Unicode.
SOLID = np.zeros(256, bool)
SOLID[33:127] = True
SOLID[[0xC3 + i for i in range(0xF5 - 0xC3)]] = True
SOLID[[0xE1, 0xE2, 0xE3]] = False
LETTER = np.zeros(256, bool)
LETTER[ord("A") : ord("Z") + 1] = LETTER[ord("a") : ord("z") + 1] = True
MARK = np.zeros(256, bool)
MARK[[ord(c) for c in ".,;:!?)"]] = True
SPACE, NEWLINE = 32, 10


def unit_starts(data: np.ndarray, heads: np.ndarray, joined: np.ndarray | None = None) -> np.ndarray:
    """Where units begin: at ``heads``, the first bytes of texts, and at each cut."""
    n = len(data)
    cut = np.zeros(n, bool)
    if n > 1:
        solid, space, line = SOLID[data], data == SPACE, data == NEWLINE
        # a text's last byte has no follower
        ahead = np.append(solid[1:], False)
        ahead[heads[heads > 0] - 1] = False
        # a text's first byte is a unit's first byte anyway, so its predecessor doesn't matter
        cut[1:] = space[1:] & ~space[:-1] & ahead[1:]
        cut[1:] |= line[1:] & (ahead[1:] | (solid[:-1] & (data[:-1] < 128)))
        cut[1:] |= line[:-1] & solid[1:]
        marks = np.flatnonzero(LETTER[data[:-1]] & MARK[data[1:]]) + 1
        if joined is not None:
            marks = marks[~joined[data[marks - 1], data[marks]]]
        cut[marks] = True
    cut[heads] = True
    return np.flatnonzero(cut)


def unit_codes(texts: pa.Array, joined: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """(first unit of each text, and their number at the end; code of each unit; distinct
    units): an empty text has no units. Texts of a slice, so together below 2 GB."""
    ends = offsets_of(texts)
    buffer = texts.buffers()[2]
    if buffer is None or ends[-1] == ends[0]:
        return np.zeros(len(texts) + 1, np.int64), np.zeros(0, np.int64), []
    data = np.frombuffer(buffer, np.uint8)[ends[0] : ends[-1]]
    ends = ends - ends[0]
    starts = unit_starts(data, ends[:-1][np.diff(ends) > 0], joined)
    bounds = np.append(starts, len(data)).astype(np.int64)
    units = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(data)])
    coded = units.dictionary_encode()
    return np.searchsorted(starts, ends), coded.indices.to_numpy(), coded.dictionary.to_pylist()


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, .. for sizes[0] places, then from starts[1] on, .."""
    ends = np.cumsum(sizes)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)
