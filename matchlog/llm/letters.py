"""Letter words of many texts at once."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from . import bpe


@dataclass
class LetterWords:
    """Lower-cased runs of letters: ``codes`` index ``distinct``; text i has the
    words ``bounds[i] .. bounds[i + 1] - 1``; ``begin`` and ``end`` are places in
    ``points``, the code points of all lower-cased texts, joined by line breaks."""

    distinct: pa.Array
    codes: np.ndarray
    bounds: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    points: np.ndarray


def letter_words(texts: list[str]) -> LetterWords:
    lowered = [t.lower() for t in texts]
    joined = "\n".join(lowered) + "\n"
    points = bpe.code_points(joined)
    letter = bpe.char_classes()[points] == bpe.LETTER
    edge = np.flatnonzero(np.diff(np.concatenate([[False], letter]).astype(np.int8)))
    begin, end = edge[0::2], edge[1::2]
    at = bpe.byte_starts(points)
    offsets = np.empty(2 * len(begin) + 1, np.int32)
    offsets[0:-1:2], offsets[1::2], offsets[-1] = at[begin], at[end], at[-1]
    pieces = pa.StringArray.from_buffers(2 * len(begin), pa.py_buffer(offsets), pa.py_buffer(joined.encode()))
    coded = pieces.take(pa.array(np.arange(0, 2 * len(begin), 2))).dictionary_encode()
    starts = np.append(0, np.cumsum([len(t) + 1 for t in lowered]))
    return LetterWords(
        coded.dictionary,
        coded.indices.to_numpy().astype(np.int64),
        np.searchsorted(begin, starts),
        begin,
        end,
        points,
    )
