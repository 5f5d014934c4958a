"""Common cuts of two tokenisations of the same bytes, by skipping along diagonals.

Both sides are arrays of byte ends. Where the tokens stand one to one, equal ends lie on one diagonal: the
index on the one side less the index on the other does not change. A run is skipped by comparing windows on the
current diagonal whose width doubles while all of a window is equal. Where a window differs, the irregular group
is walked token by token, always on the side that ends first, until both end together; the shift between
the indices is then that of the next run. Many places of the input, all at common ends, are worked on at once.
"""

from __future__ import annotations

import numpy as np

from tidegate.llm.token_bytes import spans

LANE_TOKENS = 96
WIDEST = 64


class Alignment:
    """Cuts and links of one pair of tokenisations: `cut_a[g]` and `cut_b[g]` are the last tokens of group g, and
    tokens `link_a[k]` and `link_b[k]` overlap."""

    def __init__(self, cut_a: np.ndarray, cut_b: np.ndarray, link_a: np.ndarray, link_b: np.ndarray):
        self.cut_a, self.cut_b, self.link_a, self.link_b = cut_a, cut_b, link_a, link_b


def _walk(ends_a: np.ndarray, ends_b: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray, list]:
    """The first common end at or after each (i, j), and the pairs of tokens met on the way."""
    i, j, met = i.copy(), j.copy(), []
    open_ = np.arange(len(i))
    while len(open_):
        p, q = i[open_], j[open_]
        met.append((p, q))
        a, b = ends_a[p], ends_b[q]
        i[open_] = p + (a < b)
        j[open_] = q + (b < a)
        open_ = open_[a != b]
    return i, j, met


def align(ends_a: np.ndarray, ends_b: np.ndarray, lane_tokens: int = LANE_TOKENS) -> Alignment:
    """Groups and links of two strictly rising arrays of byte ends with the same last end."""
    none = np.zeros(0, np.int64)
    if not len(ends_a):
        return Alignment(none, none, none, none)
    places = np.arange(lane_tokens - 1, len(ends_a) - 1, lane_tokens)
    first_a, first_b, _ = _walk(ends_a, ends_b, places, np.searchsorted(ends_b, ends_a[places]))
    i, kept = np.unique(np.append(-1, first_a), return_index=True)
    j = np.append(-1, first_b)[kept]
    i, j = i + 1, j + 1
    stop = np.append(i[1:], len(ends_a))
    live = i < stop
    i, j, stop = i[live], j[live], stop[live]
    width = np.ones(len(i), np.int64)
    runs, walked, cuts = [], [], []
    while len(i):
        length = np.empty(len(i), np.int64)
        for w in np.unique(width):
            at = np.flatnonzero(width == w)
            step = np.arange(w)
            left, right = i[at, None] + step, j[at, None] + step
            same = ends_a[np.minimum(left, len(ends_a) - 1)] == ends_b[np.minimum(right, len(ends_b) - 1)]
            same &= left < stop[at, None]
            length[at] = np.where(same.all(1), w, same.argmin(1))
        runs.append((i, j, length))
        i, j = i + length, j + length
        width = np.where(length == width, np.minimum(width * 2, WIDEST), 1)
        odd = np.flatnonzero((width == 1) & (i < stop))
        p, q, met = _walk(ends_a, ends_b, i[odd], j[odd])
        walked += met
        cuts.append((p, q))
        i[odd], j[odd] = p + 1, q + 1
        live = i < stop
        i, j, stop, width = i[live], j[live], stop[live], width[live]
    start_a, start_b, lengths = (np.concatenate(x) for x in zip(*runs))
    even_a, even_b = spans(start_a, lengths), spans(start_b, lengths)
    odd_a, odd_b = (np.concatenate(x) for x in zip(*cuts))
    met_a, met_b = (np.concatenate(x) if x else none for x in zip(*walked)) if walked else (none, none)
    return Alignment(np.sort(np.concatenate([even_a, odd_a])), np.sort(np.concatenate([even_b, odd_b])),
                     np.concatenate([even_a, met_a]), np.concatenate([even_b, met_b]))
