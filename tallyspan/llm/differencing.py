"""Multiway Karmarkar-Karp differencing."""

from __future__ import annotations

import heapq

import numpy as np


def difference(sizes: np.ndarray, ways: int, balanced: bool = False) -> np.ndarray:
    """Part (0 to ``ways`` - 1) of each non-negative integer size, with close sums.

    A heap holds partial partitions by their spread (largest sum less smallest).  The two
    of the largest spread are merged, one in descending and one in ascending order of its
    sums, until one is left.  At the start each size is a partial partition of its own;
    ``balanced`` instead starts from runs of ``ways`` sizes in descending order, one size
    in each part, which keeps the numbers of sizes per part equal and merges far less.

    Sums are kept in descending order less the smallest, which no merge needs.  How the
    parts of two partitions met is kept as one permutation per merge and read back from
    the last merge down.  Ties go by the position of the sizes.
    """
    sizes = np.asarray(sizes, np.int64)
    n = len(sizes)
    if ways <= 1 or n == 0:
        return np.zeros(n, np.int64)
    order = np.argsort(-sizes, kind="stable")
    width = ways if balanced else 1
    rows = -(-n // width)
    start = np.zeros((rows, ways), np.int64)
    filled = np.zeros(rows * width, np.int64)
    filled[:n] = sizes[order]
    start[:, :width] = filled.reshape(rows, width)
    spread = start[:, 0] - start[:, -1]
    start -= start[:, -1:]
    sums: list[np.ndarray | None] = list(start)
    heap = [(-int(s), i) for i, s in enumerate(spread)]
    heapq.heapify(heap)
    merges: list[tuple[int, int, np.ndarray]] = []
    while len(heap) > 1:
        a = heapq.heappop(heap)[1]
        b = heap[0][1]
        both = sums[a] + sums[b][::-1]
        place = np.argsort(-both, kind="stable")
        both = both[place]
        sums[a] = sums[b] = None
        merges.append((a, b, place))
        sums.append(both - both[-1])
        heapq.heapreplace(heap, (-int(both[0] - both[-1]), len(sums) - 1))
    part_of: list[np.ndarray | None] = [None] * len(sums)
    part_of[-1] = np.arange(ways)
    for at in range(len(merges) - 1, -1, -1):
        a, b, place = merges[at]
        back = np.empty(ways, np.int64)
        back[place] = part_of[rows + at]
        part_of[rows + at] = None
        part_of[a], part_of[b] = back, back[::-1]
    parts = np.empty(n, np.int64)
    parts[order] = np.concatenate([p[:width] for p in part_of[:rows]])[:n]
    return parts
