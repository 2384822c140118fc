"""T-occurrence search over the inverted lists of a bounded set of documents (DivideSkip)."""
from __future__ import annotations

import heapq
from bisect import bisect_left

import numpy as np


#: Up to this many entries go through the heap, and up to this many candidates are probed one by one.
HEAP, FEW = 1_000, 4


class Lists:
    """Inverted lists: token -> documents that hold it, in ascending order."""

    def __init__(self, sets: list[np.ndarray], members: np.ndarray):
        tokens = np.concatenate([sets[d] for d in members])
        owners = np.repeat(members, [len(sets[d]) for d in members])
        order = np.argsort(tokens, kind="stable")
        self.tokens, starts = np.unique(tokens[order], return_index=True)
        self.starts = np.append(starts, len(tokens))
        self.packed = owners[order].astype(np.int32)
        self.owners = self.packed.tolist()

    def counted(self, spans: list[tuple[int, int]]) -> tuple[list[int], list[int]]:
        """The documents in these lists, and in how many of them each is."""
        if not spans:
            return [], []
        n = np.bincount(np.concatenate([self.packed[a:b] for a, b in spans]))
        held = np.flatnonzero(n)
        return held.tolist(), n[held].tolist()

    def spans(self, tokens: np.ndarray) -> list[tuple[int, int]]:
        """(begin, end) of each token's list, shortest first; tokens without one are left out."""
        at = np.searchsorted(self.tokens, tokens)
        at = at[at < len(self.tokens)] if len(at) and at[-1] >= len(self.tokens) else at
        at = at[self.tokens[at] == tokens[:len(at)]]
        begin, end = self.starts[at], self.starts[at + 1]
        order = np.argsort(end - begin, kind="stable")
        return list(zip(begin[order].tolist(), end[order].tolist()))


def occurring(lists: Lists, tokens: np.ndarray, least: int, wanted) -> list[tuple[int, int]]:
    """(document, overlap) of the ``wanted`` documents that hold ``least`` or more of ``tokens``.

    The ``least - 1`` longest lists are probed and the others, the rarest tokens,
    merged by a heap: a document outside of all merged lists cannot have the
    overlap.  In a group of alike documents nearly all lists are long and nearly
    all documents are candidates; entries beyond ``HEAP`` and candidates beyond
    ``FEW`` are counted by one pass over the lists instead, with the same result.
    """
    spans = lists.spans(tokens)
    if len(spans) < least:
        return []
    merged, probes = spans[:len(spans) - least + 1], spans[len(spans) - least + 1:]
    owners = lists.owners
    if sum(b - a for a, b in merged) > HEAP:
        held, counts = lists.counted(merged)
    else:
        found: dict[int, int] = {}
        for d in heapq.merge(*[owners[a:b] for a, b in merged]):
            found[d] = found.get(d, 0) + 1
        held, counts = list(found), list(found.values())
    pairs = [(d, n) for d, n in zip(held, counts) if wanted[d]]
    if len(pairs) > FEW:
        held, counts = lists.counted(probes)
        more = dict(zip(held, counts))
        return [(d, n) for d, n in ((d, n + more.get(d, 0)) for d, n in pairs) if n >= least]
    out = []
    for d, count in pairs:
        left = len(probes)
        for a, b in probes:
            k = bisect_left(owners, d, a, b)
            count += k < b and owners[k] == d
            left -= 1
            if count + left < least:
                break
        else:
            out.append((d, count))
    return out


def linked(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """For each set, the smallest index reachable over links of Jaccard similarity ``percent`` / 100 or more.

    Breadth first: a found document leaves the lists, so a group of alike
    documents costs one search each, over ever shorter lists.
    """
    sizes = [len(s) for s in sets]
    label = np.arange(len(sets))
    alive = [n > 0 for n in sizes]
    left = sum(alive)
    lists, indexed = Lists(sets, np.flatnonzero(alive)) if left else None, left
    for seed in range(len(sets)):
        if not alive[seed]:
            continue
        alive[seed] = False
        left -= 1
        queue = [seed]
        while queue and left:
            q = queue.pop()
            if left * 2 < indexed:
                lists, indexed = Lists(sets, np.flatnonzero(alive)), left
            a = sizes[q]
            for d, overlap in occurring(lists, sets[q], -(-percent * a // 100), alive):
                if 100 * overlap >= percent * (a + sizes[d] - overlap):
                    alive[d] = False
                    left -= 1
                    label[d] = seed
                    queue.append(d)
        if not left:
            break
    return label
