"""Inverted index with block maxima for exact retrieval by a sum of term weights.

Items are numbered and cut into blocks of ``block`` neighbours. Per term the index holds the items with their weights, and
the largest weight in each block. A query first adds up block maxima: no item of a block can score more, so blocks below the
threshold are never opened. Terms whose maxima together stay below the threshold do not open blocks on their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_SLACK, _FLOAT_SLACK = 1e-9, 1e-4
_TABLE_ROWS = 1 << 21


def ragged(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the ranges [begin, end) one after another, and which range each is from."""
    sizes = end - begin
    owner = np.repeat(np.arange(len(begin)), sizes)
    return np.arange(len(owner)) + np.repeat(begin - np.cumsum(sizes) + sizes, sizes), owner


class BlockMaxIndex:
    """Postings are given as three arrays (term, item, weight > 0); a (term, item) pair occurs once."""

    def __init__(self, n_terms: int, n_items: int, terms: np.ndarray, items: np.ndarray, weights: np.ndarray, block: int = 32):
        self.table: np.ndarray | None = None
        order = np.lexsort((items, terms))
        terms, self.items, self.weights = terms[order], items[order], weights[order]
        self.n_items, self.n_blocks = n_items, max(1, -(-n_items // block))
        cell = terms * self.n_blocks + self.items // block
        self.cell_start = np.flatnonzero(np.append(True, cell[1:] != cell[:-1])) if len(cell) else np.zeros(0, np.int64)
        self.cell_end = np.append(self.cell_start[1:], len(cell))[: len(self.cell_start)]
        self.cells = cell[self.cell_start]
        self.maxima = np.maximum.reduceat(self.weights, self.cell_start) if len(cell) else np.zeros(0)
        self.term_start = np.searchsorted(self.cells, np.arange(n_terms + 1) * self.n_blocks)
        self.term_max = np.zeros(n_terms)
        filled = np.flatnonzero(np.diff(self.term_start))
        if len(filled):
            self.term_max[filled] = np.maximum.reduceat(self.maxima, self.term_start[filled])

    def bounds(self, terms: np.ndarray, query: np.ndarray, threshold: float) -> np.ndarray:
        """Upper bound per block; 0 for blocks that only terms too weak for the threshold reach."""
        most = self.term_max[terms] * query
        order = np.argsort(most)
        weak = np.cumsum(most[order]) < threshold - _SLACK
        strong = order[~weak]
        at, owner = ragged(self.term_start[terms[strong]], self.term_start[terms[strong] + 1])
        found = np.bincount(self.cells[at] % self.n_blocks, self.maxima[at] * query[strong][owner], self.n_blocks)
        return np.where(found > 0, found + most[order[weak]].sum(), 0.0)

    def scores(self, terms: np.ndarray, query: np.ndarray, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Exact scores of the items of some blocks that share a term with the query."""
        wanted = (terms[:, None] * self.n_blocks + blocks[None, :]).ravel()
        at = np.searchsorted(self.cells, wanted).clip(max=len(self.cells) - 1)
        hit = np.flatnonzero(self.cells[at] == wanted)
        places, owner = ragged(self.cell_start[at[hit]], self.cell_end[at[hit]])
        factors = np.repeat(query, len(blocks))[hit][owner]
        items, inverse = np.unique(self.items[places], return_inverse=True)
        return items, np.bincount(inverse, self.weights[places] * factors, len(items))

    def above(self, terms: np.ndarray, query: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
        """All items that score at least ``threshold``, with their scores."""
        nothing = np.zeros(0, np.int64), np.zeros(0)
        if not len(self.cells) or not len(terms) or self.term_max[terms] @ query < threshold - _SLACK:
            return nothing
        blocks = np.flatnonzero(self.bounds(terms, query, threshold) >= threshold - _SLACK)
        if not len(blocks):
            return nothing
        items, scores = self.scores(terms, query, blocks)
        keep = scores >= threshold - _SLACK
        return items[keep], scores[keep]

    def above_each(self, queries: np.ndarray, terms: np.ndarray, threshold: float) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(query, items, scores) like ``above`` for many queries of unit weights, given as distinct (query, term) pairs in
        order of the queries. Queries whose term maxima cannot reach the threshold end first; the block bounds of the others are
        added up, many at once, from a table of block maxima."""
        if not len(queries) or not len(self.cells):
            return
        if self.table is None:
            self.table = np.zeros((len(self.term_start) - 1, self.n_blocks), np.float32)
            self.table.ravel()[self.cells] = self.maxima
        first = np.flatnonzero(np.append(True, queries[1:] != queries[:-1]))
        alive = np.add.reduceat(self.term_max[terms], first) >= threshold - _SLACK
        kept = np.repeat(alive, np.diff(np.append(first, len(queries))))
        queries, terms = queries[kept], terms[kept]
        if not len(queries):
            return
        first = np.flatnonzero(np.append(True, queries[1:] != queries[:-1]))
        ends = np.append(first[1:], len(queries))
        step = max(1, _TABLE_ROWS // self.n_blocks)
        i = 0
        while i < len(first):
            j = max(i + 1, int(np.searchsorted(ends, first[i] + step, "right")))
            bounds = np.add.reduceat(self.table[terms[first[i] : ends[j - 1]]], first[i:j] - first[i], axis=0)
            for row in np.flatnonzero(bounds.max(axis=1) >= threshold - _FLOAT_SLACK):
                own = terms[first[i + row] : ends[i + row]]
                items, scores = self.scores(own, np.ones(len(own)), np.flatnonzero(bounds[row] >= threshold - _FLOAT_SLACK))
                keep = scores >= threshold - _SLACK
                if keep.any():
                    yield int(queries[first[i + row]]), items[keep], scores[keep]
            i = j

    def top(self, terms: np.ndarray, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``k`` best items with a positive score, best first; ties go to the smaller number. The blocks with the best bounds
        give a threshold, then all blocks that can still reach it are opened."""
        best, scores = np.zeros(0, np.int64), np.zeros(0)
        if not len(self.cells) or not len(terms):
            return best, scores
        at, owner = ragged(self.term_start[terms], self.term_start[terms + 1])
        block = self.cells[at] % self.n_blocks
        bounds = np.bincount(block, self.maxima[at] * query[owner], self.n_blocks)
        order = np.argsort(-bounds, kind="stable")
        order = order[bounds[order] > 0]
        i, step = 0, max(1, k // 4)
        while i < len(order):
            if len(scores) == k:
                step = int(np.searchsorted(-bounds[order], -(scores[-1] - _SLACK), "right")) - i
                if step <= 0:
                    break
            opened = np.zeros(self.n_blocks, bool)
            opened[order[i : i + step]] = True
            hit = np.flatnonzero(opened[block])
            places, cell = ragged(self.cell_start[at[hit]], self.cell_end[at[hit]])
            sums = np.bincount(self.items[places], self.weights[places] * query[owner[hit]][cell], self.n_items)
            items = np.flatnonzero(sums)
            items, found = np.concatenate([best, items]), np.concatenate([scores, sums[items]])
            first = np.lexsort((items, -np.round(found, 9)))[:k]
            best, scores = items[first], found[first]
            i, step = i + step, step * 2
        return best, scores
