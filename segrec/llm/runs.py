"""Maximal periodic runs of words by longest common extensions in suffix trees.

A run is a stretch of words with smallest period q (words q apart are equal) of at least
``max(least, 2 q)`` words that no neighbour extends. Per document:

1. Words that no run can hold are set aside. In a run of L words the L - q >= least / 2 words
   before its last period come back q words later, so each of its words lies in a window of
   ``(least + 1) // 2`` words that occurs twice within the run. Only stretches of words covered
   by windows that occur twice in the same stretch are searched; every run lies whole in one
   of them, and is a run of that stretch alone.
2. Ukkonen's algorithm builds the suffix trees of a stretch and of its reversal. An Euler tour
   of a tree holds the lengths of its nodes; the shortest one between two leaves is that
   of their lowest common ancestor, the common extension of two places, found in constant
   time from block minima and a table of powers of two.
3. The order of the leaves gives the longest Lyndon word that starts at each place, for the
   order of the words and for its reverse. By the runs theorem the Lyndon root of every run is
   among them. Each candidate is extended to the right in the first tree and to the left in
   the second; those of two periods at least are the runs, each with its smallest period.

Work and memory are linear in the length of a document but for the logarithm of the table; a
document is handled by one task, whole, and rows never leave their task.

Defined results: null text counts as empty; a document without words has no runs and collapses
to an empty text; null ids and repeated rows pass through as rows; other columns are dropped;
an empty table gives an empty result. Words are ``[^\\x20\\x09-\\x0D]+``, compared by their bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segrec.llm.common import arrow_schema, pick

LEAST = 12
PASSES = 6   # of the search for stretches; each one leaves fewer words to the trees, results do not depend on it
_BLOCK = 16
_STEP = np.uint64(0x9E3779B97F4A7C15)  # odd multiplier: a fixed arbitrary value

_RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


class SuffixTree:
    """The suffix tree of whole numbers from 1 up, closed by a 0 that occurs nowhere else."""

    def __init__(self, symbols: list[int]):
        self.text = [*symbols, 0]
        self.base = max(symbols, default=0) + 1
        self._grow()
        self._walk()

    def _grow(self) -> None:
        """Ukkonen's algorithm: nodes as places in lists, edges by (node, first symbol)."""
        text, base, n = self.text, self.base, len(self.text)
        edges: dict[int, int] = {}
        starts, ends, links = [0], [0], [0]
        get = edges.get
        node = edge = length = pending = 0
        for i, symbol in enumerate(text):
            pending += 1
            unlinked = 0
            while pending:
                if not length:
                    edge = i
                key = node * base + text[edge]
                below = get(key)
                if below is None:
                    edges[key] = len(starts)
                    starts.append(i)
                    ends.append(n)
                    links.append(0)
                    if unlinked:
                        links[unlinked] = node
                        unlinked = 0
                else:
                    start = starts[below]
                    span = ends[below] - start
                    if length >= span:
                        edge += span
                        length -= span
                        node = below
                        continue
                    if text[start + length] == symbol:
                        length += 1
                        if unlinked:
                            links[unlinked] = node
                        break
                    middle = len(starts)
                    cut = start + length
                    edges[key] = middle
                    edges[middle * base + text[cut]] = below
                    edges[middle * base + symbol] = middle + 1
                    starts[below] = cut
                    starts += (start, i)
                    ends += (cut, n)
                    links += (0, 0)
                    if unlinked:
                        links[unlinked] = middle
                    unlinked = middle
                pending -= 1
                if node:
                    node = links[node]
                elif length:
                    length -= 1
                    edge = i - pending + 1
        keys = np.fromiter(edges.keys(), np.int64, len(edges))
        nodes = np.fromiter(edges.values(), np.int64, len(edges))
        del edges
        order = np.argsort(keys)
        keys, nodes = keys[order], nodes[order]
        # the children of a node stand together, by their first symbols
        self._kids, self._parents, self._firsts = nodes, keys // base, keys % base
        self._spans = np.array(ends, np.int64) - np.array(starts, np.int64)
        self._nodes = len(starts)

    def _walk(self) -> None:
        """The Euler tour by node lengths, where each suffix's leaf stands in it, and the leaf order."""
        n, count = len(self.text), self._nodes
        bounds = np.searchsorted(self._parents, np.arange(count + 1))
        at, stop = bounds[:-1].tolist(), bounds[1:].tolist()
        kids, spans = self._kids.tolist(), self._spans.tolist()
        lengths, tour, leaves = [0] * count, [0], []
        place = [0] * n
        last = [0] * count  # leaves met when a node is left
        node, path = 0, []
        length = 0
        while True:
            k = at[node]
            if k < stop[node]:
                at[node] = k + 1
                below = kids[k]
                reach = length + spans[below]
                if at[below] == stop[below]:  # a leaf
                    suffix = n - reach
                    place[suffix] = len(tour)
                    leaves.append(suffix)
                    tour += (reach, length)
                else:
                    path.append(node)
                    node, length = below, reach
                    lengths[node] = length
                    tour.append(length)
            else:
                last[node] = len(leaves)
                if not path:
                    break
                node = path.pop()
                length = lengths[node]
                tour.append(length)
        self._place = np.array(place, np.int64)
        self._leaves = np.array(leaves, np.int64)
        self._last, self._lengths = last, lengths
        self._table(np.array(tour, np.int32))

    def _table(self, tour: np.ndarray) -> None:
        short = -len(tour) % _BLOCK
        blocks = np.concatenate((tour, np.full(short, np.iinfo(np.int32).max, np.int32))).reshape(-1, _BLOCK)
        self._tour = blocks.ravel()
        self._from_start = np.minimum.accumulate(blocks, axis=1).ravel()
        self._to_end = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        self._powers = [blocks.min(axis=1)]
        width = 1
        while 2 * width <= len(blocks):
            row = self._powers[-1]
            self._powers.append(np.minimum(row[:-width], row[width:]))
            width *= 2

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The common extension of the suffixes at ``a`` and at ``b`` (different places, pair by pair)."""
        low, high = self._place[a], self._place[b]
        low, high = np.minimum(low, high), np.maximum(low, high)
        first, final = low // _BLOCK, high // _BLOCK
        best = np.minimum(self._to_end[low], self._from_start[high])
        near = first == final
        if near.any():  # within one block: at most _BLOCK entries
            x, y = low[near], high[near]
            least = self._tour[x]
            for k in range(1, _BLOCK):
                least = np.minimum(least, self._tour[np.minimum(x + k, y)])
            best[near] = least
        between = np.flatnonzero(final - first > 1)
        if len(between):
            x, count = first[between] + 1, final[between] - first[between] - 1
            level = np.frexp(count)[1] - 1
            for power in np.unique(level):
                at = between[level == power]
                left, right = first[at] + 1, final[at] - (1 << int(power))
                row = self._powers[power]
                best[at] = np.minimum(best[at], np.minimum(row[left], row[right]))
        return best.astype(np.int64)

    def ranks(self) -> tuple[np.ndarray, np.ndarray]:
        """The rank of every suffix by its symbols, with the end before and behind all of them."""
        n = len(self.text)
        closed = np.empty(n, np.int64)
        closed[self._leaves] = np.arange(n)
        # a leaf that ends its parent's string goes behind the parent's other leaves, deeper ones first
        ending = np.flatnonzero(self._firsts == 0)
        parents = self._parents[ending]
        suffix = n - 1 - np.array(self._lengths, np.int64)[parents]
        place, depth = closed.copy(), np.zeros(n, np.int64)
        behind = np.zeros(n, bool)
        place[suffix], depth[suffix], behind[suffix] = np.array(self._last, np.int64)[parents] - 1, -(n - 1 - suffix), True
        opened = np.empty(n, np.int64)
        opened[np.lexsort((depth, behind, place))] = np.arange(n)
        return closed, opened


def _next_below(ranks: list[int]) -> list[int]:
    """Per place but the last the next one of smaller rank (the last place has the smallest)."""
    out = [0] * len(ranks)
    for i in range(len(ranks) - 2, -1, -1):
        own, j = ranks[i], i + 1
        while ranks[j] > own:
            j = out[j]
        out[i] = j
    return out[:-1]


def runs_of(symbols: np.ndarray, least: int = LEAST) -> np.ndarray:
    """All runs (start, length, period) of a sequence of whole numbers, by start, then period."""
    n = len(symbols)
    if n < max(least, 2):
        return np.zeros((0, 3), np.int64)
    codes = (np.unique(symbols, return_inverse=True)[1] + 1).tolist()
    forward = SuffixTree(codes)
    closed, opened = forward.ranks()
    places = np.arange(n)
    # under the reversed order of the words, with the end still before all of them, next below is next above
    ends = np.array([_next_below(closed.tolist()), _next_below((n - opened).tolist())], np.int64)
    start, end = np.concatenate((places, places)), ends.ravel()
    period = end - start
    right = forward.common(start, end)
    del forward
    backward = SuffixTree(codes[::-1])
    left = backward.common(n - start, n - end)
    length = left + period + right
    found = np.flatnonzero(length >= np.maximum(least, 2 * period))
    rows = np.unique(np.stack((start - left, period, length), axis=1)[found], axis=0)
    return rows[:, [0, 2, 1]]


def stretches(symbols: np.ndarray, least: int = LEAST) -> list[tuple[int, int]]:
    """Stretches (begin, end) of words outside of which there is no run, in order and apart."""
    width = max(1, (least + 1) // 2)
    starts = len(symbols) - width + 1
    if starts < 2:
        return []
    # windows by a hash: two that only seem equal widen a stretch, nothing else
    window = np.zeros(starts, np.uint64)
    for k in range(width):
        window = (window ^ (window >> np.uint64(29))) * _STEP + symbols[k:k + starts].astype(np.uint64)
    window *= _STEP
    keep = np.arange(starts)
    part = np.zeros(starts, np.int64)
    for _ in range(PASSES):
        order = np.lexsort((window[keep], part)) if part.any() else np.argsort(window[keep], kind="stable")
        key, group = window[keep][order], part[order]
        same = (key[1:] == key[:-1]) & (group[1:] == group[:-1])
        twice = np.zeros(len(keep), bool)
        twice[order[1:][same]] = twice[order[:-1][same]] = True
        if not twice.any():
            return []
        settled = bool(twice.all())
        keep = keep[twice]
        # windows that overlap or touch cover one stretch
        apart = np.concatenate(([0], np.cumsum(np.diff(keep) > width)))
        if settled and (apart == part).all():
            break
        part = apart
    heads = np.flatnonzero(np.diff(apart, prepend=-1))
    tails = np.append(heads[1:], len(keep)) - 1
    return [(int(keep[h]), int(keep[t]) + width) for h, t in zip(heads, tails, strict=True) if keep[t] + width - keep[h] >= least]


def find_runs(words: list[bytes], least: int = LEAST) -> np.ndarray:
    """All runs (start, length, period) of a document's words, by start, then period."""
    codes = {w: k for k, w in enumerate(dict.fromkeys(words))}
    symbols = np.fromiter(map(codes.__getitem__, words), np.int64, len(words))
    found = []
    for begin, end in stretches(symbols, least):
        rows = runs_of(symbols[begin:end], least)
        rows[:, 0] += begin
        found.append(rows)
    return np.concatenate(found) if found else np.zeros((0, 3), np.int64)


def collapsed(words: list[bytes], runs: np.ndarray) -> list[bytes]:
    """The words without those that lie in a run behind its first period."""
    if not len(runs):
        return words
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return [words[k] for k in np.flatnonzero(np.cumsum(change[:-1]) == 0)]


def periodic_runs(docs: DataFrame, least: int = LEAST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_words, runs (array of start, length, period; by start, then
    period), collapsed (its words without the repetitions, joined by one blank)."""
    kind = docs.schema[id_col].dataType.simpleString()
    spec = f"doc_id {kind}, n_words long, runs {_RUNS}, collapsed string"
    schema = arrow_schema(docs.sparkSession, spec)

    def work(batches):
        for batch in batches:
            texts, sizes, runs = [], [], []
            for raw in batch.column(1).to_pylist():
                words = (raw or b"").split()
                found = find_runs(words, least)
                texts.append(b" ".join(collapsed(words, found)))
                sizes.append(len(words))
                runs.append([{"start": s, "length": n, "period": p} for s, n, p in found.tolist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(runs, schema.field("runs").type),
                                              pa.array(texts, pa.binary()).cast(pa.string())], schema=schema)

    rows = pick(docs, doc_id=id_col, text=text_col)
    return rows.select("doc_id", F.col("text").cast("binary")).mapInArrow(work, spec)


__all__ = ["LEAST", "SuffixTree", "collapsed", "find_runs", "periodic_runs", "runs_of", "stretches"]
