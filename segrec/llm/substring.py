"""Repeated-passage removal behind a count-min prefilter.

A window is ``width`` consecutive words of one document. Words covered by a window whose word
sequence also starts anywhere else are removed; windows are judged on the input.

The documents are written once as chunks of bounded bytes, bucketed by chunk, and read three
times without a shuffle of text:

1. Each chunk sketches its windows: two hash lanes, each cell with a saturating count. The
   sketch is sent in sparse form, one fragment per lane and shard of the cell space. A task
   merges the fragments of one shard; summed counts can only overestimate, so every repeated
   window lies in cells counted twice or more. Each fragment gets back one bit per cell. The
   cell space grows with the corpus (about four cells per window and lane), shards do not.
2. Only windows whose cells in both lanes are estimated repeated go on, as 128-bit
   fingerprints, once per chunk with a mark if the chunk holds several. They are grouped
   exactly by shards of the fingerprint, and again one bit per fingerprint returns.
3. Each chunk removes the covered words.

A passage that a third of all documents share is one fingerprint per chunk. Nothing is
broadcast or collected but one sum (bytes of text) that sizes the cell space.

Equality of word sequences is equality of 128-bit fingerprints of 64-bit word hashes.

Defined results: null text has no words and stays null; documents below ``width`` words have
no window; repeated rows (same id or not) count as separate occurrences; null ids are carried
along; an empty table gives an empty result; other input columns come back in the struct
``row``, so their names cannot clash. A text of any length is one document of one chunk.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StringType, StructField, StructType

from segrec.llm.common import CHUNK_BYTES, chunk_table, materialise
from segrec.llm.hashing import Windows, word_hashes

CELLS = 1 << 22       # cells of one shard of a sketch lane
CELLS_PER_WINDOW = 4
PRINTS = 1 << 21      # fingerprints of one exact shard, at most about so many
LANES = 2
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_GAP = 65535


def pack_cells(cells: np.ndarray) -> bytes:
    """Ascending cell numbers as 16-bit steps; a step of 65535 says that more follows."""
    steps = np.diff(cells, prepend=0)
    gaps = steps // _GAP
    out = np.full(len(cells) + int(gaps.sum()), _GAP, dtype=np.uint16)
    out[np.cumsum(gaps + 1) - 1] = steps % _GAP
    return out.tobytes()


def unpack_cells(data: bytes) -> np.ndarray:
    steps = np.frombuffer(data, dtype=np.uint16)
    return np.cumsum(steps, dtype=np.int64)[steps != _GAP]


def _bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def _unbits(data: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8), count=n).astype(bool)


class ChunkWindows:
    """All windows of a chunk's texts."""

    def __init__(self, texts: list[bytes | None], width: int):
        self.width = width
        hashes = [word_hashes(t.split()) if t else np.zeros(0, np.uint64) for t in texts]
        self.words = np.array([len(h) for h in hashes], dtype=np.int64)
        joined = np.concatenate([np.zeros(0, np.uint64), *hashes])
        self.offsets = np.concatenate(([0], np.cumsum(self.words)))
        per_doc = np.maximum(self.words - width + 1, 0)
        # word positions at which a window starts that stays inside its document
        self.starts = np.repeat(self.offsets[:-1] - np.concatenate(([0], np.cumsum(per_doc)[:-1])), per_doc) + np.arange(per_doc.sum())
        self.prints = [Windows(width, lane)(joined)[self.starts] if len(self.starts) else np.zeros(0, np.uint64)
                       for lane in range(LANES)]

    def cells(self, lane: int, space: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct cells ascending, the cell of each window, and whether a cell has several."""
        cells, which, counts = np.unique((self.prints[lane] % np.uint64(space)).astype(np.int64),
                                         return_inverse=True, return_counts=True)
        return cells, which, counts > 1

    def suspects(self, flags: dict[tuple[int, int], bytes], space: int) -> np.ndarray:
        """Windows whose cells were counted at least twice in every lane."""
        out = np.ones(len(self.starts), dtype=bool)
        for lane in range(LANES):
            cells, which, _ = self.cells(lane, space)
            repeated = np.zeros(len(cells), dtype=bool)
            for shard, low, high in _slices(cells // CELLS):
                if (lane, shard) in flags:
                    repeated[low:high] = _unbits(flags[lane, shard], high - low)
            out &= repeated[which]
        return np.flatnonzero(out)

    def distinct(self, index: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct fingerprints (n x 2, ascending) of some windows, their places, and several-marks."""
        a, b = self.prints[0][index], self.prints[1][index]
        order = np.lexsort((b, a))
        a, b = a[order], b[order]
        fresh = np.ones(len(a), dtype=bool)
        fresh[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        group = np.cumsum(fresh) - 1
        which = np.empty(len(a), dtype=np.int64)
        which[order] = group
        return np.stack([a[fresh], b[fresh]], axis=1), which, np.bincount(group, minlength=int(fresh.sum())) > 1

    def covered(self, index: np.ndarray) -> np.ndarray:
        """Per word of the chunk: lies in one of the windows ``index``."""
        edge = np.zeros(int(self.offsets[-1]) + 1, dtype=np.int64)
        np.add.at(edge, self.starts[index], 1)
        np.add.at(edge, self.starts[index] + self.width, -1)
        return np.cumsum(edge)[:-1] > 0


def _slices(shards: np.ndarray):
    """(shard, low, high) of the runs of an ascending array of shard numbers."""
    if not len(shards):
        return
    edges = np.flatnonzero(np.diff(shards)) + 1
    for low, high in zip([0, *edges], [*edges, len(shards)], strict=True):
        yield int(shards[low]), int(low), int(high)


def _print_shards(distinct: np.ndarray, bits: int) -> np.ndarray:
    """The leading ``bits`` bits of fingerprints."""
    return (distinct[:, 0] >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(distinct), np.int64)


def cut_words(text: bytes, gone: np.ndarray) -> bytes:
    """``text`` without the marked words and the white space before each of them."""
    out, at = [], 0
    for m, drop in zip(_WORD.finditer(text), gone, strict=True):
        if drop:
            at = m.end()
        else:
            out.append(text[at:m.end()])
            at = m.end()
    out.append(text[at:])
    return b"".join(out)


def _merge_cells(key, table):
    """One shard of one lane: which cells of each fragment are counted twice or more in all."""
    cells = [unpack_cells(x) for x in table["cells"].to_pylist()]
    total = np.zeros(CELLS, dtype=np.int64)
    for c, many in zip(cells, table["many"].to_pylist(), strict=True):
        total[c] += 1 + _unbits(many, len(c))
    return _answer(key[0].as_py(), key[1].as_py(), table["chunk"], [total[c] > 1 for c in cells])


def _merge_prints(key, table):
    """One shard of fingerprints: which of each fragment occur twice or more in all."""
    prints = [np.frombuffer(x, np.uint64).reshape(-1, 2) for x in table["prints"].to_pylist()]
    several = np.concatenate([_unbits(m, len(p)) for m, p in zip(table["many"].to_pylist(), prints, strict=True)])
    a, b = np.concatenate(prints).T
    order = np.lexsort((b, a))
    same = np.zeros(len(order), dtype=bool)
    same[1:] = (a[order[1:]] == a[order[:-1]]) & (b[order[1:]] == b[order[:-1]])
    group = np.cumsum(~same) - 1
    counts = np.bincount(group, weights=1 + several[order])
    repeated = np.empty(len(order), dtype=bool)
    repeated[order] = counts[group] > 1
    return _answer(-1, key[0].as_py(), table["chunk"], np.split(repeated, np.cumsum([len(p) for p in prints])[:-1]))


def _answer(lane: int, shard: int, chunks, flags: list[np.ndarray]) -> pa.Table:
    rows = [(c, lane, shard, _bits(f)) for c, f in zip(chunks.to_pylist(), flags, strict=True) if f.any()]
    chunk, lanes, shards, bits = zip(*rows, strict=True) if rows else ((), (), (), ())
    return pa.table({"chunk": pa.array(chunk, pa.int64()), "lane": pa.array(lanes, pa.int32()),
                     "shard": pa.array(shards, pa.int64()), "flags": pa.array(bits, pa.binary())})


_ANSWER = "chunk long, lane int, shard long, flags binary"


def remove_repeats(docs: DataFrame, width: int = 50, text_col: str = "text", chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Per document: ``row`` (the other columns), ``text`` without the repeated passages, n_words, n_removed.

    Texts of which nothing is removed come back unchanged."""
    chunks, source_bytes = chunk_table(docs, text_col, chunk_bytes)
    windows = max(1, source_bytes // 6)  # for sizes only: words have about five letters
    space = -(-windows * CELLS_PER_WINDOW // CELLS) * CELLS
    print_bits = (windows // PRINTS).bit_length()
    texts = chunks.select("chunk", "text")

    def sketch(key, table):
        w = ChunkWindows(table["text"].to_pylist(), width)
        rows = []
        for lane in range(LANES):
            cells, _, many = w.cells(lane, space)
            rows += [(key[0].as_py(), lane, shard, pack_cells(cells[low:high] - shard * CELLS), _bits(many[low:high]))
                     for shard, low, high in _slices(cells // CELLS)]
        columns = zip(*rows, strict=True) if rows else [()] * 5
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary())
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                        names=["chunk", "lane", "shard", "cells", "many"])

    def suspects_of(w, answers):
        flags = {(x["lane"], x["shard"]): x["flags"] for x in answers.to_pylist()}
        index = w.suspects(flags, space)
        return flags, index, *w.distinct(index)

    def prints(key, left, right):
        _, _, distinct, _, many = suspects_of(ChunkWindows(left["text"].to_pylist(), width), right)
        rows = [(key[0].as_py(), shard, distinct[low:high].tobytes(), _bits(many[low:high]))
                for shard, low, high in _slices(_print_shards(distinct, print_bits))]
        columns = zip(*rows, strict=True) if rows else [()] * 4
        return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.binary(), pa.binary()), strict=True)],
                        names=["chunk", "shard", "prints", "many"])

    def cut(key, left, right):
        raw = left["text"].to_pylist()
        w = ChunkWindows(raw, width)
        flags, index, distinct, which, _ = suspects_of(w, right)
        repeated = np.zeros(len(distinct), dtype=bool)
        for shard, low, high in _slices(_print_shards(distinct, print_bits)):
            if (-1, shard) in flags:
                repeated[low:high] = _unbits(flags[-1, shard], high - low)
        gone = w.covered(index[repeated[which]])
        removed = np.array([int(gone[a:b].sum()) for a, b in zip(w.offsets, w.offsets[1:], strict=False)], dtype=np.int64)
        kept = [cut_words(t, gone[a:b]) if n else t
                for t, n, a, b in zip(raw, removed, w.offsets, w.offsets[1:], strict=False)]
        return pa.table([left["row"], pa.array(kept, pa.binary()).cast(pa.string()), pa.array(w.words), pa.array(removed)],
                        names=["row", "text", "n_words", "n_removed"])

    fragments = texts.groupBy("chunk").applyInArrow(sketch, "chunk long, lane int, shard long, cells binary, many binary")
    cell_flags = fragments.groupBy("lane", "shard").applyInArrow(_merge_cells, _ANSWER)
    cell_flags = materialise(cell_flags, "cell-flags")
    suspects = texts.groupBy("chunk").cogroup(cell_flags.groupBy("chunk")).applyInArrow(
        prints, "chunk long, shard long, prints binary, many binary")
    print_flags = materialise(suspects.groupBy("shard").applyInArrow(_merge_prints, _ANSWER), "print-flags")
    flags = cell_flags.unionByName(print_flags)
    out = StructType([chunks.schema["row"], StructField("text", StringType()), StructField("n_words", LongType()),
                      StructField("n_removed", LongType())])
    return chunks.select("chunk", "text", "row").groupBy("chunk").cogroup(flags.groupBy("chunk")).applyInArrow(cut, out)


__all__ = ["ChunkWindows", "cut_words", "pack_cells", "remove_repeats", "unpack_cells"]
