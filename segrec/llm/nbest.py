"""SentencePiece encoding by N-best segmentation, and decoding.

The lattice of a text has an arc for every vocabulary piece (with the score of the model file)
and, for characters outside the vocabulary, byte-fallback arcs that cost a little more per byte
than the worst piece. The score of a segmentation is the sum of its arcs. No piece crosses a
segment border (``pieces.py``), so the lattice of a text is a chain of small lattices.

Per segment a forward Viterbi pass gives the best score ``f`` of every prefix. The N best
segmentations come from an A* search backward from the end: a partial path that covers the end
of the segment from position ``i`` with score ``g`` is ranked by ``f(i) + g``, which is exactly
the score of the best completion, so paths leave the queue in the order of their scores and no
path is expanded that is not part of one of the N best (but for ties).

For a whole text the N best are combinations of alternatives of single units. An alternative
among the N best changes only units whose second-best loss is among the N - 1 smallest of the
text, so the search runs for those units alone. The loss comes with the forward pass, which
keeps the second-best score of every prefix too and runs over all new units of one length
together, in arrays. Inside a unit the same holds for its segments: alternatives are searched
in the segments with the N - 1 smallest losses alone, the others stay at their best.

The scores of a byte-pair model are merge ranks, not log-probabilities, and the model itself
encodes by merging: its encoding is one path of the lattice, and seldom the one of the best sum
(of 1,000 documents of the test tables never: 1,091,648 pieces against 957,624). ``encode_documents``
therefore gives the model's own encoding (``pieces.MergeEncoder``, equal to the library's) as the pieces of a
text, with the N-best segmentations beside it.

Scores are whole numbers and sums exact. Ties: the best segmentation takes the longest last
piece, again and again; among equal alternatives the order is by the earlier unit in the text.
Defined results: null text counts as empty, with no piece, score 0 and one (empty)
segmentation; fewer segmentations than N give fewer scores; null ids, repeated rows and extra
columns are as for ``tokencount``. Rows never leave their task.
"""

from __future__ import annotations

import heapq
from functools import lru_cache
from hashlib import sha256
from itertools import chain, count, islice
from operator import itemgetter

import numpy as np
from pyspark.sql import DataFrame

from segrec.llm.common import give_back, map_rows, pick
from segrec.llm.pieces import BLANK, Cache, merge_encoder, vocab

# Entries of the memo of a task (about 300 bytes each): it saves work, results do not depend on it.
CACHE = 500_000
# a solved unit: best score, its piece ids (32-bit, packed), loss of the second best, decoded text
_SCORE, _IDS, _LOSS, _TEXT = map(itemgetter, range(4))
NONE = 1 << 62       # loss of a unit with a single segmentation
ROWS = 500  # texts whose units are solved together, and rows of a result batch
LONGEST_BATCHED = 40  # units up to this length are solved together, longer ones one by one
UNSCORED = -10**8  # pieces at or below (runs of blanks in some vocabularies) do not set the byte score


class Lattice:
    """N-best segmentation with the pieces of one model."""

    def __init__(self, model_path: str):
        self.vocab = vocab(model_path)
        self.byte_score = min(s for s in self.vocab.scores.values() if s > UNSCORED) - 10
        self.unit = Cache(self._unit_best, CACHE)
        self._alternatives = Cache(lambda key: list(islice(self._unit_paths(*key), key[1])), CACHE // 20)
        # pieces by a 64-bit polynomial hash of their code points, for many units at once
        step = 0x9E3779B97F4A7C15
        self._powers = np.cumprod(np.array([1] + [step] * LONGEST_BATCHED, dtype=np.uint64), dtype=np.uint64)
        self._inverse = np.cumprod(np.array([1] + [pow(step, -1, 1 << 64)] * LONGEST_BATCHED, dtype=np.uint64), dtype=np.uint64)
        pieces = [p for p in self.vocab.ids if len(p) <= LONGEST_BATCHED]
        hashes = np.array([self._hash(p) for p in pieces], dtype=np.uint64)
        order = np.argsort(hashes)
        self._hashes = hashes[order]
        if (self._hashes[1:] == self._hashes[:-1]).any():
            raise ValueError("two pieces have one hash")
        # most substrings are no piece: their leading hash bits tell so at once
        self._maybe = np.zeros(1 << 20, dtype=bool)
        self._maybe[self._hashes >> np.uint64(44)] = True
        self._hashed_ids = np.array([self.vocab.ids[p] for p in pieces], dtype=np.int64)[order]
        self._hashed_scores = np.array([self.vocab.scores[p] for p in pieces], dtype=np.int64)[order]
        self._longest = max(map(len, pieces))

    def forget(self) -> None:
        """Give the memory of the memos back: Spark keeps more Python workers than tasks run."""
        self.unit.clear()
        self._alternatives.clear()

    def _hash(self, piece: str) -> int:
        codes = np.frombuffer(piece.encode("utf-32-le"), np.uint32).astype(np.uint64)
        return int((codes * self._powers[:len(codes)]).sum(dtype=np.uint64))

    def arcs(self, segment: str) -> list[list[tuple[int, int]]]:
        """For every end position: (start, score) of the arcs that end there."""
        scores, reach = self.vocab.scores, self.vocab.reach
        out: list[list[tuple[int, int]]] = [[]]
        for end in range(1, len(segment) + 1):
            here = []
            for start in range(max(0, end - reach.get(segment[max(0, end - 2):end], 1)), end):
                piece = segment[start:end]
                if piece in scores:
                    here.append((start, scores[piece]))
                elif end - start == 1:
                    here.append((start, self.byte_score * len(piece.encode("utf-8", "surrogatepass"))))
            out.append(here)
        return out

    @staticmethod
    def forward(arcs) -> tuple[list[int], list[int], list[int]]:
        """Viterbi: best and second-best score of every prefix, and where its last arc begins.

        The longest piece wins ties."""
        best, second, back = [0], [-NONE], [0]
        for here in arcs[1:]:
            top, other, place = -NONE, -NONE, 0
            for start, score in here:
                first = best[start] + score
                if first > top:
                    top, other, place = first, max(top, other), start
                else:
                    other = max(other, first)
                other = max(other, second[start] + score) if second[start] > -NONE else other
            best.append(top)
            second.append(other)
            back.append(place)
        return best, second, back

    def prepare(self, units) -> None:
        """Solve the units not met before, all units of one length together."""
        by_length: dict[int, list[str]] = {}
        for unit in set(units):
            if unit not in self.unit:
                by_length.setdefault(len(unit), []).append(unit)
        if len(self.unit) + sum(map(len, by_length.values())) > CACHE:
            self.unit.clear()
        for length, group in by_length.items():
            if length <= LONGEST_BATCHED and len(group) >= 8:
                self._solve(group, length)

    def _places(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self._hashes, wanted)
        at[at == len(self._hashes)] = 0
        return at, self._hashes[at] == wanted

    def _solve(self, group: list[str], n: int) -> None:
        """``forward`` for many units of ``n`` characters, a column of arrays per position."""
        codes = np.frombuffer("".join(group).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(-1, n).T.astype(np.uint64)
        sums = np.zeros((n + 1, len(group)), dtype=np.uint64)
        np.cumsum(codes * self._powers[:n, None], axis=0, dtype=np.uint64, out=sums[1:])
        n_bytes = 1 + (codes >= 0x80).astype(np.int64) + (codes >= 0x800) + (codes >= 0x10000)
        shape = (n + 1, len(group))
        best, second = np.full(shape, -NONE, dtype=np.int64), np.full(shape, -NONE, dtype=np.int64)
        back, last = np.zeros(shape, dtype=np.int64), np.full(shape, -1, dtype=np.int64)
        best[0] = 0
        for end in range(1, n + 1):
            top, other = best[end], second[end]
            for start in range(max(0, end - self._longest), end):
                wanted = (sums[end] - sums[start]) * self._inverse[start]
                if end - start > 1:
                    columns = np.flatnonzero(self._maybe[wanted >> np.uint64(44)])
                    at, found = self._places(wanted[columns])
                    columns, piece = columns[found], at[found]
                    if not len(columns):
                        continue
                    score = self._hashed_scores[piece]
                else:
                    columns = slice(None)
                    at, found = self._places(wanted)
                    score = np.where(found, self._hashed_scores[at], self.byte_score * n_bytes[start])
                    piece = np.where(found, at, -1)
                first = best[start, columns] + score
                old, before = top[columns], second[start, columns]
                better = first > old
                runner = np.maximum(other[columns], np.where(better, old, first))
                other[columns] = np.where(before > -NONE, np.maximum(runner, before + score), runner)
                top[columns] = np.where(better, first, old)
                back[end, columns] = np.where(better, start, back[end, columns])
                last[end, columns] = np.where(better, piece, last[end, columns])
        # pieces from the end to the begin; -2 where a unit is done
        steps, at, each = [], np.full(len(group), n), np.arange(len(group))
        while at.any():
            steps.append(np.where(at > 0, np.where(last[at, each] >= 0, self._hashed_ids[last[at, each]], -1), -2))
            at = np.where(at > 0, back[at, each], 0)
        loss = np.where(second[n] > -NONE, best[n] - second[n], NONE).tolist()
        table = np.array(steps[::-1], dtype="<i4").T
        ones, skip = (table == -1).any(axis=1).tolist(), (table == -2).sum(axis=1).tolist()
        for unit, score, ids, gap, has_bytes, k in zip(group, best[n].tolist(), np.ascontiguousarray(table), loss, ones, skip, strict=True):
            if not has_bytes:  # else left to the one-by-one path
                self.unit[unit] = score, ids[k:].tobytes(), gap, self._text(ids[k:].tolist())

    def segment_paths(self, segment: str):
        """All segmentations of a segment as (score, cuts), best first: backward A*."""
        arcs = self.arcs(segment)
        best, _, _ = self.forward(arcs)
        pushed = count()
        # the cuts of a path are a chain (cut, chain of the cuts behind it): paths share their ends
        queue = [(-best[-1], len(segment), 0, next(pushed), (len(segment), None))]
        while queue:
            _, at, done, _, chain_ = heapq.heappop(queue)
            if at == 0:
                cuts = []
                while chain_:
                    cuts.append(chain_[0])
                    chain_ = chain_[1]
                yield done, tuple(cuts)
                continue
            for start, score in arcs[at]:
                heapq.heappush(queue, (-(best[start] + score + done), start, score + done, next(pushed), (start, chain_)))

    def _ids(self, segment: str, cuts) -> list[int]:
        ids, byte_ids = self.vocab.ids, self.vocab.byte_ids
        out = []
        for a, b in zip(cuts, cuts[1:], strict=False):
            piece = segment[a:b]
            if piece in ids:
                out.append(ids[piece])
            else:
                out += [byte_ids[x] for x in piece.encode("utf-8", "surrogatepass")]
        return out

    def _unit_best(self, unit: str):
        """A unit on its own, segment by segment."""
        score, ids, loss = 0, [], NONE
        for segment in self.vocab.segments(unit):
            best, second, back = self.forward(self.arcs(segment))
            cuts = [len(segment)]
            while cuts[-1]:
                cuts.append(back[cuts[-1]])
            score += best[-1]
            ids += self._ids(segment, cuts[::-1])
            if second[-1] > -NONE:
                loss = min(loss, best[-1] - second[-1])
        return score, _packed(ids), loss, self._text(ids)

    def _text(self, ids) -> bytes:
        return b"".join([self.vocab.texts[i] for i in ids])

    def _unit_paths(self, unit: str, n: int):
        """The ``n`` best segmentations of a unit as (score, packed ids), best first.

        A combination that changes a segment scores no better than the one that changes it alone,
        so only the segments with the ``n - 1`` smallest losses (all that tie at the end would be
        equal, the earlier go first) have alternatives among the ``n`` best."""
        segments = self.vocab.segments(unit)
        losses, fixed, score = [], [], 0
        for segment in segments:
            best, second, back = self.forward(self.arcs(segment))
            cuts = [len(segment)]
            while cuts[-1]:
                cuts.append(back[cuts[-1]])
            fixed.append(_packed(self._ids(segment, cuts[::-1])))
            score += best[-1]
            losses.append(best[-1] - second[-1] if second[-1] > -NONE else NONE)
        places = heapq.nsmallest(n - 1, (i for i, loss in enumerate(losses) if loss < NONE), key=lambda i: (losses[i], i))
        places.sort()
        if not places:
            yield score, b"".join(fixed)
            return
        # what lies between two of the places is the same in all
        edges = [-1, *places, len(segments)]
        between = [b"".join(fixed[a + 1:b]) for a, b in zip(edges, edges[1:], strict=False)]

        def rebuilt(chosen):
            out = [between[0]]
            for i, cuts, after in zip(places, chosen, between[1:], strict=True):
                out += [_packed(self._ids(segments[i], cuts)), after]
            return b"".join(out)

        options = [_Lazy(self.segment_paths(segments[i])) for i in places]
        base = score - sum(x.get(0)[0] for x in options)
        for found, ids in _merged(options, rebuilt):
            yield base + found, ids

    def _found(self, units: list[str], n: int):
        """Best segmentations of the units, the places that the ``n`` best of the text may
        change, and the options at those places."""
        found = list(map(self.unit.__getitem__, units))
        if n == 1 or not units:
            return found, [], []
        loss = np.fromiter(map(_LOSS, found), dtype=np.int64, count=len(found))
        most = np.partition(loss, n - 2)[n - 2] if len(loss) >= n - 1 else NONE
        places = np.flatnonzero((loss <= most) & (loss < NONE))
        places = sorted(places[np.argsort(loss[places], kind="stable")][:n - 1].tolist())
        return found, places, [_Lazy(iter(self._options(units[i], n))) for i in places]

    def best(self, units: list[str], n: int = 1) -> tuple[bytes, list[int], bytes]:
        """For a text's units: packed piece ids of the best segmentation, scores of the ``n``
        best, and the decoded text (with the blank that encoding puts first)."""
        found, places, options = self._found(units, n)
        score = sum(map(_SCORE, found))
        base = score - sum(found[i][0] for i in places)
        scores = [base + s for s, _ in islice(_merged(options, len), n)] if places else [score]
        return b"".join(map(_IDS, found)), scores, b"".join(map(_TEXT, found))

    def encode(self, text: str | None, n: int = 1) -> list[tuple[int, list[int]]]:
        """The ``n`` best segmentations of a text as (score, piece ids), best first."""
        found, places, options = self._found(self.vocab.units(text or ""), n)
        ids = list(map(_IDS, found))
        base = sum(map(_SCORE, found)) - sum(found[i][0] for i in places)

        def rebuilt(chosen):
            changed = ids.copy()
            for i, other in zip(places, chosen, strict=True):
                changed[i] = other
            return np.frombuffer(b"".join(changed), "<i4").tolist()

        return [(base + s, rebuilt(c)) for s, c in islice(_merged(options, list), n)]

    def _options(self, unit: str, n: int) -> list:
        """The ``n`` best of a unit; the first is the one that ``encode`` takes."""
        score, ids = self.unit[unit][:2]
        others = [x for x in self._alternatives[unit, n + 1] if x[1] != ids]
        return [(score, ids), *others][:n]

    def decode(self, ids) -> str:
        return self.vocab.decode(ids)


def _packed(ids) -> bytes:
    return np.array(list(ids), dtype="<i4").tobytes()


class _Lazy:
    """Indexed access to an iterator of (score, value), best first."""

    def __init__(self, items):
        self.items, self.seen = items, []

    def get(self, k: int):
        while len(self.seen) <= k:
            item = next(self.items, None)
            if item is None:
                return None
            self.seen.append(item)
        return self.seen[k]


def _merged(lists: list[_Lazy], join):
    """Combinations of one element of each list, by falling sum of scores."""
    first = (0,) * len(lists)
    queue = [(-sum(x.get(0)[0] for x in lists), first)]
    known = {first}
    while queue:
        score, index = heapq.heappop(queue)
        yield -score, join([x.get(k)[1] for x, k in zip(lists, index, strict=True)])
        for i, x in enumerate(lists):
            step = (*index[:i], index[i] + 1, *index[i + 1:])
            if step not in known and (item := x.get(step[i])) is not None:
                known.add(step)
                heapq.heappush(queue, (score + x.get(index[i])[0] - item[0], step))


@lru_cache(maxsize=4)
def lattice(model_path: str) -> Lattice:
    return Lattice(model_path)


def encode_documents(docs: DataFrame, model_path: str, n_best: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, piece_ids (the model's own encoding) and their number n_pieces, best_ids (the
    best segmentation), nbest_scores, decoded (the text that decoding the pieces gives) and round_trip (that
    of both equals the input, in which a literal blank mark counts as a blank)."""
    pieces = lambda ids: np.frombuffer(ids, "<i4")
    return _mapped(docs, model_path, n_best, id_col, text_col,
                   "piece_ids array<int>, best_ids array<int>, decoded string",
                   lambda best, decoded, own: (pieces(own), pieces(best), decoded.decode("utf-8", "replace")), own=True)


def encode_digests(docs: DataFrame, model_path: str, n_best: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``encode_documents`` with digests in place of the pieces and the decoded text."""
    return _mapped(docs, model_path, n_best, id_col, text_col, "ids_sha256 string, decoded_sha256 string",
                   lambda ids, decoded, _: (sha256(ids).hexdigest(), sha256(decoded).hexdigest()))


def _mapped(docs, model_path, n_best, id_col, text_col, more, result, own=False) -> DataFrame:
    names = [part.split()[0] for part in more.split(", ")]

    def work(batches):
        coder = lattice(model_path)
        merges = merge_encoder(model_path) if own else None
        for b in batches:
            for at in range(0, len(b["text"]), ROWS):
                yield part(coder, merges, b["doc_id"][at:at + ROWS], b["text"][at:at + ROWS])
        coder.forget()
        if own:
            merges.forget()
        give_back()

    def part(coder, merges, doc_ids, texts):
        out = {"doc_id": doc_ids, "n_pieces": [], "nbest_scores": [], "round_trip": [], **{n: [] for n in names}}
        units = [coder.vocab.units(t or "") for t in texts]
        coder.prepare(chain.from_iterable(units))
        for text, own_units in zip(texts, units, strict=True):
            best, scores, decoded = coder.best(own_units, n_best)
            decoded, taken = decoded.removeprefix(b" "), best
            expected = (text or "").replace(BLANK, " ").encode("utf-8", "surrogatepass")
            same = decoded == expected
            if own:
                taken = merges.encode(own_units)
                decoded = b"".join([coder.vocab.texts[i] for i in np.frombuffer(taken, "<i4").tolist()]).removeprefix(b" ")
                same &= decoded == expected
            out["n_pieces"].append(len(taken) // 4)
            out["nbest_scores"].append(scores)
            out["round_trip"].append(same)
            for name, value in zip(names, result(best, decoded, taken), strict=True):
                out[name].append(value)
        return out

    return map_rows(pick(docs, doc_id=id_col, text=text_col), f"doc_id {docs.schema[id_col].dataType.simpleString()}, "
                    f"n_pieces long, nbest_scores array<long>, round_trip boolean, {more}", work)


__all__ = ["Lattice", "encode_digests", "encode_documents"]
