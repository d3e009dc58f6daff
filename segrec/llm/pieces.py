"""The piece vocabulary of a sentencepiece model, as the token operators see it.

Text is cut into *units* at blanks (no piece has a blank mark behind another character) and
units into *segments* wherever no piece holds the two neighbouring characters together. No
piece, and so no merge and no lattice arc, crosses such a border: segmentations, token counts
and scores of a text are sums over its segments. Both facts are read off the vocabulary when
it is loaded, and a vocabulary or normaliser for which they fail is refused.
"""

from __future__ import annotations

import heapq
import re
from functools import lru_cache

import numpy as np

BLANK = "▁"
_UNITS = re.compile(f"{BLANK}*[^{BLANK}]+|{BLANK}+")
_PROBE = "ﬁ ½ 　  é\tA\r\n x "


class PieceVocab:
    """Pieces, scores and segment borders of one model file."""

    def __init__(self, model_path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
        if sp.normalize(_PROBE) != BLANK + _PROBE.replace(" ", BLANK):
            raise ValueError("the model's normaliser changes texts; only identity with a leading blank is supported")
        self.ids: dict[str, int] = {}
        self.byte_ids: list[int] = [sp.unk_id()] * 256
        self.texts: list[bytes] = [b""] * sp.get_piece_size()
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.texts[i] = bytes([int(piece[3:5], 16)])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                self.ids[piece] = i
                self.texts[i] = piece.replace(BLANK, " ").encode()
        if any(BLANK in p.lstrip(BLANK) for p in self.ids):
            raise ValueError("a piece has a blank mark behind another character")
        self.scores = {p: int(sp.get_score(i)) for p, i in self.ids.items()}
        if any(sp.get_score(i) != self.scores[p] for p, i in self.ids.items()):
            raise ValueError("piece scores are not whole numbers")
        self.joined = {p[k:k + 2] for p in self.ids for k in range(len(p) - 1)}
        # line breaks stand alone if no piece holds one with another character
        self.cuts_lines = not any("\n" in pair for pair in self.joined)
        # the longest piece that ends in two given characters
        self.reach: dict[str, int] = {}
        for p in self.ids:
            self.reach[p[-2:]] = max(len(p), self.reach.get(p[-2:], 1))
        # pieces by their characters from last to first; the piece itself under ""
        self.ending: dict = {}
        for piece in self.ids:
            node = self.ending
            for ch in reversed(piece):
                node = node.setdefault(ch, {})
            node[""] = piece

    def units(self, text: str) -> list[str]:
        """``text`` as units, blank-led or a line break or what follows one; joined they are the
        normalised text."""
        if not text:
            return []
        if BLANK not in text and "  " not in text and text[-1] != " " and text[0] != " ":
            # the usual case: single blanks between words
            marked = BLANK + text.replace(" ", " " + BLANK)
            if self.cuts_lines and "\n" in marked:
                return list(filter(None, marked.replace("\n", " \n ").split(" ")))
            return marked.split(" ")
        return _UNITS.findall(BLANK + text.replace(" ", BLANK))

    def segments(self, unit: str) -> list[str]:
        joined, out, at = self.joined, [], 0
        for k in range(1, len(unit)):
            if unit[k - 1:k + 1] not in joined:
                out.append(unit[at:k])
                at = k
        out.append(unit[at:])
        return out

    def decode(self, ids) -> str:
        """Pieces to text, without the leading blank that encoding adds."""
        raw = b"".join(map(self.texts.__getitem__, ids))
        return raw[1:].decode("utf-8", "replace") if raw[:1] == b" " else raw.decode("utf-8", "replace")


class MergeEncoder:
    """The model's own encoding: pieces by merging, best score first and the leftmost of equals.

    A unit that is met again is not merged again: encodings of short ones are kept, in a memo with a bound in bytes.
    Long ones are cut into segments, and segments beyond ``SCANNED`` characters take their merges from a heap,
    so work does not grow with the square of a run without blanks."""

    SCANNED = 200          # characters of a segment whose scores are scanned for the best
    KEPT = 40              # characters of a unit that is kept
    MEMO_BYTES = 48 << 20

    def __init__(self, pieces: PieceVocab):
        self.vocab = pieces
        self._memo: dict[str, bytes] = {}
        self._bytes = 0

    def forget(self) -> None:
        self._memo.clear()
        self._bytes = 0

    def _scan(self, parts: list[str]) -> list[str]:
        get, none = self.vocab.scores.get, -(1 << 62)
        scores = [get(a + b, none) for a, b in zip(parts, parts[1:])]  # noqa: B905
        while scores and (best := max(scores)) > none:
            k = scores.index(best)
            parts[k:k + 2] = [parts[k] + parts[k + 1]]
            del scores[k]
            if k < len(scores):
                scores[k] = get(parts[k] + parts[k + 1], none)
            if k:
                scores[k - 1] = get(parts[k - 1] + parts[k], none)
        return parts

    def _merge_long(self, segment: str) -> list[str]:
        get = self.vocab.scores.get
        parts: list[str | None] = list(segment)
        n = len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue: list[tuple[int, int, str]] = []

        def offer(k: int) -> None:
            if k >= 0 and after[k] < n and (score := get(whole := parts[k] + parts[after[k]])) is not None:
                heapq.heappush(queue, (-score, k, whole))

        for k in range(n - 1):
            offer(k)
        while queue:
            _, k, whole = heapq.heappop(queue)
            if parts[k] is None or after[k] >= n or parts[k] + parts[after[k]] != whole:
                continue  # one of the two has been merged with another since
            gone = after[k]
            parts[k], parts[gone], after[k] = whole, None, after[gone]
            if after[k] < n:
                before[after[k]] = k
            offer(before[k])
            offer(k)
        return [p for p in parts if p is not None]

    def _unit(self, unit: str) -> bytes:
        ids, byte_ids = self.vocab.ids, self.vocab.byte_ids
        out: list[int] = []
        for segment in [unit] if len(unit) <= self.KEPT else self.vocab.segments(unit):
            for piece in self._scan(list(segment)) if len(segment) <= self.SCANNED else self._merge_long(segment):
                if piece in ids:
                    out.append(ids[piece])
                else:
                    out += [byte_ids[x] for x in piece.encode("utf-8", "surrogatepass")]
        return np.array(out, dtype="<i4").tobytes()

    def encode(self, units: list[str]) -> bytes:
        """The piece ids of a text's units, packed as 32-bit integers."""
        memo, out = self._memo, []
        for unit in units:
            found = memo.get(unit)
            if found is None:
                found = self._unit(unit)
                if len(unit) <= self.KEPT:
                    if self._bytes > self.MEMO_BYTES:
                        self.forget()
                    memo[unit] = found
                    self._bytes += 200 + 4 * len(unit) + len(found)
            out.append(found)
        return b"".join(out)


@lru_cache(maxsize=4)
def merge_encoder(model_path: str) -> MergeEncoder:
    return MergeEncoder(vocab(model_path))


@lru_cache(maxsize=4)
def vocab(model_path: str) -> PieceVocab:
    """One vocabulary per Python worker and model file."""
    return PieceVocab(model_path)


class Cache(dict):
    """A dictionary that computes missing entries and empties itself at ``bound`` entries."""

    def __init__(self, compute, bound: int):
        super().__init__()
        self.compute, self.bound = compute, bound

    def __missing__(self, key):
        if len(self) >= self.bound:
            self.clear()
        value = self[key] = self.compute(key)
        return value


__all__ = ["BLANK", "Cache", "MergeEncoder", "PieceVocab", "merge_encoder", "vocab"]
