"""Token counts of every prefix of a text by dynamic programming over last tokens.

For a byte-pair vocabulary whose merges depend on the merged piece alone, a token sequence is
the encoding of its text exactly if every two neighbours are: merging the text of the two
from single characters gives the two back. So each prefix has one last token ``t`` such that
``t`` ends the prefix and is compatible with the last token of the prefix before it, and::

    count(prefix) = count(prefix without t) + 1

Counts add up over the segments of a unit (``pieces.py``), so a segment is counted on its own.
Prefixes of short units and segments are kept between texts, in a memo with a bound in bytes; a
long segment is counted in lists by position that live as long as the segment does, so memory grows with the
length of a run without blanks and not with its square.

One pass over the characters gives the exact count of *every* prefix; a truncation or budget
question is then a look-up, without encoding again. The table of a text is kept as one signed
byte per character (the change of the count), ``count_deltas``; ``tokens_at`` and
``longest_within`` answer from it.

Defined results: null text counts as empty (0 bytes, 0 tokens); special strings in a text are
ordinary text, as the library treats them; characters outside the vocabulary count their
UTF-8 bytes; null ids, repeated rows and extra columns pass through as rows (other columns
are dropped); an empty table gives an empty result. Rows never leave their task.
"""

from __future__ import annotations

from array import array
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segrec.llm.common import map_rows, pick
from segrec.llm.pieces import Cache, vocab

# Bounds of the per-worker memos: entries of compatible pairs, bytes of prefix states and of unit
# counts. They save work, results do not depend on them.
CACHE = 600_000
CACHE_BYTES = 240 << 20
ENTRY = 200      # bytes of an entry besides its characters (four bytes each at most)
SHORT = 40       # characters up to which a unit is not cut, and prefixes and counts are kept


class _UnitTotals(dict):
    """Token counts of units, computed when missing; only short units are kept."""

    def __init__(self, compute):
        super().__init__()
        self.compute, self.bytes = compute, 0

    def __missing__(self, unit):
        total = self.compute(unit)
        if len(unit) <= SHORT:
            if self.bytes > CACHE_BYTES:
                self.clear()
                self.bytes = 0
            self[unit] = total
            self.bytes += ENTRY + 4 * len(unit)
        return total


class PrefixCounter:
    """Exact token counts of all prefixes, for one model."""

    def __init__(self, model_path: str):
        self.vocab = vocab(model_path)
        self._compatible = Cache(self._keeps_border, CACHE)
        self._states: dict[str, tuple[str, int]] = {"": ("", 0)}
        self._states_bytes = 0
        self.unit_total = _UnitTotals(lambda unit: self._count(unit) if len(unit) <= SHORT else sum(map(self._count, self._parts(unit))))

    def _merge(self, symbols: list[str]) -> list[str]:
        """The tokens of a short string: best-scored neighbours first, the leftmost of equals."""
        scores = self.vocab.scores
        while len(symbols) > 1:
            ranked = [(scores[p], -k) for k in range(len(symbols) - 1) if (p := symbols[k] + symbols[k + 1]) in scores]
            if not ranked:
                break
            k = -max(ranked)[1]
            symbols[k:k + 2] = [symbols[k] + symbols[k + 1]]
        return symbols

    def _keeps_border(self, pair: tuple[str, str]) -> bool:
        return self._merge([*pair[0], *pair[1]]) == [p for p in pair if p]

    def _extend(self, text: str, found: list[tuple[str, int]]) -> None:
        """Append the (last token, token count) of the prefixes of ``text`` that ``found`` lacks."""
        ending, fits = self.vocab.ending, self._compatible
        for end in range(len(found), len(text) + 1):
            node, at, tokens = ending, end, []
            while at and (node := node.get(text[at - 1])) is not None:
                at -= 1
                if "" in node:
                    tokens.append((at, node[""]))
            for start, token in reversed(tokens):
                before, count = found[start]
                if fits[before, token]:
                    break
            else:  # a character outside the vocabulary: its bytes
                token = text[end - 1]
                count = found[end - 1][1] + len(token.encode("utf-8", "surrogatepass")) - 1
            found.append((token, count + 1))

    def _parts(self, unit: str) -> list[str]:
        return [unit] if len(unit) <= SHORT else self.vocab.segments(unit)

    def _count(self, segment: str) -> int:
        """Tokens of a segment or short unit. The states of a short one's prefixes are kept, so it costs only the
        characters after its longest prefix that was met before, and of that no more than the states in reach."""
        size = len(segment)
        if size > SHORT:
            return self.segment_states(segment)[-1][1]
        states, fits, ending = self._states, self._compatible, self.vocab.ending
        if self._states_bytes > CACHE_BYTES:
            states.clear()
            states[""], self._states_bytes = ("", 0), 0
        known = size
        while (found := states.get(segment[:known])) is None:
            known -= 1
        for end in range(known + 1, size + 1):
            node, at, tokens = ending, end, []
            while at and (node := node.get(segment[at - 1])) is not None:
                at -= 1
                if "" in node:
                    tokens.append((at, node[""]))
            for start, token in reversed(tokens):
                before, count = found if start == end - 1 else states[segment[:start]]
                if fits[before, token]:
                    break
            else:  # a character outside the vocabulary: its bytes
                token = segment[end - 1]
                count = found[1] + len(token.encode("utf-8", "surrogatepass")) - 1
            found = states[segment[:end]] = (token, count + 1)
            self._states_bytes += ENTRY + 4 * end
        return found[1]

    def segment_states(self, segment: str) -> list[tuple[str, int]]:
        """(last token, token count) of every prefix of a segment or short unit."""
        if len(segment) > SHORT:
            found = [("", 0)]
            self._extend(segment, found)
            return found
        self._count(segment)
        return [self._states[segment[:k]] for k in range(len(segment) + 1)]

    def total(self, text: str | None) -> int:
        return sum(map(self.unit_total.__getitem__, self.vocab.units(text))) if text else 0

    def prefix_counts(self, text: str | None) -> np.ndarray:
        """Tokens of ``text[:0]``, ``text[:1]``, ... ``text``."""
        out, base = array("q", [0]), 0
        for unit in self.vocab.units(text or ""):
            for segment in self._parts(unit):
                out.extend([base + n for _, n in self.segment_states(segment)[1:]])
                base = out[-1]
        # the leading blank that encoding adds is no character of the text
        return np.array([0, *out[2:]], dtype=np.int64) if len(out) > 1 else np.zeros(1, np.int64)

    def longest_prefix(self, text: str | None, budget: int) -> int:
        """Characters of the longest prefix of at most ``budget`` tokens.

        Every unit adds a token at least, so it ends within the last unit that begins below the budget, or
        where that one begins: only this unit is looked at character by character."""
        base = at = 0          # tokens and characters before the unit
        last = None
        for unit in self.vocab.units(text or ""):
            if base >= budget:
                break
            last = base, at, unit
            base += self.unit_total[unit]
            at += len(unit)
        if last is None:
            return 0
        base, at, unit = last
        end = at
        for segment in self._parts(unit):
            states = self.segment_states(segment)
            end = max((at + k for k in range(1, len(states)) if base + states[k][1] <= budget), default=end)
            base += states[-1][1]
            at += len(segment)
        # the leading blank that encoding adds is no character of the text
        return max(end - 1, 0)


@lru_cache(maxsize=4)
def counter(model_path: str) -> PrefixCounter:
    return PrefixCounter(model_path)


def count_tokens(docs: DataFrame, model_path: str, limit: int = 4096, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_bytes, n_tokens, over_limit, fit_chars (the longest prefix within
    ``limit`` tokens, in characters)."""
    def work(batches):
        c = counter(model_path)
        for b in batches:
            texts = [t or "" for t in b["text"]]
            tokens = [c.total(t) for t in texts]
            yield {"doc_id": b["doc_id"], "n_bytes": [len(t.encode("utf-8", "surrogatepass")) for t in texts],
                   "n_tokens": tokens, "over_limit": [n > limit for n in tokens],
                   "fit_chars": [len(t) if n <= limit else c.longest_prefix(t, limit)
                                 for t, n in zip(texts, tokens, strict=True)]}

    return map_rows(pick(docs, doc_id=id_col, text=text_col), f"doc_id {docs.schema[id_col].dataType.simpleString()}, "
                    "n_bytes long, n_tokens long, over_limit boolean, fit_chars long", work)


def _signed_bytes(changes: np.ndarray) -> bytes:
    """A byte each. A character changes the count by its bytes at most, or by the characters of the
    piece that it completes; a vocabulary with longer pieces than a byte can say is refused, not cut off."""
    if len(changes) and (changes.min() < -128 or changes.max() > 127):
        raise ValueError("a character changes the token count by more than a signed byte holds")
    return changes.astype(np.int8).tobytes()


def prefix_table(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_tokens, count_deltas (binary, a signed byte per character)."""
    def work(batches):
        c = counter(model_path)
        for b in batches:
            counts = [c.prefix_counts(t) for t in b["text"]]
            yield {"doc_id": b["doc_id"], "n_tokens": [int(x[-1]) for x in counts],
                   "count_deltas": [_signed_bytes(np.diff(x)) for x in counts]}

    return map_rows(pick(docs, doc_id=id_col, text=text_col), f"doc_id {docs.schema[id_col].dataType.simpleString()}, "
                    "n_tokens long, count_deltas binary", work)


def tokens_at(count_deltas: Column | str, n_chars: Column | str) -> Column:
    """Tokens of the first ``n_chars`` characters (all of them if the text is shorter)."""
    @F.pandas_udf("long")
    def at(deltas: pd.Series, chars: pd.Series) -> pd.Series:
        return pd.Series([int(np.frombuffer(d, np.int8, count=min(int(n), len(d))).sum(dtype=np.int64)) if n > 0 else 0
                          for d, n in zip(deltas, chars, strict=True)])

    return at(F.col(count_deltas) if isinstance(count_deltas, str) else count_deltas,
              F.col(n_chars) if isinstance(n_chars, str) else n_chars)


def longest_within(count_deltas: Column | str, budget: int) -> Column:
    """Characters of the longest prefix of at most ``budget`` tokens."""
    @F.pandas_udf("long")
    def within(deltas: pd.Series) -> pd.Series:
        def one(d):
            counts = np.concatenate(([0], np.cumsum(np.frombuffer(d, np.int8), dtype=np.int64)))
            return int(np.flatnonzero(counts <= budget)[-1])
        return deltas.map(one).astype("int64")

    return within(F.col(count_deltas) if isinstance(count_deltas, str) else count_deltas)


__all__ = ["PrefixCounter", "count_tokens", "longest_within", "prefix_table", "tokens_at"]
