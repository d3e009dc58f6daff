"""Byte-level BPE encoding and decoding over a contiguous rank array.

A text is split at the vocabulary's added tokens (their strings become their ids) and then into
words by the splitting pattern. The bytes of a word start as one part each. Two lists hold the
word: the boundaries of its parts and the rank of every two adjacent parts. The smallest rank
is looked up again and again (the leftmost of equals), the boundary between its two parts is
deleted and the ranks beside it are refreshed, until no adjacent pair has a rank.

That scan is quadratic in the length of a word, so words beyond ``SHORT`` bytes (long runs of
letters, signs or blanks) are merged rank by rank over linked arrays instead: all pairs of the smallest rank at once,
left to right. Both orders give the same parts, because no merge makes a pair of a smaller
rank than its own; that is checked when a vocabulary is loaded, and one for which it fails is
refused, as is one with other steps than byte-level BPE.

Encodings of short words are kept per worker, in a memo with a bound in bytes, since words
repeat; results do not depend on it. Texts are read in slices that end before a blank (no word
crosses such a border), so memory grows with the text by its ids alone, or with its longest
run without blanks.

Defined results: null text counts as empty (no ids, decodes to an empty text); repeated rows
and null ids pass through as rows; columns other than the id and the text are dropped; an empty
table gives an empty result. Ids that no token has decode to nothing; bytes that are no UTF-8 (possible
for made-up ids only) decode to U+FFFD. Rows never leave their task.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from segrec.llm.common import arrow_schema, pick

SHORT = 1024            # bytes of a word up to which its ranks are scanned
KEPT = 64               # characters of a word up to which its encoding is kept
MEMO_BYTES = 96 << 20   # bound of the kept encodings of a worker
ENTRY = 220             # bytes of a kept encoding besides its characters and ids
SLICE = 1 << 20         # characters of a text that are split into words at a time
NONE = 1 << 30          # the rank of a pair that is never merged

# The pattern that splits text before the merges of byte-level vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_characters() -> list[str]:
    """The character that stands for each byte in the vocabulary's tokens: printable ones stand
    for themselves, the others take the characters from U+0100 on."""
    plain = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    others = iter(range(256, 512))
    return [chr(b if b in plain else next(others)) for b in range(256)]


class BytePairs:
    """One byte-level BPE vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, splitter = spec["model"], spec["pre_tokenizer"] or {}
        plain = (model.get("type") == "BPE" and not any(model.get(k) for k in (
            "dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")))
        if not plain or spec["normalizer"] or splitter.get("type") != "ByteLevel" or splitter.get("add_prefix_space") \
                or not splitter.get("use_regex", True) or (spec["decoder"] or {}).get("type") != "ByteLevel":
            raise ValueError("only byte-level BPE vocabularies without normaliser or added blank are supported")
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
            raise ValueError("added tokens that look at their surroundings are not supported")
        vocab: dict[str, int] = model["vocab"]
        if any(c not in vocab for c in byte_characters()):
            raise ValueError("a byte has no token")
        self.byte_ids = [vocab[c] for c in byte_characters()]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.width = max(vocab.values()) + 1
        self.ranks: dict[int, int] = {}
        self.left, self.right, self.merged = (np.zeros(len(merges), np.int64) for _ in range(3))
        made = set(self.byte_ids)
        for rank, (a, b) in enumerate(merges):
            left, right, whole = vocab[a], vocab[b], vocab[a + b]
            if left not in made or right not in made or whole in made:
                raise ValueError("a merge comes before those that make its parts, or its token is made twice")
            made.add(whole)
            self.ranks[left * self.width + right] = rank
            self.left[rank], self.right[rank], self.merged[rank] = left, right, whole
        keys = self.left * self.width + self.right
        self._by_key = np.argsort(keys)
        self._keys = keys[self._by_key]
        self._merged = self.merged.tolist()
        byte_of = {c: b for b, c in enumerate(byte_characters())}
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.texts: dict[int, bytes] = {i: _token_bytes(t, byte_of) for t, i in {**vocab, **self.added}.items()}
        longest_first = sorted(filter(None, self.added), key=len, reverse=True)
        self._cut_added = re.compile(f"({'|'.join(map(re.escape, longest_first))})") if longest_first else None
        self._words, self._unknown = _word_pattern(), _unknown_characters(splitter)
        self._memo: dict[str, bytes] = {}
        self._memo_bytes = 0

    # -- merging -----------------------------------------------------------------------

    def parts(self, word: bytes) -> tuple[list[int], list[int]]:
        """The token ids of a word and the boundaries of its parts (0, ..., its length)."""
        return self._scan(word) if len(word) <= SHORT else self._merge_by_rank(word)

    def _scan(self, word: bytes) -> tuple[list[int], list[int]]:
        get, width, merged = self.ranks.get, self.width, self._merged
        ids = list(map(self.byte_ids.__getitem__, word))
        bounds = list(range(len(word) + 1))
        # the rank of a part and the next one; the last part has none
        ranks = [get(a * width + b, NONE) for a, b in zip(ids, ids[1:])]  # noqa: B905
        ranks.append(NONE)
        while (best := min(ranks)) != NONE:
            k = ranks.index(best)
            ids[k] = merged[best]
            del ids[k + 1], bounds[k + 1], ranks[k]
            ranks[k] = get(ids[k] * width + ids[k + 1], NONE) if k + 1 < len(ids) else NONE
            if k:
                ranks[k - 1] = get(ids[k - 1] * width + ids[k], NONE)
        return ids, bounds

    def _rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left * self.width + right
        at = np.minimum(np.searchsorted(self._keys, keys), len(self._keys) - 1)
        return np.where(self._keys[at] == keys, self._by_key[at], NONE) if len(self._keys) else np.full(len(keys), NONE)

    def _merge_by_rank(self, word: bytes) -> tuple[list[int], list[int]]:
        """The same parts as ``_scan``: every rank in turn, all its pairs from left to right."""
        n = len(word)
        ids = np.array(self.byte_ids, dtype=np.int64)[np.frombuffer(word, np.uint8)]
        after, before = np.arange(1, n + 1, dtype=np.int64), np.arange(-1, n - 1, dtype=np.int64)
        alive = np.ones(n, dtype=bool)
        waiting: dict[int, list[np.ndarray]] = {}
        queue: list[int] = []

        def wait(at: np.ndarray) -> None:
            ranks = self._rank_of(ids[at], ids[after[at]])
            at, ranks = at[ranks != NONE], ranks[ranks != NONE]
            order = np.argsort(ranks, kind="stable")
            for run in np.split(order, np.flatnonzero(np.diff(ranks[order])) + 1) if len(order) else ():
                rank = int(ranks[run[0]])
                if rank not in waiting:
                    waiting[rank] = []
                    heapq.heappush(queue, rank)
                waiting[rank].append(at[run])

        wait(np.arange(n - 1))
        while queue:
            rank = heapq.heappop(queue)
            at = np.unique(np.concatenate(waiting.pop(rank)))
            at = at[alive[at] & (after[at] < n)]
            at = at[(ids[at] == self.left[rank]) & (ids[after[at]] == self.right[rank])]
            if self.left[rank] == self.right[rank] and len(at) > 1:
                # pairs that share a part: every second one of a row, from the left
                starts = np.concatenate(([True], after[at[:-1]] != at[1:]))
                first = np.maximum.accumulate(np.where(starts, np.arange(len(at)), 0))
                at = at[(np.arange(len(at)) - first) % 2 == 0]
            gone = after[at]
            ids[at], alive[gone], after[at] = self.merged[rank], False, after[gone]
            follow = after[at] < n
            before[after[at[follow]]] = at[follow]
            wait(np.unique(np.concatenate((before[at][before[at] >= 0], at[follow]))))
        return ids[alive].tolist(), [*np.flatnonzero(alive).tolist(), n]

    # -- texts -------------------------------------------------------------------------

    def _word_ids(self, word: str) -> bytes:
        found = self._memo.get(word)
        if found is None:
            found = np.array(self.parts(word.encode("utf-8", "surrogatepass"))[0], dtype="<u4").tobytes()
            if len(word) <= KEPT:
                if self._memo_bytes > MEMO_BYTES:
                    self._memo.clear()
                    self._memo_bytes = 0
                self._memo[word] = found
                self._memo_bytes += ENTRY + 4 * len(word) + len(found)
        return found

    def words(self, text: str) -> list[str]:
        """The words of a text without added tokens; joined they are the text."""
        if text.isascii() or not self._unknown.search(text):
            return self._words.findall(text)
        # characters that the library takes for neither letters nor numbers are split as signs
        shape = self._unknown.sub("\U0010fffd", text)
        return [text[m.start():m.end()] for m in self._words.finditer(shape)]

    def encode(self, text: str | None) -> bytes:
        """The token ids of a text as little-endian unsigned 32-bit integers."""
        memo, word_ids, out = self._memo.get, self._word_ids, []
        for k, piece in enumerate(self._cut_added.split(text or "") if self._cut_added else [text or ""]):
            if k % 2:
                out.append(self.added[piece].to_bytes(4, "little"))
                continue
            for part in _slices(piece):
                out.append(b"".join([memo(w) or word_ids(w) for w in self.words(part)]))
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        texts = self.texts
        return b"".join([texts.get(i, b"") for i in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")


def _token_bytes(token: str, byte_of: dict[str, int]) -> bytes:
    """A token's bytes; one with a character that stands for no byte is plain text."""
    try:
        return bytes(map(byte_of.__getitem__, token))
    except KeyError:
        return token.encode("utf-8")


def _slices(text: str) -> list[str]:
    """``text`` cut before blanks that follow another character, at least ``SLICE`` characters apart."""
    out, at = [], 0
    while len(text) - at > SLICE:
        border = _BORDER.search(text, at + SLICE)
        if border is None:
            break
        out.append(text[at:border.start() + 1])
        at = border.start() + 1
    out.append(text[at:] if at else text)
    return out


_BORDER = re.compile(r"[^\s\x1c-\x1f](?= )")


@lru_cache(maxsize=1)
def _word_pattern():
    import regex

    return regex.compile(PATTERN)


def _unknown_characters(splitter: dict) -> re.Pattern:
    """Letters and numbers of a newer Unicode version than the library's, which it takes for signs.

    Only those that Python's own tables do not assign yet can be such; the library's splitter is asked for each."""
    import regex
    from tokenizers import pre_tokenizers

    cut = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=splitter.get("use_regex", True)).pre_tokenize_str
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    new = [c for c in regex.findall(r"[\p{L}\p{N}]", every) if unicodedata.category(c) == "Cn" and len(cut("#" + c)) == 1]
    runs: list[list[int]] = []
    for c in map(ord, new):
        if runs and runs[-1][1] == c - 1:
            runs[-1][1] = c
        else:
            runs.append([c, c])
    return re.compile(f"[{''.join(f'{chr(a)}-{chr(b)}' for a, b in runs)}]" if runs else r"(?!)")


@lru_cache(maxsize=4)
def byte_pairs(path: str) -> BytePairs:
    """One vocabulary per Python worker and file."""
    return BytePairs(path)


def _map_texts(df: DataFrame, schema: str, work) -> DataFrame:
    """Rows (id, value) through ``work`` (a list of values to the other columns), the id column as it is."""
    arrow = arrow_schema(df.sparkSession, schema)

    def run(batches):
        for batch in batches:
            columns = work(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, f.type) if isinstance(c, list) else c
                                                                 for c, f in zip(columns, list(arrow)[1:], strict=True))], schema=arrow)

    return df.mapInArrow(run, schema)


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_tokens, token_ids (binary: little-endian unsigned 32-bit integers)."""
    def work(texts):
        ids = pa.array(list(map(byte_pairs(path).encode, texts)), pa.binary())
        return pc.divide(pc.binary_length(ids).cast(pa.int64()), 4), ids

    kind = docs.schema[id_col].dataType.simpleString()
    return _map_texts(pick(docs, doc_id=id_col, text=text_col), f"doc_id {kind}, n_tokens long, token_ids binary", work)


def decode_documents(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "token_ids") -> DataFrame:
    """Per row of ``encode_documents``: doc_id, n_tokens, token_ids, text."""
    def work(ids):
        return ([len(x or b"") // 4 for x in ids], [x or b"" for x in ids], [byte_pairs(path).decode(x or b"") for x in ids])

    kind = encoded.schema[id_col].dataType.simpleString()
    return _map_texts(pick(encoded, doc_id=id_col, token_ids=ids_col), f"doc_id {kind}, n_tokens long, token_ids binary, text string", work)


__all__ = ["BytePairs", "byte_pairs", "decode_documents", "encode_documents"]
