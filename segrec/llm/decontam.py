"""Benchmark decontamination by spaced-seed hashing.

Words are lower-cased runs without ASCII punctuation or white space. A fixed mask takes some
words of a window and ignores the others, so a seed still matches when ignored words were
substituted; five masks of weight five and spans of 5 to 9 find 97 % of 15-word passages with
every fifth word substituted at random, and all with fewer. Items of up to six words have masks of
their own (``SHORT_MASKS``), which find every copy that the rule asks for: one word of five or six
may differ, none of four or less. They are taken over the documents only if the benchmark has such items.
Items below ``least_words`` words (5, down to 1) are too short to identify a leak and have no seeds.

1. The seeds of all benchmark items set bits in one bitmap of a fixed size (2^25 bits, built by
   an aggregate, 4 MB), which is broadcast. Documents without a seed in the bitmap end here; a
   large benchmark only lets more documents pass.
2. The seeds of the others join the item seeds; every hit names an item and a diagonal (the
   shift between the two texts). Each diagonal is verified once on the words themselves: the
   longest aligned span of at least ``span`` words (or the item's length, if shorter) with at
   least ``agree`` of its words equal. The span is judged as it is; for the report unequal words are
   cut from its ends as long as the required length remains.

A benchmark passage in a third of all documents is a hot seed only of the small item side; the
document side of the joins can be split. No text is shuffled but that of candidates.

Defined results: null or empty texts and items match nothing; null ids are carried; repeated
rows give repeated overlaps; an empty benchmark or corpus gives no overlap; other columns come
back in the struct ``row`` and cannot clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from segrec.llm.common import map_rows, materialise, pick
from segrec.llm.hashing import mix, word_hashes

# The masks; 1 takes a word, 0 ignores it.
MASKS = ("11111", "110111", "1011011", "11001011", "110100101")
# Words that items of so many words have seeds of: with any one of five or six words substituted a mask
# misses it, of fewer all must be equal.
SHORT_MASKS = {1: ("1",), 2: ("11",), 3: ("111",), 4: ("1111",), 5: ("111", "11011"), 6: ("111",)}
_SALTED = tuple(dict.fromkeys([*MASKS, *(m for masks in SHORT_MASKS.values() for m in masks)]))
BITMAP_BITS = 25
# Fixed rule: ASCII punctuation and control characters separate words.
_BLANKS = bytes(range(128)).translate(None, b"0123456789abcdefghijklmnopqrstuvwxyz")
_SEPARATE = bytes.maketrans(_BLANKS, b" " * len(_BLANKS))


def normal_words(text: str | None) -> list[bytes]:
    return text.lower().encode("utf-8", "surrogatepass").translate(_SEPARATE).split() if text else []


class Seeds:
    """Seed hashes of all windows of a word sequence, for every mask."""

    def __init__(self, masks: tuple[str, ...] = MASKS):
        self.masks = [np.flatnonzero(np.array([*m]) == "1") for m in masks]
        self.spans = [len(m) for m in masks]
        longest = max(map(len, _SALTED))
        self.factors = mix(np.arange(1, longest + 1, dtype=np.uint64)) | np.uint64(1)
        self.salts = mix(np.array([101 + _SALTED.index(m) for m in masks], dtype=np.uint64))

    def __call__(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(seed, word position) of every window."""
        seeds, places = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for taken, span, salt in zip(self.masks, self.spans, self.salts, strict=True):
            n = len(hashes) - span + 1
            if n > 0:
                total = np.full(n, salt, dtype=np.uint64)
                for offset, factor in zip(taken, self.factors, strict=False):
                    total += hashes[offset:offset + n] * factor
                seeds.append(mix(total))
                places.append(np.arange(n))
        return np.concatenate(seeds), np.concatenate(places)


def bitmap_positions(seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    low = np.uint64((1 << BITMAP_BITS) - 1)
    return (seeds & low).astype(np.int64), ((seeds >> np.uint64(BITMAP_BITS)) & low).astype(np.int64)


def _item_seeds(items: DataFrame, least_words: int) -> DataFrame:
    """item_id, words (hashes), seeds and their places, of every item long enough."""
    def work(batches):
        long, short = Seeds(), {n: Seeds(masks) for n, masks in SHORT_MASKS.items()}
        for b in batches:
            out = {"item_id": [], "words": [], "seeds": [], "places": []}
            for item_id, text in zip(b["item_id"], b["text"], strict=True):
                hashes = word_hashes(normal_words(text))
                if len(hashes) >= least_words:
                    seeds, places = short.get(len(hashes), long)(hashes)
                    for k, v in zip(out, (item_id, hashes.view(np.int64).tolist(), seeds.view(np.int64).tolist(),
                                          places.tolist()), strict=True):
                        out[k].append(v)
            yield out

    return map_rows(items, "item_id long, words array<long>, seeds array<long>, places array<int>", work)


def _bitmap(seeds: DataFrame) -> np.ndarray:
    """Bits set by all seeds; 4 MB whatever the size of the benchmark."""
    low = (1 << BITMAP_BITS) - 1
    # a bitmap bucket holds 32,768 places, the first of which is number 1
    place = F.explode(F.array(F.col("seed").bitwiseAND(low) + 1,
                              F.shiftrightunsigned("seed", BITMAP_BITS).bitwiseAND(low) + 1))
    rows = (seeds.select(place.alias("p")).groupBy(F.bitmap_bucket_number("p").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits")).collect())
    out = np.zeros((1 << BITMAP_BITS) // 8, dtype=np.uint8)
    for r in rows:
        part = np.frombuffer(bytes(r["bits"]), np.uint8)
        out[(r["bucket"] - 1) * 4096:(r["bucket"] - 1) * 4096 + len(part)] = part
    return out


def longest_span(equal: np.ndarray, agree: float) -> tuple[int, int]:
    """The longest [low, high) that has at least ``agree`` of its places equal."""
    score = np.concatenate(([0.0], np.cumsum(equal - agree)))
    score = np.round(score, 9)
    lowest = np.minimum.accumulate(score)
    # for every end: the first place whose running score is no higher
    first = np.searchsorted(-lowest, -score, side="left")
    length = np.arange(len(score)) - first
    high = int(np.argmax(length))
    return int(first[high]), high


def trimmed(equal: np.ndarray, low: int, high: int, least: int) -> tuple[int, int]:
    """[low, high) without unequal places at its ends, but of ``least`` places at least."""
    while high - low > least and not equal[low]:
        low += 1
    while high - low > least and not equal[high - 1]:
        high -= 1
    return low, high


def find_overlaps(docs: DataFrame, benchmark: DataFrame, span: int = 13, agree: float = 0.8, least_words: int = 5,
                  text_col: str = "text") -> DataFrame:
    """One row per document, item and diagonal with an overlap: ``row`` (the document's other
    columns), item_id, doc_word, item_word, n_words, n_equal."""
    if least_words < 1:
        raise ValueError("least_words must be >= 1")
    spark = docs.sparkSession
    items = pick(benchmark, item_id="item_id", text="text").withColumn("item_id", F.col("item_id").cast("long"))
    items = materialise(_item_seeds(items, least_words).withColumn("item", F.monotonically_increasing_id()), "leak-items")
    item_seeds = items.select("item", F.explode(F.arrays_zip("seeds", "places")).alias("s")).select(
        "item", F.col("s.seeds").alias("seed"), F.col("s.places").alias("item_place"))
    bitmap = spark.sparkContext.broadcast(_bitmap(item_seeds))
    # the numbers of words that short items have: six at most
    lengths = [r["n"] for r in items.select(F.size("words").alias("n")).where(F.col("n") <= max(SHORT_MASKS)).distinct().collect()]
    masks = tuple(dict.fromkeys([*MASKS, *(m for n in sorted(lengths) for m in SHORT_MASKS[n])]))

    others = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    carried = F.struct(*others) if others else F.struct(F.lit(None).cast("int").alias("none"))
    rows = docs.select(F.col(f"`{text_col}`").alias("text"), carried.alias("row")).where(F.length("text") > 0)
    schema = StructType([rows.schema["row"], StructField("words", ArrayType(LongType())),
                         StructField("seeds", ArrayType(LongType())), StructField("places", ArrayType(IntegerType()))])

    def candidates(batches):
        find, bits = Seeds(masks), bitmap.value
        for batch in batches:
            at, words, seeds, places = [], [], [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                hashes = word_hashes(normal_words(text))
                found, place = find(hashes)
                a, b = bitmap_positions(found)
                hit = np.flatnonzero((bits[a >> 3] >> (a & 7)) & (bits[b >> 3] >> (b & 7)) & 1)
                if len(hit):
                    at.append(i)
                    words.append(hashes.view(np.int64))
                    seeds.append(found[hit].view(np.int64))
                    places.append(place[hit].astype(np.int32))
            if at:
                columns = [pa.array(x, pa.list_(t)) for x, t in ((words, pa.int64()), (seeds, pa.int64()), (places, pa.int32()))]
                yield pa.RecordBatch.from_arrays([batch.column("row").take(pa.array(at)), *columns],
                                                 names=["row", "words", "seeds", "places"])

    found = rows.mapInArrow(candidates, schema).withColumn("doc", F.monotonically_increasing_id())
    found = materialise(found, "leak-candidates")
    doc_seeds = found.select("doc", F.explode(F.arrays_zip("seeds", "places")).alias("s")).select(
        "doc", F.col("s.seeds").alias("seed"), F.col("s.places").alias("doc_place"))
    hits = (doc_seeds.join(item_seeds, "seed")
            .select("doc", "item", (F.col("doc_place") - F.col("item_place")).alias("shift")).distinct())
    pairs = (hits.join(items.select("item", "item_id", F.col("words").alias("item_words")), "item")
             .join(found.select("doc", F.col("words").alias("doc_words")), "doc")
             # only the aligned part of a document goes on
             .withColumn("doc_words", F.slice("doc_words", F.greatest("shift", F.lit(0)) + 1, F.size("item_words"))))

    def verify(batches):
        for b in batches:
            out = {"doc": [], "item_id": [], "doc_word": [], "item_word": [], "n_words": [], "n_equal": []}
            for doc, item_id, shift, ours, theirs in zip(*(b[k] for k in ("doc", "item_id", "shift", "item_words", "doc_words")),
                                                         strict=True):
                low = max(0, -shift)
                high = min(len(ours), low + len(theirs))
                equal = np.array(ours[low:high]) == np.array(theirs[:high - low])
                a, z = longest_span(equal, agree)
                least = min(span, len(ours))
                if z - a >= least:
                    a, z = trimmed(equal, a, z, least)
                    for k, v in zip(out, (doc, item_id, low + a + shift, low + a, z - a, int(equal[a:z].sum())), strict=True):
                        out[k].append(v)
            yield out

    overlaps = map_rows(pairs.select("doc", "item_id", "shift", "item_words", "doc_words"),
                        "doc long, item_id long, doc_word long, item_word long, n_words long, n_equal long", verify)
    return found.select("doc", "row").join(overlaps, "doc").drop("doc")


__all__ = ["MASKS", "SHORT_MASKS", "Seeds", "find_overlaps", "longest_span", "normal_words"]
