"""SimHash near-duplicates, candidates by Golay-code fuzzy keys.

A 64-bit fingerprint is cut into three segments of 22, 21 and 21 bits. Of at most two
differing bits some segment has none, and the segment after it (cyclically) has at most one:
either both others have one, or one of them has two and the equal pair can be chosen. Each
segment, padded to 23 bits, is a word of the perfect binary Golay code [23, 12, 7]. Its
nearest codeword is unique; words one bit apart share a codeword within distance 4. So one
side of the join carries the nearest codeword's index (one key), the other the indices of all
codewords within distance 4 (one or six keys), both with the equal segment as the second key.
Candidates are verified by their differing bits.

Equal fingerprints are one class, whatever their number. A bucket of more than ``HOT_BUCKET``
classes is not paired: its classes, and only they, are linked through the fingerprints one bit
away from them, since two classes are within two bits exactly if they share one of those.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from coursepulse.llm.components import components
from coursepulse.session import materialize

# The generator polynomial of the code and the segments (first bit, bits).
GENERATOR = 0b101011100011
SEGMENTS = ((0, 22), (22, 21), (43, 21))
CODE_BITS, CHECK_BITS = 23, 11
SEED = 42
RADIUS = 2
HOT_BUCKET = 2000
# Words of one long text are counted in blocks of this many shingles.
BLOCK = 255


def _syndromes() -> np.ndarray:
    """The syndrome of each single bit, by division through the generator."""
    out = []
    for bit in range(CODE_BITS):
        word = 1 << bit
        for high in range(CODE_BITS - 1, CHECK_BITS - 1, -1):
            if word >> high & 1:
                word ^= GENERATOR << (high - CHECK_BITS)
        out.append(word)
    return np.array(out, dtype=np.int64)


def _patterns() -> tuple[np.ndarray, np.ndarray]:
    """By syndrome: the error of weight up to 3, and the five of weight 4 where that is 3."""
    from itertools import combinations

    single = _syndromes()
    nearest = np.zeros(1 << CHECK_BITS, dtype=np.int64)
    fourth: list[list[int]] = [[] for _ in nearest]
    for weight in (1, 2, 3, 4):
        for bits in combinations(range(CODE_BITS), weight):
            syndrome = int(np.bitwise_xor.reduce(single[list(bits)]))
            error = sum(1 << b for b in bits)
            if weight < 4:
                nearest[syndrome] = error
            else:
                fourth[syndrome].append(error)
    padded = np.array([x + [-1] * (5 - len(x)) for x in fourth], dtype=np.int64)
    return nearest, padded


class Golay:
    """Codeword indices (12 bits) of 23-bit words, for arrays of words."""

    def __init__(self) -> None:
        self.single = _syndromes()
        self.nearest, self.fourth = _patterns()

    def _syndrome(self, words: np.ndarray) -> np.ndarray:
        out = np.zeros(len(words), dtype=np.int64)
        for bit in range(CODE_BITS):
            out ^= np.where(words >> bit & 1, self.single[bit], 0)
        return out

    def index(self, words: np.ndarray) -> np.ndarray:
        """Index of the nearest codeword."""
        return (words ^ self.nearest[self._syndrome(words)]) >> CHECK_BITS

    def indices(self, words: np.ndarray) -> np.ndarray:
        """Indices of all codewords within distance 4, one column each, -1 where there is none."""
        syndrome = self._syndrome(words)
        more = self.fourth[syndrome]
        rest = np.where(more >= 0, (words[:, None] ^ more) >> CHECK_BITS, -1)
        return np.column_stack([self.index(words), rest])


def fingerprint(text: str | None, shingle: int) -> int:
    """The fingerprint of a text's word shingles as an unsigned number; 0 without words."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        parts = [b" ".join(words)]
    else:
        parts = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(x, SEED) for x in parts), dtype=np.uint64)
    # Bit counts, eight byte-wide lanes at a time; a lane holds at most BLOCK.
    ones = np.zeros((8, 8), dtype=np.int64)
    starts = np.arange(0, len(hashes), BLOCK)
    lanes = np.uint64(0x0101010101010101)
    for bit in range(8):
        sums = np.add.reduceat(hashes >> np.uint64(bit) & lanes, starts)
        ones[:, bit] = sums.astype("<u8").view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    bits = np.packbits(ones.reshape(64) * 2 > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str, text: str, shingle: int) -> DataFrame:
    """(id, fp): the fingerprint of each document as a signed bigint."""

    def hashed(batches):
        for batch in batches:
            values = np.array(
                [fingerprint(x, shingle) for x in batch.column(1).to_pylist()], dtype=np.uint64
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(values.view(np.int64))], names=["id", "fp"]
            )

    picked = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text).alias("text"))
    return picked.mapInArrow(hashed, "id bigint, fp bigint")


def _keyed(classes: DataFrame, several: bool) -> DataFrame:
    """(fp, key): the fuzzy keys of each fingerprint; key holds table, index and equal segment."""

    def keys(batches):
        code = Golay()
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            cut = [(fp >> np.uint64(a) & np.uint64((1 << n) - 1)).astype(np.int64) for a, n in SEGMENTS]
            fps, out = [], []
            for table, equal in enumerate(cut):
                fuzzy = cut[(table + 1) % len(cut)]
                index = code.indices(fuzzy) if several else code.index(fuzzy)[:, None]
                key = np.where(
                    index < 0, -1, (table << 34) | (np.maximum(index, 0) << 22) | equal[:, None]
                )
                row, column = np.nonzero(key >= 0)
                fps.append(fp.view(np.int64)[row])
                out.append(key[row, column])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(fps)), pa.array(np.concatenate(out))], names=["fp", "key"]
            )

    return classes.select("fp").mapInArrow(keys, "fp bigint, key bigint")


def links(classes: DataFrame, hot: int = HOT_BUCKET) -> DataFrame:
    """(src, dst): links that connect all distinct fingerprints within ``RADIUS`` bits.

    Every pair within the radius is a row, but for hot buckets, where both fingerprints are
    linked to a common one between them (which may be no document's).
    """
    one = materialize(_keyed(classes, several=False), "golay-one")
    several = materialize(_keyed(classes, several=True), "golay-several")
    crowded = materialize(
        several.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > hot).select("key"),
        "golay-crowded",
    )
    differ = F.bit_count(F.col("src").bitwiseXOR(F.col("dst")))
    cold = one.join(crowded, "key", "left_anti").select("key", F.col("fp").alias("src"))
    pairs = (
        cold.join(several.select("key", F.col("fp").alias("dst")), "key")
        .filter((F.col("src") != F.col("dst")) & (differ <= RADIUS))
        .select("src", "dst")
    )
    packed = several.join(crowded, "key").select("fp").distinct()
    flips = F.transform(
        F.sequence(F.lit(0), F.lit(63)),
        lambda i: F.call_function("shiftleft", F.lit(1).cast("bigint"), i),
    )
    stars = packed.select(
        F.col("fp").alias("src"),
        F.explode(F.concat(F.array(F.lit(0).cast("bigint")), flips)).alias("flip"),
    ).select("src", F.col("src").bitwiseXOR(F.col("flip")).alias("dst"))
    return pairs.union(stars)


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    shingle: int = 5,
    hot: int = HOT_BUCKET,
) -> DataFrame:
    """(id_col, fp, component_id) for each row of ``docs``.

    component_id is the smallest id reachable over links of at most ``RADIUS`` bits, the row
    itself included; null ids are never the smallest. Null and empty texts have fingerprint 0
    and are one class. Repeated rows keep their number; further columns are not carried.
    """
    rows = materialize(fingerprints(docs, id_col, text, shingle), "fingerprints")
    classes = materialize(rows.groupBy("fp").agg(F.min("id").alias("least")), "classes")
    found = components(links(classes, hot))
    named = found.select(F.col("node").alias("fp"), "component")
    grouped = classes.join(named, "fp", "left").withColumn(
        "component", F.coalesce("component", "fp")
    )
    least = grouped.groupBy("component").agg(F.min("least").alias("component_id"))
    by_class = materialize(grouped.join(least, "component").select("fp", "component_id"), "by-class")
    return rows.join(by_class, "fp").select(F.col("id").alias(id_col), "fp", "component_id")


def hex_digits(fp):
    """16 lowercase hex digits of the signed bigint."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
