"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks.

Texts are words between ASCII blanks, A-Z lowered. For an item of n words every window of n
words of a document has a 64-bit fingerprint over its ``SHINGLE``-word shingles. Fingerprints
are cut into ``BLOCKS`` blocks of 8 bits; of at most ``RADIUS`` differing bits some block has at
most RADIUS // BLOCKS, so an index of all block values that near to an item's finds every window
within the radius. The radius follows from the similarity: at 0.8 about 15% of the bits differ,
and more than 23 of 64 in about one window of 100,000. Candidates are verified by the exact
weighted similarity of their shingle counts (sum of minima to sum of maxima, at least
``SIMILARITY``).

Of two windows of n shingles, similarity s needs 2ns / (1 + s) shared ones; windows with fewer
shingles of items of their size cannot pass and are not fingerprinted. Items go to the tasks in
slices of at most ``SLICE``, which bounds the index (about 300 entries an item); more items take
further passes.

Null and empty texts and items match nothing (an item without words has no window); an item of
fewer words than a shingle is one shingle. Items of equal text are reported each, one without an id
with a null id. Repeated documents and further columns are kept, whatever their names, but for one
named ``leaks``; an empty table or benchmark leaves ``leaks`` empty. Very long texts are searched
whole, a text at a time.
"""

from __future__ import annotations

from collections import Counter
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F, types as T

from coursepulse.llm.lookup import unused

SHINGLE = 5
SIMILARITY = 0.8
RADIUS, BLOCKS = 23, 8
SLICE = 8192
SEED = 42
BITS = 64 // BLOCKS
LEAK = "array<struct<item_id:bigint,start:int,words:int,similarity:double>>"


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def shingles(words: list[bytes], size: int = SHINGLE) -> list[bytes]:
    """Space-joined shingles; the whole sequence if it is shorter."""
    if len(words) <= size:
        return [b" ".join(words)] if words else []
    return [b" ".join(words[i : i + size]) for i in range(len(words) - size + 1)]


def hash_bits(parts: list[bytes]) -> np.ndarray:
    """One row of 64 bits (0 or 1) for each shingle."""
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(x, SEED) for x in parts), dtype="<u8", count=len(parts))
    return np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def pack(ones: np.ndarray, total: int) -> np.ndarray:
    """Fingerprints: a bit is 1 if set in more than half of ``total`` hashes."""
    return np.packbits(ones * 2 > total, axis=1, bitorder="little").view("<u8")[:, 0]


def similarity(a: Counter, b: Counter) -> float:
    """Weighted: sum of minima to sum of maxima."""
    least = sum((a & b).values())
    return least / (sum(a.values()) + sum(b.values()) - least)


def among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are in ``known``, which is sorted and not empty."""
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def near_values(most: int) -> np.ndarray:
    """Changes of a block: all with at most ``most`` bits."""
    return np.array(
        [sum(1 << b for b in c) for k in range(most + 1) for c in combinations(range(BITS), k)],
        dtype=np.int64,
    )


class Index:
    """Items by size: their shingles, and which are near a fingerprint."""

    def __init__(self, items: list[tuple[int, str | None]]) -> None:
        self.items = [(i, words_of(x)) for i, x in items]
        self.items = [(i, w) for i, w in self.items if w]
        self.counts = [Counter(shingles(w)) for _, w in self.items]
        self.vocabulary: dict[bytes, int] = {}
        for _, words in self.items:
            for word in words:
                self.vocabulary.setdefault(word, len(self.vocabulary) + 1)
        self.by_size: dict[int, list[int]] = {}
        for k, (_, words) in enumerate(self.items):
            self.by_size.setdefault(len(words), []).append(k)
        self.codes, self.fps, self.keys, self.owners = {}, {}, {}, {}
        changes = near_values(RADIUS // BLOCKS)
        for size, members in self.by_size.items():
            self.codes[size] = np.unique(
                np.concatenate([self.code(self.numbers(self.items[k][1]), size) for k in members])
            )
            prints = []
            for k in members:
                bits = hash_bits(shingles(self.items[k][1]))
                prints.append(pack(bits.sum(axis=0, dtype=np.int64)[None, :], len(bits))[0])
            self.fps[size] = np.array(prints, dtype="<u8")
            keys, owners = [], []
            for block in range(BLOCKS):
                values = self.block(self.fps[size], block)
                keys.append(((values[:, None] ^ changes) | block << BITS).ravel())
                owners.append(np.repeat(np.arange(len(members)), len(changes)))
            keys, owners = np.concatenate(keys), np.concatenate(owners)
            order = np.argsort(keys, kind="stable")
            self.keys[size], self.owners[size] = keys[order], owners[order]

        spans = {size: min(SHINGLE, size) for size in self.by_size}
        self.all_codes = {
            span: np.unique(np.concatenate([self.codes[n] for n in spans if spans[n] == span]))
            for span in set(spans.values())
        }

    @staticmethod
    def block(prints: np.ndarray, block: int) -> np.ndarray:
        return (prints >> np.uint64(block * BITS) & np.uint64((1 << BITS) - 1)).astype(np.int64)

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """Word numbers, 0 for words of no item."""
        found = map(self.vocabulary.get, words, repeat(0))
        return np.fromiter(found, dtype=np.uint64, count=len(words))

    @staticmethod
    def code(numbers: np.ndarray, size: int) -> np.ndarray:
        """A number for each shingle of words of the items, 0 where a word is of none."""
        span = min(SHINGLE, size)
        n = len(numbers) - span + 1
        if n <= 0:
            return np.empty(0, np.uint64)
        out, known = np.zeros(n, np.uint64), np.ones(n, bool)
        for k in range(span):
            part = numbers[k : k + n]
            out = out * np.uint64(0x9E3779B97F4A7C15) + part
            known &= part > 0
        return np.where(known, out | np.uint64(1 << 63), np.uint64(0))

    def candidates(self, prints: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(window, member) pairs within the radius."""
        windows, members = [], []
        keys, owners = self.keys[size], self.owners[size]
        for block in range(BLOCKS):
            wanted = self.block(prints, block) | block << BITS
            first = np.searchsorted(keys, wanted, "left")
            count = np.searchsorted(keys, wanted, "right") - first
            windows.append(np.repeat(np.arange(len(prints)), count))
            offset = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            members.append(owners[np.repeat(first, count) + offset])
        w, m = np.concatenate(windows), np.concatenate(members)
        near = np.bitwise_count(prints[w] ^ self.fps[size][m]) <= RADIUS
        pairs = np.unique(np.stack([w[near], m[near]]), axis=1)
        return pairs[0], pairs[1]

    def leaks(self, text: str | None) -> list[dict]:
        """The best windows that match an item, none overlapping another of the same item."""
        words = words_of(text)
        if not words:
            return []
        numbers = self.numbers(words)
        if not numbers.any():
            return []
        # Places of shingles that any item has, by the shingles' length; most texts have none.
        by_span: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for span, every in self.all_codes.items():
            codes = self.code(numbers, span)
            places = np.flatnonzero(codes)
            places = places[among(codes[places], every)]
            by_span[span] = (places, codes[places])
        if not any(len(places) for places, _ in by_span.values()):
            return []
        found: dict[int, list[tuple[int, int, float]]] = {}
        for size, members in self.by_size.items():
            if len(words) < size:
                continue
            span = min(SHINGLE, size)
            places, codes = by_span[span]
            if not len(places):
                continue
            hits = places[among(codes, self.codes[size])]
            # Starts of windows of this size that hold enough hits.
            held = size - span + 1
            least = int(np.ceil(2 * held * SIMILARITY / (1 + SIMILARITY) - 1e-9))
            if len(hits) < least:
                continue
            last = len(words) - size
            first = hits[: len(hits) - least + 1]
            reach = hits[least - 1 :]
            starts = [
                np.arange(max(b - held + 1, 0), min(a, last) + 1)
                for a, b in zip(first.tolist(), reach.tolist(), strict=True)
                if b - a < held
            ]
            starts = np.unique(np.concatenate(starts or [np.empty(0, np.int64)]))
            for run in np.split(starts, np.flatnonzero(np.diff(starts) > held) + 1):
                if not len(run):
                    continue
                low = run[0]
                bits = hash_bits(shingles(words[low : run[-1] + size], span))
                sums = np.zeros((len(bits) + 1, 64), np.int32)
                np.cumsum(bits, axis=0, out=sums[1:])
                at = run - low
                prints = pack(sums[at + held] - sums[at], held)
                for w, m in zip(*self.candidates(prints, size), strict=True):
                    start = int(run[w])
                    value = similarity(
                        Counter(shingles(words[start : start + size])), self.counts[members[m]]
                    )
                    if value >= SIMILARITY:
                        found.setdefault(members[m], []).append((start, size, value))
        out = []
        for k, hits in found.items():
            taken: list[int] = []
            for start, size, value in sorted(hits, key=lambda h: (-h[2], h[0])):
                if all(abs(start - other) >= size for other in taken):
                    taken.append(start)
                    out.append(
                        {"item_id": self.items[k][0], "start": start, "words": size, "similarity": value}
                    )
        return sorted(out, key=lambda x: (x["start"], x["item_id"] is None, x["item_id"] or 0))


def _pass(docs: DataFrame, text: str, index: Index, column: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(index))
    names = docs.columns
    at = names.index(text)
    kind = T.StructType.fromDDL(f"x {LEAK}")["x"].dataType
    arrow = pa.list_(
        pa.struct(
            [("item_id", pa.int64()), ("start", pa.int32()), ("words", pa.int32()), ("similarity", pa.float64())]
        )
    )

    def marked(batches):
        held = cloudpickle.loads(shared.value)
        for batch in batches:
            found = [held.leaks(x) for x in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, arrow)],
                names=[*(f"c{i}" for i in range(len(names))), "leaks"],
            )

    inner = T.StructType(
        [T.StructField(f"c{i}", f.dataType) for i, f in enumerate(docs.schema.fields)]
        + [T.StructField("leaks", kind)]
    )
    plain = docs.toDF(*(f"c{i}" for i in range(len(names))))
    return plain.mapInArrow(marked, inner).toDF(*names, column)


def mark(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    items_at_once: int = SLICE,
) -> DataFrame:
    """``docs`` with the array ``leaks``: item, first word, words and similarity of each match.

    The driver reads the items slice by slice, in hash order.
    """
    items = benchmark.select(F.col(item_id).cast("bigint").alias("id"), F.col(item_text).alias("text"))
    items = items.filter(F.trim("text") != "")
    slices = -(-items.count() // items_at_once)
    out = docs.withColumn("leaks", F.array().cast(LEAK))
    more = unused("_more", out.columns)
    for k in range(slices):
        part = items.filter(F.pmod(F.xxhash64("id", "text"), F.lit(slices)) == k).collect()
        if part:
            known = [(r["id"], r["text"]) for r in part]
            index = Index(sorted(known, key=lambda x: (x[0] is None, x[0] or 0, x[1])))
            out = _pass(out, text, index, more).withColumn("leaks", F.concat("leaks", more)).drop(more)
    return out
