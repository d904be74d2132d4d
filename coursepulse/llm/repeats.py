"""Removal of byte strings that repeat from earlier documents, by suffix sorting.

Every byte covered by a ``LENGTH``-byte string that also starts in a document with a smaller id
goes. A suffix array of a whole corpus cannot be built in one place, so candidates are found
first: of the ``GRAM``-byte strings in a window of LENGTH bytes the one with the least hash is the
window's anchor. Equal windows have equal anchors, and neighbouring windows mostly share one.

1. Documents are packed into chunks of about ``CHUNK_BYTES``, stored once, a row each.
2. Each chunk sends its distinct anchors; those in two documents are shared.
3. For each shared anchor a chunk sends the distinct pieces of text that hold its windows, with
   the smallest id that has them. Within a bucket of anchors, pieces are suffix-sorted in two
   stages: suffixes smaller than their successor are sorted directly, the others are induced by a
   scan over the buckets of first bytes. Adjacent suffixes with a common prefix of LENGTH bytes
   are equal windows; each piece learns which of its windows start in an earlier document.
4. Chunks mark the windows of their documents, and cut.

What is sent depends on distinct anchors and pieces of a chunk, so a passage that a third of
all documents share costs a few rows a chunk. An anchor in more than ``HOT_CHUNKS`` chunks is
split: its windows are sent one by one, spread by their own hash.

Null texts count as empty, texts shorter than LENGTH keep all. Null ids count as larger than any
other; rows of equal id are not before each other. Empty tables give empty results; further
columns are not carried.
"""

from __future__ import annotations

import math
from collections import defaultdict
from itertools import count
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F

from coursepulse.session import materialize

LENGTH, GRAM = 50, 20
CHUNK_BYTES = 2 << 20
HOT_CHUNKS = 4096
BUCKET_ANCHORS = 1 << 20  # anchors that one task compares
BUCKET_PIECES = 1 << 14  # pieces that one task sorts
PART_BUCKETS = 4  # buckets of pieces that are sent together, and sorted one after the other
NO_ID = (1 << 63) - 1
BASE = 0x9E3779B97F4A7C15
PLACE_BITS = 32
PACK_ROWS = 256  # rows read at a time
PACK_LEVEL, PIECE_LEVEL = 6, 3  # of zstd: chunks are stored once and sent twice, pieces sent once
BLOCK = 1 << 16  # windows hashed at a time, so that they stay in the processor's cache
MASK_BITS = 32  # a piece has at most LENGTH - GRAM + 1 windows


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A mixed 64-bit hash of each GRAM-byte string."""
    n = len(data) - GRAM + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    words = np.ndarray(len(data) - 7, "<u8", np.ascontiguousarray(data), 0, (1,))
    out = np.zeros(n, np.uint64)
    for k in (*range(0, GRAM - 8, 8), GRAM - 8):  # eight bytes at a time
        out ^= words[k : k + n]
        out *= np.uint64(BASE)
        out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(32)
    return out


def anchors(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(place, hash, first window, last window) of each anchor, in order of place.

    ``ends`` are the documents' ends; windows that cross one are left out. Windows of one anchor
    are neighbours; where a document's end or another anchor comes between, it is listed twice.
    """
    none = np.empty(0, np.int64)
    windows = len(data) - LENGTH + 1
    if windows <= 0:
        return none, np.empty(0, np.uint64), none, none
    starts = np.append(0, ends[:-1])
    opening = np.unique(starts[starts < windows])  # the first windows of documents
    width = LENGTH - GRAM + 1
    low = np.uint64((1 << PLACE_BITS) - 1)
    found = []
    for at in range(0, windows, BLOCK):
        n = min(BLOCK, windows - at)
        hashes = gram_hashes(data[at : at + n + LENGTH - 1])
        least = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
        # Least of LENGTH - GRAM + 1 neighbours: by doubling, then two overlapping halves.
        size = 1
        while size * 2 <= width:
            least = np.minimum(least[: len(least) - size], least[size:])
            size *= 2
        rest = width - size
        least = np.minimum(least[: len(least) - rest], least[rest:]) if rest else least
        new = np.ones(n, bool)
        new[1:] = least[1:] != least[:-1]
        new[opening[slice(*np.searchsorted(opening, (at, at + n)))] - at] = True
        first = np.flatnonzero(new)
        place = (least[first] & low).astype(np.int64)
        found.append((first + at, place + at, hashes[place]))
    first, place, hashes = (np.concatenate(x) for x in zip(*found, strict=True))
    doc = np.searchsorted(ends, first, side="right")
    new = first == starts[doc]
    new[1:] |= place[1:] != place[:-1]  # the same anchor on both sides of a block's edge
    first, place, hashes, doc = first[new], place[new], hashes[new], doc[new]
    final = ends[doc] - LENGTH
    last = np.minimum(np.append(first[1:], windows) - 1, final)
    inside = first <= final
    return place[inside], hashes[inside], first[inside], last[inside]


def strings(text: bytes, length: int) -> np.ndarray:
    """The string of ``length`` bytes from each place, filled up with zeros at the end."""
    return np.ndarray(len(text), f"S{length}", text + bytes(length), 0, (1,))


def suffix_order(text: bytes, depth: int = LENGTH) -> np.ndarray:
    """Places of all suffixes, in order of their first ``depth`` bytes, by two-stage sorting."""
    n = len(text)
    if not n:
        return np.empty(0, np.int64)
    # rising[i]: suffix i is smaller than suffix i + 1.
    data = np.frombuffer(text, np.uint8)
    step = np.sign(np.diff(data.astype(np.int16)))
    known = np.append(np.where(step != 0, np.arange(n - 1), n), n - 1)
    decides = np.minimum.accumulate(known[::-1])[::-1]
    rising = np.append(step > 0, False)[decides]
    # First stage: rising suffixes are sorted directly; of those that only the fill makes equal
    # the later is the shorter and comes first.
    direct = np.flatnonzero(rising)[::-1]
    direct = direct[np.argsort(strings(text, depth)[direct], kind="stable")]
    tops = np.searchsorted(data[direct], np.arange(257))
    # Second stage: a scan over the buckets of first bytes. What stands before a placed suffix,
    # if falling, comes next in the bucket of its own first byte: in a later one it waits for the
    # scan, in the same one it joins the end of the falling ones.
    waiting: dict[int, list[np.ndarray]] = {data[n - 1]: [np.array([n - 1])]}
    out = []
    for byte in np.flatnonzero(np.bincount(data, minlength=256)).tolist():
        bucket = []
        batch = np.concatenate(waiting.pop(byte, [np.empty(0, np.int64)]))
        while len(batch):
            bucket.append(batch)
            before = batch[batch > 0] - 1
            batch = before[(data[before] == byte) & ~rising[before]]
        bucket.append(direct[tops[byte] : tops[byte + 1]])
        placed = np.concatenate(bucket)
        out.append(placed)
        before = placed[placed > 0] - 1
        before = before[(data[before] > byte) & ~rising[before]]
        firsts = data[before]
        before = before[np.argsort(firsts, kind="stable")]
        sizes = np.bincount(firsts, minlength=256)
        ends = np.cumsum(sizes)
        for later in np.flatnonzero(sizes).tolist():
            waiting.setdefault(later, []).append(before[ends[later] - sizes[later] : ends[later]])
    return np.concatenate(out)


def suffix_array(text: bytes, depth: int = LENGTH) -> list[int]:
    """``suffix_order`` as a list.

    >>> suffix_array(b"banana")
    [5, 3, 1, 0, 4, 2]
    """
    return suffix_order(text, depth).tolist()


def earliest(pieces: list[bytes], ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each piece starts in all of them end to end, and for each place there the smallest id
    of a piece that holds the window from it (NO_ID: none starts there)."""
    text = b"".join(pieces)
    lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
    starts = np.cumsum(lengths) - lengths
    owner = np.repeat(np.arange(len(pieces)), lengths)
    whole = (starts + lengths)[owner] - np.arange(len(text)) >= LENGTH
    order = suffix_order(text)
    order = order[whole[order]]
    # Common prefixes of adjacent suffixes, as far as they matter: LENGTH bytes or less.
    sorted_windows = strings(text, LENGTH)[order]
    other = sorted_windows[1:] != sorted_windows[:-1]
    group = np.cumsum(np.append(False, other))
    least = np.full(group[-1] + 1, NO_ID, np.int64)
    np.minimum.at(least, group, ids[owner[order]])
    found = np.full(len(text), NO_ID, np.int64)
    found[order] = least[group]
    return starts, found


class Chunk:
    """Some documents' texts end to end, and their anchors."""

    def __init__(self, packed: dict) -> None:
        self.ids = np.frombuffer(packed["ids"], "<i8")
        self.lengths = np.frombuffer(packed["lengths"], "<i8")
        size = int(self.lengths.sum())
        raw = pa.decompress(packed["data"], size, codec="zstd", asbytes=True) if size else b""
        self.raw, self.data = raw, np.frombuffer(raw, np.uint8)
        self.ends = np.cumsum(self.lengths)
        self.place, self.hash, self.first, self.last = anchors(self.data, self.ends)
        self.doc = np.searchsorted(self.ends, self.place, side="right")

    def shared(self, told: pa.Table, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the anchors that are marked in ``told``, and whether each is hot."""
        key, at = np.unique(short(self.hash, bits), return_inverse=True)
        flags = np.zeros((2, len(key)), bool)
        rows = told.filter(pc.is_valid(told.column("marks"))).select(["bucket", "marks", "hot"]).to_pylist()
        buckets = np.array([r["bucket"] for r in rows], np.uint64)
        first = np.searchsorted(key, buckets << np.uint64(32)).tolist()
        end = np.searchsorted(key, (buckets << np.uint64(32)) | np.uint64(0xFFFFFFFF), "right").tolist()
        for r, s, e in zip(rows, first, end, strict=True):
            for flag, name in zip(flags, ("marks", "hot"), strict=True):
                if r[name]:
                    flag[s:e] = np.unpackbits(np.frombuffer(r[name], np.uint8), count=e - s)
        chosen = np.flatnonzero(flags[0][at])
        return chosen, flags[1][at[chosen]]

    def pieces(self, chosen: np.ndarray, single: np.ndarray) -> "Pieces":
        """Of the anchors ``chosen``; those that are ``single`` have a part for each window."""
        first, last = self.first[chosen], self.last[chosen]
        if single.any():
            n = np.where(single, last - first + 1, 1)
            chosen, single, first, last = (np.repeat(x, n) for x in (chosen, single, first, last))
            first = first + np.arange(len(first)) - np.repeat(np.cumsum(n) - n, n)
            last = np.where(single, first, last)
        raw, known = self.raw, defaultdict(count().__next__)
        number = np.array(
            [known[raw[s:e]] for s, e in zip(first.tolist(), (last + LENGTH).tolist(), strict=True)],
            np.int64,
        )
        texts = list(known)
        own = self.ids[self.doc[chosen]]
        least = np.full(len(texts), NO_ID, np.int64)
        np.minimum.at(least, number, own)
        # A piece goes by its anchor; a window of a hot anchor by its own hash.
        where = np.empty(len(texts), np.uint64)
        where[number] = self.hash[chosen]
        for k in np.unique(number[single]).tolist():
            where[k] = xxhash.xxh64_intdigest(texts[k])
        return Pieces(texts, least, where, number, first, last, own)


class Pieces(NamedTuple):
    """Distinct pieces of a chunk, with their smallest ids and where they go, and the parts of
    anchors: each one's piece, first and last window, and document's id."""

    texts: list[bytes]
    least: np.ndarray
    where: np.ndarray
    number: np.ndarray
    first: np.ndarray
    last: np.ndarray
    own: np.ndarray

    def dealt(self, parts: int) -> dict[int, np.ndarray]:
        """The numbers of the pieces that go to each of ``parts``."""
        to = (self.where % np.uint64(parts)).astype(np.int64)
        order = np.argsort(to, kind="stable")
        names, first = np.unique(to[order], return_index=True)
        return dict(zip(names.tolist(), np.split(order, first[1:]), strict=True)) if len(names) else {}


def short(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The bucket (first ``bits`` bits) and 32 bits more; more equal than hashes, never less.

    Anchors have small hashes, so these are mixed again: else the first bucket gets most.
    """
    return (hashes * np.uint64(BASE)) >> np.uint64(64 - 32 - bits)


def pack(docs: DataFrame, id_col: str, text: str, chunk_bytes: int) -> DataFrame:
    """One row for each chunk of documents; a chunk is at least one document."""

    def packed(batches):
        def row(ids, texts):
            body = b"".join(texts)
            return (
                np.array(ids, "<i8").tobytes(),
                np.array([len(t) for t in texts], "<i8").tobytes(),
                pa.Codec("zstd", compression_level=PACK_LEVEL).compress(body, asbytes=True) if body else b"",
            )

        def send(rows):
            columns = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.binary()) for c in columns], names=["ids", "lengths", "data"]
            )

        ids, texts, size = [], [], 0
        # A few rows at a time: a batch of long texts is not held as objects as well.
        for rows in (b.slice(at, PACK_ROWS) for b in batches for at in range(0, b.num_rows, PACK_ROWS)):
            own_texts = rows.column(1).cast(pa.binary()).to_pylist()
            for i, t in zip(rows.column(0).to_pylist(), own_texts, strict=True):
                ids.append(i)
                texts.append(t or b"")
                size += len(texts[-1])
                if size >= chunk_bytes:
                    yield send([row(ids, texts)])
                    ids, texts, size = [], [], 0
        if ids:
            yield send([row(ids, texts)])

    picked = docs.select(
        F.coalesce(F.col(id_col).cast("bigint"), F.lit(NO_ID)).alias("id"), F.col(text).alias("text")
    )
    rows = picked.mapInArrow(packed, "ids binary, lengths binary, data binary")
    return rows.withColumn("chunk", F.monotonically_increasing_id())


def _sent(chunk: int, kind: str, bucket: np.ndarray, columns: dict[str, np.ndarray]):
    """Rows of one chunk, one for each bucket: its values as bytes."""
    order = np.argsort(bucket, kind="stable")
    names, at = np.unique(bucket[order], return_index=True)
    out = {"chunk": [chunk] * len(names), "bucket": names.astype(np.int64)}
    for name, values in columns.items():
        parts = np.split(values[order], at[1:]) if len(names) else []
        out[name] = pa.array([p.tobytes() for p in parts], pa.binary())
    return pa.table(out)


def find_shared(packed: DataFrame, bits: int, hot_chunks: int) -> DataFrame:
    """(chunk, bucket, n, marks, hot): which n of a chunk's anchors two documents have, or many chunks.

    ``marks`` and ``hot`` have a bit for each short hash of the chunk in the bucket, in order.
    """

    def send(batches):
        for batch in batches:
            for r in batch.to_pylist():
                c = Chunk(r)
                key = short(c.hash, bits)
                # Twice within a chunk, in different documents: shared already.
                order = np.argsort(key, kind="stable")  # documents are in order
                key, doc = key[order], c.doc[order]
                new = np.append(True, key[1:] != key[:-1]) if len(key) else np.empty(0, bool)
                first = np.flatnonzero(new)
                last = np.append(first[1:], len(key)) - 1 if len(key) else first
                several = doc[first] != doc[last]
                key = key[first]
                table = _sent(
                    r["chunk"],
                    "anchors",
                    (key >> np.uint64(32)).astype(np.int64),
                    {"marks": key.astype("<u4"), "several": several},
                )
                yield from table.to_batches()

    def compare(table):
        bucket = table.column("bucket")[0].as_py()
        chunks = table.column("chunk").to_numpy()
        marks = [np.frombuffer(x, "<u4") for x in table.column("marks").to_pylist()]
        several = [np.frombuffer(x, bool) for x in table.column("several").to_pylist()]
        every = np.concatenate(marks)
        values, at, n = np.unique(every, return_inverse=True, return_counts=True)
        shared = n > 1
        shared[at[np.concatenate(several)]] = True
        hot = n > hot_chunks
        out = {"chunk": [], "bucket": [], "n": [], "marks": [], "hot": []}
        ends = np.cumsum([len(m) for m in marks])
        for chunk, own, end in zip(chunks.tolist(), marks, ends.tolist(), strict=True):
            place = at[end - len(own) : end]
            if not shared[place].any():
                continue
            out["chunk"].append(chunk)
            out["bucket"].append(bucket)
            out["n"].append(int(shared[place].sum()))
            out["marks"].append(np.packbits(shared[place]).tobytes())
            out["hot"].append(np.packbits(hot[place]).tobytes() if hot[place].any() else b"")
        return pa.table(
            {
                "chunk": pa.array(out["chunk"], pa.int64()),
                "bucket": pa.array(out["bucket"], pa.int64()),
                "n": pa.array(out["n"], pa.int64()),
                "marks": pa.array(out["marks"], pa.binary()),
                "hot": pa.array(out["hot"], pa.binary()),
            }
        )

    rows = packed.mapInArrow(send, "chunk bigint, bucket bigint, marks binary, several binary")
    return rows.groupBy("bucket").applyInArrow(
        compare, "chunk bigint, bucket bigint, n bigint, marks binary, hot binary"
    )


def find_earlier(packed: DataFrame, shared: DataFrame, bits: int, parts: int) -> DataFrame:
    """(chunk, part, masks): for each piece of a chunk in a part its windows in earlier documents."""

    def send(key, chunks, marks):
        codec, out = pa.Codec("zstd", compression_level=PIECE_LEVEL), []
        for r in chunks.to_pylist():
            c = Chunk(r)
            p = c.pieces(*c.shared(marks, bits))
            for part, members in p.dealt(parts).items():
                texts = [p.texts[i] for i in members.tolist()]
                sizes = np.fromiter(map(len, texts), np.uint8, len(texts))
                high = (p.where[members] >> np.uint64(32)).astype("<u4")
                body = b"".join([sizes.tobytes(), high.tobytes(), p.least[members].tobytes(), *texts])
                out.append(
                    {
                        "chunk": r["chunk"],
                        "part": part,
                        "n": len(texts),
                        "size": len(body),
                        "pieces": codec.compress(body, asbytes=True),
                    }
                )
        return pa.Table.from_pylist(out, schema=PIECES_ARROW)

    def sort(table):
        known = defaultdict(count().__next__)
        piece, high, own = [], [], []
        rows = table.to_pylist()
        for r in rows:
            n = r["n"]
            body = pa.decompress(r["pieces"], r["size"], codec="zstd", asbytes=True)
            high.append(np.frombuffer(body, "<u4", n, n))
            own.append(np.frombuffer(body, "<i8", n, 5 * n))
            ends = (13 * n + np.cumsum(np.frombuffer(body, np.uint8, n), dtype=np.int64)).tolist()
            piece.append([known[body[s:e]] for s, e in zip([13 * n, *ends], ends, strict=False)])
        row_ends = np.cumsum([len(x) for x in piece])
        piece, high, own = (np.concatenate(x) for x in (piece, high, own))
        texts = list(known)
        least = np.full(len(texts), NO_ID, np.int64)
        np.minimum.at(least, piece, own)
        anchor = np.empty(len(texts), np.uint32)
        anchor[piece] = high
        windows = np.fromiter(map(len, texts), np.int64, len(texts)) - LENGTH + 1
        masks = np.where(least[piece] < own, (1 << windows[piece]) - 1, 0).astype("<u4")
        # A single piece of an anchor has its windows from nowhere else.
        _, group, sizes = np.unique(anchor, return_inverse=True, return_counts=True)
        several = sizes[group] > 1
        for bucket in range(PART_BUCKETS):
            chosen = np.flatnonzero(several & (anchor % PART_BUCKETS == bucket))
            if not len(chosen):
                continue
            starts, found = earliest([texts[k] for k in chosen.tolist()], least[chosen])
            start_of = np.full(len(texts), -1, np.int64)
            start_of[chosen] = starts
            among = np.flatnonzero(start_of[piece] >= 0)
            # No window starts behind a piece's last, so MASK_BITS places are read of each.
            places = start_of[piece[among]][:, None] + np.arange(MASK_BITS)
            earlier = found[places] < own[among][:, None]
            masks[among] = np.packbits(earlier, axis=1, bitorder="little").view("<u4").ravel()
        out = [
            {"chunk": r["chunk"], "part": r["part"], "masks": own_masks.tobytes()}
            for r, own_masks in zip(rows, np.split(masks, row_ends[:-1]), strict=True)
            if own_masks.any()
        ]
        return pa.Table.from_pylist(out, schema=MASKS_ARROW)

    pieces = (
        packed.groupBy("chunk")
        .cogroup(shared.groupBy("chunk"))
        .applyInArrow(send, "chunk bigint, part bigint, n bigint, size bigint, pieces binary")
    )
    return pieces.groupBy("part").applyInArrow(sort, "chunk bigint, part bigint, masks binary")


PIECES_ARROW = pa.schema([(n, pa.int64()) for n in ("chunk", "part", "n", "size")] + [("pieces", pa.binary())])
MASKS_ARROW = pa.schema([("chunk", pa.int64()), ("part", pa.int64()), ("masks", pa.binary())])
CUT_ARROW = pa.schema(
    [
        ("id", pa.int64()),
        ("n_bytes", pa.int64()),
        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
        ("kept", pa.binary()),
    ]
)


def cut(packed: DataFrame, shared: DataFrame, masks: DataFrame, bits: int, parts: int) -> DataFrame:
    """Each document's removed spans and kept bytes."""

    def apply(key, chunks, told):
        out = []
        masks = told.filter(pc.is_valid(told.column("masks"))).select(["bucket", "masks"]).to_pylist()
        for r in chunks.to_pylist():
            c = Chunk(r)
            p = c.pieces(*c.shared(told, bits))
            mask_of = np.zeros(len(p.texts), np.uint32)
            dealt = p.dealt(parts)
            for m in masks:
                mask_of[dealt[m["bucket"]]] = np.frombuffer(m["masks"], "<u4")
            # Windows to go: all of a part whose piece an earlier document of the chunk has.
            full = ((1 << (p.last - p.first + 1)) - 1).astype("<u4")
            mask = np.where(p.own > p.least[p.number], full, mask_of[p.number])
            of = np.flatnonzero(mask)
            bit = np.unpackbits(mask[of].astype("<u4").view(np.uint8), bitorder="little")
            part, window = np.nonzero(bit.reshape(-1, MASK_BITS))
            gone = p.first[of[part]] + window
            # In order of place, windows that overlap or touch are one span of their document.
            doc = np.searchsorted(c.ends, gone, side="right")
            new = np.ones(len(gone), bool)
            new[1:] = (gone[1:] > gone[:-1] + LENGTH) | (doc[1:] != doc[:-1])
            first = np.flatnonzero(new)
            doc, start = doc[first], gone[first]
            end = gone[np.append(first[1:], len(gone))[: len(first)] - 1] + LENGTH
            offsets = np.searchsorted(doc, np.arange(len(c.ids) + 1))
            origin = c.ends - c.lengths
            kept = []
            at, stop = [0, *end.tolist()], start.tolist()
            columns = (origin.tolist(), c.ends.tolist(), offsets[:-1].tolist(), offsets[1:].tolist())
            for s, e, a, b in zip(*columns, strict=True):
                if a == b:
                    kept.append(c.raw[s:e])
                    continue
                edges = zip([s, *at[a + 1 : b + 1]], [*stop[a:b], e], strict=True)
                kept.append(b"".join([c.raw[x:y] for x, y in edges]))
            span = pa.StructArray.from_arrays(
                [start - origin[doc], end - origin[doc]], names=["start", "end"]
            )
            spans = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), span)
            columns = [pa.array(c.ids), pa.array(c.lengths), spans, pa.array(kept, pa.binary())]
            out.append(pa.Table.from_arrays(columns, names=CUT_ARROW.names).cast(CUT_ARROW))
        return pa.concat_tables(out) if out else CUT_ARROW.empty_table()

    empty = F.lit(None).cast("binary")
    told = shared.drop("n").withColumn("masks", empty).union(
        masks.select("chunk", "part", empty.alias("marks"), empty.alias("hot"), "masks")
    )
    return (
        packed.groupBy("chunk")
        .cogroup(told.groupBy("chunk"))
        .applyInArrow(
            apply,
            "id bigint, n_bytes bigint, spans array<struct<start:bigint,end:bigint>>, kept binary",
        )
    )


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    chunk_bytes: int = CHUNK_BYTES,
    hot_chunks: int = HOT_CHUNKS,
) -> DataFrame:
    """id_col, n_bytes, spans (removed, in bytes, end exclusive) and kept (bytes) of each row."""
    packed = materialize(pack(docs, id_col, text, chunk_bytes), "repeat-chunks")
    size = packed.agg(F.count(F.lit(1)), F.sum(F.length("lengths"))).first()
    expected = max(1, size[0]) * chunk_bytes * 2 // (LENGTH - GRAM + 2)
    bits = max(1, math.ceil(math.log2(max(2, expected / BUCKET_ANCHORS))))
    shared = materialize(find_shared(packed, bits, hot_chunks), "repeat-shared")
    pieces = shared.agg(F.sum("n")).first()[0] or 0
    parts = max(1, math.ceil(pieces / BUCKET_PIECES / PART_BUCKETS))
    masks = materialize(find_earlier(packed, shared, bits, parts), "repeat-masks")
    out = cut(packed, shared, masks, bits, parts)
    return out.select(
        F.when(F.col("id") != NO_ID, F.col("id")).alias(id_col), "n_bytes", "spans", "kept"
    )
