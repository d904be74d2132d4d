"""Removal of word windows that repeat from earlier documents, by relative Lempel-Ziv parsing.

Every word covered by a window of ``WINDOW`` consecutive words that also starts in a document with
a smaller id goes. Texts are parsed against the corpus itself, dealt into indexed reference blocks:

1. Documents are packed into chunks of about ``CHUNK_BYTES``, stored once, a row each. A word is
   a 64-bit hash of its bytes, a text the sequence of its words' hashes.
2. Of the ``GRAM``-word strings in a window the one with the least hash is the window's anchor;
   neighbouring windows that share one make a piece of the text. A window has the same anchor
   wherever it is, so all its occurrences meet in the reference block of that anchor, and there is
   no other block that a text would have to be parsed against.
3. Each chunk offers its distinct pieces, by hash, with the smallest id that has them. A piece that
   an earlier document has in full is one factor. Where an anchor has several pieces, the words of
   each are fetched from the documents that have it first.
4. The pieces of a block are taken by ascending id. Each is parsed greedily: the reference made of
   the pieces with smaller ids is indexed by its windows, the longest match from the present word
   on is the next factor, a word without one is a literal. Windows across the end of a factor begin
   in its last words; these are looked up next, so that no window is missed. Then the piece joins
   the reference.
5. Chunks mark the words of their factors, and cut.

What a chunk sends grows with its distinct pieces, so a passage that a third of all documents share
costs a few rows a chunk. An anchor of more than ``HOT_PIECES`` pieces is split: its windows are
sent one by one, dealt by their own hash. Two words are taken as equal if their 64-bit hashes are.

Null texts count as empty; texts of fewer than WINDOW words keep all. Null ids count as larger than
any other; rows of equal id are not before each other, and repeated rows keep their number. A very
long text is a chunk of its own. Empty tables give empty results; further columns are not carried.
"""

from __future__ import annotations

import math
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from coursepulse.llm.repeats import NO_ID, pack
from coursepulse.session import materialize

WINDOW, GRAM = 13, 5
CHUNK_BYTES = 2 << 20
HOT_PIECES = 256
BLOCK_OFFERS = 1 << 19  # offers that one task compares
BLOCK_PIECES = 1 << 15  # pieces that one task parses
SLICE_BYTES = 1 << 18
BASE, STEP = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93

# The blanks of the word pattern: space, and tab to carriage return.
BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True


def mix(h: np.ndarray) -> np.ndarray:
    """Spread all bits of 64-bit values over all others."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))


class Powers:
    """Powers of an odd number modulo 2^64 and of its inverse, as far as they were needed."""

    def __init__(self, base: int) -> None:
        self.bases = (base, pow(base, -1, 1 << 64))
        self.tables = [np.ones(1, np.uint64)] * 2

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.tables[0]) < n:
            size = 1 << (n - 1).bit_length()
            for k, base in enumerate(self.bases):
                table = np.full(size, base, np.uint64)
                table[0] = 1
                self.tables[k] = np.multiply.accumulate(table)
        return self.tables[0], self.tables[1]


POWERS = Powers(BASE)
EMPTY = np.empty(0, np.int64)


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """Sums of values times powers of the base, from which any part's hash follows."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * POWERS.upto(len(values) + 1)[0][: len(values)], out=out[1:])
    return out


def part_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A mixed hash of each part [start, end), the same wherever it stands."""
    inverse = POWERS.upto(len(sums))[1]
    size = (ends - starts).astype(np.uint64) * np.uint64(STEP)
    return mix((sums[ends] - sums[starts]) * inverse[starts] + size)


def words(data: np.ndarray, doc_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of all words; none crosses the end of a document."""
    n = len(data)
    if not n:
        return EMPTY, EMPTY
    edge = np.zeros(n + 1, bool)
    edge[doc_ends] = True
    inside = ~BLANK[data]
    starts = inside & np.append(True, ~inside[:-1] | edge[1:-1])
    ends = inside & np.append(~inside[1:] | edge[1:-1], True)
    return np.flatnonzero(starts), np.flatnonzero(ends) + 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The hash of each word; bytes are taken in slices, which bounds what is held."""
    out = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        origin = starts[first]
        last = max(first + 1, int(np.searchsorted(ends, origin + SLICE_BYTES, side="right")))
        sums = prefix_sums(BYTE[data[origin : ends[last - 1]]])
        out[first:last] = part_hashes(sums, starts[first:last] - origin, ends[first:last] - origin)
        first = last
    return out


class Block:
    """Some documents' words, and the pieces that share an anchor."""

    def __init__(self, packed: dict) -> None:
        self.ids = np.frombuffer(packed["ids"], "<i8")
        self.lengths = np.frombuffer(packed["lengths"], "<i8")
        size = int(self.lengths.sum())
        self.raw = pa.decompress(packed["data"], size, codec="zstd", asbytes=True) if size else b""
        self.doc_ends = np.cumsum(self.lengths)
        data = np.frombuffer(self.raw, np.uint8)
        starts, ends = words(data, self.doc_ends)
        self.doc = np.searchsorted(self.doc_ends, starts, side="right")
        self.words = word_hashes(data, starts, ends)
        self.sums = prefix_sums(self.words)
        self._pieces()

    def _pieces(self) -> None:
        """First and last window, anchor, hash and document's id of each piece, by place."""
        n = len(self.words) - WINDOW + 1
        self.first = self.last = EMPTY
        self.anchor = self.piece = np.empty(0, np.uint64)
        self.own = EMPTY
        if n <= 0:
            return
        at = np.arange(len(self.words) - GRAM + 1)
        grams = part_hashes(self.sums, at, at + GRAM)
        low = np.uint64(32)
        least = (grams >> low << low) | at.astype(np.uint64)
        # Least of WINDOW - GRAM + 1 neighbours: by doubling, then two overlapping halves.
        width, size = WINDOW - GRAM + 1, 1
        while size * 2 <= width:
            least = np.minimum(least[: len(least) - size], least[size:])
            size *= 2
        if width > size:
            least = np.minimum(least[: len(least) - width + size], least[width - size :])
        starts = np.flatnonzero(self.doc[:n] == self.doc[WINDOW - 1 :])
        if not len(starts):
            return
        place = (least[starts] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        new = np.ones(len(starts), bool)
        new[1:] = (place[1:] != place[:-1]) | (starts[1:] != starts[:-1] + 1)
        first = np.flatnonzero(new)
        self.first = starts[first]
        self.last = starts[np.append(first[1:], len(starts)) - 1]
        self.anchor = grams[place[first]]
        self.piece = part_hashes(self.sums, self.first, self.last + WINDOW)
        self.own = self.ids[self.doc[self.first]]

    def distinct(self) -> tuple[np.ndarray, np.ndarray]:
        """A place of each distinct piece, by hash, in a document of the least id; and that id."""
        order = np.lexsort((self.own, self.piece))
        hashes = self.piece[order]
        new = np.append(True, hashes[1:] != hashes[:-1]) if len(order) else np.empty(0, bool)
        places = order[new]
        return places, self.own[places]


def _by_block(chunk: int, block: np.ndarray, columns: dict[str, np.ndarray]) -> pa.Table:
    """Rows of one chunk, one for each block: its values as bytes."""
    order = np.argsort(block, kind="stable")
    names, at = np.unique(block[order], return_index=True)
    out = {"chunk": [chunk] * len(names), "block": names.astype(np.int64)}
    for name, values in columns.items():
        parts = np.split(values[order], at[1:]) if len(names) else []
        out[name] = pa.array([p.tobytes() for p in parts], pa.binary())
    return pa.table(out)


def _joined(rows: list[bytes], kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(x for x in rows if x), kind)


def offers(packed: DataFrame, bits: int) -> DataFrame:
    """(chunk, block, anchors, pieces, least): a chunk's distinct pieces, by hash."""

    def send(batches):
        for batch in batches:
            for r in batch.to_pylist():
                block = Block(r)
                places, least = block.distinct()
                anchor = block.anchor[places]
                columns = {
                    "anchors": (anchor >> np.uint64(32 - bits)).astype("<u4"),
                    "pieces": block.piece[places].astype("<u8"),
                    "least": least.astype("<i8"),
                }
                where = (anchor >> np.uint64(64 - bits)).astype(np.int64)
                yield from _by_block(r["chunk"], where, columns).to_batches()

    schema = "chunk bigint, block bigint, anchors binary, pieces binary, least binary"
    return packed.mapInArrow(send, schema)


def whole_factors(offered: DataFrame, hot_pieces: int) -> DataFrame:
    """(chunk, whole, asked, hot): pieces, by hash, of which a chunk has something to do.

    ``whole`` are those that an earlier document has in full. The words of ``asked`` and ``hot``
    are needed: their anchor has other pieces, more than ``hot_pieces`` of them if hot.
    """

    def compare(table):
        sizes = np.array([len(x) // 8 for x in table.column("pieces").to_pylist()])
        anchor = _joined(table.column("anchors").to_pylist(), "<u4")
        piece = _joined(table.column("pieces").to_pylist(), "<u8")
        own = _joined(table.column("least").to_pylist(), "<i8")
        order = np.lexsort((own, piece, anchor))
        a, p = anchor[order], piece[order]
        new_anchor = np.append(True, a[1:] != a[:-1])
        new_piece = new_anchor | np.append(True, p[1:] != p[:-1])
        piece_at = np.cumsum(new_piece) - 1
        anchor_at = np.cumsum(new_anchor) - 1
        least = own[order][new_piece][piece_at]
        n_pieces = np.bincount(anchor_at[new_piece])[anchor_at]
        whole = np.empty(len(order), bool)
        whole[order] = own[order] > least
        several = np.empty(len(order), np.int64)
        several[order] = n_pieces
        ask = ~whole & (several > 1) & (several <= hot_pieces)
        hot = ~whole & (several > hot_pieces)
        edges = np.cumsum(sizes)[:-1]
        parts = [np.split(x, edges) for x in (piece, whole, ask, hot)]
        rows = {"chunk": table.column("chunk"), "whole": [], "asked": [], "hot": []}
        for p, *masks in zip(*parts, strict=True):
            for name, m in zip(("whole", "asked", "hot"), masks, strict=True):
                rows[name].append(p[m].tobytes())
        for name in ("whole", "asked", "hot"):
            rows[name] = pa.array(rows[name], pa.binary())
        return pa.table(rows)

    found = offered.groupBy("block").applyInArrow(
        compare, "chunk bigint, whole binary, asked binary, hot binary"
    )
    return found.filter(F.length("whole") + F.length("asked") + F.length("hot") > 0)


PIECES = pa.schema(
    [("chunk", pa.int64()), ("block", pa.int64())]
    + [(n, pa.binary()) for n in ("pieces", "at", "route", "least", "sizes", "words")]
)


def fetch(packed: DataFrame, told: DataFrame, blocks: int) -> DataFrame:
    """The words of the pieces that were asked for, dealt into reference blocks."""

    def send(key, chunks, told):
        asked, hot = (_joined(told.column(n).to_pylist(), "<u8") for n in ("asked", "hot"))
        out = []
        for r in chunks.to_pylist() if len(asked) + len(hot) else []:
            block = Block(r)
            places, least = block.distinct()
            hashes = block.piece[places]
            some, split = np.isin(hashes, asked), np.isin(hashes, hot)
            # Pieces of hot anchors go window by window.
            n = block.last[places[split]] - block.first[places[split]] + 1
            step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            parent = np.repeat(places[split], n)
            start = np.append(block.first[places[some]], block.first[parent] + step)
            end = np.append(block.last[places[some]], block.first[parent] + step) + WINDOW
            route = np.append(
                block.anchor[places[some]],
                part_hashes(block.sums, start[some.sum() :], end[some.sum() :]),
            )
            columns = {
                "pieces": np.append(hashes[some], np.repeat(hashes[split], n)).astype("<u8"),
                "at": np.append(np.zeros(some.sum()), step).astype("<u2"),
                "route": route.astype("<u8"),
                "least": np.append(least[some], np.repeat(least[split], n)).astype("<i8"),
                "sizes": (end - start).astype("<u2"),
            }
            where = (route % np.uint64(blocks)).astype(np.int64)
            order = np.argsort(where, kind="stable")
            names, first = np.unique(where[order], return_index=True)
            for name, part in zip(names.tolist(), np.split(order, first[1:]), strict=True):
                spans = zip(start[part].tolist(), end[part].tolist(), strict=True)
                row = {k: v[part].tobytes() for k, v in columns.items()}
                body = b"".join(block.words[s:e].tobytes() for s, e in spans)
                out.append(row | {"chunk": r["chunk"], "block": name, "words": body})
        return pa.Table.from_pylist(out, schema=PIECES)

    return (
        packed.groupBy("chunk")
        .cogroup(told.groupBy("chunk"))
        .applyInArrow(
            send,
            "chunk bigint, block bigint, pieces binary, at binary, route binary, least binary, "
            "sizes binary, words binary",
        )
    )


class Reference:
    """Texts that are parsed against: sequences of 8-byte words, indexed by their windows."""

    def __init__(self) -> None:
        self.texts: list[bytes] = []
        self.held: set[bytes] = set()
        self.index: dict[bytes, list[tuple[int, int]]] = {}

    def add(self, text: bytes) -> None:
        if text in self.held:
            return
        self.held.add(text)
        for at in range(0, len(text) - 8 * WINDOW + 1, 8):
            self.index.setdefault(text[at : at + 8 * WINDOW], []).append((len(self.texts), at))
        self.texts.append(text)

    def _match(self, text: bytes, at: int) -> int:
        """Bytes of the longest match of ``text`` from ``at`` on; 0 if shorter than a window."""
        best = 0
        for number, place in self.index.get(text[at : at + 8 * WINDOW], ()):
            other, size = self.texts[number], 8 * WINDOW
            most = min(len(text) - at, len(other) - place)
            while size < most and text[at + size : at + size + 8] == other[place + size : place + size + 8]:
                size += 8
            best = max(best, size)
        return best

    def factors(self, text: bytes) -> list[tuple[int, int]]:
        """Greedy factors (start, end) in words, of at least a window; other words are literals.

        After a factor the search goes on with the first window across its end.
        """
        out, at = [], 0
        while at + 8 * WINDOW <= len(text):
            size = self._match(text, at)
            if size:
                out.append((at // 8, (at + size) // 8))
                at += size - 8 * (WINDOW - 1)
            else:
                at += 8
        return out


def earlier_windows(pieces: list[tuple[int, bytes]]) -> list[int]:
    """For each (id, words) the windows that a piece of smaller id has, as bits."""
    out = [0] * len(pieces)
    reference, waiting, last = Reference(), [], None
    for k in sorted(range(len(pieces)), key=lambda k: pieces[k][0]):
        own, text = pieces[k]
        if own != last:
            for x in waiting:
                reference.add(x)
            waiting, last = [], own
        for start, end in reference.factors(text):
            out[k] |= ((1 << (end - start - WINDOW + 1)) - 1) << start
        waiting.append(text)
    return out


MASKS = pa.schema([("chunk", pa.int64()), ("pieces", pa.binary()), ("masks", pa.binary())])


def parse(fetched: DataFrame) -> DataFrame:
    """(chunk, pieces, masks): the windows of pieces, as bits, that an earlier document has."""

    def run(table):
        known: dict[tuple[int, int, bytes], list[tuple[int, int, int]]] = {}
        for r in table.to_pylist():
            kinds = (("pieces", "<u8"), ("at", "<u2"), ("route", "<u8"), ("least", "<i8"), ("sizes", "<u2"))
            columns = [np.frombuffer(r[n], kind).tolist() for n, kind in kinds]
            place = 0
            for piece, at, route, own, size in zip(*columns, strict=True):
                text = r["words"][place : place + 8 * size]
                place += 8 * size
                known.setdefault((route, own, text), []).append((r["chunk"], piece, at))
        by_route: dict[int, list[tuple[int, int, bytes]]] = {}
        for key in known:
            by_route.setdefault(key[0], []).append(key)
        out: dict[int, list[tuple[int, int]]] = {}
        for keys in by_route.values():
            masks = earlier_windows([(own, text) for _, own, text in keys])
            for key, mask in zip(keys, masks, strict=True):
                for chunk, piece, at in known[key] if mask else ():
                    out.setdefault(chunk, []).append((piece, mask << at))
        rows = [
            {
                "chunk": chunk,
                "pieces": np.array([p for p, _ in x], "<u8").tobytes(),
                "masks": np.array([m for _, m in x], "<u2").tobytes(),
            }
            for chunk, x in out.items()
        ]
        return pa.Table.from_pylist(rows, schema=MASKS)

    return fetched.groupBy("block").applyInArrow(
        run, "chunk bigint, pieces binary, masks binary"
    )


CUT = pa.schema(
    [
        ("id", pa.int64()),
        ("n_words", pa.int64()),
        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
        ("kept", pa.string()),
    ]
)


def _covered(block: Block, whole: np.ndarray, pieces: np.ndarray, masks: np.ndarray) -> np.ndarray:
    """Which words of a chunk are covered by a factor."""
    places, least = block.distinct()
    number = np.searchsorted(block.piece[places], block.piece)
    told, at = np.unique(pieces, return_inverse=True)
    bits = np.zeros(len(told), np.int64)
    np.bitwise_or.at(bits, at, masks.astype(np.int64))
    own_bits = np.zeros(len(block.piece), np.int64)
    if len(told):
        near = np.minimum(np.searchsorted(told, block.piece), len(told) - 1)
        own_bits = np.where(told[near] == block.piece, bits[near], 0)
    gone = np.isin(block.piece, whole)
    if len(places):
        gone |= block.own > least[number]
    own_bits = np.where(gone, (1 << (block.last - block.first + 1)) - 1, own_bits)
    change = np.zeros(len(block.words) + 1, np.int64)
    for k in range(WINDOW - GRAM + 1):
        start = block.first[own_bits >> k & 1 > 0] + k
        np.add.at(change, start, 1)
        np.add.at(change, start + WINDOW, -1)
    return np.cumsum(change[:-1]) > 0


def cut(packed: DataFrame, told: DataFrame, masks: DataFrame) -> DataFrame:
    """Each document's number of words, removed spans of words, and kept text."""

    def apply(key, chunks, told):
        whole, pieces = (_joined(told.column(n).to_pylist(), "<u8") for n in ("whole", "pieces"))
        bits = _joined(told.column("masks").to_pylist(), "<u2")
        out = []
        for r in chunks.to_pylist():
            block = Block(r)
            gone = _covered(block, whole, pieces, bits)
            counts = np.bincount(block.doc, minlength=len(block.ids))
            last_word = np.cumsum(counts)
            rows = zip(block.ids.tolist(), block.doc_ends.tolist(), block.lengths.tolist(),
                       last_word.tolist(), counts.tolist(), strict=True)
            for i, end, size, last, n in rows:
                own = gone[last - n : last]
                kept, spans = block.raw[end - size : end].split(), []
                if own.any():
                    kept = compress(kept, (~own).tolist())
                    edge = np.flatnonzero(np.diff(np.concatenate([[0], own.view(np.int8), [0]])))
                    spans = [
                        {"start": s, "end": e}
                        for s, e in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True)
                    ]
                out.append({"id": i, "n_words": n, "spans": spans, "kept": b" ".join(kept).decode()})
        return pa.Table.from_pylist(out, schema=CUT)

    none = F.lit(None).cast("binary")
    both = told.select("chunk", "whole", none.alias("pieces"), none.alias("masks")).union(
        masks.select("chunk", none.alias("whole"), "pieces", "masks")
    )
    return (
        packed.groupBy("chunk")
        .cogroup(both.groupBy("chunk"))
        .applyInArrow(
            apply,
            "id bigint, n_words bigint, spans array<struct<start:bigint,end:bigint>>, kept string",
        )
    )


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    chunk_bytes: int = CHUNK_BYTES,
    hot_pieces: int = HOT_PIECES,
) -> DataFrame:
    """id_col, n_words, spans (removed, in words, end exclusive) and kept (text) of each row."""
    packed = materialize(pack(docs, id_col, text, chunk_bytes), "lz-chunks")
    chunks = packed.count()
    # About one piece to (WINDOW - GRAM + 2) / 2 words, of six bytes or more.
    expected = max(1, chunks) * chunk_bytes // (3 * (WINDOW - GRAM + 2))
    bits = max(1, math.ceil(math.log2(max(2, expected / BLOCK_OFFERS))))
    told = materialize(whole_factors(offers(packed, bits), hot_pieces), "lz-whole")
    asked = told.agg(F.sum(F.length("asked") + F.length("hot") * (WINDOW - GRAM + 1))).first()[0] or 0
    blocks = max(1, math.ceil(asked / 8 / BLOCK_PIECES))
    masks = materialize(parse(fetch(packed, told, blocks)), "lz-masks")
    return cut(packed, told, masks).select(
        F.when(F.col("id") != NO_ID, F.col("id")).alias(id_col), "n_words", "spans", "kept"
    )
