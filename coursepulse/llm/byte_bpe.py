"""Byte-level BPE: encoding by ranked merges over the bytes of distinct words, and decoding.

``encode`` takes documents in blocks, finds their words by the split pattern, and folds the
ranked merges over the byte arrays of the words that are new to the task: all words of one
length at once, in each step every word merges its leftmost adjacent pair of lowest rank. A
document's ids are those of its words in order. ``decode`` concatenates the binary pieces of
the ids with a higher-order function. (The merges were first folded by higher-order functions
too; the README has the figures that spoke against it.)

Null texts count as empty and have no ids. Texts and words of any length are encoded whole; a
row is encoded on its own, so ties and repeated rows keep their number and further columns are
kept, whatever their names, but for one of the output's name. An empty table gives an empty result. Words' ids are held in a table
that starts afresh beyond ``TABLE_WORDS``, which costs time, not results.
"""

from __future__ import annotations

import base64
import heapq

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F, types as T

from coursepulse.llm import lookup

BLOCK_CHARS = 2 << 20
TABLE_WORDS = 1 << 19
LONG_WORD = 32  # bytes; longer words are merged one by one
NO_RANK = (1 << 31) - 1
# Fixed value: Unicode white space, which the rank files' libraries mean by \s.
WHITE_SPACE = r"\t-\r \x85\xa0  -     　"


def read_ranks(path: str) -> dict[bytes, int]:
    """The vocabulary file of base64 pieces and ranks; its size bounds the rank map."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}


def unicode_blanks(pattern: str) -> str:
    r"""The pattern with \s and \S spelt out.

    >>> unicode_blanks(r"\s+") == "[" + WHITE_SPACE + "]+"
    True
    """
    out, inside, i = [], False, 0
    while i < len(pattern):
        two = pattern[i : i + 2]
        if two == r"\s":
            out.append(WHITE_SPACE if inside else f"[{WHITE_SPACE}]")
        elif two == r"\S":
            if inside:
                raise ValueError(r"\S inside a class")
            out.append(f"[^{WHITE_SPACE}]")
        else:
            if two[0] in "[]":
                inside = two[0] == "["
            out.append(two if two[0] == "\\" else two[0])
            i += len(out[-1])
            continue
        i += 2
    return "".join(out)


class Merges:
    """Ids of words by ranked merges, from the literal rank map."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.byte_id = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        pairs = sorted(
            (ranks[piece[:cut]] << 32 | ranks[piece[cut:]], rank)
            for piece, rank in ranks.items()
            for cut in range(1, len(piece))
            if piece[:cut] in ranks and piece[cut:] in ranks
        )
        self.keys = np.array([k for k, _ in pairs], dtype=np.int64)
        self.values = np.array([v for _, v in pairs], dtype=np.int64)
        self.pieces = {rank: piece for piece, rank in ranks.items()}

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Id of the pieces joined; NO_RANK where they are no piece."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.values[at], NO_RANK)

    def same_length(self, words: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of one length as rows, and how many of each row count."""
        raw = np.frombuffer(b"".join(words), np.uint8).reshape(len(words), length)
        pieces = self.byte_id[raw]
        sizes = np.full(len(words), length)
        active = np.arange(len(words))
        ranks = self.rank(pieces[:, :-1], pieces[:, 1:])
        while ranks.shape[1] and len(active):
            at = ranks.argmin(axis=1)
            row = np.arange(len(ranks))
            low = ranks[row, at]
            going = low < NO_RANK
            if not going.all():
                ranks, at, low, active = ranks[going], at[going], low[going], active[going]
                row = np.arange(len(ranks))
                if not len(active):
                    break
            own = pieces[active]
            own[row, at] = low
            columns = np.arange(own.shape[1] - 1)
            own[:, :-1] = np.where(columns > at[:, None], own[:, 1:], own[:, :-1])
            own[:, -1] = -1
            pieces[active] = own
            sizes[active] -= 1
            # Ranks move along; those beside the new piece are looked up.
            columns = np.arange(ranks.shape[1] - 1)
            ranks[:, :-1] = np.where(columns >= at[:, None], ranks[:, 1:], ranks[:, :-1])
            ranks[:, -1] = NO_RANK
            for side in (at - 1, at):
                fits = (side >= 0) & (side + 1 < sizes[active])
                r, c = row[fits], side[fits]
                ranks[r, c] = self.rank(own[r, c], own[r, c + 1])
        return pieces, sizes

    def single(self, word: bytes) -> list[int]:
        """The same for one word of any length, with a heap of pairs."""
        ids = [int(self.byte_id[b]) for b in word]
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        of = lambda i: self.ranks.get(
            self.pieces[ids[i]] + self.pieces[ids[after[i]]], NO_RANK
        )
        heap = [(of(i), i, ids[i], ids[i + 1]) for i in range(n - 1)]
        heap = [x for x in heap if x[0] < NO_RANK]
        heapq.heapify(heap)
        while heap:
            rank, i, left, right = heapq.heappop(heap)
            j = after[i] if ids[i] >= 0 else n
            if j >= n or ids[i] != left or ids[j] != right:
                continue  # one of the pieces has been merged meanwhile
            ids[i], ids[j] = rank, -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] < n and (new := of(k)) < NO_RANK:
                    heapq.heappush(heap, (new, k, ids[k], ids[after[k]]))
        return [i for i in ids if i >= 0]

    def fold(self, words: list[bytes]) -> list[list[int]]:
        """Ids of distinct words; a word that is a piece is that piece."""
        out: list[list[int]] = [[]] * len(words)
        by_length: dict[int, list[int]] = {}
        for i, word in enumerate(words):
            if (whole := self.ranks.get(word)) is not None:
                out[i] = [whole]
            elif len(word) > LONG_WORD:
                out[i] = self.single(word)
            else:
                by_length.setdefault(len(word), []).append(i)
        for length, members in by_length.items():
            pieces, sizes = self.same_length([words[i] for i in members], length)
            for i, row, n in zip(members, pieces.tolist(), sizes.tolist(), strict=True):
                out[i] = row[:n]
        return out


class Encoder:
    """A table of words and their ids, and documents as runs of it."""

    def __init__(self, merges: Merges, pattern: str) -> None:
        import regex

        self.merges = merges
        self.find = regex.compile(unicode_blanks(pattern)).findall
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.ids = np.empty(0, np.int32)
        self.starts = np.empty(0, np.int64)
        self.sizes = np.empty(0, np.int64)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and the number of ids of each text."""
        if len(self.index) > TABLE_WORDS:
            self.clear()
        split = [self.find(x) for x in texts]
        new = list(dict.fromkeys(w for x in split for w in x if w not in self.index))
        if new:
            found = self.merges.fold([w.encode() for w in new])
            sizes = np.array([len(x) for x in found], dtype=np.int64)
            first = len(self.ids) + np.cumsum(sizes) - sizes
            self.index.update(zip(new, range(len(self.index), len(self.index) + len(new))))
            flat = np.fromiter((i for x in found for i in x), np.int32, count=int(sizes.sum()))
            self.ids = np.concatenate([self.ids, flat])
            self.starts = np.concatenate([self.starts, first])
            self.sizes = np.concatenate([self.sizes, sizes])
        get = self.index.__getitem__
        counts = np.array([len(x) for x in split], dtype=np.int64)
        words = np.fromiter((get(w) for x in split for w in x), np.int64, count=int(counts.sum()))
        sizes = self.sizes[words]
        ends = np.cumsum(sizes)
        within = np.arange(int(sizes.sum())) - np.repeat(ends - sizes, sizes)
        ids = self.ids[np.repeat(self.starts[words], sizes) + within]
        upto = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
        return ids, np.diff(upto)


def encode(
    docs: DataFrame,
    ranks: dict[bytes, int],
    pattern: str,
    text: str = "text",
    out: str = "token_ids",
) -> DataFrame:
    """``docs`` with the array ``out`` of token ids of the whole text."""
    docs = docs.drop(out)
    shared = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(Merges(ranks)))
    names = docs.columns
    at = names.index(text)

    def encoded(batches):
        encoder = Encoder(cloudpickle.loads(shared.value), pattern)
        for batch in batches:
            texts = [x or "" for x in batch.column(at).to_pylist()]
            first = 0
            while first < len(texts):
                last, size = first, 0
                while last < len(texts) and size < BLOCK_CHARS:
                    size += len(texts[last])
                    last += 1
                ids, sizes = encoder.encode(texts[first:last])
                ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                part = batch.slice(first, last - first)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.ListArray.from_arrays(pa.array(ends), pa.array(ids))],
                    names=[*(f"c{i}" for i in range(len(names))), "ids"],
                )
                first = last

    inner = T.StructType(
        [T.StructField(f"c{i}", f.dataType) for i, f in enumerate(docs.schema.fields)]
        + [T.StructField("ids", T.ArrayType(T.IntegerType()))]
    )
    plain = docs.toDF(*(f"c{i}" for i in range(len(names))))
    return plain.mapInArrow(encoded, inner).toDF(*names, out)


def decode(
    df: DataFrame, ranks: dict[bytes, int], ids: str = "token_ids", out: str = "decoded"
) -> DataFrame:
    """``df`` with the binary ``out``: the ids' pieces, concatenated."""
    spark = df.sparkSession
    pieces = [""] * (max(ranks.values(), default=0) + 1)
    for piece, i in ranks.items():
        pieces[i] = piece.hex()
    tables = lookup.constants(spark, {"pieces": pa.array([pieces], pa.list_(pa.string()))})
    return lookup.with_constants(
        df,
        out,
        tables,
        lambda t: F.unhex(F.array_join(F.transform(F.col(ids), lambda i: t["pieces"][i]), "")),
    )
