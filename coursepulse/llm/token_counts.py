"""Token counts without token ids: pieces are counted once per distinct pre-token.

Within a task, documents are taken in blocks of ``BLOCK_BYTES``. A document is a bag of words
between ASCII blanks; each distinct word that is not yet in the task's table is normalised and
cut into pre-tokens once, each distinct pre-token is run through the merges once, and only
numbers of pieces are kept. The documents' frequencies are then joined to that table and
summed. The tables start afresh beyond ``TABLE_ENTRIES``, which costs time, not results. A join
of the whole corpus on the pre-token would shuffle a row for each distinct pre-token of each
document, more than the texts themselves.

Cutting at blanks first is right for tokenizers whose pre-tokens hold no blanks and whose
normaliser does not look across them; ``count_tokens`` takes no others.

Null texts count as empty (0 bytes, 0 tokens). Strings of special tokens inside a text are one
token each, as the library does by default. Rows are independent: ties and repeated rows keep
their number, further columns are kept by ``count_tokens`` (those of an
output's name are replaced) and an empty table stays empty.
"""

from __future__ import annotations

import operator
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

BLOCK_BYTES = 4 << 20
TABLE_ENTRIES = 1 << 20


class Pieces:
    """Numbers of pieces by word, each distinct pre-token counted once."""

    def __init__(self, tokenizer) -> None:
        specials = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        pattern = "|".join(map(re.escape, sorted(specials, key=len, reverse=True)))
        self.special = re.compile(pattern) if pattern else None
        self.normalize = tokenizer.normalizer.normalize_str if tokenizer.normalizer else str
        self.cut = tokenizer.pre_tokenizer.pre_tokenize_str
        self.tokenize = tokenizer.model.tokenize
        self.pieces: dict[str, int] = {}
        self.words: dict[bytes, int] = {}
        if any(" " in x or "\u0120" in x for x, _ in self.cut(self.normalize("a b, c"))):
            raise ValueError("the tokenizer's pre-tokens hold blanks")

    def add(self, words: set[bytes]) -> None:
        if len(self.words) > TABLE_ENTRIES:
            self.words, self.pieces = {}, {}
        for word in words.difference(self.words):
            total = 0
            for piece, _ in self.cut(self.normalize(word.decode())):
                if piece not in self.pieces:
                    self.pieces[piece] = len(self.tokenize(piece))
                total += self.pieces[piece]
            self.words[word] = total

    def frequencies(self, text: str) -> tuple[Counter, int]:
        """Word frequencies of one text, and the number of special tokens in it."""
        if self.special is None or not self.special.search(text):
            return Counter(text.encode().split()), 0
        parts = self.special.split(text)
        found: Counter = Counter()
        for part in parts:
            found.update(part.encode().split())
        return found, len(parts) - 1

    def total(self, found: Counter) -> int:
        return sum(map(operator.mul, map(self.words.__getitem__, found), found.values()))


def blocks(texts: list[str | None], most: int):
    """Consecutive texts, null as empty, of about ``most`` characters at a time."""
    held, size = [], 0
    for text in texts:
        held.append(text or "")
        size += len(held[-1])
        if size >= most:
            yield held
            held, size = [], 0
    if held:
        yield held


def count_tokens(
    docs: DataFrame, vocabulary: str, text: str = "text", limit: int = 2048
) -> DataFrame:
    """``docs`` without the text, with n_bytes, n_tokens and over_limit (more than ``limit``).

    ``vocabulary`` is the tokenizer's file, read by the driver and sent to the tasks.
    """
    docs = docs.drop("n_bytes", "n_tokens", "over_limit")
    with open(vocabulary, encoding="utf-8") as source:
        definition = source.read()
    shared = docs.sparkSession.sparkContext.broadcast(definition)
    at = docs.columns.index(text)
    others = [c for i, c in enumerate(docs.schema.fields) if i != at]

    def counted(batches):
        from tokenizers import Tokenizer

        table = Pieces(Tokenizer.from_str(shared.value))
        for batch in batches:
            sizes, totals = [], []
            for block in blocks(batch.column(at).to_pylist(), BLOCK_BYTES):
                by_doc = [table.frequencies(x) for x in block]
                table.add(set().union(*(f for f, _ in by_doc)))
                sizes += [len(x.encode()) for x in block]
                totals += [n + table.total(f) for f, n in by_doc]
            kept = [c for i, c in enumerate(batch.columns) if i != at]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(sizes, pa.int64()), pa.array(totals, pa.int64())],
                names=[*(f"c{i}" for i in range(len(kept))), "n_bytes", "n_tokens"],
            )

    # Positional names inside: the caller's may clash with each other or with the new ones.
    inner = T.StructType(
        [T.StructField(f"c{i}", c.dataType) for i, c in enumerate(others)]
        + [T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())]
    )
    plain = docs.toDF(*(f"d{i}" for i in range(len(docs.columns))))
    out = plain.mapInArrow(counted, inner).withColumn("over_limit", F.col("n_tokens") > limit)
    return out.toDF(*(c.name for c in others), "n_bytes", "n_tokens", "over_limit")
