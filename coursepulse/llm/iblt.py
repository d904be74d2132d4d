"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A paragraph ends at a line break or after a sentence (``SENTENCE_END``); a run of more than
``LONG_RUN`` characters without such an end is cut after words chosen by their hash: as in
content-defined chunking the text itself decides, so that two versions are cut alike, and long
lines do not count as one. ``PARAGRAPH_END``, the default, ends only at sentences whose last
letter is one of a to m and leaves long runs whole. A paragraph's digest is xxHash64. A sketch has three
tables of ``cells`` cells; each distinct digest is added to one cell of each table, which holds
the exclusive-or of digests and that of their check sums. Two sketches of one size subtract
cell by cell (exclusive-or is its own inverse), and peeling cells with a single digest recovers
the digests that only one text has. Where that
fails, the sketches are made anew as large as both texts' digests need, and doubled up to
``RETRIES`` times; what is still left then is compared digest by digest. The least digests of both
texts tell beforehand about how many differ: where these are more than a common sketch can tell
apart, the first try is made that large.

DataFrame functions only; a text's cells live in arrays of its row. Null texts count as empty.
Texts without paragraphs have an empty sketch and are alike (1.0). Repeated paragraphs count
once. ``edited_versions`` orders by id, then by the text's hash: rows equal in both are one
document with several rows, which all keep their place; null ids come last. A table of one
document is its own next; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from coursepulse.plans.ranks import global_row_number
from coursepulse.session import materialize

TABLES = 3
CELLS = 8
RETRIES = 3
PARAGRAPH_END = r"\n|(?<=[a-m][.!?]) "
SENTENCE_END = r"\n|(?<=[.!?]) "
# A longer run without an end is cut after about every sixteenth word, by the word's hash.
LONG_RUN, RUN_WORDS = 400, 16
ROUNDS = 24
# So many least digests tell how much two texts differ; so many more are allowed for.
BOTTOM, SPARE = 12, 8
NULL_ID = -(1 << 63)
CELL = "array<struct<cell:bigint,x:bigint,h:bigint>>"


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value``, which is evaluated once."""
    return F.transform(F.array(value), body)[0]


def _cut_run(run: Column) -> Column:
    """A run without line breaks in pieces that end after words of every sixteenth hash."""
    ends = lambda w: F.pmod(F.xxhash64(w), F.lit(RUN_WORDS)) == 0
    words = F.transform(
        F.split(run, "(?<= )|(?<=[。！？、，])", -1),
        lambda w: F.when(ends(w), F.concat(w, F.lit("\n"))).otherwise(w),
    )
    return F.split(F.array_join(words, ""), "\n", -1)


def digests(text: Column, end: str = PARAGRAPH_END) -> Column:
    """The distinct paragraph digests of a text; ``SENTENCE_END`` also cuts long runs."""
    parts = F.split(F.coalesce(text, F.lit("")), end, -1)
    if end == SENTENCE_END:
        cut = lambda p: F.when(F.length(p) > LONG_RUN, _cut_run(p)).otherwise(F.array(p))
        parts = F.flatten(F.transform(parts, cut))
    parts = F.filter(parts, lambda p: F.trim(p) != "")
    return F.array_distinct(F.transform(parts, lambda p: F.xxhash64(p)))


def _check(digest: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(digest, F.lit(TABLES)), 32)


def _entries(found: Column, cells: Column) -> Column:
    """One entry for each digest and table."""

    def spread(d: Column, h: Column) -> Column:
        place = lambda t: F.pmod(F.xxhash64(d, F.lit(t)), cells) + cells * t
        return F.array(
            *(
                F.struct(place(t).alias("cell"), d.alias("x"), h.alias("h"))
                for t in range(TABLES)
            )
        )

    return F.flatten(F.transform(found, lambda d: bound(_check(d), lambda h: spread(d, h))))


def _gather(entries: Column) -> Column:
    """Entries of one cell as one, in order of cells; cells that hold nothing are left out.

    Of the sorted entries the places where a cell begins are filtered out, then each cell's run
    is joined; nothing grows step by step.
    """

    def joined(e: Column, starts: Column) -> Column:
        def cell(at: Column, k: Column) -> Column:
            end = F.coalesce(F.get(starts, k + 1), F.size(e))
            first = e[at]
            several = F.aggregate(
                F.sequence(at + 1, end - 1),
                F.struct(first["x"].alias("x"), first["h"].alias("h")),
                lambda s, i: F.struct(
                    s["x"].bitwiseXOR(e[i]["x"]).alias("x"), s["h"].bitwiseXOR(e[i]["h"]).alias("h")
                ),
                lambda s: F.struct(first["cell"].alias("cell"), s["x"].alias("x"), s["h"].alias("h")),
            )
            return F.when(end - at == 1, first).otherwise(several)

        return F.filter(F.transform(starts, cell), lambda c: (c["x"] != 0) | (c["h"] != 0))

    def starts(e: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(e) - 1)
        return F.filter(at, lambda i: (i == 0) | (e[i]["cell"] != F.get(e, i - 1)["cell"]))

    return bound(
        F.sort_array(entries),
        lambda e: F.when(F.size(e) == 0, e).otherwise(bound(starts(e), lambda at: joined(e, at))),
    )


def sketch(found: Column, cells: Column) -> Column:
    """The cells in use of the sketch of distinct digests; ``cells`` is a bigint."""
    return _gather(_entries(found, cells))


def subtract(left: Column, right: Column) -> Column:
    return _gather(F.concat(left, right))


def peel(cells_left: Column, cells: Column) -> Column:
    """Struct of ``left`` (cells that stay, empty on success) and ``found`` (digests)."""

    def single(state: Column) -> Column:
        alone = F.filter(state["left"], lambda c: c["h"] == _check(c["x"]))
        return F.array_distinct(F.transform(alone, lambda c: c["x"]))

    def taken(state: Column, found: Column) -> Column:
        return F.struct(
            _gather(F.concat(state["left"], _entries(found, cells))).alias("left"),
            F.concat(state["found"], found).alias("found"),
            (F.size(found) == 0).alias("stuck"),
        )

    def step(state: Column, _: Column) -> Column:
        return F.when(state["stuck"], state).otherwise(
            bound(
                single(state),
                lambda found: F.when(
                    F.size(found) == 0,
                    F.struct(
                        state["left"].alias("left"),
                        state["found"].alias("found"),
                        F.lit(True).alias("stuck"),
                    ),
                ).otherwise(taken(state, found)),
            )
        )

    start = F.struct(
        cells_left.alias("left"),
        F.array().cast("array<bigint>").alias("found"),
        (F.size(cells_left) == 0).alias("stuck"),
    )
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step)


def expected_difference(a: Column, b: Column) -> Column:
    """An estimate of the digests that only one side has, from the ``BOTTOM`` least of both.

    The least of all digests are a sample of them: the share that both sides have tells how alike
    the sides are.
    """
    least = lambda x: F.slice(F.sort_array(x), 1, BOTTOM)

    def guess(x: Column, y: Column) -> Column:
        def of(sample: Column) -> Column:
            both = F.size(F.filter(sample, lambda d: F.array_contains(x, d) & F.array_contains(y, d)))
            total, n = F.size(a) + F.size(b), F.size(sample)
            # Of n distinct digests, ``both`` stand for two each.
            return F.when(n == 0, F.lit(0)).otherwise(F.ceil(total * (n - both) / (n + both)))

        return bound(F.slice(F.sort_array(F.array_union(x, y)), 1, BOTTOM), of)

    return bound(least(a), lambda x: bound(least(b), lambda y: guess(x, y))).cast("bigint")


def with_difference(df: DataFrame, a: str, b: str, sketch_a: str, sketch_b: str, out: str) -> DataFrame:
    """``df`` with ``<out>_n`` (digests that one side lacks) and ``<out>_tries`` (sizes used).

    Sketches of the common size are subtracted where the difference is expected to be small, else
    the first try has two cells for each digest that is expected to differ. One column for each
    step of a try: a step is planned apart and runs only where it is needed.
    """
    added = ["_first", "_cells", "_rest", "_peeled", "_tries"]
    base = F.lit(CELLS).cast("bigint")
    # Two cells for each digest of either text, then twice as many.
    full = F.greatest(
        F.lit(2 * CELLS).cast("bigint"), F.ceil((F.size(a) + F.size(b)) * 2 / F.lit(TABLES))
    )
    guess = expected_difference(F.col(a), F.col(b))
    size = F.least(full, F.ceil((guess + SPARE) * 2 / F.lit(TABLES)))
    df = df.withColumn("_first", F.when(guess <= CELLS, base).otherwise(F.greatest(base + 1, size)))
    first = F.col("_first")
    small = subtract(F.col(sketch_a), F.col(sketch_b))
    made = subtract(sketch(F.col(a), first), sketch(F.col(b), first))
    df = df.withColumn("_rest", F.when(first == base, small).otherwise(made))
    df = df.withColumn("_peeled", peel(F.col("_rest"), first))
    df = df.withColumn("_tries", (first > base).cast("int"))
    failed = F.size(F.col("_peeled.left")) > 0
    for tries in range(1, RETRIES + 1):
        cells = F.col("_cells")
        df = df.withColumn("_cells", full * F.lit(1 << (tries - 1)))
        df = df.withColumn(
            "_rest", F.when(failed, subtract(sketch(F.col(a), cells), sketch(F.col(b), cells)))
        )
        df = df.withColumn("_tries", F.when(failed, F.col("_tries") + 1).otherwise(F.col("_tries")))
        df = df.withColumn(
            "_peeled", F.when(failed, peel(F.col("_rest"), cells)).otherwise(F.col("_peeled"))
        )
    found = F.size(F.col("_peeled.found"))
    exact = F.size(F.array_except(a, b)) + F.size(F.array_except(b, a))
    df = df.withColumn(f"{out}_n", F.when(failed, exact).otherwise(found))
    return df.withColumnRenamed("_tries", f"{out}_tries").drop(*added)


def likeness(a: Column, b: Column, differ: Column) -> Column:
    """Shared digests to all digests, 0 to 1; 1 where neither text has any."""
    every = F.size(a) + F.size(b) + differ
    return F.when(every == 0, F.lit(1.0)).otherwise(
        (F.size(a) + F.size(b) - differ).cast("double") / every
    )


def printed(found: Column, cells: Column) -> Column:
    """A sketch as text: the number of digests, then cell, digests and check in hex."""
    return F.concat_ws(
        ";",
        F.size(found).cast("string"),
        F.array_join(
            F.transform(
                cells,
                lambda c: F.concat_ws(
                    ",", c["cell"].cast("string"), F.lower(F.hex(c["x"])), F.lower(F.hex(c["h"]))
                ),
            ),
            ";",
        ),
    )


def edited_versions(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", end: str = PARAGRAPH_END
) -> DataFrame:
    """doc_id, text, edited (last quarter replaced by the next text's start), digests, next_digests.

    Each text's digests are made once and go with it.

    The order is made of ids and hashes alone; texts move once to their id, their starts once
    more to the document before.
    """
    rows = docs.select(
        F.coalesce(F.col(id_col).cast("bigint"), F.lit(NULL_ID)).alias("id"),
        F.col(id_col).isNull().alias("no_id"),
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("hash"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
        digests(F.col(text), end).alias("digests"),
    )
    keys = ["no_id", "id", "hash"]
    known = rows.groupBy(*keys).agg(F.max(F.length("text")).alias("n"))
    order = materialize(
        global_row_number(known, [F.col(k) for k in keys], "pos", first=0), "edit-order"
    )
    total = order.count()
    before = order.select(
        *(F.col(k).alias(f"to_{k}") for k in keys),
        F.expr("n div 4").cast("int").alias("take"),
        F.pmod(F.col("pos") + 1, F.lit(max(total, 1))).alias("pos"),
    )
    wanted = materialize(order.drop("n").join(before, "pos").drop("pos"), "edit-wanted")
    heads = (
        rows.join(wanted, keys)
        .select(
            *(F.col(f"to_{k}").alias(k) for k in keys),
            F.left("text", F.col("take")).alias("head"),
            F.col("digests").alias("next_digests"),
        )
        .dropDuplicates(keys)
    )
    kept = F.expr("left(text, length(text) - length(text) div 4)")
    return rows.join(heads, keys).select(
        F.when(~F.col("no_id"), F.col("id")).alias("doc_id"),
        "text",
        F.concat(kept, F.col("head")).alias("edited"),
        "digests",
        "next_digests",
    )


def compare(versions: DataFrame, end: str = PARAGRAPH_END) -> DataFrame:
    """The fingerprints of text and edited text, and the likeness to the edited and next text.

    ``end`` is that of ``edited_versions``.
    """
    df = versions.select(
        "doc_id",
        F.length("text").cast("bigint").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        F.col("digests").alias("_own"),
        digests(F.col("edited"), end).alias("_edit"),
        F.col("next_digests").alias("_next"),
    )
    for name in ("own", "edit", "next"):
        df = df.withColumn(f"_k_{name}", sketch(F.col(f"_{name}"), F.lit(CELLS).cast("bigint")))
    for name in ("edit", "next"):
        df = with_difference(df, "_own", f"_{name}", "_k_own", f"_k_{name}", name)
    return df.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        printed(F.col("_own"), F.col("_k_own")).alias("fingerprint"),
        printed(F.col("_edit"), F.col("_k_edit")).alias("edited_fingerprint"),
        likeness(F.col("_own"), F.col("_edit"), F.col("edit_n")).alias("near_edited"),
        likeness(F.col("_own"), F.col("_next"), F.col("next_n")).alias("near_next"),
        F.col("edit_n").alias("n_edited"),
        F.col("edit_tries").alias("tries_edited"),
        F.col("next_tries").alias("tries_next"),
    )
