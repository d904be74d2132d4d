"""Secret scan with multipart credential linking, in DataFrame functions only.

Base kinds are found by pattern and always reported. Weak candidates (a long key-like run, an
endpoint address) mean nothing alone: a key-like run is reported if an access identifier starts
within ``SCOPE`` code points of it, an endpoint if an access identifier and a secret (assigned,
hexadecimal or key-like) do. The interval join is an equality join on bins of ``SCOPE`` code
points: of each bin only the first and last place of either part are kept, which decides
"within" exactly for the bin itself and its two neighbours, without pairs.

Positions are code points, ends exclusive. Null and empty texts have no spans. Rows are judged
by their own text only; repeated rows keep their number, null ids are allowed, and an empty
table gives an empty result. Very long texts are scanned whole, one row at a time. ``find`` keeps
columns of any other name and replaces one named ``spans``; ``scan`` adds ``_base``, ``_weak``
and ``_key`` and replaces columns of these names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from coursepulse.llm.lookup import unused
from coursepulse.session import materialize

# The kinds in their order, and the patterns.
KINDS = ("assign", "access", "hex", "key", "endpoint")
ASSIGN = (
    r"((?i:password|passwd|secret|token|api_?key))"
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"(?<![0-9a-f])[0-9a-f]{16,}"
KEY = r"(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{32,}"
ENDPOINT = r"""https?://[^\s"'<>]+"""
LEAST_ASSIGNED, LEAST_ACCESS = 12, 18
SCOPE = 400
SPAN = "array<struct<start:int,kind:int,end:int>>"
INSIDE = ("_base", "_weak", "_key", "_found")


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value``, which is evaluated once."""
    return F.transform(F.array(value), body)[0]


def spans(
    text: Column, pattern: str, kind: int, least: int = 0, group: int = 0
) -> Column:
    """Leftmost non-overlapping matches whose ``group`` has ``least`` characters.

    The text between the matches gives their places: lengths are summed along both.
    """
    none = F.array().cast(SPAN)
    all_of = lambda g: F.regexp_extract_all(text, F.lit(pattern), F.lit(g))

    def walk(x: Column) -> Column:
        def step(state: Column, i: Column) -> Column:
            start = state["at"] + F.length(x["gaps"][i])
            end = start + F.length(x["found"][i])
            span = F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"))
            kept = F.when(
                F.length(x["values"][i]) >= least, F.concat(state["out"], F.array(span).cast(SPAN))
            ).otherwise(state["out"])
            return F.struct(end.alias("at"), kept.alias("out"))

        start = F.struct(F.lit(0).alias("at"), none.alias("out"))
        return F.aggregate(
            F.sequence(F.lit(0), F.size(x["found"]) - 1), start, step, lambda s: s["out"]
        )

    def located(found: Column) -> Column:
        values = all_of(group) if group else found
        parts = F.struct(
            found.alias("found"),
            F.split(text, pattern, -1).alias("gaps"),
            values.alias("values"),
        )
        return F.when(F.size(found) == 0, none).otherwise(bound(parts, walk))

    return bound(all_of(0), located)


def _overlaps(a: Column, b: Column) -> Column:
    return (a["start"] < b["end"]) & (b["start"] < a["end"])


def scan(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with base spans, weak candidates, and a key where these need linking."""
    value = F.coalesce(F.col(text), F.lit(""))
    base = F.concat(
        spans(value, ASSIGN, 0, LEAST_ASSIGNED, 2),
        spans(value, ACCESS, 1, LEAST_ACCESS),
        spans(value, HEX, 2),
    )
    weak = F.concat(spans(value, KEY, 3), spans(value, ENDPOINT, 4))
    free = F.filter(
        F.col("_weak"),
        lambda w: (w["kind"] == 4) | ~F.exists(F.col("_base"), lambda b: _overlaps(w, b)),
    )
    has_access = F.exists(F.col("_base"), lambda b: b["kind"] == 1)
    identity = F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("-")), F.lit(":"), value)
    return (
        docs.withColumn("_base", base)
        .withColumn("_weak", weak)
        .withColumn("_weak", F.when(has_access, free).otherwise(F.array().cast(SPAN)))
        .withColumn("_key", F.when(F.size("_weak") > 0, F.sha2(identity, 256)))
    )


def _linked(scanned: DataFrame, scope: int) -> DataFrame:
    """(_key, _found): the weak candidates whose complementary parts are in scope."""
    bin_of = lambda place: F.floor(place / F.lit(scope))
    keyed = scanned.filter("_key IS NOT NULL")
    parts = keyed.select("_key", F.explode(F.concat("_base", "_weak")).alias("p")).select(
        "_key", "p.*", bin_of(F.col("p.start")).alias("bin")
    )
    place = lambda *kinds: F.when(F.col("kind").isin(*kinds), F.col("start"))
    facts = parts.groupBy("_key", "bin").agg(
        F.min(place(1)).alias("access_first"),
        F.max(place(1)).alias("access_last"),
        F.min(place(0, 2, 3)).alias("secret_first"),
        F.max(place(0, 2, 3)).alias("secret_last"),
    )
    weak = parts.filter(F.col("kind") >= 3).withColumn(
        "bin", F.explode(F.array(F.col("bin") - 1, F.col("bin"), F.col("bin") + 1))
    )
    inside = lambda c: F.coalesce(
        F.col(c).between(F.col("start") - scope, F.col("start") + scope), F.lit(False)
    )
    judged = (
        weak.join(facts, ["_key", "bin"])
        .groupBy("_key", "start", "kind", "end")
        .agg(
            F.bool_or(inside("access_first") | inside("access_last")).alias("access"),
            F.bool_or(inside("secret_first") | inside("secret_last")).alias("secret"),
        )
    )
    kept = judged.filter(F.col("access") & ((F.col("kind") == 3) | F.col("secret")))
    return kept.groupBy("_key").agg(
        F.collect_list(F.struct("start", "kind", "end")).cast(SPAN).alias("_found")
    )


def find(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    carry: list[str] | None = None,
    scope: int = SCOPE,
) -> DataFrame:
    """The columns ``carry`` (all by default) and ``spans``, sorted by start and kind.

    The scan's result is stored once: the linking reads it without scanning the texts again.
    """
    wanted = [n for n in (docs.columns if carry is None else carry) if n.lower() != "spans"]
    # The caller's columns that are named like one used inside have another name until the end.
    clash = [n for n in docs.columns if n.lower() in INSIDE]
    plain = {n: unused(n, [*docs.columns, *INSIDE]) for n in clash}
    names = [plain.get(n, n) for n in wanted]
    scanned = scan(
        docs.withColumnsRenamed(plain), plain.get(id_col, id_col), plain.get(text, text)
    ).select(*names, "_base", "_weak", "_key")
    stored = materialize(scanned, "secrets")
    alone = stored.filter("_key IS NULL").withColumn("_found", F.array().cast(SPAN))
    linked = stored.filter("_key IS NOT NULL").join(_linked(stored, scope), "_key", "left")
    both = alone.unionByName(linked)
    every = F.array_sort(F.concat("_base", F.coalesce("_found", F.array().cast(SPAN))))
    own = [F.col(n).alias(w) for n, w in zip(names, wanted, strict=True)]
    return both.select(*own, every.alias("spans"))


def digest(found: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    name = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(
        F.transform(
            found,
            lambda s: F.concat_ws(
                ":", name[s["kind"]], s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )


def redact(text: Column, found: Column, mask: str = "[SECRET]") -> Column:
    """The text with each maximal run of overlapping spans replaced by ``mask``."""

    def step(state: Column, s: Column) -> Column:
        clear = s["start"] >= state["at"]
        before = F.substring(text, state["at"] + 1, s["start"] - state["at"])
        return F.struct(
            F.greatest(state["at"], s["end"]).alias("at"),
            F.when(clear, F.concat(state["out"], F.array(before, F.lit(mask))))
            .otherwise(state["out"])
            .alias("out"),
        )

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    end = lambda s: F.concat(
        F.array_join(s["out"], ""), F.substring(text, s["at"] + 1, F.length(text))
    )
    return F.when(F.size(found) > 0, F.aggregate(found, start, step, end)).otherwise(text)
