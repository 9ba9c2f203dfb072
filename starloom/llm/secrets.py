"""Secrets in texts, and multipart credentials by interval joins; SQL functions only.

Base kinds are found by pattern. Parts that mean little alone are candidates:
access identifiers too short for the base kind, opaque strings of forty
characters, and endpoints. A candidate is reported only if a part that
completes it (``COMPLEMENTS``) begins within ``SCOPE`` characters of it.

The join by scope does not pair parts off. Places are cut into intervals as long
as the scope; per text, interval and kind only the first and the last part are
kept. A part in the same interval is within the scope in any case, of the next
interval only the first, of the one before only the last can be the nearest: a
candidate meets three rows per kind at most, however many parts there are.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.registry import query, table
from starloom.session import reliable_checkpoint

#: Patterns of the base kinds, the length that counts, its group.
BASE = (
    (
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        8,
    ),
    ("access", r"AKIA[A-Z0-9]+", 0, 16),
    ("hex", r"[0-9a-f]+", 0, 32),
)
#: The hex runs that count, found at once: shorter ones cannot overlap them.
AT_ONCE = {"hex": r"[0-9a-f]{32,}+"}
CANDIDATES = (
    ("access_part", r"AKIA[A-Z0-9]{8,11}(?![A-Z0-9])"),
    ("key_part", r"(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=])"),
    ("endpoint", r"https?://[A-Za-z0-9.-]+(?::[0-9]+)?"),
)
KINDS = tuple(k for k, *_ in BASE) + tuple(k for k, _ in CANDIDATES)
#: What must be near a candidate of each kind.
COMPLEMENTS = {
    "access_part": ("key_part", "assign"),
    "key_part": ("access", "access_part"),
    "endpoint": ("access", "assign", "key_part"),
}
SCOPE = 256

SPAN = "struct<start:bigint,kind:int,end:bigint>"


#: Elements summed up one by one; longer arrays are gone through in such blocks.
BLOCK = 128
#: Characters of the pieces that a text is cut into before it is masked.
PIECE = 512


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often it occurs there."""
    return F.get(F.transform(F.array(value), body), 0)


def _before(values: Column, add: Callable[[Column, Column], Column]) -> Column:
    """For each number of an array what ``add`` makes of 0 and all before it.

    Blocks are summed up first, so the work is in proportion to the array times
    ``BLOCK``, not to its square.
    """

    def total(part: Column) -> Column:
        return F.aggregate(part, F.lit(0).cast("bigint"), add)

    def within(all_: Column, sums: Column) -> Column:
        ahead = F.transform(sums, lambda _, b: total(F.slice(sums, 1, b)))
        return _let(
            ahead,
            lambda starts: F.transform(
                all_,
                lambda _, i: add(
                    F.get(starts, F.floor(i / BLOCK).cast("int")),
                    total(F.slice(all_, i - i % BLOCK + 1, i % BLOCK)),
                ),
            ),
        )

    blocks = lambda v: F.sequence(F.lit(0), F.floor((F.size(v) - 1) / BLOCK).cast("int"))
    sums = lambda v: F.transform(blocks(v), lambda b: total(F.slice(v, b * BLOCK + 1, F.lit(BLOCK))))
    some = _let(values, lambda v: _let(sums(v), lambda t: within(v, t)))
    return F.when(F.size(values) > 0, some).otherwise(F.array().cast("array<bigint>"))


def _spans(text: Column, kind: str, pattern: str, group: int, least: int) -> Column:
    """Spans of the matches whose group has ``least`` characters; places are in code points.

    What lies between the matches is what splitting leaves, so that adding up
    the lengths of both gives the places.
    """
    number = KINDS.index(kind)
    pieces = F.split(text, pattern, -1)
    wholes = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else wholes
    lengths = F.transform(
        F.arrays_zip(pieces.alias("gap"), wholes.alias("whole"), parts.alias("part")),
        lambda r: F.struct(
            F.length(r["gap"]).cast("bigint").alias("gap"),
            F.coalesce(F.length(r["whole"]), F.lit(0)).cast("bigint").alias("whole"),
            F.coalesce(F.length(r["part"]), F.lit(-1)).alias("part"),
        ),
    )

    def placed(rows: Column) -> Column:
        steps = F.transform(rows, lambda r: r["gap"] + r["whole"])
        every = F.zip_with(
            rows,
            _before(steps, lambda a, b: a + b),
            lambda r, at: F.struct(
                (at + r["gap"]).alias("start"),
                F.lit(number).alias("kind"),
                (at + r["gap"] + r["whole"]).alias("end"),
                r["part"].alias("part"),
            ),
        )
        good = F.filter(every, lambda s: s["part"] >= least)
        return F.transform(good, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))

    return F.when(F.regexp(text, F.lit(pattern)), _let(lengths, placed)).otherwise(
        F.array().cast(f"array<{SPAN}>")
    )


def _labels(spans: Column) -> Column:
    """``kind:start:end`` of spans by start, then kind, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            F.array_sort(spans),
            lambda s: F.concat_ws(
                ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )


def _linked(found: DataFrame) -> DataFrame:
    """``(_row, linked)``: the candidates of each text that have a complement in scope."""
    parts = found.select(
        "_row", F.explode(F.concat("base", "weak")).alias("s")
    ).select("_row", "s", (F.col("s.start") / SCOPE).cast("bigint").alias("cell"))
    ends = parts.groupBy("_row", "cell", F.col("s.kind").alias("other")).agg(
        F.min("s.start").alias("low"), F.max("s.start").alias("high")
    )
    ends = ends.select(
        "_row", "other", "low", "high", F.explode(F.expr("array(cell - 1, cell, cell + 1)")).alias("cell")
    )
    fits = reduce(
        lambda a, b: a | b,
        [
            (F.col("s.kind") == KINDS.index(k)) & F.col("other").isin([KINDS.index(o) for o in others])
            for k, others in COMPLEMENTS.items()
        ],
    )
    near = (F.abs(F.col("low") - F.col("s.start")) <= SCOPE) | (
        F.abs(F.col("high") - F.col("s.start")) <= SCOPE
    )
    weak = parts.where(F.col("s.kind") >= len(BASE))
    return (
        weak.join(ends, ["_row", "cell"])
        .where(fits & near)
        .groupBy("_row")
        .agg(F.collect_set("s").alias("linked"))
    )


def scan(docs: DataFrame, column: str = "text") -> DataFrame:
    """``docs`` without ``column``, with ``base`` and ``linked``: arrays of spans
    ``(start, kind, end)``, ``kind`` being a number in ``KINDS``.

    NULL and empty texts have no spans; rows that repeat are scanned one by one
    and all returned. Columns named ``base``, ``linked``, ``weak`` or ``_row`` are
    replaced. Texts are read once; the spans are stored, and the join by scope
    reads those texts' rows alone that have a candidate.
    """
    others = [c for c in docs.columns if c not in (column, "base", "linked", "weak", "_row")]
    text = F.coalesce(F.col(column), F.lit(""))
    base = F.concat(
        *[_spans(text, k, AT_ONCE.get(k, p), group, least) for k, p, group, least in BASE]
    )
    weak = F.concat(*[_spans(text, k, p, 0, 1) for k, p in CANDIDATES])
    found = reliable_checkpoint(
        docs.select(
            *others,
            F.monotonically_increasing_id().alias("_row"),
            base.alias("base"),
            weak.alias("weak"),
        )
    )
    linked = _linked(found.where(F.size("weak") > 0))
    joined = found.where(F.size("weak") > 0).join(linked, "_row", "left")
    none = F.array().cast(f"array<{SPAN}>")
    with_weak = joined.select(*others, "base", F.coalesce("linked", none).alias("linked"))
    return found.where(F.size("weak") == 0).select(*others, "base", none.alias("linked")).union(
        with_weak
    )


def report(docs: DataFrame) -> DataFrame:
    """Per document how many spans of each base kind there are, the digest of the
    base spans, and all spans."""

    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    counts = [count(n).alias(f"n_{k}") for n, (k, *_) in enumerate(BASE)]
    return scan(docs.select("doc_id", "text")).select(
        "doc_id",
        *counts,
        F.sha2(_labels(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        _labels(F.concat("base", "linked")).alias("spans"),
    )


MASK = "[secret]"


def masked(docs: DataFrame) -> DataFrame:
    """``docs`` with every span of ``scan`` in ``text`` replaced by ``MASK``; spans
    that overlap become one. Texts without a span, NULL ones too, stay as they are.

    ``n_chars``, if there is one, is set to the new length where a text changed.
    Rows are masked on their way, none is dropped.
    """
    names = docs.columns
    packed = docs.select(F.col("text"), F.struct("*").alias("_all"))
    found = scan(packed.select("_all", F.col("text")))
    text = F.col("_all.text")
    spans = F.array_sort(F.concat("base", "linked"))

    def cut(pieces: Column, begin: Column, end: Column) -> Column:
        """The text between two places, from the pieces that hold it."""
        first = F.floor(begin / PIECE).cast("int")
        some = F.array_join(F.slice(pieces, first + 1, F.floor(end / PIECE).cast("int") - first + 1), "")
        return F.substr(some, (begin % PIECE + 1).cast("int"), (end - begin).cast("int"))

    def without(held: Column) -> Column:
        pieces, own = held["pieces"], held["spans"]
        ends = _before(F.transform(own, lambda s: s["end"]), lambda a, b: F.greatest(a, b))
        places = F.zip_with(own, ends, lambda s, at: F.struct(s["start"].alias("start"), at.alias("at")))
        apart = F.filter(places, lambda p: p["start"] >= p["at"])
        masked_ = F.transform(apart, lambda p: F.concat(cut(pieces, p["at"], p["start"]), F.lit(MASK)))
        rest = cut(pieces, F.array_max(F.transform(own, lambda s: s["end"])), held["length"])
        return F.concat(F.array_join(masked_, ""), rest)

    changed = F.size(spans) > 0
    held = F.struct(
        F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0)).alias("pieces"),
        spans.alias("spans"),
        F.length(text).cast("bigint").alias("length"),
    )
    new = F.when(changed, _let(held, without)).otherwise(text)
    out = found.select("_all", new.alias("_new"), changed.alias("_changed"))
    column = {"text": F.col("_new")}
    if "n_chars" in names:
        kind = docs.schema["n_chars"].dataType
        column["n_chars"] = F.when(F.col("_changed"), F.length("_new").cast(kind)).otherwise(
            F.col("_all.n_chars")
        )
    return out.select(*[column.get(c, F.col(f"_all.`{c}`")).alias(c) for c in names])


@query("op9_secret_scan")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return report(table(spark, sf, "documents"))
