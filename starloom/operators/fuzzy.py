"""Texts matched to the listed spelling that is fewest edits away."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.operators.categorize import categorize
from starloom.operators.joins import keys_match
from starloom.operators.keys import first_per_group, with_scalar

#: Letters of a piece that texts are compared by.
Q = 2
#: Edits a text may be away: from so many characters on, so many.
ALLOWED = ((0, 0), (4, 1), (7, 2))


def _edits_for(length: Column, allowed: Sequence[tuple[int, int]]) -> Column:
    out = F.lit(0)
    for least, edits in sorted(allowed):
        out = F.when(length >= least, edits).otherwise(out)
    return out


def _pieces(text: Column) -> Column:
    """All runs of ``Q`` characters with those at the ends, numbered where they repeat."""
    padded = F.concat(F.lit("\x02" * (Q - 1)), text, F.lit("\x03" * (Q - 1)))
    runs = F.transform(
        F.sequence(F.lit(1), F.length(text) + Q - 1), lambda i: F.substr(padded, i, F.lit(Q))
    )
    return F.transform(
        runs,
        lambda run, i: F.concat(
            F.size(F.filter(F.slice(runs, 1, i), lambda r: r == run)).cast("string"), run
        ),
    )


def _prefixes(texts: DataFrame, often: DataFrame) -> DataFrame:
    """``(text, length, edits, piece)``: each text's rarest pieces, one more than its
    edits can spoil, and an empty one if they can spoil all."""
    every = texts.select("text", "length", "edits", F.explode(_pieces(F.col("text"))).alias("piece"))
    known = often.select(F.col("piece").alias("_piece"), "often")
    ranked = every.join(known, keys_match(every, [("piece", "_piece")]), "left")
    order = Window.partitionBy("text").orderBy(F.coalesce("often", F.lit(0)), "piece")
    chosen = ranked.withColumn("place", F.row_number().over(order)).where(
        F.col("place") <= Q * F.col("edits") + 1
    )
    hopeless = texts.where(F.col("length") + Q - 1 <= Q * F.col("edits"))
    columns = ["text", "length", "edits", "piece"]
    return chosen.select(*columns).unionByName(hopeless.withColumn("piece", F.lit("")).select(*columns))


def nearest_spelling(
    texts: DataFrame,
    spellings: DataFrame,
    *,
    allowed: Sequence[tuple[int, int]] = ALLOWED,
) -> DataFrame:
    """``(text, value, edits)``: for each distinct text the spelling fewest edits away.

    ``texts`` and ``spellings`` have one column each. How many edits a text may be
    away depends on its length, see ``ALLOWED``; texts without such a spelling,
    and NULLs, are not in the result. Ties go to the spelling least in order.

    Two texts ``d`` edits apart differ in at most ``Q d`` pieces each, so among each
    one's ``Q d + 1`` rarest (in one order for both) there is a common one. Only
    pairs with a common rare piece and fitting lengths are compared. Texts longer
    than any spelling can be are left out before they are taken apart.
    """
    most = max(edits for _, edits in allowed)
    value = F.col(spellings.columns[0])
    listed = spellings.select(value.alias("text")).where("text is not null").distinct()
    listed = listed.withColumn("length", F.length("text")).withColumn("edits", F.lit(most))
    longest = listed.agg(F.coalesce(F.max("length"), F.lit(-1)).alias("_longest"))
    asked = texts.select(F.col(texts.columns[0]).alias("text")).where("text is not null").distinct()
    asked = asked.withColumn("length", F.length("text"))
    asked = asked.withColumn("edits", _edits_for(F.col("length"), allowed))
    asked = with_scalar(asked, longest).where(F.col("length") <= F.col("_longest") + F.col("edits"))
    often = listed.select(F.explode(_pieces(F.col("text"))).alias("piece")).groupBy("piece").agg(
        F.count(F.lit(1)).alias("often")
    )
    left = _prefixes(asked, often)
    right = _prefixes(listed, often).select(
        F.col("piece").alias("_piece"), F.col("text").alias("value"), F.col("length").alias("_length")
    )
    near = F.abs(F.col("length") - F.col("_length")) <= F.col("edits")
    pairs = left.join(right, keys_match(left, [("piece", "_piece")]) & near)
    pairs = pairs.select("text", "value", F.col("edits").alias("may")).distinct()
    away = F.levenshtein("text", "value", most)
    close = pairs.withColumn("edits", away).where((F.col("edits") >= 0) & (F.col("edits") <= F.col("may")))
    return first_per_group(close, ["text"], ["edits", "value"]).select("text", "value", "edits")


def fuzzy_categorize(
    df: DataFrame,
    col: str,
    mapping: Mapping[str, Iterable[str]] | DataFrame,
    *,
    out: str = "category",
    normalize: Callable[[Column], Column] | None = None,
    default: str = "Uncategorized",
    allowed: Sequence[tuple[int, int]] = ALLOWED,
) -> DataFrame:
    """``categorize`` for texts with typing errors.

    A text that is listed gets its category as there; another gets that of the
    nearest spelling, if one is near enough.
    """
    if isinstance(mapping, DataFrame):
        spellings = mapping.select("value")
    else:
        rows = [(v,) for values in mapping.values() for v in values]
        spellings = df.sparkSession.createDataFrame(rows, "value string")
    text = F.col(col) if normalize is None else normalize(F.col(col))
    keyed = df.withColumn("_as", text)
    spelled = nearest_spelling(keyed.select("_as"), spellings, allowed=allowed)
    spelled = spelled.select(F.col("text").alias("_spelled"), F.col("value").alias("_meant"))
    meant = keyed.join(spelled, keys_match(keyed, [("_as", "_spelled")]), "left")
    meant = meant.select(*df.columns, F.coalesce("_meant", "_as").alias("_as"))
    return categorize(meant, "_as", mapping, out=out, default=default).drop("_as")
