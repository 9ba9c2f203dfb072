"""Short texts contained in long ones, by MinHash of windows; SQL functions only.

Words are runs of letters and digits in lower case. A text is the sequence of
its five-word shingles (its whole word sequence is the only one if it has fewer
words), each as a 64-bit hash. Texts and items are covered by windows of
consecutive shingles; the least hash of a window, under one permutation per
band, is its key. Items are partitioned by size, and every partition has the
window that its items need: ``plan`` says which.

An item is found when a window lies wholly in a stretch that both share: equal
windows have equal keys in every band. Items whose own shingles repeat, and
those smaller than every plan, use windows of one, where the key is the shingle.

Items whose shingles are scattered over a text may share no window with it. So
each item also has its least hashes as keys, one more than it may lack (a
bottom-k MinHash): a text that has enough of the item has one of them, wherever
it stands. What is retrieved is then checked on the whole sets, and nothing that
would pass the check is left out.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.session import reliable_checkpoint

SHINGLE = 5
SPLIT = r"[^\p{L}\p{N}]+"
#: One constant per band, xor-ed to hashes: band 0 takes them as they are.
PERMUTATIONS = (0, 0x2545F4914F6CDD1D, 0x5851F42D4C957F2D, 0x369DEA0F31A53F85)


@dataclass(frozen=True)
class Partition:
    """Items of at least ``smallest`` shingles: windows of ``width`` shingles,
    begun every ``step`` in long texts and everywhere in items."""

    smallest: int
    width: int
    step: int = 1
    bands: int = 1


EXACT = Partition(0, 1)


def shingle_hashes(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` with the hashes of its shingles, in order of place, instead of the text.

    NULL, empty and wordless texts have none.
    """
    words = F.array_remove(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), SPLIT), "")
    w, n = F.col("_words"), F.size("_words")
    hashes = (
        F.when(
            n >= SHINGLE,
            F.transform(
                F.sequence(F.lit(0), n - SHINGLE),
                lambda i: F.xxhash64(*[w[i + k] for k in range(SHINGLE)]),
            ),
        )
        .when(n > 0, F.array(F.xxhash64(F.concat_ws(" ", w))))
        .otherwise(F.array().cast("array<bigint>"))
    )
    others = [F.col(c) for c in df.columns if c != text]
    return df.select(*others, words.alias("_words")).select(*others, hashes.alias(out))


def _window_keys(hashes: Column, i: Column, part: Partition, step: int) -> list[Column]:
    """Keys of the window of ``part`` that begins at ``i``; NULL where none does."""
    fits = (i + part.width <= F.size(hashes)) & (i % step == 0)
    keys = []
    for band in range(part.bands if part.width > 1 else 1):
        salt = F.lit(PERMUTATIONS[band])
        ranks = [hashes[i + k].bitwiseXOR(salt) for k in range(part.width)]
        least = F.least(*ranks) if len(ranks) > 1 else ranks[0]
        mark = (part.width * 64 + band) * 0x1D8E4E27C47D124F % (1 << 62)
        key = least.bitwiseXOR(F.lit(mark))
        if step == 1 and part.width > 1:  # say a minimum once per run of windows
            before = F.least(*[hashes[i + k - 1].bitwiseXOR(salt) for k in range(part.width)])
            key = F.when((i == 0) | (before != least), key)
        keys.append(F.when(fits, key))
    return keys


def _exploded(df: DataFrame, hashes: str, parts: Sequence[Partition], everywhere: bool) -> DataFrame:
    """A row per key of each text, with its other columns.

    Texts without shingles go at the end: a condition on them (an inner explode
    implies one) would be pushed below the hashes and compute these per element.
    """
    places = F.when(F.size(hashes) > 0, F.sequence(F.lit(0), F.size(hashes) - 1))
    at = df.select("*", F.explode_outer(places).alias("_at"))
    keys = [
        k
        for p in parts
        for k in _window_keys(F.col(hashes), F.col("_at"), p, 1 if everywhere else p.step)
    ]
    return at.select(*df.columns, F.explode(F.array(*keys)).alias("_key")).where("_key is not null")


def item_keys(
    items: DataFrame, plan: Sequence[Partition], percent: int
) -> tuple[DataFrame, list[Partition]]:
    """``(_key, item, n_item, _set)`` stored as a table, and the partitions in use.

    ``items`` has ``item`` and ``text``; an item's name may repeat, then its
    texts count one by one. Items without words are left out.
    """
    sets = shingle_hashes(items.select("item", "text"), "text", "_seq").select(
        "item", "_seq", F.array_distinct("_seq").alias("_set")
    )
    sized = sets.withColumn("n_item", F.size("_set"))
    choice = F.lit(0)
    for k, p in enumerate(plan, 1):
        choice = F.when(F.col("n_item") >= p.smallest, k).otherwise(choice)
    sized = reliable_checkpoint(
        sized.withColumn("_part", F.when(F.size("_seq") > F.col("n_item"), 0).otherwise(choice))
    ).where("n_item > 0")
    parts = [EXACT, *plan]
    used = sorted(r[0] for r in sized.select("_part").distinct().collect())
    least = F.expr(f"slice(array_sort(_set), 1, n_item - cast(ceil({percent} * n_item / 100) as int) + 1)")
    least = sized.select("item", "n_item", "_set", least.alias("_seq"))
    found = _exploded(least, "_seq", [EXACT], True)
    for k in used:
        found = found.union(_exploded(sized.where(F.col("_part") == k), "_seq", [parts[k]], True).select(*found.columns))
    found = found.select("_key", "item", "n_item", "_set").distinct()
    return reliable_checkpoint(found), [parts[k] for k in sorted({0, *used})] if used else []


def contained(
    docs: DataFrame,
    items: DataFrame,
    plan: Sequence[Partition],
    *,
    percent: int = 80,
    broadcast_bytes: int = 64 << 20,
) -> DataFrame:
    """``(doc_id, item, n_shared, n_item)`` where a document has at least
    ``percent`` of an item's distinct shingles.

    Up to ``broadcast_bytes`` of item keys with their sets (measured) are sent
    to the tasks, and documents are read once and never shuffled. Beyond it keys
    are joined by shuffle, and the documents found are read again; the result
    is the same.
    """
    keys, parts = item_keys(items, plan, percent)
    size = keys.agg(F.sum(F.size("_set") * 8 + 64)).first()[0] or 0
    docs = docs.select("doc_id", "text")
    hashed = shingle_hashes(docs, "text", "_doc")
    enough = f"100 * n_shared >= {percent} * n_item"
    if not parts:
        return keys.select(F.lit(0).cast("long").alias("doc_id"), "item", F.col("n_item").alias("n_shared"), "n_item")
    rows = _exploded(hashed, "_doc", parts, False)
    shared = F.size(F.array_intersect("_doc", "_set")).alias("n_shared")
    if size <= broadcast_bytes:
        met = rows.join(F.broadcast(keys), "_key")
        met = met.select("doc_id", "item", shared, "n_item")
    else:
        pairs = rows.select("doc_id", "_key").join(keys.select("_key", "item"), "_key")
        pairs = reliable_checkpoint(pairs.select("doc_id", "item").distinct())
        sets = keys.select("item", "n_item", "_set").distinct()
        again = shingle_hashes(docs.join(pairs.select("doc_id").distinct(), "doc_id", "left_semi"), "text", "_doc")
        met = again.join(pairs, "doc_id").join(sets, "item").select("doc_id", "item", shared, "n_item")
    return met.where(enough).groupBy("doc_id", "item").agg(
        F.max("n_shared").alias("n_shared"), F.min_by("n_item", F.struct(-F.col("n_shared"), "n_item")).alias("n_item")
    )
