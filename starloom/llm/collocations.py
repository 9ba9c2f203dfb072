"""Phrase collocations, by Rabin-Karp fingerprints of all n-grams.

Words' hashes are the digits of a prefix polynomial, so that every n-gram's
fingerprint is one subtraction of numpy arrays; a language is mixed in, so equal
phrases of two languages differ.

1. Each task sums up equal fingerprints and packs what it has, sorted, into one
   row per range of fingerprints. Ranges are as many as the input's bytes ask for;
   their rows are merged by numpy, a stretch of a range at a time. Pointers to occurrences are not
   shuffled, they would double its bytes: step 3 finds every place again.
2. Fingerprints met ``least`` times or more go into a bit filter of at
   most ``FILTER_WORDS`` words. It never misses one, so a full filter costs time
   and no result.
3. The texts are read again. Words behind equal hashes are compared byte by byte
   and numbered, so what passes the filter is counted as the phrase it is: a
   collision makes no two phrases one. Only these phrases become strings.

Nothing is kept per occurrence, no phrase gathers rows in one task, and the
number of rows per task and phrase is at most one.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.llm.registry import query, table
from starloom.llm.text import LOWER, constants, hash_runs, mix, once, slices, utf8
from starloom.session import reliable_checkpoint

LONGEST = 3  # words of a phrase
LEAST = 10  # occurrences of a candidate
TOP = 2000  # phrases per language
INSIDE = 50  # per cent of a phrase's occurrences within a longer one that drop it

RANGE_BYTES = 8 << 20  # of text per range of fingerprints
PART_BYTES = 1 << 20  # of text that numpy handles at once
TASK_GRAMS = 3_000_000  # n-grams that a task sums up at once
MERGE_GRAMS = 500_000  # of a range, merged at once
ROW_BYTES = 2 << 20  # of packed n-grams in a batch of rows
WORD_BYTES = 1 << 18  # of words compared at once
FILTER_WORDS = 1 << 22  # of 64 bits: at most 32 MB go to each task
KEYS_A_WORD = 4

#: Bytes that end a piece, and those that only part words.
BREAK = np.zeros(256, bool)
BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
GAP = np.zeros(256, bool)
GAP[[0x20, 0x09]] = True

_VALUE = constants(256, 31) * ~(BREAK | GAP)
_DIGIT = int(constants(1, 32)[0]) | 1
_FIRST = constants(LONGEST + 1, 33)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the polynomial's base and of its inverse, ``n`` at least."""
    size = 1 << max(16, int(n).bit_length())

    def build() -> tuple[np.ndarray, np.ndarray]:
        out = []
        for base in (_DIGIT, pow(_DIGIT, -1, 1 << 64)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        return out[0], out[1]

    return once(("collocation powers", size), build)


class Grams:
    """Words of several texts, and the fingerprints of their n-grams.

    ``tongue`` has a number per text for its language, ``seeds`` a hash per number.
    ``bits`` shortens fingerprints, so that tests meet collisions.
    """

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, tongue: np.ndarray, seeds: np.ndarray, bits: int = 64):
        self.raw = raw = LOWER[raw]
        ends_piece = BREAK[raw]
        inside = ~(ends_piece | GAP[raw])
        n = len(raw)
        cuts = offsets[(offsets > 0) & (offsets < n)]
        opens = inside.copy()
        opens[1:] &= ~inside[:-1]
        opens[cuts] = inside[cuts]
        closes = inside.copy()
        closes[:-1] &= ~inside[1:]
        closes[cuts - 1] = inside[cuts - 1]
        self.starts, self.ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        text = np.searchsorted(offsets, self.starts, side="right") - 1
        self.tongue = tongue[text]
        # a word's piece: breaks before it, and one more for each text
        self.piece = np.searchsorted(np.flatnonzero(ends_piece), self.starts) + text
        hashes = hash_runs(raw, self.starts, self.ends, _VALUE) if n else np.zeros(0, np.uint64)
        self.words = mix(hashes ^ seeds[self.tongue])
        up, self.down = _powers(len(self.words))
        self.sums = np.zeros(len(self.words) + 1, np.uint64)
        np.cumsum(self.words * up[: len(self.words)], out=self.sums[1:])
        self.keep = np.uint64(64 - bits)

    def places(self, n: int) -> np.ndarray:
        """First words of all n-grams, each within a piece."""
        if n == 1:
            return np.arange(len(self.piece))
        return np.flatnonzero(self.piece[n - 1 :] == self.piece[: 1 - n])

    def prints(self, n: int, at: np.ndarray) -> np.ndarray:
        """Fingerprints of the n-grams at these words."""
        sums = (self.sums[at + n] - self.sums[at]) * self.down[at]
        return mix(sums + _FIRST[n]) >> self.keep << self.keep

    def numbers(self) -> tuple[np.ndarray, np.ndarray]:
        """A number per word, equal where language and bytes are, and each number's first word.

        Equal hashes are not trusted: all bytes are compared with those of the
        first word under that hash, and words that differ get numbers of their own.
        """
        _, first, number = np.unique(self.words, return_index=True, return_inverse=True)
        size, like = self.ends - self.starts, first[number]
        wrong = (size != size[like]) | (self.tongue != self.tongue[like])
        upto = np.cumsum(size)
        a = 0
        while a < len(size):  # some words at a time: an index per byte takes eight bytes
            b = max(a + 1, int(np.searchsorted(upto, upto[a] - size[a] + WORD_BYTES, side="right")))
            some = size[a:b]
            begins = np.cumsum(some) - some
            right = np.arange(some.sum()) - np.repeat(begins, some)
            own = np.repeat(self.starts[a:b], some) + right
            other = np.minimum(np.repeat(self.starts[like[a:b]], some) + right, len(self.raw) - 1)
            differ = self.raw[own] != self.raw[other]
            if differ.any():
                wrong[a:b] |= np.add.reduceat(differ, begins, dtype=np.int64) > 0
            a = b
        extra: dict[tuple[int, bytes], int] = {}
        first = list(first)
        for k in np.flatnonzero(wrong):
            key = int(self.tongue[k]), self.raw[self.starts[k] : self.ends[k]].tobytes()
            if key not in extra:
                extra[key] = len(first)
                first.append(k)
            number[k] = extra[key]
        return number, np.array(first, np.int64)


def _parts(batches: Iterable[pa.RecordBatch], bits: int) -> Iterator[tuple[list[str], Grams]]:
    """The texts' n-grams, some megabytes at a time, and their languages."""
    for batch in batches:
        for part in slices(batch, "text", PART_BYTES):
            coded = part.column("lang").dictionary_encode()
            names = coded.dictionary.to_pylist()
            seeds = [int.from_bytes(blake2b(x.encode(), digest_size=8).digest(), "little") for x in names]
            yield names, Grams(
                *utf8(part.column("text")),
                coded.indices.to_numpy(zero_copy_only=False),
                np.array(seeds, np.uint64),
                bits,
            )


def pack(prints: np.ndarray, counts: np.ndarray) -> bytes:
    """Ascending fingerprints with their counts, as byte planes that compress well."""
    steps = np.diff(prints, prepend=np.uint64(0))
    large = np.flatnonzero(counts > 254)
    low = np.minimum(counts, 255).astype(np.uint8)
    head = np.array([len(prints), len(large)], np.int64)
    planes = steps.view(np.uint8).reshape(-1, 8).T
    return b"".join(x.tobytes() for x in (head, planes, low, counts[large].astype(np.int64)))


def unpack(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n, more = np.frombuffer(data, np.int64, 2)
    planes = np.frombuffer(data, np.uint8, 8 * n, 16).reshape(8, n)
    prints = np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64)[:, 0], dtype=np.uint64)
    counts = np.frombuffer(data, np.uint8, n, 16 + 8 * n).astype(np.int64)
    counts[counts == 255] = np.frombuffer(data[16 + 9 * n :], np.int64, more)
    return prints, counts


def _summed(prints: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(prints, kind="stable")
    prints = prints[order]
    first = np.flatnonzero(np.concatenate(([True], prints[1:] != prints[:-1])))
    return prints[first], np.add.reduceat(counts[order], first)


def _sketch(batches: Iterator[pa.RecordBatch], ranges: int, bits: int) -> Iterator[pa.RecordBatch]:
    """Rows ``(range, grams)`` of all n-grams of a task.

    A task holds ``TASK_GRAMS`` fingerprints, whatever its texts are, and no copy
    of them: they are sorted in place and counted range by range.
    """
    width = -(-(1 << 64) // ranges)
    edges = np.array([min(k * width, (1 << 64) - 1) for k in range(1, ranges)], np.uint64)

    def rows(prints: np.ndarray) -> Iterator[pa.RecordBatch]:
        prints.sort()
        cuts = [0, *np.searchsorted(prints, edges).tolist(), len(prints)]
        some, data, size = [], [], 0
        for k in range(ranges):
            own = prints[cuts[k] : cuts[k + 1]]
            if len(own):
                first = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
                some.append(k)
                data.append(pack(own[first], np.diff(first, append=len(own))))
                size += len(data[-1])
            if some and (size >= ROW_BYTES or k == ranges - 1):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(some, pa.int64()), pa.array(data, pa.binary())], ["range", "grams"]
                )
                some, data, size = [], [], 0

    held, n = np.empty(TASK_GRAMS, np.uint64), 0
    for _, grams in _parts(batches, bits):
        for k in range(1, LONGEST + 1):
            new = grams.prints(k, grams.places(k))
            while len(new):
                some = min(len(new), len(held) - n)
                held[n : n + some] = new[:some]
                new, n = new[some:], n + some
                if n == len(held):
                    yield from rows(held)
                    n = 0
    if n:
        yield from rows(held[:n])


def _frequent(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Fingerprints met ``least`` times; rows come sorted by range."""

    def merged(held: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        """Of one range, a stretch of fingerprints after the other."""
        low, high = min(int(x[0]) for x, _ in held), max(int(x[-1]) for x, _ in held)
        stretches = -(-sum(len(x) for x, _ in held) // MERGE_GRAMS)
        step = (high - low) // stretches + 1
        at = [0] * len(held)
        for k in range(1, stretches + 1):
            end = np.uint64(min(low + k * step, high))
            upto = [int(np.searchsorted(x, end, side="right" if k == stretches else "left")) for x, _ in held]
            prints = np.concatenate([x[i:j] for (x, _), i, j in zip(held, at, upto, strict=True)])
            counts = np.concatenate([x[i:j] for (_, x), i, j in zip(held, at, upto, strict=True)])
            at = upto
            if len(prints):
                prints, counts = _summed(prints, counts)
                yield pa.RecordBatch.from_arrays([pa.array(prints[counts >= least].view(np.int64))], ["print"])

    now, held = None, []
    for batch in batches:
        for k, data in zip(batch.column("range").to_pylist(), batch.column("grams"), strict=True):
            if k != now and held:
                yield from merged(held)
                held.clear()
            now = k
            held.append(unpack(data.as_buffer()))
    if held:
        yield from merged(held)


def _marks(prints: np.ndarray) -> np.ndarray:
    """The three bits a fingerprint has in its word of the filter."""
    one = np.uint64(1)
    bit = np.uint64(63)
    return one << (prints & bit) | one << (prints >> np.uint64(6) & bit) | one << (prints >> np.uint64(12) & bit)


def _filter_rows(batches: Iterator[pa.RecordBatch], shift: int) -> Iterator[pa.RecordBatch]:
    """``(word, marks)``: the words of the filter that a task's fingerprints touch."""
    for batch in batches:
        prints = np.sort(mix(batch.column("print").to_numpy().view(np.uint64)))
        if len(prints):
            word = prints >> np.uint64(shift)
            first = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            marks = np.bitwise_or.reduceat(_marks(prints), first)
            yield pa.RecordBatch.from_arrays(
                [pa.array(word[first].view(np.int64)), pa.array(marks.view(np.int64))], ["word", "marks"]
            )


def _filter(prints: DataFrame) -> tuple[np.ndarray, int]:
    """A bit filter that holds all of ``prints``, and how its words are addressed."""
    n = prints.count()
    width = min(FILTER_WORDS, max(256, 1 << (n // KEYS_A_WORD).bit_length()))
    shift = 64 - (width.bit_length() - 1)
    words = np.zeros(width, np.uint64)
    rows = (
        prints.mapInArrow(partial(_filter_rows, shift=shift), "word bigint, marks bigint")
        .groupBy("word")
        .agg(F.bit_or("marks").alias("marks"))
        .toArrow()  # `width` rows at most
    )
    words[rows["word"].to_numpy()] = rows["marks"].to_numpy().view(np.uint64)
    return words, shift


def _count(batches: Iterator[pa.RecordBatch], kept, shift: int, bits: int) -> Iterator[pa.RecordBatch]:
    """``(lang, words, phrase, n)``: phrases that pass the filter, and with no
    phrase the number of all words."""
    held = kept.value
    for names, g in _parts(batches, bits):
        if not len(g.words):
            continue
        number, first = g.numbers()
        texts = pa.array([g.raw[a:b].tobytes() for a, b in zip(g.starts[first], g.ends[first], strict=True)], pa.string())
        per = np.bincount(g.tongue, minlength=len(names))
        langs = pa.array(names, pa.string())
        some = np.flatnonzero(per)
        yield _rows(langs.take(pa.array(some)), 0, pa.nulls(len(some), pa.string()), per[some])
        before = None  # numbers of the n-grams that are one word shorter, by their first word
        for n in range(1, LONGEST + 1):
            at = g.places(n)
            last = number[at + n - 1].astype(np.int64)
            key = last if before is None else before[at] * len(first) + last
            spread = np.zeros(len(number), np.int64)
            _, one, which, many = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
            spread[at] = which
            before = spread
            heads = at[one]
            mixed = mix(g.prints(n, heads))
            marks = _marks(mixed)
            good = (held[mixed >> np.uint64(shift)] & marks) == marks
            heads, many = heads[good], many[good]
            parts = [texts.take(pa.array(number[heads + k])) for k in range(n)]
            phrase = pc.binary_join_element_wise(*parts, " ") if n > 1 else parts[0]
            yield _rows(langs.take(pa.array(g.tongue[heads])), n, phrase, many)


def _rows(langs: pa.Array, words: int, phrases: pa.Array, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [langs, pa.array(np.full(len(n), words, np.int32)), phrases, pa.array(n.astype(np.int64))],
        ["lang", "words", "phrase", "n"],
    )


def phrase_counts(docs: DataFrame, *, least: int = LEAST, bits: int = 64) -> DataFrame:
    """``(lang, words, phrase, f)``: how often each phrase of one to ``LONGEST``
    words occurs, if ``least`` times or more; and under ``words`` 0, without a
    phrase, the number of words of each language.

    ``docs`` has ``text`` and ``lang`` (NULL: ``und``). NULL and empty texts have no
    words; rows that repeat count each time; an empty table gives no rows.
    """
    spark = docs.sparkSession
    docs = docs.select(F.coalesce("text", F.lit("")).alias("text"), F.coalesce("lang", F.lit("und")).alias("lang"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(1, -(-size // RANGE_BYTES))
    sketched = docs.mapInArrow(partial(_sketch, ranges=ranges, bits=bits), "range bigint, grams binary")
    # a range per task: hashing would lay several into one
    dealt = sketched.repartitionById(ranges, F.col("range").cast("int")).sortWithinPartitions("range")
    prints = reliable_checkpoint(dealt.mapInArrow(partial(_frequent, least=least), "print bigint"))
    words, shift = _filter(prints)
    kept = spark.sparkContext.broadcast(words)
    counted = docs.mapInArrow(
        partial(_count, kept=kept, shift=shift, bits=bits), "lang string, words int, phrase string, n bigint"
    )
    summed = counted.groupBy("lang", "words", "phrase").agg(F.sum("n").alias("f"))
    return reliable_checkpoint(summed.where((F.col("f") >= least) | (F.col("words") == 0)))


def _cut(left: str, right: str) -> Column:
    """``floor(1000000 a^2 / (l r))`` in 38 digits: exact for counts under 10^15."""
    return F.expr(
        f"cast(1000000bd * cast(a as decimal(15,0)) * cast(a as decimal(15,0)) "
        f"div (cast({left} as decimal(15,0)) * cast({right} as decimal(15,0))) as bigint)"
    )


def collocations(docs: DataFrame, *, least: int = LEAST, top: int = TOP, bits: int = 64) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: each language's ``top`` phrases.

    A phrase of two or three words that occurs ``a >= least`` times scores
    ``floor(1000000 a^2 / (l r))`` at the cut into two parts, met ``l`` and ``r``
    times, that scores lowest (the earliest, if they tie). It is left out if half
    of its occurrences lie in a longer phrase. Ties in score go to the larger
    ``a``, then to the phrase that is less in UTF-8. See ``phrase_counts`` for
    NULLs, repeats and empty tables.
    """
    counts = phrase_counts(docs, least=least, bits=bits)
    totals = counts.where("words = 0").select("lang", F.col("f").alias("n"))
    known = counts.where("words > 0").select("lang", F.col("phrase").alias("part"), "f")
    found = counts.where("words > 1").select("lang", "words", "phrase", F.col("f").alias("a"))
    found = found.withColumn("w", F.split("phrase", " "))
    inner = F.array(F.expr("concat_ws(' ', w[0], w[1])"), F.expr("concat_ws(' ', w[1], w[2])"))
    longer = (
        found.where(f"words = {LONGEST}")
        .select("lang", F.col("a").alias("held"), F.explode(inner).alias("phrase"))
        .groupBy("lang", "phrase")
        .agg(F.max("held").alias("held"))
    )
    two = found.where("words = 2").join(longer, ["lang", "phrase"], "left")
    two = two.where(f"held is null or 100 * held < {INSIDE} * a").select("lang", "phrase", "a", "w")
    three = found.where(f"words = {LONGEST}").select("lang", "phrase", "a", "w")

    def slots(df: DataFrame, **parts: str) -> DataFrame:
        each = [F.struct(F.lit(k).alias("slot"), F.expr(x).alias("part")) for k, x in parts.items()]
        return df.select("lang", "phrase", "a", F.inline(F.array(*each)))

    looked = slots(two, l1="w[0]", r1="w[1]").union(
        slots(three, l1="w[0]", r1="concat_ws(' ', w[1], w[2])", l2="concat_ws(' ', w[0], w[1])", r2="w[2]")
    )
    met = reliable_checkpoint(looked.join(known, ["lang", "part"]))
    sides = [F.max(F.when(F.col("slot") == s, F.col("f"))).alias(s) for s in ("l1", "r1", "l2", "r2")]
    scored = met.groupBy("lang", "phrase", "a").agg(*sides)
    scored = scored.withColumns({"s1": _cut("l1", "r1"), "s2": _cut("l2", "r2")})
    late = F.coalesce(F.col("s2") < F.col("s1"), F.lit(False))
    scored = scored.select(
        "lang",
        "phrase",
        "a",
        *[F.when(late, F.col(f"{c}2")).otherwise(F.col(f"{c}1")).alias(c) for c in "lr"],
        F.when(late, F.col("s2")).otherwise(F.col("s1")).alias("score"),
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.join(totals, "lang").select(
        "lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", "score"
    )


SQL = r"""
WITH pieces AS (
    SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece
    FROM (SELECT coalesce(lang, 'und') AS lang,
                 translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
          FROM documents)),
words AS (
    SELECT lang, list_filter(regexp_split_to_array(piece, '[ \x09]+'), lambda x: x <> '') AS w FROM pieces),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang),
grams AS (
    SELECT lang, unnest(w) AS phrase, 1 AS k FROM words
    UNION ALL SELECT lang, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i+1])), 2 FROM words
    UNION ALL SELECT lang, unnest(list_transform(range(1, len(w) - 1),
                                  lambda i: w[i] || ' ' || w[i+1] || ' ' || w[i+2])), 3 FROM words),
f AS (SELECT lang, phrase, k, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 10),
parts AS (SELECT lang, phrase, k, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
longer AS (
    SELECT lang, phrase, max(a) AS held
    FROM (SELECT lang, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS phrase, a FROM parts WHERE k = 3)
    GROUP BY ALL),
kept AS (
    SELECT p.* FROM parts p LEFT JOIN longer h ON p.lang = h.lang AND p.phrase = h.phrase
    WHERE p.k = 3 OR h.held IS NULL OR 100 * h.held < 50 * p.a),
cuts AS (
    SELECT lang, phrase, a, 1 AS cut, w[1] AS lp, array_to_string(w[2:], ' ') AS rp FROM kept
    UNION ALL SELECT lang, phrase, a, 2, w[1] || ' ' || w[2], w[3] FROM kept WHERE k = 3),
scored AS (
    SELECT c.lang, c.phrase, c.a, c.cut, x.f AS l, y.f AS r,
           CAST((1000000::HUGEINT * c.a * c.a) // (x.f::HUGEINT * y.f) AS BIGINT) AS score
    FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = c.lp JOIN f y ON y.lang = c.lang AND y.phrase = c.rp),
lowest AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""


@query("op11_collocations", SQL)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return collocations(table(spark, sf, "documents"))
