"""URL filters: listed rules, and association rules mined from labelled URLs.

A URL is a set of tokens: the ends of its host (``h:net``, ``h:example.net``), the
segments of its path (``p:en``), the extension of the last one (``x:html``) and the
keys of its query (``q:page``). Spark's FP-growth counts the token sets of labelled
URLs together with their label; a set that at least ``SUPPORT`` of them (and
``SUPPORT_ROWS``) have with the label becomes a rule if ``CONFIDENCE`` of those that
have the set have the label, more than of all URLs, and if no rule of one token
less says so as surely. Tokens that occur in just the same URLs are one token for
the miner, so that fixed frames of long paths do not multiply its sets.

Listed and mined rules stand in one inverted index under one token each: a listed
rule under its host, a mined one under its rarest token. Distinct URLs meet only
the rules under their own tokens, by a join; nothing depends on how many rules
there are. The longest listed rule that fits decides, else the surest mined one,
else a URL is allowed.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.registry import query, table
from starloom.operators.joins import keys_match
from starloom.operators.keys import with_scalar
from starloom.session import reliable_checkpoint

SUPPORT = 0.001  # of all labelled URLs
SUPPORT_ROWS = 20
CONFIDENCE = 0.8
HOST_LABELS = 3  # ends of a host that are mined

BLOCK, ALLOW = "block", "allow"


@dataclass(frozen=True)
class UrlRule:
    """A verdict on a host, its subdomains, and the paths that begin with ``path``."""

    verdict: str
    host: str
    path: str


#: The listed rules.
RULES = (
    UrlRule(BLOCK, "net", "/"),
    UrlRule(ALLOW, "example.net", "/en/"),
    UrlRule(BLOCK, "example.com", "/de/"),
    UrlRule(ALLOW, "org", "/fr/"),
)

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty without one, and for NULL."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def host(url: Column) -> Column:
    return F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), _UPPER, _UPPER.lower())


def path(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def tokens(url: Column, labels: int = HOST_LABELS) -> Column:
    """The URL's tokens, each once; ``labels`` bounds the ends of the host."""
    parts = F.split(host(url), r"\.")
    n = F.size(parts)
    ends = F.transform(
        F.sequence(F.lit(1), F.least(n, F.lit(labels))),
        lambda k: F.concat(F.lit("h:"), F.array_join(F.slice(parts, n - k + 1, k), ".")),
    )
    segments = F.filter(F.split(path(url), "/"), lambda s: s != "")
    last = F.element_at(F.split(path(url), "/"), -1)
    extension = F.regexp_extract(last, r"\.([A-Za-z0-9]+)$", 1)
    asked = F.regexp_extract(_rest(url), r"^[^?#]*\?([^#]*)", 1)
    keys = F.filter(F.transform(F.split(asked, "&"), lambda x: F.split(x, "=")[0]), lambda s: s != "")
    found = F.concat(
        F.when(host(url) != "", ends).otherwise(F.array().cast("array<string>")),
        F.transform(segments, lambda s: F.concat(F.lit("p:"), s)),
        F.when(extension != "", F.array(F.concat(F.lit("x:"), extension))).otherwise(
            F.array().cast("array<string>")
        ),
        F.transform(keys, lambda s: F.concat(F.lit("q:"), s)),
    )
    return F.array_distinct(found)


_MINED = "verdict string, tokens array<string>, confidence double, support bigint, token string"


def mine(
    labelled: DataFrame,
    *,
    support: float = SUPPORT,
    support_rows: int = SUPPORT_ROWS,
    confidence: float = CONFIDENCE,
) -> DataFrame:
    """``(verdict, tokens, confidence, support, token)``: rules for ``labelled``, rows
    ``(url, verdict)``; ``token`` is the one the rule is found by.

    Every row counts, repeated ones as often as they occur. Rows whose URL has no
    token count among all. NULL verdicts are left out; without rows there are no rules.
    """
    spark = labelled.sparkSession
    rows = labelled.where("verdict is not null").select(
        F.concat(F.lit("="), "verdict").alias("label"),
        tokens(F.col("url")).alias("tokens"),
        F.xxhash64("url", F.monotonically_increasing_id()).alias("row"),
    )
    rows = reliable_checkpoint(rows)
    n = rows.count()
    least = max(support_rows, -int(-support * n // 1))
    if n < least:
        return spark.createDataFrame([], _MINED)
    # At most tokens-per-URL / support tokens are frequent, whatever the input.
    frequent = (
        rows.select("row", F.explode("tokens").alias("token"))
        .groupBy("token")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("row").cast("decimal(20,0)")).alias("urls"))
        .where(F.col("n") >= least)
        .groupBy("n", "urls")
        .agg(F.max(F.struct(F.length("token"), "token"))["token"].alias("token"))
    )
    frequent = reliable_checkpoint(frequent)
    known = frequent.agg(F.collect_list("token").alias("_known"))
    baskets = with_scalar(rows, known).select(
        F.concat(F.array_intersect("tokens", "_known"), F.array("label")).alias("items")
    )
    sets = FPGrowth(itemsCol="items", minSupport=(least - 0.5) / n).fit(baskets).freqItemsets
    sets = reliable_checkpoint(sets.select(F.array_sort("items").alias("items"), "freq"))
    is_label = lambda x: F.startswith(x, F.lit("="))
    # The label sorts before all tokens.
    with_label = sets.where(is_label(F.col("items")[0])).select(
        F.substr(F.col("items")[0], F.lit(2)).alias("verdict"),
        F.slice("items", 2, 1 << 20).alias("tokens"),
        F.col("freq").alias("support"),
    )
    plain = sets.where(~is_label(F.col("items")[0])).select(F.col("items").alias("tokens"), F.col("freq").alias("had"))
    base = with_label.where("size(tokens) = 0").select("verdict", (F.col("support") / n).alias("base"))
    rules = (
        with_label.where("size(tokens) > 0")
        .join(plain, "tokens")
        .join(base, "verdict")
        .withColumn("confidence", F.col("support") / F.col("had"))
        .where((F.col("confidence") >= confidence) & (F.col("confidence") > F.col("base")))
    )
    rules = reliable_checkpoint(rules.select("verdict", "tokens", "confidence", "support"))
    shorter = rules.select("verdict", F.col("tokens").alias("part"), F.col("confidence").alias("sure"))
    parts = rules.where("size(tokens) > 1").select(
        "verdict",
        "tokens",
        "confidence",
        F.explode(F.expr("transform(tokens, t -> array_remove(tokens, t))")).alias("part"),
    )
    needless = parts.join(shorter, ["verdict", "part"]).where("sure >= confidence").select("verdict", "tokens").distinct()
    rarity = frequent.select("token", "n")
    return (
        rules.join(needless, ["verdict", "tokens"], "left_anti")
        .withColumn("token", F.explode("tokens"))
        .join(rarity, "token")
        .groupBy("verdict", "tokens", "confidence", "support")
        .agg(F.min_by("token", F.struct("n", "token")).alias("token"))
    )


def listed(spark: SparkSession, rules: Sequence[UrlRule]) -> DataFrame:
    """Listed rules as ``(verdict, host, path)``."""
    return spark.createDataFrame([(r.verdict, r.host, r.path) for r in rules], "verdict string, host string, path string")


def judge(pages: DataFrame, rules: DataFrame, mined: DataFrame) -> DataFrame:
    """``(page_id, host, path, rule, verdict, tokens, confidence)``, a row for every page.

    ``pages`` has ``page_id, url``, ``rules`` what ``listed`` gives, ``mined`` what
    ``mine`` gives; further columns are not read. ``rule`` is the listed rule that
    decides, else NULL; ``tokens`` and ``confidence`` are those of a mined rule that
    decides, else NULL. A NULL URL or one without ``://`` has an empty host and path
    and is allowed. Repeated rows and NULL ids are judged like others. Of several
    mined rules the one of the largest confidence decides, then the larger support,
    then the fewer tokens, then ``block``, then the last in order of tokens.
    """
    pages = pages.select("page_id", "url")
    urls = pages.where("url is not null").select("url").distinct()
    deepest = rules.agg(F.max(F.size(F.split("host", r"\.")))).first()[0] or 0
    seen = urls.select(
        "url",
        host(F.col("url")).alias("host"),
        path(F.col("url")).alias("path"),
        tokens(F.col("url")).alias("tokens"),
        tokens(F.col("url"), max(HOST_LABELS, deepest)).alias("all"),
    )
    index = rules.select(
        F.concat(F.lit("h:"), "host").alias("token"),
        "verdict",
        F.concat("host", "path").alias("rule"),
        F.col("path").alias("begins"),
        F.lit(None).cast("array<string>").alias("needs"),
        F.lit(None).cast("double").alias("confidence"),
        F.lit(None).cast("bigint").alias("support"),
    ).unionByName(
        mined.select(
            "token",
            "verdict",
            F.lit(None).cast("string").alias("rule"),
            F.lit(None).cast("string").alias("begins"),
            F.col("tokens").alias("needs"),
            "confidence",
            "support",
        )
    )
    index = reliable_checkpoint(index)
    met = seen.withColumn("token", F.explode("all")).join(index, "token")
    fits = F.when(F.col("rule").isNotNull(), F.startswith("path", "begins")).otherwise(
        F.size(F.array_except("needs", "tokens")) == 0
    )
    order = F.struct(
        F.coalesce(F.length("rule"), F.lit(0)),
        "confidence",
        "support",
        -F.size("needs"),
        "verdict",
        "rule",
        "needs",
    )
    best = met.where(fits).groupBy("url").agg(F.max_by(F.struct("rule", "verdict", "needs", "confidence"), order).alias("best"))
    best = reliable_checkpoint(best.select(F.col("url").alias("_url"), "best"))
    return pages.join(best, keys_match(pages, [("url", "_url")]), "left").select(
        "page_id",
        host(F.col("url")).alias("host"),
        path(F.col("url")).alias("path"),
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(ALLOW)).alias("verdict"),
        F.col("best.needs").alias("tokens"),
        F.col("best.confidence").alias("confidence"),
    )


def page_labels(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """``(url, verdict)`` of labelled pages: ``block`` where a label says bad quality
    or toxic. A page's labels are those under its page_id."""
    bad = F.max(F.when(F.expr("quality <=> 0 or toxic <=> 1"), 1).otherwise(0))
    known = labels.where("quality is not null or toxic is not null").groupBy("doc_id").agg(bad.alias("bad"))
    return pages.join(known, keys_match(pages, [("page_id", "doc_id")])).select(
        "url", F.when(F.col("bad") == 1, BLOCK).otherwise(ALLOW).alias("verdict")
    )


@query("op13_url_filter")
def _(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages").select("page_id", "url")
    mined = reliable_checkpoint(mine(page_labels(pages, table(spark, sf, "labels"))))
    return judge(pages, listed(spark, RULES), mined)
