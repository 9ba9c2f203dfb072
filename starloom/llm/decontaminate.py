"""Benchmark items inside documents: size-partitioned MinHash containment search.

See ``containment``. An item counts as leaked into a document that has at least
80 % of its five-word shingles. Losing a fifth of ``q`` shingles leaves a
stretch of ``0.8 q`` of them (an edit inside costs four or more), from 20 on of
eight: the windows below lie within it. Items scattered more than an edit
scatters them are found by their least hashes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.containment import Partition, contained
from starloom.llm.registry import query, table

PLAN = (Partition(3, 2), Partition(5, 4), Partition(10, 8))


def leaks(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``(doc_id, item_id, n_shared, n_item)``, one row per document and item found.

    ``docs`` has ``doc_id, text``, ``benchmark`` has ``item_id, text``; further
    columns are not read. NULL, empty and wordless texts contain nothing and are
    found nowhere; items of under five words are found in documents of just these
    words. Repeated rows count once; a NULL doc_id or item_id is reported as NULL.
    Letter case, punctuation and white space make no difference.
    """
    items = benchmark.select(F.col("item_id").alias("item"), "text")
    return contained(docs, items, PLAN, **options).withColumnRenamed("item", "item_id")


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item."""
    return docs.join(leaks(docs, benchmark).select("doc_id").distinct(), "doc_id", "left_anti")


SQL = r"""
WITH w AS (
    SELECT kind, id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'),
                                 lambda x: x <> '') AS w
    FROM (SELECT 'd' AS kind, doc_id AS id, text FROM documents
          UNION ALL SELECT 'b', item_id, text FROM benchmark)),
s AS (
    SELECT DISTINCT kind, id, unnest(CASE WHEN len(w) >= 5
        THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))
        WHEN len(w) > 0 THEN ['= ' || array_to_string(w, ' ')] ELSE [] END) AS shingle
    FROM w),
q AS (SELECT id, count(*) AS n_item FROM s WHERE kind = 'b' GROUP BY id)
SELECT d.id AS doc_id, b.id AS item_id, CAST(count(*) AS INTEGER) AS n_shared,
       CAST(any_value(n_item) AS INTEGER) AS n_item
FROM s d JOIN s b ON d.shingle = b.shingle AND d.kind = 'd' AND b.kind = 'b' JOIN q ON q.id = b.id
GROUP BY d.id, b.id HAVING 100 * count(*) >= 80 * any_value(n_item)
"""


@query("op3_decontaminate", SQL)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return leaks(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
