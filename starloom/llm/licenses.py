"""Licence notices inside documents: MinHash bands over overlapping windows.

See ``containment``. Templates are notices and grants; a document carries a
licence when it has at least 80 % of a template's five-word shingles. Windows
of a document overlap by half, those of a template begin at every shingle: a
stretch of five shared shingles, which a match always has, holds a window of
each that are equal and collide in every band. Where an edit falls into all
windows, ``b`` bands still collide with a chance of ``1 - (1 - J)**b`` for a
window pair of similarity ``J``: 94 % at 0.6 with three. Templates of under seven
shingles have windows of one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.containment import Partition, contained
from starloom.llm.registry import query, table

PLAN = (Partition(7, 4, 2, 3),)

#: Notices and grants of common licences, in their own words.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        'software and associated documentation files (the "Software"), to deal in the Software '
        "without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file '
        "except in compliance with the License. You may obtain a copy of the License at",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation, either version "
        "3 of the License, or (at your option) any later version.",
    ),
    (
        "GPL-2.0",
        "This program is free software; you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation; either version "
        "2 of the License, or (at your option) any later version.",
    ),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    (
        "CC-BY-NC-4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    (
        "CC-BY-4.0",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    (
        "BSD",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met",
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ),
)


def template_table(spark: SparkSession) -> DataFrame:
    """``(license, text)``, one row per notice; a licence may have several."""
    return spark.createDataFrame(list(TEMPLATES), "license string, text string")


def license_hits(docs: DataFrame, templates: DataFrame, **options) -> DataFrame:
    """``(doc_id, license, n_shared, n_item)``, one row per document and licence:
    the template of which most shingles are there.

    ``docs`` has ``doc_id, text``, ``templates`` has ``license, text``; further
    columns are not read. NULL, empty and wordless texts carry nothing and are
    found nowhere; repeated rows count once; a NULL doc_id is reported as NULL.
    """
    items = templates.select(F.col("license").alias("item"), "text")
    return contained(docs, items, PLAN, **options).withColumnRenamed("item", "license")


def _sql() -> str:
    quote = lambda x: "'" + x.replace("'", "''") + "'"
    rows = ",\n".join(f"({k}, {quote(a)}, {quote(t)})" for k, (a, t) in enumerate(TEMPLATES))
    return rf"""
WITH t(k, license, text) AS (VALUES {rows}),
w AS (
    SELECT kind, id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{{L}}\p{{N}}]+'),
                                 lambda x: x <> '') AS w
    FROM (SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 't', k, text FROM t)),
s AS (
    SELECT DISTINCT kind, id, unnest(CASE WHEN len(w) >= 5
        THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))
        WHEN len(w) > 0 THEN ['= ' || array_to_string(w, ' ')] ELSE [] END) AS shingle
    FROM w),
q AS (SELECT id, count(*) AS n_item FROM s WHERE kind = 't' GROUP BY id),
hit AS (
    SELECT d.id AS doc_id, b.id AS k, count(*) AS n_shared, any_value(n_item) AS n_item
    FROM s d JOIN s b ON d.shingle = b.shingle AND d.kind = 'd' AND b.kind = 't' JOIN q ON q.id = b.id
    GROUP BY d.id, b.id HAVING 100 * count(*) >= 80 * any_value(n_item))
SELECT doc_id, license, CAST(max(n_shared) AS INTEGER) AS n_shared,
       CAST(arg_min(n_item, -n_shared * 100000 + n_item) AS INTEGER) AS n_item
FROM hit JOIN t USING (k) GROUP BY doc_id, license
"""


@query("op4_license_scan", _sql())
def _(spark: SparkSession, sf: str) -> DataFrame:
    return license_hits(table(spark, sf, "documents"), template_table(spark))
