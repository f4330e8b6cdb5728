"""Queries of the consolidation family: file ids and collision-free names."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixtures import Fixtures
from ..functions.names import file_id
from ..operators.consolidate import allocate_names
from .q_intake import ext_sql, stem_sql
from .registry import query


@query("file_ids", """
SELECT ord, md5(path || '_' || CAST(mtime_us AS VARCHAR) || '_' || CAST(size AS VARCHAR)) AS file_id FROM manifest""",
       ("manifest",))
def q_file_ids(spark, sf):
    m = Fixtures(spark, sf)["manifest"]
    return m.select("ord", file_id(F.col("path"), F.col("mtime_us"), F.col("size")).alias("file_id"))


@query("allocate_names", f"""
WITH f AS (SELECT ord, name, row_number() OVER (PARTITION BY name ORDER BY ord) - 1 AS j,
                  count(*) OVER (PARTITION BY name) AS n FROM manifest),
nm AS (SELECT DISTINCT name, n FROM f),
slots AS (SELECT name, unnest(range(0, n + (SELECT count(*) FROM existing_names) + 1)) AS slot FROM nm),
named AS (SELECT name, slot, CASE WHEN slot = 0 THEN name
                 ELSE {stem_sql('name')} || '_' || CAST(slot AS VARCHAR) || {ext_sql('name')} END AS target FROM slots),
free AS (SELECT name, target, row_number() OVER (PARTITION BY name ORDER BY slot) - 1 AS j
         FROM named WHERE target NOT IN (SELECT name FROM existing_names))
SELECT f.ord, f.name, free.target AS target_name FROM f JOIN free ON f.name = free.name AND f.j = free.j""",
       ("manifest", "existing_names"))
def q_allocate_names(spark, sf):
    fx = Fixtures(spark, sf)
    return allocate_names(fx["manifest"].select("ord", "name"), fx["existing_names"]).select("ord", "name", "target_name")


@query("allocate_names_overwrite", """
SELECT ord, name, name AS target_name, ord <> max(ord) OVER (PARTITION BY name) AS overwritten FROM manifest""",
       ("manifest",))
def q_allocate_names_overwrite(spark, sf):
    fx = Fixtures(spark, sf)
    return allocate_names(fx["manifest"].select("ord", "name"), overwrite=True)\
        .select("ord", "name", "target_name", "overwritten")

