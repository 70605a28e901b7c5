"""Payloads of any shape as VARIANT columns: nothing has to be known of them before they are read.

A payload is kept as it came; a path that isn't there, or holds something else than was asked for, is null. Text that
doesn't begin as JSON is null too, so one broken payload doesn't stop the others; what follows a whole value is ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def payload(text: Column) -> Column:
    """A JSON text as a variant; a text that was quoted as JSON once more is unwrapped."""
    once = F.try_parse_json(text)
    return F.coalesce(F.try_parse_json(F.try_variant_get(once, "$", "string")), once)


def shape(v: Column) -> Column:
    """array, object, or the type of a plain value; null for none."""
    kind = F.lower(F.schema_of_variant(v))
    return F.when(kind.startswith("array"), "array").when(kind.startswith("object"), "object").otherwise(kind)


def field(v: Column, path: str, kind: str = "string") -> Column:
    return F.try_variant_get(v, path, kind)


def elements(df: DataFrame, column: str, place: str = "pos", key: str = "key", value: str = "value", outer: bool = False) -> DataFrame:
    """A row for each element of an array or field of an object, with its place and, for fields, its name; outer: rows without any stay."""
    spread = df.sparkSession.tvf.variant_explode_outer if outer else df.sparkSession.tvf.variant_explode
    return df.lateralJoin(spread(F.col(column).outer()).toDF(place, key, value))


def leaves(df: DataFrame, keys: list[str], column: str, depth: int = 16) -> DataFrame:
    """keys, path and text of every plain value inside a payload, nested at most `depth` deep; deeper ones are told as JSON text.

    A recursive query: each round opens the arrays and objects that the one before found.
    """
    spark = df.sparkSession
    spark.conf.set("spark.sql.cteRecursionRowLimit", "-1")
    names = ", ".join(f"`{k}`" for k in keys)
    nested = "(lower(schema_of_variant(v)) LIKE 'array%' OR lower(schema_of_variant(v)) LIKE 'object%')"
    return spark.sql(
        f"""WITH RECURSIVE walk AS (
              SELECT {names}, '$' AS path, `{column}` AS v, 0 AS level FROM {{df}} WHERE `{column}` IS NOT NULL
              UNION ALL
              SELECT {names}, concat(walk.path, coalesce(concat('.', e.key), concat('[', e.pos, ']'))), e.value, walk.level + 1
              FROM walk, LATERAL variant_explode(walk.v) AS e WHERE walk.level < {depth} AND {nested})
            SELECT {names}, path, coalesce(try_variant_get(v, '$', 'string'), to_json(v)) AS text FROM walk WHERE NOT {nested} OR level = {depth}""",
        df=df,
    )
