"""Databases as sources and sinks: parallel reads and writes, and merges of batches in one transaction.

Executors write a batch into staging tables; then the driver asks the database to merge them all in one transaction, so
readers see either the batch or nothing of it, and no row passes through the driver. The merging statement is the database's own:
`INSERT ... ON CONFLICT` for PostgreSQL, `MERGE INTO` for the others.

An embedded database lives in the driver's process, where executors of a cluster can't connect to it. There they write and
read files in the shared folder, which the database loads and unloads itself, one at a time.
"""

from __future__ import annotations

import math
import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import scratch

STAGING = "staging_"
#: Derby: texts that can be compared are bounded. They are staged as large objects, as Spark writes them.
TEXT = "VARCHAR(32672)"


@dataclass(frozen=True)
class Database:
    """url: a JDBC address whose driver is on the class path. least: columns that keep their smaller value, insert_only: tables whose rows never change."""

    url: str
    properties: dict[str, str] = field(default_factory=dict)
    least: tuple[str, ...] = ("first_seen_at",)
    insert_only: tuple[str, ...] = ("events",)

    @property
    def dialect(self) -> str:
        return self.url.split(":")[1]

    def apart(self, spark: SparkSession) -> bool:
        """Whether the database is one in the driver's process, and executors are others."""
        return self.dialect == "derby" and not self.url.startswith("jdbc:derby://") and spark.sparkContext.master.split("[")[0] != "local"


def quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def quoted_column(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _said(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def merge_sql(db: Database, name: str, columns: list[str], keys: list[str], texts: tuple[str, ...] = ()) -> str:
    """The statement that merges a table's staging table into it. texts: columns that Derby stages as large objects."""
    into, staged = quoted(name), quoted(STAGING + name)
    names, rest = ", ".join(map(quoted, columns)), [] if name in db.insert_only else [c for c in columns if c not in keys]
    if db.dialect == "postgresql":
        change = ", ".join(f"{quoted(c)} = LEAST(t.{quoted(c)}, EXCLUDED.{quoted(c)})" if c in db.least else f"{quoted(c)} = EXCLUDED.{quoted(c)}" for c in rest)
        return f"INSERT INTO {into} AS t ({names}) SELECT {names} FROM {staged} ON CONFLICT ({', '.join(map(quoted, keys))}) DO " + (f"UPDATE SET {change}" if rest else "NOTHING")
    own = lambda c: f"CAST(s.{quoted(c)} AS {TEXT})" if db.dialect == "derby" and c in texts else f"s.{quoted(c)}"
    smaller = lambda c: f"CASE WHEN t.{quoted(c)} IS NULL OR {own(c)} < t.{quoted(c)} THEN {own(c)} ELSE t.{quoted(c)} END"
    change = ", ".join(f"{quoted(c)} = {smaller(c) if c in db.least else own(c)}" for c in rest)
    matched = f" WHEN MATCHED THEN UPDATE SET {change}" if rest else ""
    on = " AND ".join(f"t.{quoted(k)} = {own(k)}" for k in keys)
    return f"MERGE INTO {into} AS t USING {staged} AS s ON {on}{matched} WHEN NOT MATCHED THEN INSERT ({names}) VALUES ({', '.join(map(own, columns))})"


@contextmanager
def transaction(spark: SparkSession, db: Database) -> Iterator[object]:
    """A statement of the driver's own connection; all that it does is kept, or nothing if an error leaves the block."""
    settings = spark._jvm.java.util.Properties()
    for k, v in db.properties.items():
        settings.setProperty(k, v)
    connection = spark._jvm.java.sql.DriverManager.getConnection(db.url, settings)
    try:
        connection.setAutoCommit(False)
        yield connection.createStatement()
        connection.commit()
    except BaseException:
        connection.rollback()
        raise
    finally:
        connection.close()


def write_table(df: DataFrame, db: Database, name: str, tasks: int = 8, batch: int = 5_000, mode: str = "overwrite") -> None:
    """df as a table, by at most so many connections."""
    if db.apart(df.sparkSession):
        df.limit(0).write.mode(mode).jdbc(db.url, quoted(name), properties=db.properties)
        return _load(df, db, name)
    df.write.mode(mode).options(numPartitions=tasks, batchsize=batch).jdbc(db.url, quoted(name), properties=db.properties)


def read_table(spark: SparkSession, db: Database, name: str, key: str | None = None, tasks: int = 8, where: str = "1 = 1") -> DataFrame:
    """A table, by ranges of a numeric key between its least and greatest value; filters and columns go to the database."""
    if db.apart(spark):
        return _unload(spark, db, name, key, tasks, where)
    if key is None:
        return spark.read.jdbc(db.url, quoted(name), properties=db.properties)
    k = quoted(key)
    ends = spark.read.jdbc(db.url, f"(SELECT MIN({k}) AS low, MAX({k}) AS high FROM {quoted(name)} WHERE {where}) ends", properties=db.properties).toDF("low", "high").first()
    if ends.low is None:
        return spark.read.jdbc(db.url, quoted(name), properties=db.properties).filter(where)
    # Spark's first and last range are open, so nulls and rows that come later are read as well
    got = spark.read.jdbc(db.url, quoted(name), column=key, lowerBound=int(ends.low), upperBound=int(ends.high) + 1, numPartitions=tasks, properties=db.properties)
    return got if where == "1 = 1" else got.filter(where)


def _load(df: DataFrame, db: Database, name: str) -> None:
    """Append df to a table by files that executors write and the database reads."""

    def cell(c: str, kind: str) -> Column:
        v = F.hex(quoted_column(c)) if kind == "binary" else F.col(quoted_column(c)).cast("string")
        return F.coalesce(F.concat(F.lit('"'), F.replace(v, F.lit('"'), F.lit('""')), F.lit('"')), F.lit(""))

    spark, folder = df.sparkSession, scratch(df.sparkSession, "load")
    df.select(F.concat_ws(",", *(cell(c, kind) for c, kind in df.dtypes)).alias("value")).write.text(folder)
    path = spark._jvm.org.apache.hadoop.fs.Path
    store = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    with tempfile.TemporaryDirectory() as own:
        for part in store.listStatus(path(folder)):
            if part.getPath().getName().startswith("part-") and part.getLen():
                store.copyToLocalFile(False, part.getPath(), path(f"file://{own}/part"), True)
                with transaction(spark, db) as statement:
                    statement.execute(f"CALL SYSCS_UTIL.SYSCS_IMPORT_TABLE(NULL, {_said(name)}, {_said(own + '/part')}, ',', '\"', 'UTF-8', 0)")
    store.delete(path(folder), True)


def _unload(spark: SparkSession, db: Database, name: str, key: str | None, tasks: int, where: str) -> DataFrame:
    """A table's rows from files that the database writes, one for each range of the key, and executors read."""
    schema, folder = spark.read.jdbc(db.url, quoted(name), properties=db.properties).schema, scratch(spark, "unload")
    path = spark._jvm.org.apache.hadoop.fs.Path
    store = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    store.mkdirs(path(folder))
    with tempfile.TemporaryDirectory() as own, transaction(spark, db) as statement:
        for n, part in enumerate(_ranges(statement, name, key, tasks, where)):
            statement.execute(f"CALL SYSCS_UTIL.SYSCS_EXPORT_QUERY({_said(f'SELECT * FROM {quoted(name)} WHERE ({where}) AND {part}')}, {_said(own + '/part')}, ',', '\"', 'UTF-8')")
            store.copyFromLocalFile(False, True, path(f"file://{own}/part"), path(f"{folder}/part-{n:05d}.csv"))
            os.remove(f"{own}/part")
    texts = ", ".join(f"`{f.name.replace('`', '``')}` string" for f in schema)
    # nothing between commas is null, two quotes are an empty text; a name that no text has tells them apart
    got = spark.read.schema(texts).csv(folder, nullValue=uuid.uuid4().hex, emptyValue="", multiLine=True, escape='"', encoding="UTF-8", maxCharsPerColumn=-1)
    kind = lambda f: f.dataType.simpleString()
    return got.select(*(F.unhex(quoted_column(f.name)).alias(f.name) if kind(f) == "binary" else F.col(quoted_column(f.name)).cast(f.dataType).alias(f.name) for f in schema))


def _ranges(statement: object, name: str, key: str | None, tasks: int, where: str) -> list[str]:
    """Conditions that part a table by a numeric key; nulls are in the first."""
    if key is None:
        return ["1 = 1"]
    k = quoted(key)
    ends = statement.executeQuery(f"SELECT MIN({k}), MAX({k}) FROM {quoted(name)} WHERE {where}")
    ends.next()
    low, high = ends.getString(1), ends.getString(2)
    ends.close()
    if low is None:
        return ["1 = 1"]
    first, last = (math.floor(Decimal(x)) for x in (low, high))
    cuts = sorted({first + (last + 1 - first) * i // tasks for i in range(1, tasks)} - {first})
    if not cuts:
        return ["1 = 1"]
    return [f"({k} < {cuts[0]} OR {k} IS NULL)", *(f"{k} >= {a} AND {k} < {b}" for a, b in zip(cuts, cuts[1:])), f"{k} >= {cuts[-1]}"]


def tables(spark: SparkSession, db: Database) -> set[str]:
    """The names of the database's tables."""
    with transaction(spark, db) as statement:
        found = statement.getConnection().getMetaData().getTables(None, None, "%", None)
        names = set()
        while found.next():
            names.add(found.getString("TABLE_NAME"))
        return names


def publish(batch: dict[str, tuple[DataFrame, list[str]]], db: Database, tasks: int = 8) -> list[str]:
    """Merge tables (name -> rows and key columns), in their order, in one transaction; returns its statements.

    A table that isn't there is made, with its key. Rows must be unique by key. If anything fails, the tables stay as they were.
    """
    spark = next(iter(batch.values()))[0].sparkSession
    have, statements = tables(spark, db), []
    for name, (df, keys) in batch.items():
        # keys of null can't be told apart by a database
        write_table(df.dropna(subset=keys), db, STAGING + name, tasks)
        texts = tuple(c for c, kind in df.dtypes if kind == "string")
        if name not in have:
            empty = df.limit(0).write.mode("overwrite")
            if db.dialect == "derby" and texts:
                empty = empty.option("createTableColumnTypes", ", ".join(f"`{c}` {TEXT}" for c in texts))
            empty.jdbc(db.url, quoted(name), properties=db.properties)
            with transaction(spark, db) as statement:
                for k in keys if db.dialect == "derby" else []:
                    statement.execute(f"ALTER TABLE {quoted(name)} ALTER COLUMN {quoted(k)} NOT NULL")
                statement.execute(f"ALTER TABLE {quoted(name)} ADD PRIMARY KEY ({', '.join(map(quoted, keys))})")
        statements.append(merge_sql(db, name, df.columns, keys, texts))
    with transaction(spark, db) as statement:
        for sql in statements:
            statement.execute(sql)
    return statements
