"""Export to and import from databases (survey S23); the database's driver must be on the class path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.lineage import cut

#: Type of text columns in tables that an export makes.
TEXT = "VARCHAR(4000)"
RUN, PART, MERGED = "run_id", "part_no", -1


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _statements(spark: SparkSession, url: str, statements: list[str]) -> None:
    """Runs statements as one transaction."""
    connection = spark._jvm.java.sql.DriverManager.getConnection(url)
    try:
        connection.setAutoCommit(False)
        try:
            for sql in statements:
                statement = connection.createStatement()
                statement.executeUpdate(sql)
                statement.close()
            connection.commit()
        except Exception:
            connection.rollback()
            raise
    finally:
        connection.close()


def _write(rows: DataFrame, url: str, table: str, mode: str) -> None:
    types = ", ".join(f"{_quoted(c)} {TEXT}" for c, t in rows.dtypes if t == "string")
    rows.write.format("jdbc").option("url", url).option("dbtable", table).option("createTableColumnTypes", types.replace('"', "`")).mode(mode).save()


def _read(spark: SparkSession, url: str, table: str) -> DataFrame:
    return spark.read.format("jdbc").option("url", url).option("dbtable", table).load()


def export(facts: DataFrame, url: str, table: str, key: list[str], run_id: str, parts: int = 8) -> None:
    """Upserts facts into a database's table, once for a run however often it is started anew.

    Rows are dealt to ``parts`` by a hash of their key. Each part goes to ``<table>_stage``, after what an earlier try left of it there is
    gone, and is then noted in ``<table>_done``; a run that starts anew passes over parts that are noted. In the end one
    transaction replaces the rows of equal key, empties the stage and notes the run, so that readers of the table never see half
    of it. Keys must be unique and not null. The tables are made where they are not there.
    """
    spark, stage, done = facts.sparkSession, f"{table}_stage", f"{table}_done"
    columns = facts.columns
    staged = facts.withColumns({RUN: F.lit(run_id), PART: F.pmod(F.xxhash64(*key), F.lit(parts)).cast("int")})
    for rows, name in ((facts, table), (staged, stage), (spark.createDataFrame([], f"{RUN} string, {PART} int"), done)):
        _write(rows.limit(0), url, name, "ignore")
    told = {r[PART] for r in _read(spark, url, done).filter(F.col(RUN) == run_id).collect()}
    if MERGED in told:
        return
    mine = f"{_quoted(RUN)} = {_text(run_id)}"
    note = lambda part: f"INSERT INTO {done} ({_quoted(RUN)}, {_quoted(PART)}) VALUES ({_text(run_id)}, {part})"
    rows = cut(staged)
    for part in sorted(set(range(parts)) - told):
        _statements(spark, url, [f"DELETE FROM {stage} WHERE {mine} AND {_quoted(PART)} = {part}"])
        _write(rows.filter(F.col(PART) == part), url, stage, "append")
        _statements(spark, url, [note(part)])
    names = ", ".join(map(_quoted, columns))
    same = " AND ".join(f"s.{_quoted(c)} = {table}.{_quoted(c)}" for c in key)
    _statements(spark, url, [
        f"DELETE FROM {table} WHERE EXISTS (SELECT 1 FROM {stage} s WHERE s.{mine} AND {same})",
        f"INSERT INTO {table} ({names}) SELECT {names} FROM {stage} WHERE {mine}",
        f"DELETE FROM {stage} WHERE {mine}",
        note(MERGED),
    ])


def text_bounds(parts: int, prefix: str = "0x") -> list[str]:
    """What cuts hexadecimal text, such as addresses, into ``parts`` even ranges."""
    return [f"{prefix}{k * 0x1000 // parts:03x}" for k in range(1, parts)]


def read_ranges(spark: SparkSession, url: str, table: str, column: str, bounds: list[str]) -> DataFrame:
    """A table in ranges of a text column, read side by side; bounds: in order, each the beginning of a range. Nulls go with the first."""
    c = _quoted(column)
    if not bounds:
        return _read(spark, url, table)
    ranges = [f"({c} < {_text(bounds[0])} OR {c} IS NULL)"]
    ranges += [f"{c} >= {_text(a)} AND {c} < {_text(b)}" for a, b in zip(bounds, bounds[1:], strict=False)]
    return spark.read.jdbc(url, table, predicates=[*ranges, f"{c} >= {_text(bounds[-1])}"])
