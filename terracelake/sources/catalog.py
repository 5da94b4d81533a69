"""Registers the folders of a layer as catalog tables."""

from __future__ import annotations

import logging
import re
import uuid
from collections.abc import Collection, Sequence
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

log = logging.getLogger(__name__)

# Folders listed at a time, and partitions added by one statement.
LISTERS, BATCH = 16, 500
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"

CSV_OPTIONS = {"header": "true", "inferSchema": "true"}


def use_database(spark: SparkSession, database: str) -> None:
    spark.catalog.setCurrentDatabase(database)


def read_table(spark: SparkSession, name: str, alias: str | None = None) -> DataFrame:
    table = spark.table(name)
    return table.alias(alias) if alias else table


def table_folders(spark: SparkSession, root: str,
                  one_per_file: Collection[str] = ()) -> list[tuple[str, str]]:
    """Name and path of each folder under ``root`` that holds data.

    A folder is a table when it has data files or ``key=value`` folders. All other folders are
    searched further down, also those beside data files. The name is the last part of the
    path. In a folder named in ``one_per_file`` every file is a table of its own.
    """
    top = spark._jvm.org.apache.hadoop.fs.Path(root)
    files = top.getFileSystem(spark._jsc.hadoopConfiguration())
    found: list[tuple[str, str]] = []
    waiting = [top]
    while waiting:
        folder = waiting.pop()
        entries = [e for e in files.listStatus(folder)
                   if not e.getPath().getName().startswith(("_", "."))]
        inner = [e.getPath() for e in entries if e.isDirectory()]
        plain = [p for p in inner if "=" not in p.getName()]
        if len(plain) < len(entries):
            tables = [folder]
            if folder.getName() in one_per_file:
                tables = [e.getPath() for e in entries if e.isFile()]
            found += [(table.getName().split(".")[0], table.toString()) for table in tables]
        waiting += plain
    return sorted(found)


def register_tables(spark: SparkSession, root: str, database: str, prefix: str,
                    source: str = "parquet", merge_schema: bool = True,
                    one_per_file: Collection[str] = (), move: bool = False) -> list[str]:
    """Makes each data folder under ``root`` the external table ``<prefix><folder>``,
    in lower case and with ``_`` for characters that a table name cannot have.

    Run it again after new data has come: new columns are added, changed types are
    updated, new partitions are picked up (see ``add_new_partitions``). Columns, partitions and
    folders that have gone are logged and stay registered. ``merge_schema`` looks at every Parquet footer
    for new columns, in a distributed job; leave it off where the files of a
    folder are known to agree.

    Two folders with the same table name, a managed table of that name, and a table that lies
    elsewhere are errors; with ``move`` the last follows the data. An error leaves that
    table as it was and the others are registered. All errors are raised together at the end.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    options = CSV_OPTIONS if source == "csv" else {"mergeSchema": str(merge_schema).lower()}
    paths: dict[str, list[str]] = {}
    for folder, path in table_folders(spark, root, one_per_file):
        paths.setdefault(re.sub(r"[^0-9a-z_]", "_", f"{prefix}{folder}".lower()), []).append(path)
    done, errors = [], []
    for table, own in paths.items():
        try:
            if len(own) > 1:
                raise ValueError(f"several folders have this name: {', '.join(own)}")
            _register(spark, database, table, own[0], source, options, move)
            done.append(f"{database}.{table}")
        except Exception as error:  # noqa: BLE001  (the other folders are registered all the same)
            errors.append(f"{database}.{table}: {error}")
    for table in spark.catalog.listTables(database):
        if table.name.startswith(prefix) and table.name not in paths and not table.isTemporary:
            log.warning("no data folder found for table %s.%s; it is kept", database, table.name)
    if errors:
        raise RuntimeError(f"{len(done)} tables are registered, {len(errors)} are not:\n" + "\n".join(errors))
    return done


def _register(spark: SparkSession, database: str, table: str, path: str, source: str,
              options: dict[str, str], move: bool) -> None:
    name, moved = f"`{database}`.`{table}`", False
    if not spark.catalog.tableExists(name):
        spark.catalog.createTable(name, path=path, source=source, schema=None, **options)
    else:
        kind, place = _kind_and_place(spark, name)
        if kind != "EXTERNAL":
            raise ValueError(f"it is a {kind.lower()} table, which is not for this job to change")
        if place != _qualified(spark, path):
            if not move:
                raise ValueError(f"it lies at {place}, not at {path}")
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{_escaped(path)}'")
            spark.catalog.refreshTable(name)
            moved = True
        _update_columns(spark, database, table, path, source, options)
    add_new_partitions(spark, name, moved)


def add_new_partitions(spark: SparkSession, name: str, moved: bool = False) -> int:
    """Adds the partitions of an external table that its folder has and the catalog doesn't; returns how many.

    Only folders are listed, down to the last partition column and many at a time, no data
    files, and the catalog is only told what is new, BATCH partitions by one statement. So a run that finds
    nothing new changes nothing. Those whose folder has gone are logged and stay. With ``moved``, known
    partitions are pointed to their folders under the place where the table is now.
    """
    own = [column for column in spark.catalog.listColumns(name) if column.isPartition]
    columns, whole = [c.name for c in own], [c.dataType in ("tinyint", "smallint", "int", "bigint") for c in own]
    if not columns:
        return 0

    def same(values: Sequence[str]) -> tuple[str, ...]:
        """Folders may write 7 as 07; the catalog doesn't."""
        return tuple(str(int(v)) if number and re.fullmatch(r"-?\d+", v) else v for v, number in zip(values, whole))

    _, root = _kind_and_place(spark, name)
    known = {_values(row["partition"]) for row in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    found = {same(values): path for values, path in partition_folders(spark, root, columns).items()}
    for values in found.keys() & known if moved else ():
        spark.sql(f"ALTER TABLE {name} PARTITION ({_spec(columns, values)}) SET LOCATION '{_escaped(found[values])}'")
    new = [values for values in found if values not in known]
    for at in range(0, len(new), BATCH):
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS " + " ".join(
            f"PARTITION ({_spec(columns, values)}) LOCATION '{_escaped(found[values])}'" for values in new[at:at + BATCH]))
    if gone := known - found.keys():
        log.warning("the folders of %d partitions of %s have gone; they are kept", len(gone), name)
    return len(new)


def _values(path: str) -> tuple[str, ...]:
    """The values of a partition's path, ``a=1/b=x``, as they are written."""
    return tuple(part.split("=", 1)[1] for part in path.split("/"))


def _spec(columns: Sequence[str], values: Sequence[str]) -> str:
    return ", ".join(f"`{column}` = " + ("NULL" if value == NO_VALUE else f"'{_escaped(unquote(value))}'")
                     for column, value in zip(columns, values))


def partition_folders(spark: SparkSession, root: str, columns: Sequence[str]) -> dict[tuple[str, ...], str]:
    """Values and path of each partition folder ``<column>=<value>/...`` under ``root``."""
    same = str if spark.conf.get("spark.sql.caseSensitive") == "true" else str.lower
    top = spark._jvm.org.apache.hadoop.fs.Path(root)
    files = top.getFileSystem(spark._jsc.hadoopConfiguration())

    def inner(folder: tuple, column: str) -> list[tuple]:
        values, path = folder
        entries = [e.getPath() for e in files.listStatus(path) if e.isDirectory()]
        parts = [(p.getName().split("=", 1), p) for p in entries]
        return [((*values, part[1]), p) for part, p in parts if len(part) == 2 and same(part[0]) == same(column)]

    folders = [((), top)]
    with ThreadPoolExecutor(LISTERS) as pool:
        for column in columns:
            folders = [f for found in pool.map(inner, folders, [column] * len(folders)) for f in found]
    return {values: path.toString() for values, path in folders}


def _kind_and_place(spark: SparkSession, name: str) -> tuple[str, str]:
    rows = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    return rows["Type"], _qualified(spark, rows["Location"])


def _qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system, so that two spellings of a place are equal."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toString()


def _escaped(path: str) -> str:
    return path.replace("\\", "\\\\").replace("'", "\\'")


def _update_columns(spark: SparkSession, database: str, table: str, path: str, source: str,
                    options: dict[str, str]) -> None:
    name = f"`{database}`.`{table}`"
    same = str if spark.conf.get("spark.sql.caseSensitive") == "true" else str.lower
    known = {same(f.name): f for f in spark.table(name).schema}
    seen = {same(f.name): f for f in spark.read.format(source).options(**options).load(path).schema}
    gone = [f for key, f in known.items() if key not in seen]
    if gone:
        log.warning("no file of table %s has the columns %s; they are kept", name, [f.name for f in gone])
    added = [f for key, f in seen.items() if key not in known]
    if any(key in seen and seen[key].dataType != f.dataType for key, f in known.items()):
        # The new table is whole before the old one's name goes to it. Both are external, so
        # neither name holds the files.
        fresh, old = (f"`{database}`.`{table}_{word}_{uuid.uuid4().hex[:8]}`" for word in ("new", "old"))
        try:
            spark.catalog.createTable(fresh, path=path, source=source, schema=None, **options)
            if gone:
                spark.sql(f"ALTER TABLE {fresh} ADD COLUMNS ({StructType(gone).toDDL()})")
            spark.table(fresh).limit(0).collect()
        except Exception:
            spark.sql(f"DROP TABLE IF EXISTS {fresh}")
            raise
        spark.sql(f"ALTER TABLE {name} RENAME TO {old}")
        spark.sql(f"ALTER TABLE {fresh} RENAME TO {name}")
        spark.sql(f"DROP TABLE {old}")
    elif added:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({StructType(added).toDDL()})")
