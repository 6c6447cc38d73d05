"""Names for tables: a database, versioned tables below one root, views and external tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from tierline.sources import storage
from tierline.sources.versioned import VersionedTable


class Workspace:
    """All tables of one flow, kept below ``root`` and known to SQL by name."""

    def __init__(self, spark: SparkSession, root: str, database: str = "tierline", **table_options):
        self.spark = spark
        self.root = storage.full_path(spark, root)
        self.database = database
        self.table_options = table_options

    def use(self) -> None:
        """Create the database if it is absent, and select it."""
        self._create_database()
        self.spark.sql(f"USE `{self.database}`")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def table(self, name: str, **options) -> VersionedTable:
        return VersionedTable(self.spark, self.path(name), **{**self.table_options, **options})

    def _qualified(self, name: str) -> str:
        return f"`{self.database}`.`{name}`"

    def _create_database(self) -> None:
        self.spark.sql(
            f"CREATE DATABASE IF NOT EXISTS `{self.database}` LOCATION '{self.root}/_{self.database}'"
        )

    def register(self, name: str) -> DataFrame:
        """Make the newest version of a table readable by name, as ``database.name``.

        The name is a view in the catalog, so other sessions find it, too, and tables of the same
        name in other databases are not in its way. Call this again after a change; the view shows
        the version it was made from.
        """
        self._create_database()
        self.table(name).publish_view(self._qualified(name), self._qualified(f"{name}__files"))
        return self.spark.table(self._qualified(name))

    def show(self, name: str, sql: str) -> DataFrame:
        """Give the rows of a statement over registered tables a name of their own."""
        self._create_database()
        self.spark.sql(f"CREATE OR REPLACE VIEW {self._qualified(name)} AS {sql}")
        return self.spark.table(self._qualified(name))

    def save(self, name: str, df: DataFrame, **layout) -> DataFrame:
        """Write a frame as the content of a table, and register it.

        A table that is there keeps its schema and layout, and a frame that does not fit is refused.
        """
        table = self.table(name)
        if table.exists:
            table.overwrite(df)
        else:
            table.replace(df, **layout)
        return self.register(name)

    def external_table(self, name: str, path: str, file_format: str = "parquet") -> DataFrame:
        """Register files that lie at a path, if the name is free. Dropping it keeps the files."""
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS `{name}` USING {file_format} LOCATION '{path}'"
        )
        return self.spark.table(name)

    def drop(self, names: Iterable[str], paths: Iterable[str] = ()) -> None:
        """Drop tables and views with their data; further paths must lie below the root."""
        targets = [self.path(n) for n in names] + [storage.full_path(self.spark, p) for p in paths]
        for target in targets:
            inside = storage.full_path(self.spark, target)
            if not inside.startswith(self.root + "/"):
                raise ValueError(f"{target} is not below {self.root}")
        for name in names:
            if self.spark.catalog.databaseExists(self.database):
                self.spark.sql(f"DROP VIEW IF EXISTS {self._qualified(name)}")
                self.spark.sql(f"DROP TABLE IF EXISTS {self._qualified(f'{name}__files')}")
            if name in {t.name for t in self.spark.catalog.listTables() if t.tableType != "VIEW"}:
                self.spark.sql(f"DROP TABLE IF EXISTS `{name}`")
        for target in targets:
            storage.remove(self.spark, target)


def maintain(workspace: Workspace, keys: Mapping[str, str]) -> None:
    """The daily job: put small files of each table together and cluster it by its key."""
    for name, key in keys.items():
        table = workspace.table(name)
        table.cluster(key)
        table.compact()
