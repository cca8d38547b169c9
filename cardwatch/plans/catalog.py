"""T1 as catalog tables: the warehouse's folders under their SQL names, with
column defaults, for users who write SQL.

The tables lie on the warehouse's own folders, so rows that ``INSERT`` adds are
the rows the daily run reads, and partitions that a load adds are found after
:meth:`Catalog.refresh`.  The terminal history is kept in versions
(``warehouse.py``); its table is a plain one for loading a history by SQL, and
:meth:`Catalog.adopt_history` makes its rows the next version.
"""

from __future__ import annotations

from dataclasses import dataclass

from cardwatch.functions.expressions import OPEN_END
from cardwatch.plans.warehouse import HISTORY_VIEW_NAME, SQL_VIEW_NAMES, TABLES, Warehouse
from cardwatch import schemas

# Defaults of omitted columns.
DEFAULTS = {
    HISTORY_VIEW_NAME: {"effective_from": "localtimestamp()", "effective_to": f"TIMESTAMP_NTZ '{OPEN_END}'", "deleted_flg": "false"},
    "rep_fraud": {"report_dt": "localtimestamp()", "placeholder": "false"},
}
HISTORY_FOLDER = "terminals_hist_sql"


@dataclass
class Catalog:
    wh: Warehouse
    database: str = "cardwatch"

    def name(self, table: str) -> str:
        return f"`{self.database}`.`{table}`"

    def _create(self, table: str, schema, parts: list[str], folder: str) -> None:
        columns = []
        for f in schema.fields:
            default = DEFAULTS.get(table, {}).get(f.name)
            columns.append(f"`{f.name}` {f.dataType.simpleString()}" + (f" DEFAULT {default}" if default else ""))
        partitioned = f" PARTITIONED BY ({', '.join(parts)})" if parts else ""
        self.wh.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name(table)} ({', '.join(columns)}) USING parquet{partitioned} "
                          f"LOCATION '{self.wh.path(folder)}'")

    def create_tables(self) -> list[str]:
        """Create the database and every table that does not exist; returns
        the tables' names."""
        self.wh.ensure_tables()
        self.wh.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.database}` LOCATION '{self.wh.path('_catalog')}'")
        for folder, (schema, parts) in TABLES.items():
            self._create(SQL_VIEW_NAMES[folder], schema, parts, folder)
        self._create(HISTORY_VIEW_NAME, schemas.TERMINALS_HIST, [], HISTORY_FOLDER)
        self.refresh()
        return [*SQL_VIEW_NAMES.values(), HISTORY_VIEW_NAME]

    def refresh(self) -> None:
        """Find the partitions and files that loads added to the folders."""
        for folder, (_, parts) in TABLES.items():
            if parts:
                self.wh.spark.sql(f"ALTER TABLE {self.name(SQL_VIEW_NAMES[folder])} RECOVER PARTITIONS")
            self.wh.spark.catalog.refreshTable(f"{self.database}.{SQL_VIEW_NAMES[folder]}")

    def adopt_history(self, as_of=None) -> int:
        """The rows of the history table as the next version of the history."""
        return self.wh.replace_history(self.wh.spark.table(f"{self.database}.{HISTORY_VIEW_NAME}"), as_of)
