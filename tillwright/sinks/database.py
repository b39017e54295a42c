"""JDBC writers."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame

from ..schemas import DERIVED_TRANSACTION_COLUMNS, LOAD_ORDER
from ..sources.database import jdbc_options

# Replacing a table keeps its definition, keys and grants: rows are truncated, not the table dropped.
SAVE_MODES = {"replace": "overwrite", "append": "append"}


def write_table(
    df: DataFrame,
    url: str,
    table: str,
    if_exists: str = "replace",
    properties: dict[str, str] | None = None,
    connections: int | None = None,
    batch_size: int = 10_000,
    cascade: bool = False,
) -> None:
    """A table over at most `connections` connections (by default one per partition).

    `cascade` empties the tables that refer to a replaced one as well: a database may refuse to
    truncate a parent otherwise.
    """
    options = jdbc_options(
        url, properties, dbtable=table, numPartitions=connections, batchsize=batch_size,
        truncate="true", cascadeTruncate="true" if cascade and if_exists == "replace" else None,
    )
    df.write.format("jdbc").mode(SAVE_MODES[if_exists]).options(**options).save()


def load_tables(
    tables: Mapping[str, DataFrame],
    write: Callable[[str, DataFrame], None],
    order: tuple[str, ...] = LOAD_ORDER,
) -> list[str]:
    """Hand the tables to `write`, parents first, without the columns cleaning derived.

    Tables the caller does not have are left out. Returns the names in the order written.
    """
    written = []
    for name in order:
        if name in tables:
            write(name, tables[name].drop(*DERIVED_TRANSACTION_COLUMNS))
            written.append(name)
    return written


def load_database(
    tables: Mapping[str, DataFrame],
    url: str,
    if_exists: str = "replace",
    properties: dict[str, str] | None = None,
    connections: int | None = None,
) -> list[str]:
    """Load the tables, parents first.

    Replacing a parent empties its children, so all tables have to be loaded again with it; with some
    only, a replaced parent is left to the database to accept or refuse.
    """
    everything = set(LOAD_ORDER) <= set(tables)

    def write(name: str, df: DataFrame) -> None:
        write_table(df, url, name, if_exists, properties, connections, cascade=everything)

    return load_tables(tables, write)
