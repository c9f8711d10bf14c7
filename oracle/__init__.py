"""Independent DuckDB SQL for every registered query (see ``oracle.sql``)."""

from oracle.sql import all_sql  # noqa: F401
