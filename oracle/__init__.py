"""Independent DuckDB SQL for every registered query (the correctness oracle)."""

from oracle.sql import AS_OF, oracle_sql  # noqa: F401
