"""DuckDB SQL oracle for the correctness gate (``__spark_entry__.oracle_sql``)."""
