"""DuckDB SQL that restates every registered query, independently of the Spark code."""
