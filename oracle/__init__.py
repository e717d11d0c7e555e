"""DuckDB SQL that checks the registered Spark queries."""
