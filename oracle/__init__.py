"""Independent DuckDB SQL for every query, used only to check results."""
