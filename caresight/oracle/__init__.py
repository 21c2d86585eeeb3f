"""Independent DuckDB SQL for every registered query (the correctness oracle).

The only text shared with the Spark side is the adapter SQL (input shaping). The logic
here is written the way the original reports state it: pair joins, ROW_NUMBER, CASE lists.
"""
