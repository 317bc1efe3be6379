"""Independent DuckDB SQL for every registered query (the correctness oracle).

Raw-table rules, models and test lists are stated here for themselves; nothing is imported from the library
under test. Each query string is self-contained: the CTEs it needs are prefixed by ``sql.build``.
"""
