"""Column-level helpers: T-SQL scalar semantics, code lists, parameter splitting."""
