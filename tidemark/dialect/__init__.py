"""The SQL dialect: tokens, accept and reject rules, rewriting to Spark SQL."""
