"""SQL functions of the dialect, as temporary functions of a session."""
