"""Sources and sinks: declared tables, seeds, JSON lines, CSV."""
