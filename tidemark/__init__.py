"""Time-series SQL analytics and corpus curation on Spark."""
