"""Errors of the dialect, with the wording that callers match on."""

from __future__ import annotations


class QueryError(Exception):
    """A query that the dialect rejects."""

    def __init__(self, rule: str, message: str):
        super().__init__(message)
        self.rule, self.message = rule, message


class Lint:
    """A query that runs and is likely wrong."""

    def __init__(self, rule: str, message: str):
        self.rule, self.message = rule, message

    def __repr__(self) -> str:
        return f"{self.rule}: {self.message}"
