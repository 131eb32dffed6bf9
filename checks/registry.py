"""Where queries and their SQL are collected."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Case:
    name: str
    run: Query
    sql: str | None


CASES: dict[str, Case] = {}


_MEMOS: list[dict] = []


def memo() -> dict:
    """Where queries keep what they share in a session; `forget` empties it."""
    _MEMOS.append({})
    return _MEMOS[-1]


def forget() -> None:
    """Make the next run of every query do its whole work again."""
    for kept in _MEMOS:
        kept.clear()


def case(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; without SQL only its rows can be counted."""

    def add(run: Query) -> Query:
        CASES[name] = Case(name, run, sql)
        return run

    return add
