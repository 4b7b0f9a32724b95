"""Ordered validation rules: the first one a row fails names the reason it is quarantined."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """``fails`` receives the rule's column and is true for a row that breaks the rule."""

    code: str
    column: str
    fails: Callable[[Column], Column]


def first_failure(rules: Sequence[Rule], value_of: Callable[[str], Column] = F.col) -> Column:
    """Code of the first failing rule, NULL for a row that passes them all."""
    return F.coalesce(*[F.when(rule.fails(value_of(rule.column)), F.lit(rule.code)) for rule in rules])


def label_first(
    df: DataFrame, rules: Sequence[Rule], reason: str, value_of: Callable[[str], Column] = F.col
) -> DataFrame:
    return df.withColumn(reason, first_failure(rules, value_of))
