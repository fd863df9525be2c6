"""Aggregates and arithmetic that several plans share."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def count_where(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def sum_where(value: Column, condition: Column) -> Column:
    return F.sum(F.when(condition, value))


def last_known(value: Column, by: Column) -> Column:
    """The value at the largest key, among rows where both are known."""
    known = value.isNotNull() & by.isNotNull()
    return F.max_by(value, F.when(known, by))


def first_known(value: Column, by: Column) -> Column:
    known = value.isNotNull() & by.isNotNull()
    return F.min_by(value, F.when(known, by))


def ratio(part: Column, whole: Column) -> Column:
    """A true quotient; null for a zero denominator."""
    return part / F.nullif(whole, F.lit(0))


def weighted_mean(value: Column, weight: Column) -> Column:
    return F.sum(value * weight) / F.sum(weight)


def excess_wait(observed_sq: Column, observed: Column, scheduled_sq: Column, scheduled: Column) -> Column:
    """Mean wait beyond the scheduled one, from sums of headways and of their squares."""
    return ratio(observed_sq, 2 * observed) - ratio(scheduled_sq, 2 * scheduled)
