"""Queries over the test tables, one or more for each operator, with the SQL that gives the same result.

SQL is left out where it can't express an operator over whole tables (sequential folds, string similarity, iterated
removal, trained models); tests hold those against plain restatements of their rules.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quern.queries import documents, models, records, vectors

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {**documents.QUERIES, **records.QUERIES, **models.QUERIES, **vectors.QUERIES}
SQL: dict[str, str] = {**documents.SQL, **records.SQL, **models.SQL, **vectors.SQL}
