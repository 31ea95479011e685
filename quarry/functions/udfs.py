"""User-defined functions: Python, pandas (Arrow) and SQL-bodied.

Python UDFs are an optimizer barrier and cross into a Python worker; the
pandas form moves Arrow batches instead of rows.  SQL UDFs (``CREATE
FUNCTION .. RETURN expr``) are inlined into the plan and keep whole-stage
codegen, so they are the preferred form; the Python forms exist because the
lessons teach them.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F


# The Python bodies are built inside factories, so they are pickled by value
# and shipped with the task: the executors' Python workers need no copy of
# this package on their path.
def first_letter_fn():
    """Row-at-a-time body: first character of a string."""
    def first_letter(text):
        return None if text is None else text[:1]
    return first_letter


def first_letters_fn():
    """Vectorised body: first character of every string in an Arrow batch."""
    def first_letters(s: pd.Series) -> pd.Series:
        return s.str[:1]
    return first_letters


def first_letter_udf():
    """``udf(first_letter)`` - a row-at-a-time Python UDF."""
    return F.udf(first_letter_fn(), "string")


def first_letter_decorated():
    """The decorator form: ``@udf("string")`` on a function."""
    @F.udf("string")
    def first_letter_of(text):
        return None if text is None else text[:1]
    return first_letter_of


def first_letter_vectorized():
    """``@pandas_udf("string")``: one call per Arrow batch of rows."""
    return F.pandas_udf(first_letters_fn(), "string")


def register_python(spark: SparkSession) -> None:
    """Make the Python forms callable from SQL."""
    spark.udf.register("sql_first_letter", first_letter_fn(), "string")
    spark.udf.register("sql_first_letter_vectorized", first_letter_vectorized())


# SQL-bodied functions (temporary: live in the session).
SQL_FUNCTIONS = {
    "price_with_discount": """CREATE OR REPLACE TEMPORARY FUNCTION price_with_discount(price DOUBLE, pct DOUBLE)
        RETURNS DOUBLE RETURN round(price * (1 - pct), 2)""",
    "price_band": """CREATE OR REPLACE TEMPORARY FUNCTION price_band(price DOUBLE)
        RETURNS STRING RETURN CASE WHEN price >= 1800 THEN 'premium'
                                   WHEN price >= 1200 THEN 'standard'
                                   ELSE 'basic' END""",
    "random_ping": """CREATE OR REPLACE TEMPORARY FUNCTION random_ping()
        RETURNS INT RETURN CAST(rand() * 250 AS INT)""",
    "mask_all_but_two": """CREATE OR REPLACE TEMPORARY FUNCTION mask_all_but_two(x STRING)
        RETURNS STRING RETURN CASE WHEN length(x) <= 2 THEN x
                                   ELSE concat(repeat('*', length(x) - 2), right(x, 2)) END""",
}


def register_sql(spark: SparkSession) -> None:
    for ddl in SQL_FUNCTIONS.values():
        spark.sql(ddl)
