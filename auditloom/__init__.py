"""Public-records analytics written as Spark DataFrame operators.

Every operator is a function ``f(df, ...) -> DataFrame`` (or ``Column``) that
only declares a plan.  Nothing here collects rows to the driver; the two places
that run an action while a plan is built (a global rank and a table export) say
so in their docstrings.
"""

__version__ = "0.1.0"
