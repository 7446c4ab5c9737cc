"""Ratings analytics and recommendation operators on Spark.

Every operator is a function ``f(df, ..., *, params) -> DataFrame`` built from
the DataFrame / SQL API, so Catalyst plans it and the work runs distributed.
"""

__version__ = "0.1.0"
