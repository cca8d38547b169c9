"""Operators of a training-data pipeline over the corpus tables.

Nothing else in the library imports this package; ``__spark_entry__.py``
adds its queries when it is present.  Every operator is a
``DataFrame -> DataFrame`` function with its own column-name parameters;
``registry`` holds the thin registered queries and ``oracle`` their SQL.
"""
