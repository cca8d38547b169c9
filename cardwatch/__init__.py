"""cardwatch: daily card-transaction warehousing and fraud reporting on Spark.

Every operator is a ``DataFrame -> DataFrame`` function built from the
DataFrame API, so Catalyst sees one declarative plan per output.  Only the
modules under ``plans`` and ``streaming`` write data.
"""

from cardwatch.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
