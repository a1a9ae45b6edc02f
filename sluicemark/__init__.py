"""Spark-native ingest, upsert and export engine.

Every operator takes and returns DataFrames (or columns) and leaves the physical plan to
Catalyst.  ``sources`` reads, ``operators`` transforms and writes, ``functions`` holds
column expressions, ``streaming`` the incremental file loads, ``plans`` the whole flows.
"""

from sluicemark import session

__all__ = ["session"]
