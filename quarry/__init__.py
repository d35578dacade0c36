"""quarry: Spark-native analytics operators for tables and streams.

Every operator is a function from DataFrames to DataFrames built on the
public Spark SQL / Structured Streaming / Spark ML APIs. Sub-packages:

* ``sources``   - table scans, literal tables, file listings, sinks
* ``functions`` - column expressions (safe division, conditional sums, ...)
* ``operators`` - relational, as-of, time-series, text, matching, ML, monitoring
* ``streaming`` - Structured Streaming versions of the incremental operators
* ``plans``     - the named end-to-end queries and their SQL oracles
"""

from quarry.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
