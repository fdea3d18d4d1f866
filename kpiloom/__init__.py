"""kpiloom: per-entity KPI time-series incident analytics as plain Spark jobs.

Every public operator is a ``DataFrame -> DataFrame`` function.  Nothing in the
package runs Python per row; all work is DataFrame / SQL expressions that Spark
partitions, shuffles and generates code for.
"""

__version__ = "0.1.0"
