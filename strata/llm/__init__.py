"""Operators for training-data pipelines over the ``documents``-like tables.

Nothing outside this subpackage imports it.  Every operator takes DataFrames and
column names, returns DataFrames, and keeps its intermediate tables in the shared
folder of ``spark.checkpoint.dir`` (see :mod:`strata.llm.common`).
"""

import sys

from pyspark import cloudpickle

# Functions run by executors travel with the tasks: the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
