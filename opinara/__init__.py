"""Review analytics as Spark DataFrame jobs.

Every operator takes and returns DataFrames and works on all keys in one job.
"""

import sys

from pyspark import cloudpickle

# Helpers that run inside tasks travel with the plan, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
