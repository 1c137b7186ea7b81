"""Two-stage text retrieval and its evaluation as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

# The Arrow kernels travel inside the job, so executors need no install of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
