"""Evidence operators for Spark: chunks, vectors, facts, validators, answers and KPI series as DataFrame jobs."""

import sys

from pyspark import cloudpickle

# Tasks carry the package's functions with them, so executors need no installed copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
