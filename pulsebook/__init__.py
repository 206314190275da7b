"""pulsebook: telemetry journals, classification and reports as Spark plans."""

import sys

from pyspark import cloudpickle

# The folds run in Python workers. Their code travels with the tasks, so executors
# need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
