"""Training-data operators: scoring, de-duplication, scanning, tokenising and archiving of text at corpus scale."""

import sys

from pyspark import cloudpickle

# Executors get the task functions of this subpackage inside the job, so they need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
