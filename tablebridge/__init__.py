"""Moving tables between systems without changing what they mean."""

import sys

from pyspark import cloudpickle

# Functions that tasks run travel with their code, so executors need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
