"""tallyloom: bookkeeping analytics as plain functions from DataFrames to DataFrames."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Arrow functions travel with their code, so executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
