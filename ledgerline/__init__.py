"""ledgerline: evidence, lineage and training-data operators on Spark DataFrames."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions that run on executors travel with their code, so executors need Python's libraries but not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
