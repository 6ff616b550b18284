"""feedmill: curated article feeds and training-corpus preparation on PySpark."""

import sys

from pyspark import cloudpickle

# Functions that run on executors travel by value, so executors need not have
# this package on their Python path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
