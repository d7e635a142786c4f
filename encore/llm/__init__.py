"""Operations for large text corpora, each a Spark job; nothing else in the library needs them."""

import sys

from pyspark import cloudpickle

# The functions that run in tasks travel with the job, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
