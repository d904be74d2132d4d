"""Operations of a training-data pipeline over the ``documents`` and ``conversations`` tables."""

import sys

from pyspark import cloudpickle

# Functions for Python workers travel with the job: executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
