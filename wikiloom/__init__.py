"""Wiki migration and analysis over tables of any size, as Spark jobs."""

import sys

from pyspark import cloudpickle

# The small Python helpers travel inside the job, so executors need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
