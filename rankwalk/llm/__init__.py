"""Training-data operators: thirteen operators and the pipeline over ten of them.

The functions of this subpackage travel to the executors inside the jobs
(pickled by value), so the package need not be installed there.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
