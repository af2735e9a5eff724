"""Operators for large-scale training-data pipelines.

Every module holds one operator with its own general interface;
``queries.py`` derives the registered ``opN_*`` queries from them.  Nothing
else in the library imports this subpackage.
"""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to the executors with the job, so that
# nothing needs to be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
