"""heliotab: solar-yield analytics for whole fleets of installations, on Spark DataFrames.

Every public function takes and returns DataFrames (or Columns) and is meant to be
chained with ``df.transform(...)``.
"""

import sys

from pyspark import cloudpickle

# The few functions that run in Python workers travel with their code, so that a cluster
# needs no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
