"""Operations of a training-data pipeline: dedup, search, filters, formats, tokens.

Each module holds one operator with its general interface; ``queries`` registers
the thin ``opN_<name>`` queries over it. Functions that run inside Spark tasks
are shipped by value, so executors need no installed copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
