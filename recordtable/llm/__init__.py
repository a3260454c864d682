"""Training-data operators (line dedup, language ID, packing, ...), one module each.

Nothing else in the library imports this subpackage. Its Python functions are
sent to executors by value, so executors need no installed copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
