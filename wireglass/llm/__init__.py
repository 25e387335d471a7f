"""Training-data operators: each module is one operator, `queries` applies them to the given tables.

Nothing else in the library imports this subpackage.
"""

import sys

from pyspark import cloudpickle

# functions sent to executors travel with their code, so that executors need no installed copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
