"""Training-data operators on the ``documents`` / ``embeddings`` / ``labels`` tables.

Nothing else in the library imports this package; ``__spark_entry__.py`` adds
its queries when the package can be imported.
"""

import sys

from pyspark import cloudpickle

# functions of this package travel to executors by value, so those need no copy of it
cloudpickle.register_pickle_by_value(sys.modules[__name__])
