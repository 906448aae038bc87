"""Operators of a training-data pipeline over document tables.

Nothing else in the package imports this one.  ``registry.queries()`` and
``registry.oracle_sql()`` are what ``__spark_entry__`` adds when the
subpackage is present.

Functions of this subpackage that run inside tasks travel with the job (by
value), so executors need numpy and pyarrow but no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
