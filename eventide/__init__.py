"""eventide: streaming and batch event analytics expressed as Spark DataFrame plans.

Every operator is a function from DataFrame(s) to a DataFrame. The same function works on a
batch frame and, where Spark allows it, on a streaming frame, so one definition serves both
the table form and the stream form of a query.
"""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# Functions that run inside tasks (Arrow UDFs, mapInPandas, stateful processors) are pickled
# with their code, so executors need no installed copy of this package.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])

from eventide.session import checkpoint_dir, get_session  # noqa: E402

__all__ = ["get_session", "checkpoint_dir"]
