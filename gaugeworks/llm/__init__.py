"""Operators that prepare a text corpus for training; nothing else in the library imports them.

Every operator takes and returns DataFrames and keeps the columns it does not own, so it can be
used alone or as a stage of ``corpus_pipeline``. Python that runs inside tasks is pickled by
value: executors need the listed packages, but not this one.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
