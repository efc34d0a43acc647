"""Operators for preparing training text, each a Spark job over the whole table.

Nothing outside this folder imports it, ``corpus_pipeline.py`` apart.
"""

import sys

from pyspark import cloudpickle

# Functions of this folder travel to the executors with their code, so that a
# cluster needs no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
