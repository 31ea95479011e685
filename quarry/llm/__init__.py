"""Operators of a training-data pipeline (packing, filters, dedup, PII, tokens).

Each module holds one operator; ``queries`` registers one query per operator
and ``corpus_pipeline.py`` at the repository top chains five of them.
"""

import sys

from pyspark import cloudpickle

# Function bodies travel with the task, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
