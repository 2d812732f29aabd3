"""Operators of a training-data pipeline.

One module per operator; ``queries`` registers them and ``corpus_pipeline.py`` at
the repository top chains five of them. Nothing outside this subpackage imports it.

Functions that run in Python workers travel with the job, so executors need the
installed libraries but no copy of this package.
"""
import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
