"""Operators for preparing training text: filtering, de-duplication, tokens, formatting."""

from pyspark import cloudpickle

import presslake

# Python workers get the operators with the task; executors need no install.
cloudpickle.register_pickle_by_value(presslake)
