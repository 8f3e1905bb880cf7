"""Operators for the preparation of large text corpora.

One module per operator; ``queries`` registers one query for each, with its SQL where
SQL can say it.  Nothing outside this package imports it.

Functions that run in Python workers travel by value, so executors need no copy of this
package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
