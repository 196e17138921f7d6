"""medstar — a clinical-document warehouse written as plain PySpark jobs.

Documents (HL7 v3 XML) are read whole, header and patient fields are
extracted with one parse per document, kept in a versioned wide table with
cell-level last-write-wins, flattened to a patient fact, joined to
dimensions and pre-aggregated into time-segmented cubes.
"""

__version__ = "0.1.0"

import logging as _logging
import sys as _sys

try:
    # Ship the package's functions by value with every Python UDF, so
    # executors need no installed copy of it.
    from pyspark.cloudpickle import register_pickle_by_value as _by_value
    _by_value(_sys.modules[__name__])
except (ImportError, AttributeError) as _e:
    _logging.getLogger(__name__).warning(
        "functions are not shipped by value (%s): executors need medstar installed", _e)
