"""Panel and time-series decision analytics as PySpark DataFrame operators."""

import sys

from pyspark import cloudpickle

from panelkit.config import Controls, ModelParams, PanelParams

__all__ = ["Controls", "ModelParams", "PanelParams"]

# Functions of this package travel to the executors by value, which need not have it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
