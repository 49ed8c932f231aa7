"""Hierarchical discrete codes for item embeddings, built on PySpark DataFrames."""

import sys

from pyspark import cloudpickle

from codeloom.params import (
    EvalParams,
    PrepParams,
    QuantizerParams,
    RunParams,
    TrainParams,
    WeightParams,
)

__all__ = [
    "EvalParams",
    "PrepParams",
    "QuantizerParams",
    "RunParams",
    "TrainParams",
    "WeightParams",
]

# Functions sent to the workers travel with the task, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
