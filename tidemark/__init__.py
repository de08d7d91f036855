"""Snapshot history on Spark: dated workbooks in, a checked history out."""

import sys

from pyspark import cloudpickle

from tidemark.contract import Contract, load_contract
from tidemark.errors import ContractError, QualityGateError, TidemarkError
from tidemark.plans.job import JobResult, run_job

# The workbook reader runs in Python workers. Its functions are sent by value, so the
# executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = [
    "Contract",
    "ContractError",
    "JobResult",
    "QualityGateError",
    "TidemarkError",
    "load_contract",
    "run_job",
]
