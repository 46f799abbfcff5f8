"""Incremental runs of the batch operators over arriving files.

The surveyed workload has no streams; what it does have is stage-by-stage
ETL over files. ``micro_batch`` runs one of the batch operators on each
micro-batch of a file stream and appends the result to a stage table.
"""

from tessera.streaming.micro_batch import run_incremental

__all__ = ["run_incremental"]
