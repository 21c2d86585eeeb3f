"""Streaming.

The reference's three jobs are batch reports over snapshots: no watermark, window, state
store, change capture or incremental load occurs in it, so this package defines no
streaming operator. The report plans are plain DataFrames and can be applied to each
micro-batch of a ``foreachBatch`` sink if a caller needs that.
"""
