"""Market-tick analytics on Spark: DataFrame-in, DataFrame-out building blocks.

Batch and streaming code share the same functions; the ``streaming`` package only
adds sources, triggers, checkpoints and sinks around them.
"""

__version__ = "0.1.0"
