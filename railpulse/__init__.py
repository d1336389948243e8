"""Transit-event analytics on Spark: snapshots and timetables in, ARR/DEP events out."""

__version__ = "0.1.0"
