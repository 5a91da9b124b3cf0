"""Continuous loads: the operators inside ``foreachBatch``."""
