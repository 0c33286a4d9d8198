"""Rivulet: table snapshots and change-data capture as Spark plans."""

__version__ = "0.1.0"
