"""Annalist: corpus landing, history and reporting jobs on PySpark DataFrames."""

from annalist.session import cut_lineage, session, spread, work_dir

__all__ = ["cut_lineage", "session", "spread", "work_dir"]
