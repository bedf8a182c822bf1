"""Readers and writers."""
from .files import load_meta, read_daily, read_events, read_predictions, read_table, save_meta, write_table

__all__ = ["load_meta", "read_daily", "read_events", "read_predictions", "read_table", "save_meta", "write_table"]
