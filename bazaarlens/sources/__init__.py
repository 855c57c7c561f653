from bazaarlens.sources.csv_files import corrupt_rows, read_csv_positional
from bazaarlens.sources.loading import LoadError, Place, load, load_audit, load_plan
from bazaarlens.sources.versions import open_tables

__all__ = ["LoadError", "Place", "corrupt_rows", "load", "load_audit", "load_plan", "open_tables", "read_csv_positional"]
