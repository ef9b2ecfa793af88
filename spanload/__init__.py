"""spanload — a Spark-native toolkit for loading large document tables.

A table is split into contiguous key ranges (chunks), its documents are
cleaned and conformed to a declared schema, exported as size-bounded
compressed JSON-lines parts and published through a staging area.  Every
step is a DataFrame job; only range tables, offsets and report rows ever
reach the driver.
"""

from spanload.session import build_session, scratch_path

__all__ = ["build_session", "scratch_path"]
