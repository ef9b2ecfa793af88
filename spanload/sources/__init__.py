"""Sources: test tables, raw documents, JSON-lines folders, range files, table specs."""
