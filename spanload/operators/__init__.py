"""DataFrame operators: splits, chunks, cleaning, conformance, export, publish."""
