"""Join strategy, ordered numbering, table layouts and the whole pipeline."""
