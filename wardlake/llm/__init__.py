"""Text-corpus operators for training-data pipelines."""
