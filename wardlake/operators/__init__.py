"""wardlake operators."""
