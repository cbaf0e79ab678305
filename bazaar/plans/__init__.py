"""Query catalogue and stage runner."""
