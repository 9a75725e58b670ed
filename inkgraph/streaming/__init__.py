"""Per-row analyses over streams of incoming texts."""
