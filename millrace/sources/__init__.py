"""Reading raw exports and publishing results."""
