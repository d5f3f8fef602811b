"""DataFrame-to-DataFrame operators. Nothing here triggers a write."""
