"""Where batches come from and where files go."""
