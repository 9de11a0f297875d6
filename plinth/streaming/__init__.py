"""The package has no streaming operators: every operator is a batch transformation."""
