"""popflow: synthetic-population preparation, re-basing, synthesis and validation on Spark."""
