"""Complete jobs composed of the operators: prepare, rebase, synthesize and validate."""
