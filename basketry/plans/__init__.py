"""Complete jobs composed from the operators: facts, modeling dataset, profiling, models, drift."""
