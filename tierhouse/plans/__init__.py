"""Layer builds put together from the operators, and the jobs that run them."""
