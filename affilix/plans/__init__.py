"""The two jobs, put together from the operators."""
