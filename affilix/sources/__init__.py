"""Reading the inputs and writing the results."""
