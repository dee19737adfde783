"""The three stages, extract, transform and load, and the run that chains them."""
