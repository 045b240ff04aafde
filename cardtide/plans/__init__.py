"""Complete analyses: input path to report path."""
