"""Jobs: the operators in order, with staging, publishing and error handling."""
