"""Ready-made plans that apply operators to the test tables."""
