"""Binding of the driver's tables to the attempt model, for checks and benchmarks."""
