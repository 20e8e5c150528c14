"""Loaders, sinks, catalogue registration and dataset profiling."""
