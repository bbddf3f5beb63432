"""Lumenfold: applied-modelling data work (profiling, features, metrics, search, scoring) as Spark jobs."""
