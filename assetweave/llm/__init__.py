"""Training-data operators: ten corpus stages that run as Spark jobs.

Nothing outside this subpackage imports it.
"""
