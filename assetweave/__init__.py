"""A Spark engine for content-addressed asset tables, and operators for training corpora."""
