"""Column functions: names, classes, addresses, digests, geometry."""
