"""The test tables seen as customer datasets, and every registered query with its SQL."""
