"""DataFrame operators: coverage, layer joins, aggregates, legends."""
