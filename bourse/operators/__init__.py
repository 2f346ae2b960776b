"""DataFrame operators: bars, silver, price aggregates, gold, quality."""
