"""DataFrame operators: filters, projections, lookups, aggregates, ordering, unions."""
