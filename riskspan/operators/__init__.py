"""DataFrame -> DataFrame operators: joins, filters, aggregates, statistics."""
