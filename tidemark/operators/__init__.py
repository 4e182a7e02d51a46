"""Table-level operators: joins, aggregates, ordering, reshaping, versions, quality."""
