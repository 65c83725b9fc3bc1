"""DataFrame operators: validation, states, dimensions, fact, KPIs, checks."""
