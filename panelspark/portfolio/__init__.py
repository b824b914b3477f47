"""Portfolio construction and factor evaluation over a long factor store (factor, entity, dt, value): many factors in one job."""
