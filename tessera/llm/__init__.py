"""Training-data operators: one module per operator, `contract` holds their queries."""
