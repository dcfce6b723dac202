"""The airline model: staging, warehouse, older star schema, metrics, quality rules, forecast."""
