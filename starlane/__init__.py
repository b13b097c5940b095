"""starlane: a quality gate and star-schema engine for delivery data on Spark."""
