"""Entity-register harmonisation, resolution and data cleaning on Spark."""
