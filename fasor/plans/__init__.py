"""End-to-end plans: the folder load, and the queries over the driver's tables."""
