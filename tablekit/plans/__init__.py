"""Query plans over the driver's tables, each paired with an oracle SQL text."""
