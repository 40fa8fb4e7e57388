"""cadenza: layered (raw, silver, gold) analytics as DataFrame operators on Spark."""
