"""Composite data products (H), the driver-table stand-ins and the
registered checks (Spark query + oracle SQL per operator)."""
