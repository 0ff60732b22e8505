"""Plans over the driver's tables: the query catalogue and its SQL oracles."""
