"""Analytics over a registry of companies, as Spark plans."""
