"""Point-in-time customer propensity analytics as Spark DataFrame plans."""
