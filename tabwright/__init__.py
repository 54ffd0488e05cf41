"""Customer-table preparation and binary-outcome modelling on Spark."""
