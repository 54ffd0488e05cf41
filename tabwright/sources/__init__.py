"""Reading and writing tables, fitted models and the run log."""
