"""Complete reports and scorings composed from the operators."""
