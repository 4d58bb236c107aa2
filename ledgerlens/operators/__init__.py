"""DataFrame-to-DataFrame operators: quality, silver, gold, analytics and alert rules."""
