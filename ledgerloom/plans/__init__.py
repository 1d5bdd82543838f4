"""Layer plans: bronze, silver, gold, and the backfill over a calendar."""
