"""Plans: bronze, silver, gold and KPI builders composed from operators."""
