"""The jobs: source tables, silver, gold, serving and the daily runs."""
