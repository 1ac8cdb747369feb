"""Tallyforge: DataFrame-to-DataFrame building blocks for tallies, rankings, profiles and models on Spark."""
