"""The measures. Each plan takes tables and periods and returns one lazy row per period."""
