"""Prices of the outside services."""

# Service, list price of 1,000 calls, free calls a month, usual share of a dry run's requests.
SERVICES = [("geocoding", 5.0, 10_000, 0.86), ("place_details_pro", 17.0, 5_000, 0.46)]
