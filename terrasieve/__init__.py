"""Registry geocoding and location-quality operators for PySpark."""
