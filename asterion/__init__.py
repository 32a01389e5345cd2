"""asterion: small-body survey analytics as lazy Spark DataFrame jobs."""
