"""gazetta: a PySpark engine for curated listing feeds."""
