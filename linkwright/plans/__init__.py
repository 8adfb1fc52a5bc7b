"""End-to-end jobs and their bindings to the star-schema tables."""
