"""End-to-end jobs composed from the other packages."""
