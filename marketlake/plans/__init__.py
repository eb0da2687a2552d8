"""Composite jobs: marts (C01–C16), ingest flows (C17–C32) and the registered
queries over the driver tables."""
