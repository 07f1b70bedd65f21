"""Files, tables and the fixture adapter."""
