"""Reading and writing files, tables and nested payloads."""
