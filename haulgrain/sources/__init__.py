"""Reading, landing, lineage and publishing."""
