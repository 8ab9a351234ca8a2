"""Sources: landing CSV scans, fingerprints, lineage, test-data views, generator."""
