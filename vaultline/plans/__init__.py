"""Layer models (structured, curated, access) and the end-to-end run."""
