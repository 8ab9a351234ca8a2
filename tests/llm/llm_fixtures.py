"""Small tables for the operator tests (the session comes from tests/conftest.py)."""

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def make_docs(session, texts):
    """Rows of the documents table from a list of texts (ids by position) or (id, text) pairs."""
    pairs = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
    return session.createDataFrame([(i, t, "en", "src0", None if t is None else len(t)) for i, t in pairs], DOC_SCHEMA)
