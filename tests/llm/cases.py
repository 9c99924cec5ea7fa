"""Shared by the tests of the corpus operators."""

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(texts, source="s"):
    return [(i, t, "en", source, len(t or "")) for i, t in enumerate(texts)]
