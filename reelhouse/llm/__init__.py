"""Training-data operators over documents, pages and vectors.

Nothing else in the library imports this package."""
