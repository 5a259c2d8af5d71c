"""Reading and landing documents, file listings, and the tables on disk."""
