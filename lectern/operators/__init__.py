"""DataFrame operators over documents, catalogs, positions and ledgers."""
