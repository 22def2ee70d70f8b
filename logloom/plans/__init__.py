"""Jobs that chain the operators: structure, ingest, vectorize, train."""
