"""Jobs built from the operators: ingest, backfill and answering requests."""
