"""Table writes, batches with a file ledger, audit columns and the run log."""
