"""Writers: snapshots, change tables, prediction batches, messages, cached history."""
