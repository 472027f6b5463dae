"""Sources and sinks: snapshot parts, vector shards, ledgers."""
