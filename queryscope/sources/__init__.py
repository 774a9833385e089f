"""Sources (driver tables, fixture adapters, daily shards) and sinks."""
