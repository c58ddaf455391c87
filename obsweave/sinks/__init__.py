"""Where data goes: the upserted Parquet table, JSON lines, Arrow, several sinks at once."""
