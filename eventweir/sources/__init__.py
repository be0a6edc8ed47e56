"""Where envelopes and tables are read from."""
