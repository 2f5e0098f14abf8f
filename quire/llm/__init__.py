"""Training-data operators. Nothing outside this folder imports it (the entry module does so behind a guard)."""
