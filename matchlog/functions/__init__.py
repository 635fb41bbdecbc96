"""Column expressions: charset decode, framing, the rule pack, enrichment."""
