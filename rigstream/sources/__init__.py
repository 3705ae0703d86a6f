"""Message sources, the offset ledger and keyed tables."""
