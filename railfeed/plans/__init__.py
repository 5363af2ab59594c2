"""Jobs over the raw, kept and modelled layers, and the run ledger."""
