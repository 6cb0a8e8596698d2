"""Where spans, prices, toggles, registries and texts come from."""
