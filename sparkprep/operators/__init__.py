"""DataFrame-in, DataFrame-out operators (lazy; no driver-side collects)."""
