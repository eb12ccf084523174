"""Column-expression helpers (pure functions returning ``Column``)."""
