"""Column-level building blocks (``Column -> Column``, no shuffles)."""
