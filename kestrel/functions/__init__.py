"""Column builders: scalar helpers (``columns``) and business rules (``rules``)."""
