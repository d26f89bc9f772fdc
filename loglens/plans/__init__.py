"""Plan building blocks shared by the operators (scans, as-of lookups)."""
