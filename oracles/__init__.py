"""The same results in SQL, for checking; no engine code depends on this package."""
