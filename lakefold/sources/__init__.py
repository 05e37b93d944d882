"""Sources: Bronze file readers, the versioned Silver store, registration."""
