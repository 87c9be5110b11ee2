"""Monthly trip files: listing, footers, signature check, drift-safe reading."""
